"""Helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import gridmill

#: A word of a text: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


#: Bytes of rows that a task hands to Python at a time.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Keep what Python holds of a task small, also where texts are long."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.conf.get(name)
    if not held.rstrip("bB").isdigit() or not 0 < int(held.rstrip("bB")) <= BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    gridmill.ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder that driver and executors share.

    It lies in ``spark.checkpoint.dir`` when the session has that setting; only
    sessions without it (tests on one machine) get a folder of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"/tmp/checkpoints/{os.getuid()}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def keep(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back: cuts lineage, and survives lost executors."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that no later plan reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder, for tasks that write their own files."""
    return pafs.FileSystem.from_uri(path)


def parts_of(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in stretches of rows whose texts have about ``size`` bytes (a longer text
    alone), so that arrays made of them stay small."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
        yield batch.slice(at, end - at)
        at = end


def text_hash(text: str = "text") -> Column:
    """With the document id, a row's identity: rows equal in both are copies."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())


def row_hash(text: str = "text") -> Column:
    """A row's identity in one number; rows with the same id and text share it."""
    return F.xxhash64(F.col("doc_id"), F.col("doc_id").isNull(), text_hash(text))


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; a null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column in a row, and where each text starts (and the last ends).
    Nulls are empty."""
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = column.fill_null(b"" if kind == pa.large_binary() else "").cast(kind)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def windows(flat: np.ndarray, offsets: np.ndarray, cuts: Callable[[np.ndarray, int, int], np.ndarray], size: int) -> Iterator[tuple[int, int]]:
    """Stretches of ``size`` bytes or somewhat more, each ending where a text does or where
    ``cuts`` (of the bytes, for a range) allows it, so that long texts pass in parts."""
    at = 0
    while at < len(flat):
        end, step = at + size, 1 << 16
        while end < len(flat):
            place = offsets[np.searchsorted(offsets, end)]  # the next text's start
            found = np.flatnonzero(cuts(flat, end, min(end + step, len(flat))))
            if len(found) or place <= end + step:
                end = min(place, end + found[0] if len(found) else place)
                break
            end += step
        end = min(end, len(flat))
        yield at, int(end)
        at = int(end)


def numbered_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The different words of all texts (A-Z lowered, cut at ASCII white space), the number
    of each word in a row, and how many each text has."""
    low = pc.ascii_trim_whitespace(pc.ascii_lower(texts.fill_null("")))
    cut = pc.ascii_split_whitespace(low)
    counts = np.diff(cut.offsets.to_numpy())
    coded = cut.flatten().dictionary_encode()
    order = coded.indices.to_numpy()
    empty = pc.equal(pc.binary_length(low), 0).to_numpy(zero_copy_only=False)
    if empty.any():  # a text without words is cut into one empty word
        order = order[np.repeat(~empty, counts)]
        counts = np.where(empty, 0, counts)
    return coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist(), order, counts.astype(np.int64)


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all texts' words in a row, and how many each text has."""
    words, order, counts = numbered_words(texts)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return hashes[order], counts


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A task's function that gives its freed memory back when it ends. Workers live on
    beside the next ones, and would keep what their largest arrays took."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):
            pass  # another C library: nothing to ask

    return run


def marks(keys: DataFrame, key: str, log_bits: int = 24) -> Broadcast:
    """A bitmap of 2**log_bits places with the places of 64-bit hashes marked: 2 MB, whatever
    their number. More hashes only make it let more through."""
    place = F.col(key).bitwiseAND(F.lit((1 << log_bits) - 1)) + 1
    parts = keys.select(place.alias("place")).groupBy(F.expr("bitmap_bucket_number(place)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits"))
    out = bytearray(1 << (log_bits - 3))
    for row in parts.collect():  # 2 MB at most, in one job instead of one a partition
        at = (row["bucket"] - 1) * 4096
        out[at : at + len(row["bits"])] = row["bits"]
    return keys.sparkSession.sparkContext.broadcast(bytes(out))


def marked(rows: DataFrame, key: str, found: Broadcast, yes: bool = True) -> DataFrame:
    """Rows whose hash has its place marked (or, without ``yes``, the others): all that
    match, and some that don't, so that a join has less to shuffle."""
    at = rows.columns.index(key)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(found.value, np.uint8)
        for batch in batches:
            place = batch.column(at).to_numpy().view(np.uint64) & np.uint64(len(bits) * 8 - 1)
            hit = (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1
            yield batch.filter(pa.array(hit.astype(bool) if yes else ~hit.astype(bool)))

    return rows.mapInArrow(tidy(test), rows.schema)


def held_in_fold(doc_id: str, folds: int, fold: int) -> Column:
    """Whether a document lies in the fold crc32(id as text) mod ``folds``; null ids are text ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == fold
