"""Token ids in binary files of patched frame-of-reference blocks.

Texts are range-partitioned and sorted by document id, encoded, and written as
one file a partition. A block holds up to ``BLOCK`` ids: the block's least id is
subtracted, the rest is packed at a width that a percentile of the values
chooses, and the values too wide for it keep their high bits in an exception
list. A footer holds where each block and each document starts, so that one
document's ids can be read without the blocks before it.

File, all little-endian: ``PFOR1`` and three zero bytes; blocks; block offsets (uint64 each); document counts (uint64 each);
trailer of six uint64: number of ids, blocks, documents, offset of the block
index, of the document index, block length. A block: uint32 count, least id,
uint8 width, uint32 exceptions; packed bits; exception places (uint16); their
high bits (uint32).

A task writes under a name of its own and its row in the manifest names that file,
so that files of failed or repeated attempts are never read.

Words between ASCII white space are encoded once per worker and remembered: the
tokenizer's vocabulary file drops white space and never joins across it, which a
test holds against encoding whole texts. Arrow splits and numbers a batch's words, so
that Python sees its different ones only. A vocabulary file of another kind gets whole
texts.

Defined cases: a null text is empty and has the end id alone; null ids come first;
rows equal in id are ordered by text; an id may have any type that Arrow writes and Spark orders; an empty table writes no file; columns
other than the id and the text are not read.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmill.llm.common import filesystem, keep, parts_of, scratch, table, tidy

VOCABULARY = "word_bpe_49k.json"
END = 1
BLOCK = 4096
PERCENTILE = 0.95
MAGIC = b"PFOR1\0\0\0"
_BLOCK_HEAD = struct.Struct("<IIBI")
_TRAILER = struct.Struct("<6Q")
#: Words a worker remembers; beyond that it starts anew.
REMEMBERED = 500_000
#: Bytes of texts that are encoded together.
PART_BYTES = 2 << 20
# What a vocabulary file must say of texts for its words to be encoded one by one.
WORD_WISE = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}
_SIGNS_BEHIND = (r"([a-z0-9])([!-/:-@\[-`{-~]+)([\x20\x09-\x0d]|$)", r"\1 \2\3")
_ENCODERS: dict[str, Encoder] = {}


class _Rows(dict):
    """Numbers words as they are first seen, and lists the new ones."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = k = len(self)
        self.new.append(word)
        return k


def goes_by_words(path: str) -> bool:
    """Whether the vocabulary file lower-cases, drops white space, and cuts letters,
    single digits and other signs apart, so that words can be encoded one by one."""
    with open(path, encoding="utf-8") as source:
        held = json.load(source)
    return all(held.get(k) == v for k, v in WORD_WISE.items())


class Encoder:
    """Encodes texts word by word, with a memory of bounded size; texts that name one of
    the file's special tokens, and all texts under a file of another kind, as a whole."""

    def __init__(self, path: str):
        os.environ["RAYON_NUM_THREADS"] = "1"
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [x.content.lower() for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.by_words = goes_by_words(path)
        self._forget()

    def _forget(self) -> None:
        self.rows = _Rows()
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and each text's number of ids."""
        texts = texts.fill_null("")
        low = pc.ascii_lower(texts)
        whole = np.full(len(texts), not self.by_words)
        for name in self.special:
            whole |= pc.match_substring(low, name).to_numpy(zero_copy_only=False).astype(bool)
        if not whole.any():
            return self._words(low)
        ids, counts = self._words(pc.if_else(pa.array(whole), "", low))
        parts, ends = np.split(ids, np.cumsum(counts)[:-1]), counts.copy()
        for k in np.flatnonzero(whole).tolist():
            parts[k] = np.array(self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids, np.uint32)
            ends[k] = len(parts[k])
        return np.concatenate(parts), ends

    def _words(self, low: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.rows) > REMEMBERED:
            self._forget()
        # Signs behind a word are a token run of their own: cut off, fewer words differ.
        words = pc.ascii_split_whitespace(pc.replace_substring_regex(low, *_SIGNS_BEHIND))
        counts = np.diff(words.offsets.to_numpy())
        coded = words.flatten().dictionary_encode()
        known = np.fromiter(map(self.rows.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False)), np.int64, len(coded.dictionary))
        if self.rows.new:
            self._learn(self.rows.new)
            self.rows.new = []
        order = known[coded.indices.to_numpy()] if len(known) else known
        sizes = self.sizes[order]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[order] - (ends - sizes), sizes) + np.arange(total)] if total else np.zeros(0, np.uint32)
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(edges)

    def _learn(self, new: list[str]) -> None:
        """Encode new words: those of plain letters are one piece to the model, the others
        are joined, and a token's place in the joined text tells its word."""
        sizes, ids = np.zeros(len(new), np.int64), [np.zeros(0, np.uint32)] * len(new)
        model, odd = self.tokenizer.model, []
        for k, word in enumerate(new):
            if word.isascii() and word.isalpha():
                ids[k] = [t.id for t in model.tokenize(word)]
                sizes[k] = len(ids[k])
            else:
                odd.append(k)
        for at in range(0, len(odd), 4096):
            own = odd[at : at + 4096]
            words = [new[k] for k in own]
            encoded = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
            lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
            begins = np.fromiter((x for x, _ in encoded.offsets), np.int64, len(encoded))
            counts = np.bincount(np.searchsorted(np.cumsum(lengths), begins, "right"), minlength=len(words))
            sizes[own] = counts
            for k, part in zip(own, np.split(np.array(encoded.ids, np.uint32), np.cumsum(counts)[:-1])):
                ids[k] = part
        total = int(sizes.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + total] = np.fromiter(chain.from_iterable(ids), np.uint32, total)
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.used += total


def encoder(path: str) -> Encoder:
    """This worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pack_block(ids: np.ndarray) -> bytes:
    least = int(ids.min()) if len(ids) else 0
    above = ids.astype(np.uint32) - np.uint32(least)
    width = int(np.partition(above, k := min(len(above) - 1, int(PERCENTILE * len(above))))[k]).bit_length() if len(ids) else 0
    low = above & np.uint32((1 << width) - 1)
    odd = np.flatnonzero(above >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    bits = ((low[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)).astype(np.uint8)
    return _BLOCK_HEAD.pack(len(ids), least, width, len(odd)) + np.packbits(bits, bitorder="little").tobytes() + odd.astype("<u2").tobytes() + (above[odd] >> np.uint32(width)).astype("<u4").tobytes()


def unpack_block(data: bytes) -> np.ndarray:
    count, least, width, odd = _BLOCK_HEAD.unpack_from(data)
    at = _BLOCK_HEAD.size
    packed = np.frombuffer(data, np.uint8, (count * width + 7) // 8, at)
    bits = np.unpackbits(packed, count=count * width, bitorder="little").reshape(count, width)
    if width <= 16:
        wide = np.zeros((count, 16), np.uint8)
        wide[:, :width] = bits
        out = np.packbits(wide, axis=1, bitorder="little").view("<u2")[:, 0].astype(np.uint32)
    else:
        out = (bits.astype(np.uint32) << np.arange(width, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)
    at += len(packed)
    places = np.frombuffer(data, "<u2", odd, at)
    out[places] |= np.frombuffer(data, "<u4", odd, at + 2 * odd) << np.uint32(width)
    return out + np.uint32(least)


class Writer:
    """Writes one file, block by block."""

    def __init__(self, sink):
        self.sink, self.at = sink, sink.write(MAGIC)
        self.waiting: list[np.ndarray] = []
        self.held, self.ids = 0, 0
        self.offsets: list[int] = []
        self.counts: list[np.ndarray] = []

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append(ids)
        self.held += len(ids)
        self.counts.append(counts)
        if self.held >= BLOCK:
            joined = np.concatenate(self.waiting)
            whole = len(joined) // BLOCK * BLOCK
            for i in range(0, whole, BLOCK):
                self._put(joined[i : i + BLOCK])
            self.waiting, self.held = [joined[whole:]], len(joined) - whole

    def _put(self, ids: np.ndarray) -> None:
        self.offsets.append(self.at)
        self.at += self.sink.write(pack_block(ids))
        self.ids += len(ids)

    def close(self) -> None:
        if self.held:
            self._put(np.concatenate(self.waiting))
        counts = np.concatenate(self.counts) if self.counts else np.zeros(0, np.int64)
        index = self.at
        self.at += self.sink.write(np.array(self.offsets, "<u8").tobytes())
        docs = self.at
        self.sink.write(counts.astype("<u8").tobytes() + _TRAILER.pack(self.ids, len(self.offsets), len(counts), index, docs, BLOCK))


class Reader:
    """Reads a file by its footer."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - _TRAILER.size)
        self.ids, blocks, docs, self.index, at, self.block = _TRAILER.unpack(source.read(_TRAILER.size))
        source.seek(self.index)
        self.offsets = np.append(np.frombuffer(source.read(8 * blocks), "<u8").astype(np.int64), self.index)
        source.seek(at)
        self.counts = np.frombuffer(source.read(8 * docs), "<u8").astype(np.int64)

    def blocks(self) -> Iterator[np.ndarray]:
        for k in range(len(self.offsets) - 1):
            yield self._block(k)

    def _block(self, k: int) -> np.ndarray:
        self.source.seek(int(self.offsets[k]))
        return unpack_block(self.source.read(int(self.offsets[k + 1] - self.offsets[k])))

    def document(self, number: int) -> np.ndarray:
        """One document's ids, from the blocks that hold them alone."""
        start = int(self.counts[:number].sum())
        stop = start + int(self.counts[number])
        first = start // self.block
        parts = [self._block(k) for k in range(first, -(-stop // self.block))]
        return np.concatenate(parts)[start - first * self.block : stop - first * self.block] if parts else np.zeros(0, np.uint32)

    def documents(self) -> Iterator[tuple[int, int, int]]:
        """(start, number of ids, crc32 of the ids) of each document, a block in memory at a time."""
        blocks, held = self.blocks(), np.zeros(0, np.uint32)
        start = 0
        for count in self.counts.tolist():
            left, crc = count, 0
            while left:
                if not len(held):
                    held = next(blocks)
                crc = zlib.crc32(held[:left].astype("<u4", copy=False).tobytes(), crc)
                taken = min(left, len(held))
                held, left = held[taken:], left - taken
            yield start, count, crc
            start += count


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end: int = END, text: str = "text") -> DataFrame:
    """Write ``docs`` in ascending doc_id order; the manifest of files: shard, file,
    bytes, n_ids, n_docs, doc_ids, first_id (ids in the files before it)."""
    fs, root = filesystem(folder)
    fs.create_dir(f"{root}/ids", recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, base = filesystem(folder)
        shard, name, out, doc_ids = TaskContext.get().partitionId(), f"ids/{uuid.uuid4().hex}.pfor", None, []
        for batch in (part for batch in batches for part in parts_of(batch, 1, PART_BYTES)):
            if out is None:
                sink = own.open_output_stream(f"{base}/{name}", compression=None)
                out = Writer(sink)
            ids, counts = encoder(vocabulary).encode(batch.column(1))
            out.add(np.insert(ids, np.cumsum(counts), np.uint32(end)), counts + 1)
            doc_ids.append(pa.array(batch.column(0).to_pylist(), batch.column(0).type))  # a copy, which holds no texts
        if out is not None:
            out.close()
            sink.close()
            size = own.get_file_info(f"{base}/{name}").size
            yield pa.RecordBatch.from_pydict({"shard": [shard], "file": [name], "bytes": [size], "n_ids": [out.ids], "n_docs": [sum(map(len, doc_ids))]})
            # The ids of documents live in the file's own table beside the manifest.
            with own.open_output_stream(f"{base}/{name}.docs", compression=None) as names:
                with pa.ipc.new_file(names, pa.schema([("doc_id", doc_ids[0].type)])) as sheet:
                    for part in doc_ids:
                        sheet.write_batch(pa.record_batch([part], names=["doc_id"]))

    # The start of the text in the ranges keeps its order and lets rows of one id lie in several tasks.
    rows = docs.select("doc_id", F.col(text).alias("text")).repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    manifest = keep(rows.mapInArrow(tidy(write), "shard long, file string, bytes long, n_ids long, n_docs long"), f"{folder}/manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
    return manifest.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, folder: str, kind: str = "bigint") -> DataFrame:
    """doc_id (of the type ``kind``), start, n_tokens, ids_crc32 of every document, from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, base = filesystem(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with own.open_input_file(f"{base}/{row['file']}") as source, own.open_input_file(f"{base}/{row['file']}.docs") as names:
                    found = np.array(list(Reader(source, row["bytes"]).documents()), np.int64).reshape(-1, 3)
                    doc_ids = pa.ipc.open_file(names).read_all()["doc_id"].combine_chunks()
                for at in range(0, len(found), 50_000):
                    part = found[at : at + 50_000]
                    yield pa.record_batch([doc_ids.slice(at, 50_000), pa.array(part[:, 0] + row["first_id"]), pa.array(part[:, 1]), pa.array(part[:, 2])], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = manifest.select("file", "bytes", "first_id").repartition(manifest.sparkSession.sparkContext.defaultParallelism * 2)
    return spread.mapInArrow(tidy(read), f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenize_documents(docs: DataFrame, vocabulary: str | None = None, end: int = END) -> DataFrame:
    """Write the files, read them back."""
    folder = scratch(docs.sparkSession, "tokens")
    written = write_token_files(docs, folder, vocabulary or vocabulary_path(), end)
    return read_token_files(written, folder, docs.schema["doc_id"].dataType.simpleString())


def op4_tokens(spark, sf_dir: str) -> DataFrame:
    return tokenize_documents(table(spark, sf_dir, "documents"))
