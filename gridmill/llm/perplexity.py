"""Interpolated modified Kneser-Ney model of word pairs, and its scores.

Counting: each task numbers nothing, it hashes words (64 bits) and collapses its
pairs of neighbouring words, with the start of a text as a word of its own. The
collapsed pairs go to a bucket by their first word (by the second for first words that
are over a thousandth of all), as blocks of sorted, compressed columns; a bucket adds them up and writes its pairs as one sorted hash array with
its counts. What a word is as a context (how often, with how many different next
words, seen once, twice or more often) and as a continuation is summed per word.

Scoring: workers map the arrays into memory and look up a batch's different pairs in
sorted order, so that an array is read front to back. The model never enters the
driver or a broadcast; what a worker holds of it is page cache.

A pair's key is 40 bits of each word's hash, a word's own key all 64. Two words that share
40 bits share what they are as contexts and continuations: of a million words that is
under one pair in the mean, of a billion some 450,000, by which much the sum of p may
differ from 1 after those.

    p(w | v) = max(c(vw) - D, 0) / c(v.) + g(v) p(w)
    p(w)     = max(n(.w) - D', 0) / n(..) + g' / (V + 1)

with D by count 1, 2, 3 and more from the counts of counts, n(.w) the number of
different words before w. Words never seen have the last term alone. After a context
never seen p(w) holds.

Order 2 is what the disk allows for: different triples are four fifths of all words
of such a corpus, so that counting them would write several times the input.

Defined cases: a null text is empty, and is its end alone; null ids are text '' for
the fold and score like any; repeated rows count and score each; without training
rows every word is unknown; an empty table gives an empty result; only the id and
the text are read.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.llm.common import filesystem, hashed_words, held_in_fold, keep, scratch, table, tidy

FOLDS, HELD_OUT = 7, 2
START, END = b" <s>", b" </s>"  # no words: they hold a blank
#: Words of training text a bucket is made for; a bucket's pairs stay in one task's memory.
BUCKET_BYTES = 12 << 20
#: Words that a task holds before it passes their counts on.
STRETCH = 3_000_000
_U = np.uint64
_CODEC = "zstd"


def _hash(word: bytes) -> np.uint64:
    return _U(xxhash.xxh3_64_intdigest(word))


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all texts' words, each text's end behind them, and the texts' lengths."""
    words, counts = hashed_words(texts)
    sizes = counts + 1
    h = np.full(int(sizes.sum()), _hash(END), np.uint64)
    inner = np.ones(len(h), bool)
    inner[np.cumsum(sizes) - 1] = False
    h[inner] = words
    return h, sizes


def _contexts(h: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    before = np.concatenate([h[:1], h[:-1]])
    before[np.cumsum(sizes) - sizes] = _hash(START)
    return before


def _signed(x: np.uint64) -> int:
    return int(np.array([x], np.uint64).view(np.int64)[0])


def _pair_parts(before: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """40 bits of each word: the first's and 24 of the second's, and the second's other 16."""
    a, b = before >> _U(24), h >> _U(24)
    return (a << _U(24)) | (b >> _U(16)), b & _U(0xFFFF)


def _pair_keys(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    x = (high ^ (low * _U(0x9E3779B97F4A7C15))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(32))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(29))


def _add_up(high: np.ndarray, low: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((low, high))
    high, low, counts = high[order], low[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])])) if len(high) else np.zeros(0, np.int64)
    return high[first], low[first], np.add.reduceat(counts, first) if len(first) else counts


def _packed(high: np.ndarray, low: np.ndarray, counts: np.ndarray) -> bytes:
    """Columns of sorted pairs, byte by byte, so that what repeats lies together."""
    planes = [np.ascontiguousarray(x.astype(t).view(np.uint8).reshape(len(x), -1).T).tobytes() for x, t in ((high, "<u8"), (low, "<u2"), (counts, "<u4"))]
    return pa.Codec(_CODEC).compress(b"".join(planes), asbytes=True)


def _unpacked(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = np.frombuffer(pa.Codec(_CODEC).decompress(data, 14 * n, asbytes=True), np.uint8)
    cut = [0, 8 * n, 10 * n, 14 * n]
    high, low, counts = (np.ascontiguousarray(raw[a:b].reshape(-1, n).T).view(t)[:, 0] for a, b, t in zip(cut, cut[1:], ("<u8", "<u2", "<u4")))
    return high, low.astype(np.uint64), counts.astype(np.int64)


def _bucket(high: np.ndarray, low: np.ndarray, log_buckets: int, hot: np.ndarray) -> np.ndarray:
    """A pair's bucket goes by its first word; pairs of the ``hot`` first words by the second."""
    if not log_buckets:
        return np.zeros(len(high), np.int64)
    second = (((high & _U(0xFFFFFF)) << _U(16)) | low) * _U(0x9E3779B97F4A7C15)
    return (np.where(np.isin(high >> _U(24), hot), second, high) >> _U(64 - log_buckets)).astype(np.int64)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a stretch of texts, with their counts."""
    held, size = [], 0
    for batch in batches:
        held.append(tokens(batch.column(0))[0])
        size += len(held[-1])
        if size > STRETCH:
            yield _counted(held)
            held, size = [], 0
    if held:
        yield _counted(held)


def _counted(held: list[np.ndarray]) -> pa.RecordBatch:
    words, counts = np.unique(np.concatenate(held), return_counts=True)
    return pa.record_batch([pa.array(words.view(np.int64)), pa.array(counts, pa.int64())], names=["word", "count"])


def _collapse(log_buckets: int, hot: np.ndarray):
    """Pairs of a stretch of texts, collapsed: a row for each bucket."""

    def rows(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        high, low, n = _add_up(*(np.concatenate(x) for x in zip(*held)))
        buckets = _bucket(high, low, log_buckets, hot)
        order = np.argsort(buckets, kind="stable")
        high, low, n = high[order], low[order], n[order]
        edges = np.searchsorted(buckets[order], np.arange((1 << log_buckets) + 1))
        blocks = [(b, int(y - x), _packed(high[x:y], low[x:y], n[x:y])) for b, (x, y) in enumerate(zip(edges, edges[1:])) if y > x]
        return pa.record_batch([pa.array([b for b, _, _ in blocks], pa.int32()), pa.array([x for _, x, _ in blocks], pa.int64()), pa.array([x for _, _, x in blocks], pa.binary())], names=["bucket", "pairs", "block"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            h, sizes = tokens(batch.column(0))
            high, low = _pair_parts(_contexts(h, sizes), h)
            held.append(_add_up(high, low, np.ones(len(h), np.int64)))
            size += len(h)
            if size > STRETCH:
                yield rows(held)
                held, size = [], 0
        if held:
            yield rows(held)

    return count


def _merge(folder: str):
    """Adds a bucket's blocks up, writes its arrays, and tells what its words are."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for bucket, n, block in zip(*(c.to_pylist() for c in batch.columns)):
                if bucket != at and held:
                    yield from _finish(folder, at, held)
                    held = []
                at = bucket
                held.append(_unpacked(block, n))
        if held:
            yield from _finish(folder, at, held)

    return merge


def _finish(folder: str, bucket: int, held: list) -> Iterator[pa.RecordBatch]:
    high, low, counts = _add_up(*(np.concatenate(x) for x in zip(*held)))
    keys = _pair_keys(high, low)
    order = np.argsort(keys)
    fs, root = filesystem(folder)
    name = f"pairs/{uuid.uuid4().hex}"
    for kind, x in (("keys", keys[order].astype("<u8")), ("counts", counts[order].astype("<u4"))):
        with fs.open_output_stream(f"{root}/{name}.{kind}", compression=None) as sink:
            sink.write(x.tobytes())
    of_counts = [int((counts == k).sum()) for k in (1, 2, 3, 4)]
    none = {k: pa.nulls(1, pa.int64()) for k in ("word", "total", "once", "twice", "more", "before")}
    yield pa.record_batch({"file": pa.array([name]), "bucket": pa.array([bucket], pa.int64()), "size": pa.array([len(keys)], pa.int64()), "of_counts": pa.array([of_counts], pa.list_(pa.int64())), **none})
    # As contexts: sorted by the first word. As continuations: by the second.
    a = (high >> _U(24)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
    sums = [np.add.reduceat(x, first).astype(np.int64) for x in (counts, counts == 1, counts == 2, counts >= 3)]
    b, before = np.unique((((high & _U(0xFFFFFF)) << _U(16)) | low).astype(np.int64), return_counts=True)
    for words, columns in ((a[first], [*sums, np.zeros(len(first), np.int64)]), (b, [*[np.zeros(len(b), np.int64)] * 4, before])):
        n = len(words)
        yield pa.record_batch({"file": pa.nulls(n, pa.string()), "bucket": pa.nulls(n, pa.int64()), "size": pa.nulls(n, pa.int64()), "of_counts": pa.nulls(n, pa.list_(pa.int64())), "word": pa.array(words), **{k: pa.array(c, pa.int64()) for k, c in zip(("total", "once", "twice", "more", "before"), columns)}})


def discounts(n: list[int]) -> tuple[float, float, float]:
    """D for counts of 1, 2, and 3 or more, from how many have counts of 1 to 4."""
    if not n[0] or not n[1]:
        return 0.5, 0.5, 0.5
    y = n[0] / (n[0] + 2 * n[1])
    d = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.5 * k for k in (1, 2, 3)]
    return tuple(min(max(x, 0.05), 0.95 * k) for k, x in enumerate(d, 1))


def _discounted(counts: np.ndarray, d: tuple) -> np.ndarray:
    return np.where(counts == 0, 0.0, np.maximum(counts - np.array([0.0, *d])[np.minimum(counts, 3).astype(np.int64)], 0.0))


_COLUMNS = {"words": "<i8", "counts": "<i8", "context": "<i8", "backed": "<f8", "continued": "<f8"}


def _write_words(folder: str, facts: dict):
    """The words' own hash arrays, sorted by key inside a file: count, what they are as
    contexts (occurrences, and the mass left for p(w)) and the p(w) of the model."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
        if parts:
            word, count, total, once, twice, more, before = map(np.concatenate, zip(*parts))
            d, e = facts["pairs"], facts["words"]
            backed = np.where(total > 0, (d[0] * once + d[1] * twice + d[2] * more) / np.maximum(total, 1), 1.0)
            continued = _discounted(before, e) / facts["kinds"] + facts["rest"]
            own = word.view(np.uint64)
            order = np.argsort(own)
            fs, root = filesystem(folder)
            name = f"words/{uuid.uuid4().hex}"
            for kind, x in zip(_COLUMNS, (own.view(np.int64), count, total, backed, continued)):
                with fs.open_output_stream(f"{root}/{name}.{kind}", compression=None) as sink:
                    sink.write(x[order].astype(_COLUMNS[kind]).tobytes())
            yield pa.record_batch({"file": pa.array([name]), "low": pa.array([int(own[order[0]] >> _U(1))], pa.int64()), "size": pa.array([len(own)], pa.int64())})

    return write


def _mapped(folder: str, name: str, kind: str) -> np.ndarray:
    """An array mapped into memory. Files of a store that can't be mapped are copied to a
    nameless local file first, which goes with the mapping."""
    fs, root = filesystem(f"{folder}/{name}")
    if fs.type_name == "local":
        return np.memmap(root, kind, "r") if os.path.getsize(root) else np.zeros(0, kind)
    with tempfile.TemporaryFile() as local, fs.open_input_stream(root) as source:
        while part := source.read(1 << 24):
            local.write(part)
        local.flush()
        return np.memmap(local, kind, "r")


class Model:
    """A worker's view of the arrays."""

    def __init__(self, folder: str, facts: dict):
        self.facts = facts
        self.folder = folder
        self.pairs = [None] * (1 << facts["log_buckets"])
        self.words = [{k: _mapped(folder, f"{name}.{k}", t) for k, t in _COLUMNS.items()} for name in facts["word_files"]]
        self.lows = np.array([w["words"][0] for w in self.words], np.int64).view(np.uint64)

    def word_rows(self, h: np.ndarray) -> dict[str, np.ndarray]:
        """Facts of sorted different words; absent ones get what unknown words get."""
        out = {"counts": np.zeros(len(h), np.int64), "context": np.zeros(len(h), np.int64), "backed": np.ones(len(h)), "continued": np.full(len(h), self.facts["rest"])}
        edges = np.append(np.searchsorted(h, self.lows), len(h))
        for own, x, y in zip(self.words, edges, edges[1:]):
            keys = own["words"].view(np.uint64)
            at = np.minimum(np.searchsorted(keys, h[x:y]), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == h[x:y])
            for k, values in out.items():
                values[x + hit] = own[k][at[hit]]
        return out

    def pair_counts(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Counts of sorted different pairs."""
        out = np.zeros(len(high), np.int64)
        keys = _pair_keys(high, low)
        buckets = _bucket(high, low, self.facts["log_buckets"], self.facts["hot"])
        by_bucket = np.argsort(buckets, kind="stable")
        edges = np.searchsorted(buckets[by_bucket], np.arange(len(self.pairs) + 1))
        for b, (x, y) in enumerate(zip(edges, edges[1:])):
            name = self.facts["pair_files"].get(b)
            if y == x or name is None:
                continue
            if self.pairs[b] is None:
                self.pairs[b] = _mapped(self.folder, f"{name}.keys", "<u8"), _mapped(self.folder, f"{name}.counts", "<u4")
            own = by_bucket[x:y]
            own = own[np.argsort(keys[own])]
            asked = keys[own]
            held, counts = self.pairs[b]
            at = np.minimum(np.searchsorted(held, asked), len(held) - 1)
            out[own] = np.where(held[at] == asked, counts[at], 0)
        return out

    def log10(self, before: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 p of each word after the one before it, and the words' training counts."""
        known, inverse = np.unique(np.concatenate([h, before]), return_inverse=True)
        of = self.word_rows(known)
        here, prior = inverse[: len(h)], inverse[len(h) :]
        pairs, back = np.unique((prior.astype(np.int64) << 32) | here.astype(np.int64), return_inverse=True)
        high, low = _pair_parts(known[pairs >> 32], known[pairs & 0xFFFFFFFF])
        order = np.lexsort((low, high))
        counts = np.empty(len(pairs), np.int64)
        counts[order] = self.pair_counts(high[order], low[order])
        x, y = pairs >> 32, pairs & 0xFFFFFFFF
        p = _discounted(counts, self.facts["pairs"]) / np.maximum(of["context"][x], 1) + of["backed"][x] * of["continued"][y]
        return np.log10(p)[back], of["counts"][here]


_MODELS: dict[str, Model] = {}


def train(docs: DataFrame, folder: str, text: str = "text") -> dict:
    """Count ``docs`` into arrays under ``folder``; the few facts that open the model."""
    spark = docs.sparkSession
    fs, root = filesystem(folder)
    for kind in ("pairs", "words"):
        fs.create_dir(f"{root}/{kind}", recursive=True)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    log_buckets = max(0, math.ceil(math.log2(max(1, size) / BUCKET_BYTES)))
    words = keep(docs.select(text).mapInArrow(tidy(_word_counts), "word long, count long").groupBy("word").agg(F.sum("count").alias("count")), f"{folder}/counted")
    # Words that are over a thousandth of all: a thousand at most. A bucket is not to hold all pairs of one.
    total = words.agg(F.sum("count")).first()[0] or 0
    hot = [r["word"] for r in words.where(F.col("count") * 1000 > total).select("word").toLocalIterator()]
    hot = np.array(sorted({h >> 24 for h in np.array([*hot, _signed(_hash(START))], np.int64).view(np.uint64).tolist()}), np.uint64)
    blocks = docs.select(text).mapInArrow(tidy(_collapse(log_buckets, hot)), "bucket int, pairs long, block binary")
    blocks = blocks.repartition(1 << log_buckets, "bucket").sortWithinPartitions("bucket")
    merged = keep(blocks.mapInArrow(tidy(_merge(folder)), "file string, bucket long, size long, of_counts array<long>, word long, total long, once long, twice long, more long, before long"), f"{folder}/merged")
    files = merged.where("file IS NOT NULL").select("file", "bucket", "of_counts")
    facts: dict = {"log_buckets": log_buckets, "hot": hot, "pair_files": {}}
    sums = [0, 0, 0, 0]
    for row in files.toLocalIterator():  # a row a bucket
        facts["pair_files"][row["bucket"]] = row["file"]
        sums = [a + b for a, b in zip(sums, row["of_counts"])]
    facts["pairs"] = discounts(sums)
    stats = merged.where("word IS NOT NULL").groupBy(F.col("word").alias("short")).agg(*[F.sum(k).alias(k) for k in ("total", "once", "twice", "more", "before")])
    short = F.shiftrightunsigned("word", 24)
    own = words.unionByName(spark.createDataFrame([(_signed(_hash(START)), 0)], "word long, count long"))
    joined = own.withColumn("short", short).join(stats, "short", "left").fillna(0).drop("short")
    joined = keep(joined.select("word", "count", "total", "once", "twice", "more", "before"), f"{folder}/joined")
    row = joined.agg(F.sum("count").alias("n"), F.count_if(F.col("count") > 0).alias("v"), F.sum("before").alias("kinds"), *[F.count_if(F.col("before") == k).alias(f"n{k}") for k in (1, 2, 3, 4)], F.count_if(F.col("before") >= 3).alias("n3up")).first()
    facts["total"], facts["vocabulary"], facts["kinds"] = row["n"] or 0, row["v"] or 0, max(1, row["kinds"] or 0)
    facts["words"] = e = discounts([row[f"n{k}"] for k in (1, 2, 3, 4)])
    mass = (e[0] * row["n1"] + e[1] * row["n2"] + e[2] * row["n3up"]) / facts["kinds"] if row["kinds"] else 1.0
    facts["rest"] = mass / (facts["vocabulary"] + 1)
    # Keys in unsigned order: files hold ranges of them.
    ranged = joined.repartitionByRange(max(1, facts["vocabulary"] // 500_000), F.col("word").bitwiseXOR(F.lit(-(1 << 63))))
    written = keep(ranged.mapInArrow(tidy(_write_words(folder, facts)), "file string, low long, size long"), f"{folder}/files")
    facts["word_files"] = [r["file"] for r in written.orderBy("low").toLocalIterator()]
    return facts


def score(docs: DataFrame, folder: str, facts: dict, text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score and perplexity of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if folder not in _MODELS:
            _MODELS.clear()
            _MODELS[folder] = Model(folder, facts)
        model, spread = _MODELS[folder], facts["total"] + facts["vocabulary"] + 1
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                h, sizes = tokens(part.column(1))
                logs, counts = model.log10(_contexts(h, sizes), h)
                first = np.cumsum(sizes) - sizes
                scores = np.add.reduceat(logs, first)
                base = np.add.reduceat(np.log10((counts + 1) / spread), first)
                known = np.add.reduceat((counts > 0).astype(np.int64), first)
                yield pa.record_batch([part.column(0), pa.array(sizes), pa.array(known), pa.array(np.full(len(sizes), facts["total"], np.int64)), pa.array(base), pa.array(scores), pa.array(10.0 ** (-scores / sizes))], names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text).mapInArrow(tidy(run), f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")


def op2_perplexity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "model")
    facts = train(docs.where(~held_in_fold("doc_id", FOLDS, HELD_OUT)), folder)
    scored = score(docs, folder, facts)
    return scored.select("doc_id", held_in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
