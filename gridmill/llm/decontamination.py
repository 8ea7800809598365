"""Benchmark decontamination with a generalised suffix automaton.

Test items become word sequences (A-Z lowered, everything but digits, letters
and non-ASCII separates words) and are put into one suffix automaton. Texts are
streamed through it: each word moves the automaton along, and the longest suffix
that occurs in some item is known at every word. Where that length reaches
``window`` words, or the whole of a shorter item, the words are hit.

Words are numbered, and pairs of neighbouring words that occur in no item are
told apart with array operations first; the automaton then walks only stretches
long enough to hold a window, which leaves its answers unchanged.

The benchmark is taken in blocks of about ``BLOCK_WORDS`` words, an automaton each (some
300 MB in a worker, which holds one at a time). One block is the usual case: texts are
read once and never shuffle. More blocks take a pass over the texts each, and what they
hit is joined by row, so that no broadcast grows with the benchmark.

Defined cases: a null text or item has no words; repeated items count by their
ids once each; repeated rows are handled alike; an empty benchmark hits nothing;
an item whose id is null is named ``null``; other columns of documents are carried.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.llm.common import keep, row_hash, scratch, table, tidy, utf8

WINDOW = 10
BLOCK_WORDS = 300_000
#: A document loses its spans; beyond this share of hit words it goes as a whole.
MAX_COVERAGE = 0.5
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_RUN = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        return -1


class Automaton:
    """Suffix automaton of several word sequences."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window, self.numbers = window, _Numbers()
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.shortest = window
        ends: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        pairs = set()
        for name, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers)) for w in words_of(text)]
            if not ids:
                continue
            self.shortest = min(self.shortest, len(ids))
            pairs.update(zip(ids, ids[1:]))
            at = 0
            for x in ids:
                at = self._extend(at, x)
        # States are final only now: clones move strings between them.
        for name, text in items:
            ids, at = [self.numbers[w] for w in words_of(text)], 0
            for x in ids:
                at = self.step[at][x]
                ends.setdefault(at, set()).add(name)
            if 0 < len(ids) < window:
                self.short.setdefault(at, []).append((len(ids), name))
        self.items = [frozenset()] * len(self.link)
        gathered: list[set[str]] = [set() for _ in self.link]
        for state, names in ends.items():
            gathered[state] |= names
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.length[state] >= window:
                self.items[state] = frozenset(gathered[state])
                if self.length[self.link[state]] >= window:
                    gathered[self.link[state]] |= gathered[state]
        self.words = max(1, len(self.numbers))
        self.pairs = np.array(sorted(a * self.words + b for a, b in pairs), np.int64)

    def _extend(self, last: int, x: int) -> int:
        step, link, length = self.step, self.link, self.length
        if x in step[last]:
            old = step[last][x]
            return old if length[old] == length[last] + 1 else self._split(last, x, old)
        new = len(link)
        step.append({}), link.append(0), length.append(length[last] + 1)
        at = last
        while at >= 0 and x not in step[at]:
            step[at][x] = new
            at = link[at]
        if at >= 0:
            old = step[at][x]
            link[new] = old if length[old] == length[at] + 1 else self._split(at, x, old)
        return new

    def _split(self, at: int, x: int, old: int) -> int:
        copy = len(self.link)
        self.step.append(dict(self.step[old])), self.link.append(self.link[old]), self.length.append(self.length[at] + 1)
        while at >= 0 and self.step[at].get(x) == old:
            self.step[at][x] = copy
            at = self.link[at]
        self.link[old] = copy
        return copy

    def walk(self, ids: list[int]) -> Iterator[tuple[int, int, set[str]]]:
        """(end, words hit up to there, items) of each place where a window ends."""
        at = size = 0
        for end, x in enumerate(ids):
            while at and x not in self.step[at]:
                at = self.link[at]
                size = self.length[at]
            if x in self.step[at]:
                at, size = self.step[at][x], size + 1
            else:
                at = size = 0
            reach, names = 0, set()
            if size >= self.window:
                reach, top = self.window, at
                while self.length[self.link[top]] >= self.window:
                    top = self.link[top]
                names |= self.items[top]
            if self.short:
                up = at
                while up > 0:
                    for k, name in self.short.get(up, ()):
                        if k <= size:
                            reach = max(reach, k)
                            names.add(name)
                    up = self.link[up]
            if reach:
                yield end, reach, names

    def matches(self, texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, dict[int, set[str]]]:
        """Hit flags of all words of all texts, where each text starts, items by text."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        starts = np.concatenate([[0], np.cumsum(sizes)])
        hit, items = np.zeros(starts[-1], bool), {}
        if not len(self.numbers) or not starts[-1]:
            return hit, starts, items
        ids = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(texts)), np.int64, starts[-1])
        known = ids >= 0
        if self.shortest == 1:
            run = known
            first_of = np.zeros(len(ids), bool)
            first_of[starts[:-1][sizes > 0]] = True
            begins = np.flatnonzero(run & (first_of | ~np.concatenate([[False], run[:-1]])))
            stops = np.flatnonzero(run & (np.concatenate([first_of[1:], [True]]) | ~np.concatenate([run[1:], [False]]))) + 1
        else:
            good = known[:-1] & known[1:]
            inner = starts[1:-1]
            inner = inner[(inner > 0) & (inner < len(ids))]
            good[inner - 1] = False  # a pair never spans two texts
            where = np.flatnonzero(good)
            keys = ids[where] * self.words + ids[where + 1]
            at = np.searchsorted(self.pairs, keys)
            good[where] = (self.pairs[np.minimum(at, len(self.pairs) - 1)] == keys) if len(self.pairs) else False
            edge = np.diff(np.concatenate([[0], good.astype(np.int8), [0]]))
            begins, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + 1
        long = stops - begins >= self.shortest
        for begin, stop in zip(begins[long].tolist(), stops[long].tolist()):
            for end, reach, names in self.walk(ids[begin:stop].tolist()):
                hit[begin + end + 1 - reach : begin + end + 1] = True
                items.setdefault(int(np.searchsorted(starts, begin, "right")) - 1, set()).update(names)
        return hit, starts, items


class Block:
    """Items of at most about ``block_words`` words, broadcast as texts; a worker builds their
    automaton when it first needs it, and holds one at a time."""

    _built: dict[str, Automaton] = {}

    def __init__(self, spark: SparkSession, items: list[tuple[str, bytes]], window: int):
        self.key, self.window, self.items = uuid.uuid4().hex, window, spark.sparkContext.broadcast(items)

    def scan(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, dict[int, set[str]]]:
        if self.key not in self._built:
            self._built.clear()
            self._built[self.key] = Automaton(self.items.value, self.window)
        return self._built[self.key].matches([words_of(t) for t in texts])


def blocks(benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> tuple[int, Iterator[Block]]:
    """How many blocks the different items make, and one after the other of them."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), F.coalesce(F.col("text"), F.lit("")).alias("text")).distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    many = max(1, -(-total // (block_words * 4)))

    def one(b: int) -> Block:
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(many)) == b).toLocalIterator()
        return Block(spark, [(r["item"], r["text"].encode()) for r in rows], window)

    return many, map(one, range(many))


def _spans(hit: np.ndarray) -> list[list[int]]:
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))).reshape(-1, 2).tolist()


def _flags(n: int, spans: list[list[int]]) -> np.ndarray:
    hit = np.zeros(n, bool)
    for a, b in spans:
        hit[a:b] = True
    return hit


_FOUND = "spans array<array<long>>, items array<string>"


def _hits(docs: DataFrame, block: Block, text: str) -> DataFrame:
    """row, spans and items of each document that one block hits."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit, starts, items = block.scan(utf8(batch.column(1)))
            spans = [_spans(hit[starts[k] : starts[k + 1]]) for k in items]
            yield pa.record_batch([batch.column(0).take(pa.array(list(items), pa.int64())), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array([sorted(x) for x in items.values()], pa.list_(pa.string()))], names=["row", "spans", "items"])

    return docs.select(row_hash(text).alias("row"), text).mapInArrow(tidy(scan), f"row long, {_FOUND}")


def _hits_of_all(docs: DataFrame, found: Iterator[Block], text: str, folder: str) -> DataFrame:
    """row, spans and items of each document that any block hits. A pass over ``docs`` for
    each block; a block's broadcast goes when its pass is written."""
    parts = []
    for n, block in enumerate(found):
        parts.append(keep(_hits(docs, block, text), f"{folder}/block{n}"))
        block.items.unpersist()
    every = reduce(DataFrame.unionByName, parts).distinct()  # repeated rows are hit alike
    return keep(every.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")), f"{folder}/hits")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items, spans of each document.

    ``items`` are the ids of the items that have an occurring window, sorted as
    strings; ``spans`` are the maximal runs of hit words, [first, after the last).
    """
    many, found = blocks(benchmark, window, block_words)
    only = next(found) if many == 1 else None

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(1))
            if only is not None:
                hit, starts, items = only.scan(texts)
                counts = np.diff(starts)
                spans = {k: _spans(hit[starts[k] : starts[k + 1]]) for k in items}
            else:
                counts = np.fromiter((len(words_of(t)) for t in texts), np.int64, len(texts))
                held = [(k, x, y) for k, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())) if x]
                spans = {k: _spans(_flags(int(counts[k]), x)) for k, x, _ in held}
                items = {k: set(y) for k, _, y in held}
            names = [sorted(items.get(k, ())) for k in range(batch.num_rows)]
            runs = [spans.get(k, []) for k in range(batch.num_rows)]
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array([sum(b - a for a, b in x) for x in runs], pa.int64()), pa.array([len(x) for x in names], pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(runs, pa.list_(pa.list_(pa.int64())))],
                names=["doc_id", "n_words", "n_hit", "n_items", "items", "spans"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text)
    if only is None:
        hits = _hits_of_all(docs, found, text, scratch(docs.sparkSession, "contamination"))
        rows = docs.select("doc_id", text, row_hash(text).alias("row")).join(hits, "row", "left").select("doc_id", text, "spans", "items")
    return rows.mapInArrow(tidy(told), f"doc_id {kind}, n_words long, n_hit long, n_items long, items array<string>, spans array<array<long>>")


def _without(text: bytes, hit: np.ndarray) -> bytes:
    """The text without hit words, from the first to the last byte of each run of them."""
    runs = [m.span() for m in _RUN.finditer(text)]
    parts, last = [], 0
    for a, b in _spans(hit):
        parts.append(text[last : runs[a][0]])
        last = runs[b - 1][1]
    return b"".join([*parts, text[last:]])


def _changed(batch: pa.RecordBatch, texts: dict[int, str], gone: list[int]) -> pa.RecordBatch:
    """``batch`` with new texts (and ``n_chars``, if it has that), without the rows ``gone``."""
    columns = list(batch.columns)
    for name, new in (("text", texts), ("n_chars", {k: len(v) for k, v in texts.items()})):
        if new and name in batch.schema.names:
            at = batch.schema.get_field_index(name)
            values = columns[at].to_pylist()
            for k, v in new.items():
                values[k] = v
            columns[at] = pa.array(values, batch.schema.field(at).type)
    stays = np.ones(batch.num_rows, bool)
    stays[gone] = False
    return pa.record_batch(columns, schema=batch.schema).filter(pa.array(stays))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` without benchmark passages: hit words are cut out of the texts, from the
    first to the last byte of each span, and ``n_chars`` follows; a document of which
    more than ``max_coverage`` is hit goes. Cutting is repeated until nothing is hit,
    as what a cut joins can form a window again. Untouched texts stay byte for byte."""
    many, found = blocks(benchmark, window, block_words)
    if many > 1:
        return _decontaminate_in_rounds(docs, benchmark, window, max_coverage, block_words)
    only, at = next(found), docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = utf8(batch.column(at))
            hit, starts, items = only.scan(texts)
            gone, new = [], {}
            for k in items:
                own, left = hit[starts[k] : starts[k + 1]], texts[k]
                if own.sum() > max_coverage * len(own):
                    gone.append(k)
                    continue
                while own.any():
                    left = _without(left, own)
                    own, _, _ = only.scan([left])
                new[k] = left.decode()
            yield _changed(batch, new, gone) if items else batch

    return docs.mapInArrow(tidy(cut), docs.schema)


def _decontaminate_in_rounds(docs: DataFrame, benchmark: DataFrame, window: int, max_coverage: float, block_words: int) -> DataFrame:
    """The same over several blocks: hits of all blocks first, then one cut, and again."""
    folder, names = scratch(docs.sparkSession, "decontaminated"), docs.columns
    spans = "_" * (1 + max(map(len, names)))  # longer than any name of the documents
    first, number = True, 0
    while True:
        hits = _hits_of_all(docs, blocks(benchmark, window, block_words)[1], "text", f"{folder}/{number}")
        if hits.isEmpty():
            return docs
        limit = max_coverage if first else 1.0

        def cut(batches: Iterator[pa.RecordBatch], limit: float = limit) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                gone, new = [], {}
                texts = utf8(batch.column("text"))
                for k, held in enumerate(batch.column(spans).to_pylist()):
                    if held:
                        own = _flags(len(words_of(texts[k])), held)
                        if own.sum() > limit * len(own):
                            gone.append(k)
                        else:
                            new[k] = _without(texts[k], own).decode()
                yield _changed(batch.select(names), new, gone)

        found = hits.select(F.col("row").alias(f"{spans}r"), F.col("spans").alias(spans))
        marked_rows = docs.withColumn(f"{spans}k", row_hash("text"))
        joined = marked_rows.join(found, marked_rows[f"{spans}k"] == found[f"{spans}r"], "left").select(*names, spans)
        docs = keep(joined.mapInArrow(tidy(cut), docs.schema), f"{folder}/cut{number}")
        first, number = False, number + 1


def op9_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT k, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT d.*, s.n FROM d, (SELECT DISTINCT n FROM bw) s WHERE len(d.w) >= s.n))),
h AS (SELECT dw.k, dw.i, dw.n, bw.item FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
p AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM h) GROUP BY k),
m AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT k, item FROM h) GROUP BY k)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(p.n_hit, 0)::BIGINT AS n_hit, coalesce(m.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(m.items, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN p USING (k) LEFT JOIN m USING (k)
"""
