"""Ranked lexical search turned round: the items' inverted index is broadcast, and the
documents stream through it.

The first pass cuts each text into terms and keeps, in a stored table, how often it holds
each term of the items, and its length; counts of documents by term and the corpus's
lengths are sums over that table. The second pass streams the stored counts through the
inverted index (term to items, with weights): each task adds up scores for a chunk of
documents and keeps the ``TOP`` best of each item, against the least of those that it has.
The heaps of all tasks are merged by a rank within each item.

Items come in blocks of some ``BLOCK_TERMS`` pairs of item and term, so that what is
broadcast (some 30 bytes a pair) and a task's heaps stay bounded; each block takes a pass
over the texts. An item of more terms than that is dealt over blocks; such blocks give
out scores instead of heaps, which are summed by document before they are ranked.

Scores are integers below 2**53, added as doubles without loss: a term gives at most
1000 * ln(2N + 2) * 10**6, and a block holds no more than 2 * ``BLOCK_TERMS`` terms.

Defined cases: a null text or item has no terms; rows of one item_id (or without one)
are one item, with the terms of all; repeated documents are documents each; documents of
equal score go by id, those without an id last; without documents or items there are no
rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridmill.llm.common import drop, flat_bytes, keep, row_hash, scratch, table, tidy, windows

TOP = 10
BLOCK_TERMS = 120_000
#: Bytes of texts that are cut into terms together, and scores that are added up together.
WINDOW = 4 << 20
CHUNK = 2_000_000
# Fixed values of the score: k1 = 1.2 * 1000 by length, b = 0.9, in whole numbers.
_SCALE, _TF, _M, _BASE, _SLOPE = 1_000_000_000, 1000, 8, 10, 90
#: A byte of a term, A-Z lowered; 0 for what separates terms.
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 0 for c in range(256)], np.uint8)


def _separators(flat: np.ndarray, a: int, b: int) -> np.ndarray:
    return _FOLD[flat[a:b]] == 0


def terms_of(texts: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Terms of all texts in a row, and the row of each, a window at a time."""
    flat, offsets = flat_bytes(texts)
    for a, b in windows(flat, offsets, _separators, WINDOW):
        folded = _FOLD[flat[a:b]]
        inside = folded > 0
        first = inside.copy()
        starts = offsets[(offsets > a) & (offsets < b)] - a
        first[1:] &= ~inside[:-1]
        first[starts] = inside[starts]
        at = np.flatnonzero(first)
        if len(at):
            data = folded[inside]
            places = np.append((np.cumsum(inside) - 1)[at], len(data))
            words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(places), pa.py_buffer(data)])
            yield words, np.searchsorted(offsets, at + a, "right") - 1


def item_terms(items: DataFrame, text: str = "text") -> DataFrame:
    """The different (item_id, term) of all items, with the block that each belongs to."""
    kind = items.schema["item_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, rows in terms_of(batch.column(1)):
                yield pa.record_batch([batch.column(0).take(pa.array(rows)), words.cast(pa.binary())], names=["item_id", "term"])

    return items.select("item_id", F.col(text).alias("text")).mapInArrow(tidy(cut), f"item_id {kind}, term binary").distinct()


def with_blocks(pairs: DataFrame, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``pairs`` with ``block``, and ``split``: whether the item lies in several blocks."""
    sizes = pairs.groupBy("item_id").agg(F.count("*").alias("_n"))
    blocks = F.greatest(F.lit(1), F.ceil(F.lit(pairs.count()) * 2 / block_terms)).cast("int")
    dealt = pairs.join(sizes.withColumnRenamed("item_id", "_id"), F.col("item_id").eqNullSafe(F.col("_id"))).withColumn("split", F.col("_n") > block_terms / 2)
    by_item, by_term = F.pmod(F.xxhash64("item_id"), blocks), F.pmod(F.xxhash64("item_id", "term"), blocks)
    return dealt.withColumn("block", F.when(F.col("split"), blocks + by_term).otherwise(by_item).cast("int")).drop("_n", "_id")


def matched_terms(docs: DataFrame, terms: Broadcast, text: str = "text") -> DataFrame:
    """doc_id, n (all terms of the text), and how often it holds which of ``terms``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pa.array(terms.value, pa.large_binary())
        size = max(1, len(vocabulary))
        for batch in batches:
            n, keys = np.zeros(batch.num_rows, np.int64), [np.zeros(0, np.int64)]
            for words, rows in terms_of(batch.column(1)):
                n += np.bincount(rows, minlength=batch.num_rows)
                found = pc.index_in(words, value_set=vocabulary).fill_null(-1).to_numpy()
                keys.append(rows[found >= 0] * size + found[found >= 0])
            keys, counts = np.unique(np.concatenate(keys), return_counts=True)
            ends = pa.array(np.append(0, np.cumsum(np.bincount(keys // size, minlength=batch.num_rows))), pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (keys % size, counts)]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(n), *lists], names=["doc_id", "row", "n", "terms", "counts"])

    rows = docs.select("doc_id", F.col(text).alias("text"), row_hash(text).alias("row"))
    return rows.mapInArrow(tidy(count), f"doc_id {kind}, row long, n long, terms array<int>, counts array<int>")


class Index:
    """Items by term, with the term's weight: two flat arrays, and where each term's items start."""

    def __init__(self, item_of: np.ndarray, term_of: np.ndarray, weights: np.ndarray, n_items: int, documents: int, length: int):
        order = np.argsort(term_of, kind="stable")
        self.items, self.starts = item_of[order].astype(np.int32), np.searchsorted(term_of[order], np.arange(len(weights) + 1))
        self.weights, self.n_items, self.documents, self.length = weights, n_items, documents, length

    def scores(self, n: np.ndarray, rows: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Scores of all documents (of lengths ``n``) by items, from (row, term, count)."""
        out = np.zeros(len(n) * self.n_items)
        m = _BASE + (_SLOPE * n * self.documents) // max(1, self.length)
        gain = self.weights[terms] * ((_SCALE * counts) // (_TF * counts + _M * m[rows]))
        wide = self.starts[terms + 1] - self.starts[terms]
        ends = np.cumsum(wide)
        at = 0
        while at < len(terms):
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, "right")))
            w = wide[at:end]
            inner = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
            items = self.items[np.repeat(self.starts[terms[at:end]], w) + inner]
            out += np.bincount(np.repeat(rows[at:end], w) * self.n_items + items, np.repeat(gain[at:end], w).astype(float), len(out))
            at = end
        return out.reshape(len(n), self.n_items).astype(np.int64)


class Heaps:
    """The ``top`` best documents of each item, of all that were offered."""

    def __init__(self, n_items: int, ids: pa.DataType, top: int):
        self.top, self.least = top, np.zeros(n_items, np.int64)
        self.held = pa.table({"item": pa.array([], pa.int32()), "score": pa.array([], pa.int64()), "doc_id": pa.array([], ids)})

    def offer(self, scores: np.ndarray, doc_ids: pa.Array) -> None:
        if len(scores) > self.top:
            self.least = np.maximum(self.least, np.partition(scores, len(scores) - self.top, axis=0)[-self.top])
        row, item = np.nonzero((scores > 0) & (scores >= self.least))
        if not len(row):
            return
        new = pa.table({"item": pa.array(item, pa.int32()), "score": pa.array(scores[row, item]), "doc_id": doc_ids.take(pa.array(row))})
        every = pa.concat_tables([self.held, new]).sort_by([("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")])
        items, score = every["item"].to_numpy(), every["score"].to_numpy()
        first = np.append(True, items[1:] != items[:-1])
        nth = np.arange(len(items)) - np.maximum.accumulate(np.where(first, np.arange(len(items)), 0))
        last = nth == self.top - 1
        self.least[items[last]] = np.maximum(self.least[items[last]], score[last])
        self.held = every.filter(pa.array(nth < self.top)).combine_chunks()


def _stream(matched: DataFrame, index: Broadcast, top: int, whole: bool) -> DataFrame:
    """(item, score, doc_id): each task's best of each item, or, unless ``whole``, all scores
    with ``row``, what the document is known by in other blocks."""
    kind = matched.schema["doc_id"].dataType.simpleString()
    matched = matched.select("doc_id", "n", "terms", "counts", "row")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, heaps = index.value, None
        step = max(1, CHUNK // max(1, x.n_items))
        for batch in batches:
            heaps = heaps or Heaps(x.n_items, batch.column(0).type, top)
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                terms, counts = part.column(2), part.column(3)
                long = pc.list_value_length(terms).to_numpy().astype(np.int64)
                rows = np.repeat(np.arange(part.num_rows), long)
                scores = x.scores(part.column(1).to_numpy(), rows, terms.flatten().to_numpy().astype(np.int64), counts.flatten().to_numpy().astype(np.int64))
                if whole:
                    heaps.offer(scores, part.column(0))
                else:
                    row, item = np.nonzero(scores)
                    yield pa.record_batch([pa.array(item, pa.int32()), pa.array(scores[row, item]), part.column(0).take(pa.array(row)), part.column(4).take(pa.array(row))], names=["item", "score", "doc_id", "row"])
        if whole and heaps is not None and heaps.held.num_rows:
            yield from heaps.held.to_batches()

    return matched.mapInArrow(tidy(score), f"item int, score long, doc_id {kind}" + ("" if whole else ", row long"))


def best_documents(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS, text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each item."""
    spark, folder = docs.sparkSession, scratch(docs.sparkSession, "search")
    pairs = keep(with_blocks(item_terms(items), block_terms), f"{folder}/items")
    kinds = f"item_id {items.schema['item_id'].dataType.simpleString()}, score long, doc_id {docs.schema['doc_id'].dataType.simpleString()}"
    found, partial = spark.createDataFrame([], kinds), None
    for block, whole in [(r["block"], not r["split"]) for r in pairs.select("block", "split").distinct().orderBy("block").collect()]:
        own = pairs.where(F.col("block") == block).select("item_id", "term").toArrow()  # no more than some block_terms rows
        names, terms = own["item_id"].combine_chunks().dictionary_encode("encode"), own["term"].combine_chunks().dictionary_encode()
        vocabulary = spark.sparkContext.broadcast(terms.dictionary.to_pylist())
        read = matched_terms(docs, vocabulary, text)
        matched = keep(read, f"{folder}/matched{block}")
        total = matched.where("n > 0").agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
        holding = np.zeros(len(terms.dictionary), np.int64)
        for r in matched.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
            holding[r["term"]] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * total["documents"] + 2) / (2 * int(df) + 1))) for df in holding], np.int64)
        index = spark.sparkContext.broadcast(Index(names.indices.to_numpy(), terms.indices.to_numpy(), weights, len(names.dictionary), total["documents"], total["length"]))
        scored = _stream(matched, index, top, whole)
        labels = spark.createDataFrame(pa.table({"item": pa.array(range(len(names.dictionary)), pa.int32()), "item_id": names.dictionary}))
        scored = scored.join(F.broadcast(labels), "item").drop("item")
        if whole:
            found = found.unionByName(keep(scored, f"{folder}/heaps{block}"))
        else:
            scored = scored.groupBy("item_id", "row", "doc_id").agg(F.max("score").alias("score"), F.count("*").alias("copies"))
            partial = scored if partial is None else partial.unionByName(scored)
        if whole:
            drop(spark, f"{folder}/matched{block}")
    if partial is not None:
        summed = partial.groupBy("item_id", "row", "doc_id").agg(F.sum("score").alias("score"), F.max("copies").alias("copies"))
        copies = F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(top)).cast("int")))  # equal rows, as many as can be wanted
        found = found.unionByName(summed.select("item_id", "doc_id", "score", copies).drop("col"))
    order = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def op12_search(spark, sf_dir: str) -> DataFrame:
    return best_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS length FROM d WHERE len(w) > 0),
t AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(w) AS term FROM d) GROUP BY k, term),
f AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM t, s GROUP BY term, n_docs),
m AS (SELECT k, doc_id, 10 + (90 * len(w) * n_docs) // length AS m FROM d, s WHERE len(w) > 0),
x AS (SELECT i.item_id, m.k, m.doc_id, sum(f.weight * ((1000000000 * t.tf) // (1000 * t.tf + 8 * m.m)))::BIGINT AS score
  FROM t JOIN f USING (term) JOIN i USING (term) JOIN m USING (k) GROUP BY i.item_id, m.k, m.doc_id),
r AS (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank, doc_id, score FROM x WHERE score > 0)
SELECT * FROM r WHERE rank <= 10
"""
