"""Toxicity by multiple-instance learning: labels of documents, scores of sentences.

A document is toxic if one of its sentences is. Sentence scores are logistic in the
words (whole, and their first characters, so that word forms share what is learnt),
and combine by noisy-or: P = 1 - (1 - p1)(1 - p2)... The gradient of the document's
loss reaches each sentence in proportion to its own score, so that the sentences
that explain the label are found without being labelled; they are returned.

The fit sees a sample of labelled rows of at most ``SAMPLE`` of each label, taken by
a hash of the id, out of the rows outside the held-out fold; one task fits it, and the
weights (hashed, of fixed size) are broadcast. Where labels are few, scores of texts
that were not learnt from are too low; so each half of the sample is also scored by a
model of the other half, and all log odds are shifted by one number so that
``THRESHOLD`` parts these scores best. There a label counts by its share of all
labelled rows, not of the sample. Scoring is one pass over the texts without a shuffle,
by the same noisy-or that was fitted, then the shift. Arrow cuts and numbers a
batch's words, and the worker remembers a stem's summed weight.

Defined cases: a null or empty text has no sentence and score 0; labels that are
null are not learnt from; without both labels all scores are 0; repeated rows are
scored alike; ids that are null are no labelled rows; of several texts with one id the
one of the least hash is learnt from; only doc_id, text and ``labels`` (doc_id, toxic)
are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.llm.common import held_in_fold, table, tidy

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
SAMPLE = 4000
LOG_FEATURES = 20
MIN_DOCUMENTS = 3
POWER = 3
PREFIXES = (4, 5, 6)
EPOCHS = 6
RATE = 0.15
DECAY = 2e-5
#: A sentence without an end is cut after so many words.
LONGEST = 40
REMEMBERED = 150_000
_START_BIAS = -1.5


def features(stem: str) -> list[int]:
    """Numbers of a word's features: the whole, and its first characters."""
    names = [stem] + [stem[:n] + "\0" for n in PREFIXES if len(stem) >= n] if stem else []
    return [zlib.crc32(x.encode()) & ((1 << LOG_FEATURES) - 1) for x in names]


def cut(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The different stems (words in small letters, without signs around them), the stem's
    number of each word in a row, each text's number of words, and where sentences start
    among all words: behind a word that ends one, at a text's start, and after ``LONGEST``
    words."""
    split = pc.utf8_split_whitespace(pc.utf8_trim_whitespace(texts.fill_null("")))
    counts = np.diff(split.offsets.to_numpy()).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    order = coded.indices.to_numpy()
    stems = pc.replace_substring_regex(pc.utf8_lower(coded.dictionary), r"^[^\pL\pN]+|[^\pL\pN]+$", "").dictionary_encode()
    ends = pc.match_substring_regex(coded.dictionary, r"""[.!?]["')*$%&#]*$""").to_numpy(zero_copy_only=False).astype(bool)
    blank = pc.equal(pc.binary_length(coded.dictionary), 0).to_numpy(zero_copy_only=False)
    if blank.any():  # a text without words is cut into one empty word
        real = ~blank[order]
        counts = np.where(np.add.reduceat(real, np.cumsum(counts) - counts), counts, 0)
        order = order[real]
    begins = np.zeros(len(order) + 1, bool)
    begins[1:] = ends[order]
    begins[np.cumsum(counts) - counts] = True
    starts = np.flatnonzero(begins[:-1])
    sizes = np.diff(np.append(starts, len(order)))
    pieces = -(-sizes // LONGEST)
    nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return stems.dictionary.to_numpy(zero_copy_only=False).tolist(), stems.indices.to_numpy()[order], counts, np.repeat(starts, pieces) + nth * LONGEST


def sentence_scores(z: np.ndarray) -> np.ndarray:
    """A logistic score to the power ``POWER``: many sentences of small scores must not add
    up to a toxic document."""
    return (1 / (1 + np.exp(-np.clip(z, -30, 30)))) ** POWER


def cut_features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """For each text its features, the place among them and the sentence of each word's
    feature, and the number of sentences."""
    stems, order, counts, starts = cut(pa.array(texts, pa.string()))
    own = [features(x) for x in stems]
    many = np.fromiter(map(len, own), np.int64, len(own))
    flat, at = np.fromiter(chain.from_iterable(own), np.int32, int(many.sum())), np.cumsum(many) - many
    sentence = np.searchsorted(starts, np.arange(len(order)), "right") - 1
    ends = np.cumsum(counts)
    edges = np.searchsorted(starts, np.append(0, ends))
    documents = []
    for d, (end, n) in enumerate(zip(ends.tolist(), counts.tolist())):
        words = order[end - n : end]
        times = many[words]
        inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        which, inverse = np.unique(flat[np.repeat(at[words], times) + inside], return_inverse=True)
        documents.append((which, inverse.astype(np.int32), np.repeat(sentence[end - n : end] - edges[d], times).astype(np.int32), int(edges[d + 1] - edges[d])))
    return documents


def noisy_or(document: tuple, weights: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
    """The scores of a text's sentences, and the chance that none is toxic."""
    which, inverse, owner, n = document
    p = sentence_scores(np.bincount(owner, weights[which][inverse], n) + bias)
    return p, float(np.exp(np.log1p(-np.minimum(p, 1 - 1e-12)).sum()))


def slopes(p: np.ndarray, clean: float, label: int) -> np.ndarray:
    """How the document's loss, the log of its label's chance with a minus, changes with each
    sentence's log odds."""
    grown = POWER * p * (1 - p ** (1 / POWER)) / np.maximum(1 - p, 1e-12)  # p'(z) / (1 - p)
    return -grown * clean / max(1 - clean, 1e-9) if label else grown


def descend(documents: list[tuple], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> tuple[np.ndarray, float]:
    """Weights of the features and the bias, by gradient steps on one document at a time."""
    weights, bias = np.zeros(1 << LOG_FEATURES, np.float64), _START_BIAS
    seen = np.zeros(len(weights), np.int32)
    for which, *_ in documents:
        seen[which] += 1
    usual = seen >= MIN_DOCUMENTS  # features of a document or two stay at no weight
    squares, bias_square = np.full(len(weights), 1e-2), 1e-2
    shuffled = np.random.default_rng(seed)
    for _ in range(epochs):
        for d in shuffled.permutation(len(documents)):
            which, inverse, owner, n = documents[d]
            if not n:
                continue
            p, clean = noisy_or(documents[d], weights, bias)
            slope = slopes(p, clean, labels[d])
            total = np.bincount(inverse, slope[owner], len(which)) * usual[which] + DECAY * weights[which]
            squares[which] += total * total
            weights[which] -= RATE * total / np.sqrt(squares[which])
            bias_square += slope.sum() ** 2
            bias -= RATE * slope.sum() / np.sqrt(bias_square)
    return weights, float(bias)


def log_odds(scores: np.ndarray) -> np.ndarray:
    held = np.clip(scores, 1e-9, 1 - 1e-9)
    return np.log(held) - np.log1p(-held)


def shift_for(scores: np.ndarray, labels: np.ndarray, shares: np.ndarray) -> float:
    """What to add to the scores' log odds so that ``THRESHOLD`` cuts where precision and
    recall have the greatest harmonic mean, each row counting by its share; the cut lies
    midway between two scores."""
    order = np.argsort(-scores, kind="stable")
    z = log_odds(scores[order])
    toxic = np.where(labels[order] == 1, shares[order], 0.0)
    found, taken = np.cumsum(toxic), np.cumsum(shares[order])
    mean = 2 * found / (taken + toxic.sum())
    edge = np.flatnonzero((z[:-1] > z[1:]) & (scores[order][:-1] > 0))  # equal scores fall on one side
    if not len(edge):
        return 0.0
    best = edge[np.argmax(mean[edge])]
    return float(log_odds(np.array([THRESHOLD]))[0] - (z[best] + z[best + 1]) / 2)


def fit(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 7, shares: tuple[float, float] = (1.0, 1.0)) -> tuple[np.ndarray, float, float]:
    """Weights, bias, and the shift of the scores. ``shares``: how many labelled rows one row
    of the sample stands for, of label 0 and of label 1."""
    if len(set(labels)) < 2:
        return np.zeros(1 << LOG_FEATURES, np.float32), -50.0, 0.0
    documents = cut_features(texts)
    weights, bias = descend(documents, labels, epochs, seed)
    halves = np.random.default_rng(seed).permutation(len(texts)) % 2
    scores = np.zeros(len(texts))
    for half in (0, 1):
        inside, outside = np.flatnonzero(halves != half), np.flatnonzero(halves == half)
        if len({labels[d] for d in inside}) < 2:
            return weights.astype(np.float32), bias, 0.0
        model = descend([documents[d] for d in inside], [labels[d] for d in inside], epochs, seed)
        for d in outside:
            scores[d] = 1 - noisy_or(documents[d], *model)[1] if documents[d][3] else 0.0
    known = np.array(labels)
    return weights.astype(np.float32), bias, shift_for(scores, known, np.where(known == 1, shares[1], shares[0]))


class _Sums(dict):
    """Numbers stems; a stem's weights are summed up once."""

    def __init__(self, weights: np.ndarray):
        self.weights, self.values = weights, []

    def __missing__(self, stem: str) -> int:
        self[stem] = k = len(self)
        self.values.append(float(self.weights[features(stem)].sum()) if stem else 0.0)
        return k


class Scorer:
    """Scores batches of texts."""

    def __init__(self, weights: np.ndarray, bias: float, shift: float = 0.0):
        self.weights, self.bias, self.shift = weights, bias, shift
        self.held = _Sums(weights)

    def score(self, texts: pa.Array) -> tuple[np.ndarray, list[list[dict]]]:
        """Each text's score, and its sentences of at least one half (before the shift)."""
        if len(self.held) > REMEMBERED:
            self.held = _Sums(self.weights)
        stems, order, counts, starts = cut(texts)
        rows = np.fromiter(map(self.held.__getitem__, stems), np.int64, len(stems))
        sums = np.array(self.held.values)[rows][order]
        found: list[list[dict]] = [[] for _ in counts]
        if not len(order):
            return np.zeros(len(counts)), found
        p = sentence_scores(np.add.reduceat(sums, starts) + self.bias)
        ends = np.cumsum(counts)
        upto = np.concatenate([[0.0], np.cumsum(np.log1p(-np.minimum(p, 1 - 1e-12)))])
        edges = np.searchsorted(starts, np.append(0, ends))
        # Sums of each text's own sentences, not differences of running ones: equal texts score alike.
        scores = np.zeros(len(counts))
        some = np.flatnonzero(edges[1:] > edges[:-1])
        plain = 1 - np.exp(np.add.reduceat(np.diff(upto), edges[some]))
        scores[some] = 1 / (1 + np.exp(-(log_odds(plain) + self.shift)))
        stops = np.append(starts[1:], len(order))
        for k in np.flatnonzero(p >= 0.5).tolist():
            text = int(np.searchsorted(edges, k, "right")) - 1
            first = int(ends[text] - counts[text])
            found[text].append({"first": int(starts[k]) - first, "last": int(stops[k]) - first, "score": float(p[k])})
        return scores, found


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text, toxic of at most ``sample`` rows of each label, and how many labelled rows each
    stands for. Of several texts with one id
    the one with the least hash is taken, of several labels the greater."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_in_fold("doc_id", FOLDS, HELD_OUT)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = rows.groupBy("toxic").agg(F.greatest(F.count("*") / sample, F.lit(1.0)).alias("stands_for"))  # two rows
    picked = [rows.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id", F.lit("toxicity")), "doc_id").limit(sample) for y in (0, 1)]
    few = picked[0].unionByName(picked[1]).join(F.broadcast(n), "toxic").select("doc_id", "toxic", "stands_for")  # at most 2 * sample rows of three numbers
    found = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").where("text IS NOT NULL")
    return found.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "toxic", "stands_for")).alias("one")).select("doc_id", "one.text", "one.toxic", "one.stands_for")


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> tuple[np.ndarray, float, float]:
    """The model, fitted by one task on the bounded sample; the driver gets its weights (4 MB)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: list[str] = []
        toxic: list[int] = []
        shares = [1.0, 1.0]
        for batch in batches:
            texts += batch.column(1).to_pylist()
            toxic += batch.column(2).to_pylist()
            for y, share in set(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                shares[y] = share
        weights, *numbers = fit(texts, toxic, epochs, shares=(shares[0], shares[1]))
        yield pa.record_batch([pa.array([weights.astype("<f4").tobytes()], pa.binary())] + [pa.array([x], pa.float64()) for x in numbers], names=["weights", "bias", "shift"])

    few = training_sample(docs, labels, sample).repartition(1).sortWithinPartitions("doc_id", "text")
    got = few.mapInArrow(tidy(run), "weights binary, bias double, shift double").first()
    return (np.frombuffer(got["weights"], "<f4"), got["bias"], got["shift"]) if got else (np.zeros(1 << LOG_FEATURES, np.float32), -50.0, 0.0)


def score_documents(docs: DataFrame, model: tuple[np.ndarray, float, float], keep_rows: float | None = None) -> DataFrame:
    """doc_id, score, sentences (first word, after the last, score of those of at least
    one half); with ``keep_rows``, the rows of ``docs`` that score less."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at, own = docs.columns.index("text"), docs.columns.index("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*sent.value)
        for batch in batches:
            scores, found = scorer.score(batch.column(at))
            if keep_rows is not None:
                yield batch.filter(pa.array(scores < keep_rows))
            else:
                kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("score", pa.float64())]))
                yield pa.record_batch([batch.column(own), pa.array(scores, pa.float64()), pa.array(found, kind)], names=["doc_id", "score", "sentences"])

    if keep_rows is not None:
        return docs.mapInArrow(tidy(run), docs.schema)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(tidy(run), f"doc_id {kind}, score double, sentences array<struct<first:long,last:long,score:double>>")


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_documents(docs, learn(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "sentences")
