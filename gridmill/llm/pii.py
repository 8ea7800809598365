"""Personal data: fixed forms, and what bootstrapped contexts find beside them.

Seeds are the matches of the fixed forms. The words around them induce lexical
patterns (the word before; the two before; the one before and the one after).
Patterns and the identifier-like words they stand next to form a graph, scored in
rounds: a pattern's precision is the share of its identifier-like places that hold
known identifiers (and these must be a share of all its places in running text), an
unseen word's score is noisy-or over the patterns it stands in. Words that score enough become known, and may raise other patterns. The places
of the words that were learnt are returned beside the base spans, with the kind that
the best of their patterns has. Rounds end when nothing new is learnt.

Words are what stands between ASCII white space, without signs around it; those of
signs alone are stepped over. Both passes cut texts so.

One pass finds spans and candidates, and writes them without texts. The first round
counts every place of the patterns that have enough seeds (a bitmap of fixed size picks
them), so that a context that is common in running text never counts as precise; a later
round counts those of the patterns that reach enough known words by what was learnt,
in a pass of its own if there are any. All else works on the small tables that remain.

Defined cases: a null or empty text has no spans; rows are numbered, so that null
ids and repeated rows keep their own spans; an empty table gives an empty result;
only the id and the text are read.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.llm.common import WORD, keep, marked, marks, numbered_words, scratch, table, tidy

# The base forms, in the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
_DIGIT = re.compile("[0-9]")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
#: The same, found in one pass: a match can start only where a run of digits does, since the one before ended with its run.
_IP_RUNS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What stands before a learnt span's kind; they are listed after the base.
LEARNT = "context_"
#: A pattern needs so many different known identifiers, and this precision.
MIN_SEEDS = 3
MIN_PRECISION = 0.3
#: Of all its places in running text, so many must hold known identifiers.
MIN_SHARE = 0.05
#: What an unseen word must score.
MIN_SCORE = 0.6
_HINT = re.compile(r"[0-9@]|\b(?:at|dot)\b[\])}]")
_WORD = re.compile(WORD)
_TRIM = "\"'.,;:!?()[]{}<>"
_SIGNS = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
_U = np.uint64
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if i % 2 == 0 else 2 * x - 9 * (x > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[tuple[int, int]]:
    """What ``_EMAIL`` finds from left to right, from each @ to both sides: a search from every
    letter would read a long run anew each time."""
    out, last, seen = [], 0, 0  # the last match's end, and the sign after the last @
    at = text.find("@")
    while at >= 0:
        low = max(last, seen)
        start = low + len(text[low:at].rstrip(_LOCAL))
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            last = m.end()
        seen = at + 1
        at = text.find("@", max(seen, last))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base forms, by kind, then start; places are code points."""
    out = []
    if "@" in text:
        out += [(0, *span) for span in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP_RUNS.finditer(text):
            if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.group().split(".")):
                out.append((1, *m.span()))
        for m in _CARD.finditer(text):
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


def _bare(word: bytes) -> bytes:
    """A word in small letters without the signs around it; nothing, if it has only signs."""
    return word.translate(_FOLD).strip(_TRIM.encode()) if word.translate(None, _SIGNS) else b""


def _hash(bare: bytes) -> int:
    return xxhash.xxh3_64_intdigest(bare)


def _mix(kind: int, a, b):
    return ((a ^ (b * _U(0x9E3779B97F4A7C15))) + _U(kind)) * _U(0xBF58476D1CE4E5B9)


def _patterns(before2: bytes, before: bytes, after: bytes) -> list[int]:
    """Hashes of the three patterns around a place; an edge of the text counts as an empty word."""
    h2, h1, h0 = (np.array([_hash(x)], np.uint64) for x in (before2, before, after))
    return [int(x.view(np.int64)[0]) for x in (_mix(1, h1, _U(0) * h1), _mix(2, h1, h2), _mix(3, h1, h0))]


class _Words:
    """The words of a text, by place: what :func:`_count_places` cuts it into."""

    def __init__(self, text: str):
        self.text = text
        self.edges = [m.span() for m in _WORD.finditer(text)]
        self.starts = [a for a, _ in self.edges]
        self.found: dict[tuple[int, int], tuple[bytes, int]] = {}
        self.at: tuple[int, int] | None = None
        self.around: list[int] = []

    def of(self, at: int) -> int:
        """Number of the word that holds a place."""
        return bisect.bisect_right(self.starts, at) - 1

    def _near(self, k: int, step: int) -> tuple[bytes, int]:
        """The next word to one side that is more than signs. What was found is kept for all
        words on the way, so that many places beside a long word read it once."""
        passed, out = [], None
        while out is None:
            if (k, step) in self.found:
                out = self.found[k, step]
                break
            passed.append(k)
            k += step
            if not 0 <= k < len(self.edges):
                out = b"", k
                break
            a, b = self.edges[k]
            bare = _bare(self.text[a:b].encode())
            out = (bare, k) if bare else None
        for p in passed:
            self.found[p, step] = out
        return out

    def patterns(self, start: int, end: int) -> list[int]:
        first, last = self.of(start), self.of(end - 1)
        if (first, last) != self.at:  # else what stands around is the same as for the place before
            before, k = self._near(first, -1)
            before2, _ = self._near(k, -1)
            after, _ = self._near(last, 1)
            self.at, self.around = (first, last), _patterns(before2, before, after)
        return self.around

    def trimmed(self, k: int) -> tuple[int, int]:
        start, end = self.edges[k]
        while start < end and self.text[start] in _TRIM:
            start += 1
        while end > start and self.text[end - 1] in _TRIM:
            end -= 1
        return start, end


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Base spans of each row, and its places: seeds, and other identifier-like words."""
    number = TaskContext.get().partitionId() << 40
    place = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("word", pa.int64()), ("patterns", pa.list_(pa.int64()))])
    for batch in batches:
        spans, places, numbers = [], [], []
        for text in batch.column(1).to_pylist():
            number += 1
            numbers.append(number)
            text = text or ""
            base = base_spans(text)
            own = []
            words = None
            ends = sorted((a, b) for _, a, b in base)
            firsts = [a for a, _ in ends]
            for kind, a, b in base:
                words = words or _Words(text)
                own.append({"kind": kind, "start": a, "end": b, "word": _word_hash(text[a:b]), "patterns": words.patterns(a, b)})
            m = _HINT.search(text)
            while m:
                words = words or _Words(text)
                k = words.of(m.start())
                a, b = words.trimmed(k)
                m = _HINT.search(text, words.edges[k][1])
                # Spans of one kind don't overlap: those of four kinds that reach past a start are few.
                near = ends[max(0, bisect.bisect_left(firsts, a) - len(KINDS)) : bisect.bisect_left(firsts, b)]
                if a < b and not any(x < b and a < y for x, y in near):
                    own.append({"kind": len(KINDS), "start": a, "end": b, "word": _word_hash(text[a:b]), "patterns": words.patterns(a, b)})
            spans.append([{"kind": k, "start": a, "end": b} for k, a, b in base])
            places.append(own)
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        yield pa.record_batch([pa.array(numbers, pa.int64()), batch.column(0), pa.array(spans, kind), pa.array(places, pa.list_(place))], names=["row", "doc_id", "base", "places"])


def _word_hash(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.lower().encode(), digest_size=8).digest(), "little", signed=True)


def _count_places(found):
    """How often each marked pattern stands before any word at all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(found.value, np.uint8)
        mask = _U(len(bits) * 8 - 1)
        empty = _U(_hash(b""))
        for batch in batches:
            words, order, counts = numbered_words(batch.column(0))
            bare = [_bare(w) for w in words]
            hashes = np.fromiter(map(_hash, bare), np.uint64, len(bare))[order]
            real = np.fromiter(map(bool, bare), bool, len(bare))[order]  # words of signs alone are no places
            text = np.repeat(np.arange(len(counts)), counts)[real]
            hashes = hashes[real]
            at = np.arange(len(hashes)) + 2 * text + 2  # two empty words stand between texts
            h = np.full(len(hashes) + 2 * len(counts) + 4, empty, np.uint64)
            h[at] = hashes
            one, two, next_ = h[at - 1], h[at - 2], h[at + 1]
            keys = np.concatenate([_mix(1, one, one * _U(0)), _mix(2, one, two), _mix(3, one, next_)])
            place = keys & mask
            keys = keys[(bits[(place >> _U(3)).astype(np.int64)] >> (place & _U(7)).astype(np.uint8) & 1).astype(bool)]
            values, counts = np.unique(keys, return_counts=True)
            yield pa.record_batch([pa.array(values.view(np.int64)), pa.array(counts, pa.int64())], names=["pattern", "places"])

    return count


def find_personal_data(docs: DataFrame, text: str = "text", rounds: int | None = None) -> DataFrame:
    """doc_id, base (array of kind number, start, end) and learnt (array of
    start, end, kind number). Rounds go on until nothing new is learnt, unless ``rounds`` ends them."""
    spark = docs.sparkSession
    folder = scratch(spark, "pii")
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = "struct<kind:int,start:int,end:int>"
    found = keep(docs.select("doc_id", text).mapInArrow(tidy(_find), f"row long, doc_id {kind}, base array<{span}>, places array<struct<kind:int,start:int,end:int,word:long,patterns:array<long>>>"), f"{folder}/found")
    places = found.select("row", F.explode("places").alias("p")).select("row", "p.kind", "p.start", "p.end", "p.word", F.explode("p.patterns").alias("pattern"))
    # The graph: how often which word stands in which pattern.
    graph = keep(places.groupBy("pattern", "word").agg(F.count("*").alias("n"), F.min("kind").alias("kind")), f"{folder}/graph")
    known = keep(graph.where(F.col("kind") < len(KINDS)).groupBy("word").agg(F.min("kind").alias("kind")), f"{folder}/known")
    # Patterns with fewer words than a pattern needs known ones can never be accepted, whatever is learnt.
    able = graph.groupBy("pattern").agg(F.count("*").alias("words")).where(F.col("words") >= MIN_SEEDS)
    graph = keep(marked(graph.select("pattern", "word", "n"), "pattern", marks(able, "pattern")), f"{folder}/able")
    seen = keep(graph.groupBy("pattern").agg(F.sum("n").alias("candidates")), f"{folder}/candidates")
    totals, n = None, 0
    while rounds is None or n < rounds:
        hits = marked(graph, "word", marks(known, "word")).join(known, "word").groupBy("pattern").agg(F.sum("n").alias("hits"), F.count("*").alias("different"), F.mode("kind", True).alias("kind"))
        hits = keep(hits.where(F.col("different") >= MIN_SEEDS), f"{folder}/hits{n}")
        # Only the patterns that have just reached the seeds have no count yet.
        fresh = hits.select("pattern") if totals is None else hits.select("pattern").join(totals, "pattern", "left_anti")
        if not fresh.isEmpty():
            counted = docs.select(text).mapInArrow(tidy(_count_places(marks(fresh, "pattern"))), "pattern long, places long").groupBy("pattern").agg(F.sum("places").alias("places"))
            counted = keep(counted.join(fresh, "pattern", "left_semi"), f"{folder}/counted{n}")
            totals = counted if totals is None else totals.unionByName(counted)
        if totals is None:
            break
        scored = hits.join(totals, "pattern").join(seen, "pattern").where(F.col("hits") >= MIN_SHARE * F.col("places"))
        scored = scored.withColumn("precision", F.least(F.col("hits") / (F.col("candidates") + 1), F.lit(0.999))).where(F.col("precision") >= MIN_PRECISION)
        scored = scored.select("pattern", "precision", "kind")
        words = graph.join(scored, "pattern").join(known.select("word"), "word", "left_anti").groupBy("word").agg((1 - F.exp(F.sum(F.log1p(-F.col("precision"))))).alias("score"), F.min(F.struct(-F.col("precision"), "kind")).alias("best"))
        more = keep(words.where(F.col("score") >= MIN_SCORE).select("word", F.col("best.kind").alias("kind")), f"{folder}/learnt{n}")
        if more.isEmpty():
            break
        known = keep(known.unionByName(more), f"{folder}/known{n}")
        n += 1
    learnt = places.where(F.col("kind") == len(KINDS)).select("row", "start", "end", "word").distinct().join(known, "word")
    new = learnt.groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "end", "kind"))).alias("learnt"))
    return found.join(new, "row", "left").select("doc_id", "base", F.coalesce("learnt", F.array().cast("array<struct<start:int,end:int,kind:int>>")).alias("learnt"))


def op5_pii(spark, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def of_kind(i: int):
        return F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")

    base = F.transform("base", lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    learnt = F.transform("learnt", lambda s: F.concat_ws(":", F.concat(F.lit(LEARNT), F.element_at(kinds, s["kind"] + 1)), s["start"].cast("string"), s["end"].cast("string")))
    return found.select("doc_id", *[of_kind(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(F.concat_ws(",", base), 256).alias("base_sha256"), F.concat_ws(",", F.concat(base, learnt)).alias("spans"))
