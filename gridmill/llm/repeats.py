"""Exact removal of repeated byte strings, ordered by linear grouping construction.

A byte goes if a string of ``LENGTH`` bytes around it also starts anywhere else.

Every such string holds an anchor: the place whose ``GRAM``-byte hash is least in
it, which depends on the string alone, so that all its occurrences have the anchor
at the same distance. Anchors with what lies up to ``LENGTH`` bytes around them
stand for all strings, and texts need not be compared whole:

1. Anchors with equal surroundings repeat each other: all strings within are gone.
2. Of the rest, surroundings that differ can still share strings. Such a string has
   at least half its excess on one side of the anchor; anchors meet by the hash of
   that much on the left or on the right, one representative for equal ones.
3. Surroundings that met are cut into blocks, aligned on the anchor and named by
   content; the suffixes of all these sequences are ordered by
   :func:`suffix_order`. Neighbours in that order that share as many blocks as a
   string must hold are compared string by string.

:func:`suffix_order` groups suffixes by their Lyndon prefix. Groups are processed in
descending order: each suffix of the group finds the previous smaller one, whose
prefix then extends by the group's, as often as members point to it; that splits
the groups of those found. Then the suffixes are emitted in ascending order, each
one placing those whose Lyndon prefix ends where it starts.

Strings never cross documents, and removal is judged on the input. Step 1 and 2 are
aggregations, step 3 reads sorted streams. The surroundings of a key that has more
than ``LARGE`` different ones are not gathered: their strings are counted one by one
in an aggregation, which finds the same.

Defined cases: a null text is empty; a text shorter than ``LENGTH`` bytes loses
nothing; repeated rows repeat each other; rows are told apart by a 64-bit hash of
id and text; an empty table gives an empty result; columns other than the id and
the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.llm.common import keep, marked, marks, row_hash, scratch, table, tidy, utf8

LENGTH = 400
GRAM = 32
BLOCK = 64
#: Different surroundings of one key that a task compares; about 12 MB.
LARGE = 20_000
#: Bytes of texts that are hashed at a time, and bits for a place among them.
PIECE = 1 << 19
PLACE_BITS = 23
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
#: Bytes to the left of the anchor from which a string counts as a left one.
LEFT = (LENGTH - GRAM) // 2
#: Whole blocks that any string holds.
WHOLE = (LENGTH - BLOCK + 1) // BLOCK


def suffix_order(s: list[int]) -> list[int]:
    """Starts of the suffixes of ``s`` in ascending order (a suffix before what extends it)."""
    s = [*s, -1]
    n = len(s)
    members: list[set[int]] = []
    after: list[int] = []  # group numbers, linked in ascending order
    before: list[int] = []
    at: dict[int, int] = {}
    for x in sorted(set(s)):
        at[x] = len(members)
        members.append(set())
        before.append(len(members) - 2)
        after.append(len(members))
    last = len(members) - 1
    after[last] = -1
    group = [at[x] for x in s]
    for i, g in enumerate(group):
        members[g].add(i)
    length = [1] * n
    smaller = [-1] * n
    skip = list(range(n))  # leads left, over suffixes that are done

    g = last
    while g >= 0:
        own = members[g]
        for i in own:
            skip[i] = i - 1
        count: dict[int, int] = {}
        for i in own:
            j = i - 1
            while j >= 0 and skip[j] != j:
                j = skip[j]
            k = i
            while skip[k] > j:
                skip[k], k = j, skip[k]
            smaller[i] = j
            if j >= 0:
                count[j] = count.get(j, 0) + 1
        if count:
            extra = length[i]
            moves: dict[tuple[int, int], list[int]] = {}
            for j, k in count.items():
                moves.setdefault((-k, group[j]), []).append(j)
                length[j] += k * extra
            for k, old in sorted(moves):
                moved = moves[k, old]
                if len(moved) == len(members[old]):
                    continue  # the whole group extends alike
                members[old].difference_update(moved)
                new = len(members)
                members.append(set(moved))
                before.append(old)
                after.append(after[old])
                if after[old] >= 0:
                    before[after[old]] = new
                after[old] = new
                for j in moved:
                    group[j] = new
        g = before[g]

    g, free = group[n - 1], {}
    start = 0
    while g >= 0:
        free[g] = start
        start += len(members[g])
        g = after[g]
    out = [n - 1] * n
    for place in range(n):
        j = out[place]
        i = j - 1
        while i >= 0 and i + length[i] == j:
            out[free[group[i]]] = i
            free[group[i]] += 1
            i = smaller[i]
    return out[1:]


def _gram_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all strings of ``n`` bytes, by doubling: n is summed up from powers of two."""
    power, size, h = _BASE, 1, data.astype(np.uint64) + _U(1)
    out, done = None, 0
    while True:
        if n & size:
            out = h if out is None else out[: len(h) - done] * power + h[done:]
            done += size
        if size * 2 > n:
            return out
        h = h[:-size] * power + h[size:]
        power, size = _U(int(power) ** 2 & 0xFFFFFFFFFFFFFFFF), size * 2


def _least_in_windows(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes, the place of the (leftmost) least one."""
    bits = PLACE_BITS
    mixed = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    key = ((mixed ^ (mixed >> _U(29))) >> _U(bits) << _U(bits)) | np.arange(len(h), dtype=np.uint64)
    pad = -len(key) % width
    full = np.concatenate([key, np.full(pad, np.iinfo(np.uint64).max)]).reshape(-1, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = len(h) - width + 1
    return (np.minimum(behind[:windows], ahead[width - 1 : width - 1 + windows]) & _U((1 << bits) - 1)).astype(np.int64)


def anchors(texts: list[bytes]) -> tuple[list[int], list[int]]:
    """(text number, place) of all anchors; each string of LENGTH bytes has one."""
    numbers: list[int] = []
    places: list[int] = []
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def flush() -> None:
        if not held:
            return
        data = np.frombuffer(b"".join(x for _, _, x in held), np.uint8)
        least = _least_in_windows(_gram_hashes(data, GRAM), LENGTH - GRAM + 1)
        begin = 0
        for number, first, piece in held:
            own = least[begin : begin + len(piece) - LENGTH + 1]
            own = own[np.concatenate([[True], own[1:] != own[:-1]])] - begin + first
            numbers.extend([number] * len(own))
            places.extend(own.tolist())
            begin += len(piece)
        held.clear()

    for number, text in enumerate(texts):
        for first in range(0, len(text) - LENGTH + 1, PIECE):
            piece = text[first : first + PIECE + LENGTH - 1]
            held.append((number, first, piece))
            size += len(piece)
            if size >= PIECE:
                flush()
                size = 0
    flush()
    return numbers, places


def _surroundings(text: bytes, place: int) -> tuple[int, bytes]:
    left = min(place, LENGTH - GRAM)
    return left, text[place - left : place + LENGTH]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, texts = batch.column(0).to_pylist(), utf8(batch.column(1))
        numbers, places = anchors(texts)
        out: list[tuple] = []
        for k, (number, place) in enumerate(zip(numbers, places)):
            if k and numbers[k - 1] == number and places[k - 1] == place:
                continue  # two pieces of a long text can end and begin with the same anchor
            text = texts[number]
            left, around = _surroundings(text, place)
            right = len(around) - left
            out.append((
                rows[number], place, left, right, _signed(xxhash.xxh3_64_intdigest(around, left)),
                _signed(xxhash.xxh3_64_intdigest(around[left - LEFT : left + GRAM], 1)) if left >= LEFT else None,
                _signed(xxhash.xxh3_64_intdigest(around[left : left + LENGTH - LEFT + 1], 2)) if right > LENGTH - LEFT else None,
            ))
        for at in range(0, len(out), 100_000):
            columns = zip(*out[at : at + 100_000])
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=["row", "place", "left", "right", "around", "left_key", "right_key"])


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The surroundings that were asked for: on the left side or the right side of the anchor."""
    for batch in batches:
        keys, rows, places, surrounds, sides = [], [], [], [], []
        for text, wanted, row in zip(utf8(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            for w in wanted:
                left, around = _surroundings(text, w["place"])
                keep_left = left if w["side"] == 0 else min(left, LEFT - 1)
                around = around[left - keep_left :]
                # A left string ends at most LENGTH - LEFT bytes after the anchor.
                surrounds.append(around[: keep_left + LENGTH - LEFT] if w["side"] == 0 else around)
                keys.append(w["key"]), rows.append(row), places.append(w["place"]), sides.append(keep_left)
        yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(rows, pa.int64()), pa.array(places, pa.int32()), pa.array(sides, pa.int32()), pa.array(surrounds, pa.binary())], names=["key", "row", "place", "left", "around"])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string (its hash, row, start) of the surroundings under large keys."""
    for batch in batches:
        for _, row, place, left, around in zip(*(c.to_pylist() for c in batch.columns)):
            if len(around) >= LENGTH:
                h = np.array([_signed(xxhash.xxh3_64_intdigest(around[i : i + LENGTH], left - i)) for i in range(len(around) - LENGTH + 1)], np.int64)
                starts = np.arange(len(h)) + (place - left)
                yield pa.record_batch([pa.array(h), pa.array(np.full(len(h), row, np.int64)), pa.array(starts, pa.int64())], names=["string", "row", "first"])


def shared_strings(keys: list[int], lefts: list[int], surrounds: list[bytes]) -> list[tuple[int, int, int]]:
    """(number, first, after the last) of the stretches of surroundings, counted from
    their own start, that are strings shared with other surroundings under the same
    key at the same distance from the anchor."""
    # Blocks aligned on the anchor: the first whole one starts 'skip' bytes in.
    sequence: list[int] = []
    owner: list[int] = []
    offset: list[int] = []  # of the block from the anchor
    names: dict[bytes, int] = {}
    for k, (left, around) in enumerate(zip(lefts, surrounds)):
        for b in range(left % BLOCK, len(around) - BLOCK + 1, BLOCK):
            sequence.append(names.setdefault(around[b : b + BLOCK], len(names)))
            owner.append(k)
            offset.append(b - left)
        sequence.append(-1)
        owner.append(k)
        offset.append(0)
    ends = [x for x, name in enumerate(sequence) if name < 0]
    for x, place in enumerate(ends):  # every end is a name of its own, below all blocks
        sequence[place] = -2 - x
    order = np.array(suffix_order([x + len(ends) + 2 for x in sequence]), np.int64)
    names_of = np.array(sequence + [-1] * WHOLE, np.int64)
    whole = np.lib.stride_tricks.sliding_window_view(names_of, WHOLE)[order]
    # Groups of suffixes that share as many blocks as a string holds at least.
    alike = (whole[1:] == whole[:-1]).all(axis=1)
    groups = np.concatenate([[0], np.cumsum(~alike)])
    many = np.flatnonzero((np.bincount(groups)[groups] > 1) & (np.array(sequence, np.int64)[order] >= 0))
    whose, begin = np.array(owner, np.int64)[order[many]], np.array(offset, np.int64)[order[many]]
    # Strings whose first whole block is one of these: they start up to BLOCK - 1 bytes before it.
    left, size = np.array(lefts, np.int64), np.fromiter(map(len, surrounds), np.int64, len(surrounds))
    base = np.cumsum(size) - size
    start = (left[whose] + begin)[:, None] - np.arange(BLOCK)
    k = np.broadcast_to(whose[:, None], start.shape)
    valid = (start >= 0) & (start + LENGTH <= size[k])
    start, k = start[valid], k[valid]
    if not len(k):
        return []
    h = _gram_hashes(np.frombuffer(b"".join(surrounds), np.uint8), LENGTH)[base[k] + start]
    under = np.array(keys, np.int64).view(np.uint64)[k]
    h = (h ^ (start - left[k]).astype(np.uint64) * _U(0x94D049BB133111EB)) * _BASE ^ under
    _, inverse, counts = np.unique(h, return_inverse=True, return_counts=True)
    shared = counts[inverse] > 1
    k, start = k[shared], start[shared]
    if not len(k):
        return []
    order = np.lexsort((start, k))
    k, start = k[order], start[order]
    new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (start[1:] > start[:-1] + LENGTH)]))
    last = np.append(new[1:], len(k)) - 1
    return list(zip(k[new].tolist(), start[new].tolist(), (start[last] + LENGTH).tolist()))


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans (row, first, last) that surroundings sorted by key share."""
    held: list[tuple] = []

    def spans(rows: list[tuple]) -> pa.RecordBatch:
        keys, ids, places, lefts, surrounds = zip(*rows)
        found = [(ids[k], places[k] - lefts[k] + a, places[k] - lefts[k] + b) for k, a, b in shared_strings(list(keys), list(lefts), list(surrounds))]
        columns = list(zip(*found)) or [[], [], []]
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["row", "first", "last"])

    for batch in batches:
        held += zip(*(c.to_pylist() for c in batch.columns))
        if len(held) > 1500 and held[0][0] != held[-1][0]:
            cut = next(i for i in range(len(held) - 1, -1, -1) if held[i][0] != held[-1][0]) + 1
            yield spans(held[:cut])
            held = held[cut:]
    if held:
        yield spans(held)


def repeated_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, first, last): bytes that repeated strings cover; spans of a row may overlap
    and come more than once.

    ``row`` is the document's :func:`row_hash`.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "repeats")
    rows = docs.select(row_hash(text).alias("row"), text)
    found = keep(rows.mapInArrow(tidy(_anchor_rows), "row long, place int, left int, right int, around long, left_key long, right_key long"), f"{folder}/anchors")
    classes = found.groupBy("around").agg(F.count("*").alias("many"), F.min(F.struct("row", "place")).alias("one"), F.first("left_key").alias("left_key"), F.first("right_key").alias("right_key"))
    classes = keep(classes, f"{folder}/classes")

    alike = found.join(classes.where("many > 1").select("around"), "around").where(F.col("left") + F.col("right") >= LENGTH)
    covered = alike.select("row", (F.col("place") - F.col("left")).cast("long").alias("first"), (F.col("place") + F.col("right")).cast("long").alias("last"))

    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("left_key").alias("key")), F.struct(F.lit(1).alias("side"), F.col("right_key").alias("key")))
    keyed = classes.select("one", F.explode(sides).alias("s")).where("s.key IS NOT NULL").select("one", "s.side", "s.key")
    # Counts are stored before they are joined: only a join that shuffles both sides can split a key that many rows share.
    counts = keep(keyed.groupBy("key").agg(F.count("*").alias("many")).where("many > 1"), f"{folder}/counts")
    meeting = keyed.join(counts, "key").select(F.col("one.row").alias("row"), F.col("one.place").alias("place"), "side", "key", (F.col("many") > LARGE).alias("large"))
    meeting = keep(meeting, f"{folder}/meeting")

    def surroundings(which: DataFrame) -> DataFrame:
        wanted = which.groupBy("row").agg(F.collect_list(F.struct("key", "side", "place")).alias("wanted"))
        texts = marked(rows, "row", marks(which, "row")).dropDuplicates(["row"]).join(wanted, "row").select(text, "wanted", "row")
        return texts.mapInArrow(tidy(_cut_out), "key long, row long, place int, left int, around binary")

    dealt = surroundings(meeting.where("NOT large")).repartition("key").sortWithinPartitions("key")
    shared = dealt.mapInArrow(tidy(_compare), "row long, first long, last long")
    # Stored one by one: their tasks differ too much in size for one stage.
    spans = keep(covered, f"{folder}/covered").unionByName(keep(shared, f"{folder}/shared"))
    if not meeting.where("large").limit(1).isEmpty():
        strings = keep(surroundings(meeting.where("large")), f"{folder}/large").mapInArrow(tidy(_strings), "string long, row long, first long")
        again = keep(strings.groupBy("string").agg(F.count("*").alias("many")).where("many > 1").select("string"), f"{folder}/again")
        counted = marked(strings, "string", marks(again, "string")).join(again, "string").select("row", "first", (F.col("first") + LENGTH).alias("last"))
        spans = spans.unionByName(keep(counted, f"{folder}/counted"))
    return spans


def _removal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = utf8(batch.column(1))
        left = batch.column(1).cast(pa.binary()).to_pylist()
        firsts = batch.column(2).to_pylist() if batch.num_columns > 2 else [None] * len(texts)
        out = []
        for number, (text, spans) in enumerate(zip(texts, firsts)):
            runs: list[list[int]] = []
            for span in sorted((s["first"], s["last"]) for s in spans or ()):
                if runs and span[0] <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], span[1])
                else:
                    runs.append(list(span))
            parts, last = [], 0
            for a, b in runs:
                parts.append(text[last:a])
                last = b
            parts.append(text[last:])
            kept = b"".join(parts)
            if runs:  # a run can end within a character, what is then left of it is none
                left[number] = b"".join(x.decode("utf-8", "ignore").encode() for x in parts)
            out.append((len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), [x for r in runs for x in r]))
        n, removed, spans, digest, runs = (list(c) for c in zip(*out)) if out else ([], [], [], [], [])
        columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string()), pa.array(left, pa.binary()).view(pa.string()), pa.array(runs, pa.list_(pa.int64()))]
        yield pa.record_batch(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text", "runs"])


def remove_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, ``text`` (what is left, without
    characters of which a byte is removed) and ``runs`` (first and after the last byte of
    each removed run, one after the other) of every row."""
    spans = repeated_spans(docs, text)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string, runs array<long>"
    found = marks(spans, "row")
    rows = docs.select("doc_id", text, row_hash(text).alias("row"))
    whole = marked(rows, "row", found, yes=False).select("doc_id", text).mapInArrow(tidy(_removal), schema)
    by_row = spans.groupBy("row").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    cut = marked(rows, "row", found).join(by_row, "row", "left").select("doc_id", text, "spans").mapInArrow(tidy(_removal), schema)
    return whole.unionByName(cut)


def op10_repeats(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text")
