"""Set-similarity join on word shingles with adaptive multi-match prefixes.

A document's set holds its distinct shingles of ``WORDS`` words. All sets are put
in one order, rare shingles first. Two sets with similarity of at least t share at
least l of the first |s| - ceil(t |s|) + l shingles of each, for any l: a longer
prefix costs more postings, and asks for more shared ones before a pair is verified.

Each document chooses its l by the estimated cost of its candidates, read from the
counts of the shingles in its prefix; a pair must share at least the lesser of the
two l. Counts come from a sketch of fixed size, summed over all documents. It only
sets the order and the l, so that errors in it cost time and lose no pair.

Rows with the same set form one class at once, named by a 64-bit hash of the set
(n classes make n*n/2**65 wrong merges in the mean). Before the join, classes that
share a minimum of one of a few hash functions are held against the most central of
them (the one with most prefix shingles that others have, too), and what proves
similar is united: a large group of near copies becomes one part after linear work.
What was held together and is not far apart makes a family. A family's members of
different parts are compared in blocks of ``BLOCK`` against ``BLOCK``, which returns
links and no pairs; the join then skips pairs inside a family, and verifies all
others on whole texts. A pair's shared prefix shingles bound its overlap: c of them
allow at most c and what lies behind the longer of the two prefixes' ends.

Postings meet by shingle in sorted streams; those of a crowded one, which the sketch
tells, are cut into chunks that meet two and two, in tasks of their own. Verification is
dealt out by one side of the pair in chunks of ``CHUNK`` partners. Joins by a key that
many rows can share are joins of two stored tables, whose large partitions Spark splits
at run time. Comparing a family takes work with the square of its number of parts, in
blocks of bounded size. Texts travel only where a pair asks for them: a bitmap of fixed
size tells which ones may be asked for before they are shuffled.

Defined cases: a null text, or one without words, has an empty set, links with
nothing and is its own component; ids that are null are never a component's name
unless it holds no others, then it is null; repeated rows and rows that share an id
are rows of their own; an empty table gives an empty result; columns other than the
id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.llm.common import WORD, hashed_words, keep, marked, marks, row_hash, scratch, table, text_hash, tidy
from gridmill.llm.links import components

WORDS = 5
PERCENT = 75
#: log2 of the sketch's counters: 4 MB of 32-bit counts, whatever the corpus.
SKETCH_BITS = 20
SKETCH_PART = 1 << 14
HASHES = 4
#: l is tried up to this; a greater one would need longer prefixes than it saves.
MOST_MATCHES = 16
#: Verifying one pair costs about as much as this many postings.
VERIFY_COST = 20
CHUNK = 64
#: Members of a family that a task compares with as many, and how far apart those may be
#: that found it.
BLOCK = 256
FAMILY = 0.6
#: Postings of a shingle beyond what a cell holds anyhow that stay together; those of a
#: more crowded one meet in a grid of chunks.
CROWD = 4096
GRID = 1 << 20

_MIX = np.uint64(0x9E3779B97F4A7C15)
_U = np.uint64
_SEEDS = np.arange(1, HASHES + 1, dtype=np.uint64) * _U(0xD6E8FEB86659FD93)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Each text's sorted distinct 64-bit hashes of shingles."""
    h, counts = hashed_words(texts)
    ends = np.cumsum(counts)
    full = _hashed_runs(h, WORDS)
    sets = []
    for end, n in zip(ends.tolist(), counts.tolist()):
        if n >= WORDS:
            own = np.sort(full[end - n : end - WORDS + 1])
            new = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=new[1:])
            sets.append(own[new])
        else:  # the whole sequence as one
            sets.append(_hashed_runs(h[end - n : end], n) if n else np.zeros(0, np.uint64))
    return sets


def _hashed_runs(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words in a row."""
    out = np.full(max(len(h) - n + 1, 0), n, np.uint64)
    for i in range(n):
        out = (out ^ h[i : i + len(out)]) * _MIX
        out ^= out >> _U(29)
    return _scramble(out)


def _class(s: np.ndarray) -> int:
    """The class that a set names."""
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document, and at the end the task's sketch in parts."""
    cells = np.zeros(1 << SKETCH_BITS, np.uint32)
    schema = None
    for batch in batches:
        sets = shingle_sets(batch.column(2))
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        every = np.concatenate([*sets, np.zeros(0, np.uint64)])
        cells += np.bincount((every >> _U(64 - SKETCH_BITS)).astype(np.int64), minlength=len(cells)).astype(np.uint32)
        filled = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[filled]
        least = np.stack([np.minimum.reduceat(_scramble(every ^ seed), starts) for seed in _SEEDS], axis=1) if len(filled) else np.zeros((0, HASHES), np.uint64)
        minima = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(HASHES * (sizes > 0))]), pa.int32()), pa.array(least.ravel().view(np.int64)))
        empty = pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())
        out = pa.record_batch([batch.column(0), batch.column(1), pa.array(sizes), pa.array([_class(s) for s in sets], pa.int64()), minima, *empty], names=["doc_id", "text_hash", "n_shingles", "node", "minima", "part", "cells"])
        schema = out.schema
        yield out
    if schema is not None and cells.any():
        parts = cells.astype("<u4").reshape(-1, SKETCH_PART)
        n = len(parts)
        yield pa.record_batch([*[pa.nulls(n, schema.field(i).type) for i in range(5)], pa.array(range(n), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], schema=schema)


def _add_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the sketch's parts, one in memory for each part of the partition."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            more = np.frombuffer(cells, "<u4").astype(np.uint64)
            sums[part] = sums[part] + more if part in sums else more
    if sums:
        held = [np.minimum(x, 0xFFFFFFFF).astype("<u4").tobytes() for x in sums.values()]
        yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array(held, pa.binary())], names=["part", "cells"])


def prefix(s: np.ndarray, counts: np.ndarray, usual: int) -> tuple[np.ndarray, int]:
    """The shingles of the prefix that suits ``s`` best, and its l.

    ``counts`` are the sketch's; ``usual`` is what a cell holds anyhow. Postings of
    the prefix are read, and at most that many over l can share l shingles.
    """
    cell = np.minimum(counts[(s >> _U(64 - SKETCH_BITS)).astype(np.int64)], np.uint32((1 << 24) - 1)).astype(np.uint64)
    order = np.argsort((cell << _U(40)) | (s >> _U(24)), kind="stable")
    need = (PERCENT * len(s) + 99) // 100
    most = min(MOST_MATCHES, need)
    cost = np.cumsum(np.maximum(cell[order].astype(np.int64) - usual, 0) + 1)
    ends = len(s) - need + np.arange(1, most + 1)
    read = cost[ends - 1]
    best = int(np.argmin(read + VERIFY_COST * read / np.arange(1, most + 1))) + 1
    return s[order[: ends[best - 1]]], best


def _postings(counts, usual: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        held = counts.value
        for batch in batches:
            tokens, nodes, sizes, matches, chunks = [], [], [], [], []
            for s in shingle_sets(batch.column(0)):
                node = _class(s)
                if not len(s) or node in done:
                    continue
                done.add(node)
                head, l = prefix(s, held, usual)
                tokens.append(head)
                # How many chunks a shingle's postings come in, if all that its cell counts were its own.
                chunks.append(1 + np.maximum(held[(head >> _U(64 - SKETCH_BITS)).astype(np.int64)].astype(np.int64) - usual, 0) // CROWD)
                nodes.append(node)
                sizes.append(len(s))
                matches.append(l)
            if tokens:
                lengths = [len(x) for x in tokens]
                node, parts = np.repeat(np.array(nodes, np.int64), lengths), np.concatenate(chunks)
                columns = [np.concatenate(tokens).view(np.int64), node, np.repeat((np.array(sizes, np.int64) << 8) | np.array(matches, np.int64), lengths), parts.astype(np.int32), (node % parts).astype(np.int32)]
                for at in range(0, len(columns[0]), 200_000):
                    yield pa.record_batch([pa.array(c[at : at + 200_000]) for c in columns], names=["token", "node", "measure", "chunks", "chunk"])

    return emit


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of batches sorted by the first two, cut so that equal values stay together."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            columns = [np.concatenate([a, b]) for a, b in zip(held, columns)]
        if not len(columns[0]):
            continue
        other = (columns[0] != columns[0][-1]) | (columns[1] != columns[1][-1])
        cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
        if cut:
            yield [c[:cut] for c in columns]
        held = [c[cut:] for c in columns]
    if held is not None and len(held[0]):
        yield held


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings of shingles that more than one class has, each class once. Those of a crowded
    shingle, which come in several chunks, all pass."""
    ordered = (batch.select(["token", "chunk", "node", "measure", "chunks"]) for batch in batches)
    for token, chunk, node, measure, chunks in _runs(ordered):
        first = np.concatenate([[True], (token[1:] != token[:-1]) | (chunk[1:] != chunk[:-1]) | (node[1:] != node[:-1])])
        token, chunk, node, measure, chunks = (c[first] for c in (token, chunk, node, measure, chunks))
        same = token[1:] == token[:-1]
        many = np.concatenate([[False], same]) | np.concatenate([same, [False]]) | (chunks > 1)
        if many.any():
            yield pa.record_batch([pa.array(c[many]) for c in (token, node, measure, chunks, chunk)], names=["token", "node", "measure", "chunks", "chunk"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of classes of different families that share a shingle and may link by size,
    among rows (token, cell, family, node, measure, chunk): a cell of a shingle's grid holds
    the postings of one chunk, or of two that meet each other alone."""
    for token, cell, family, node, measure, chunk in _runs(batches):
        edges = np.concatenate([[0], np.flatnonzero((token[1:] != token[:-1]) | (cell[1:] != cell[:-1])) + 1, [len(token)]])
        size = measure >> 8
        first, second = [], []
        for begin, stop in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if stop - begin < 2 or family[begin] == family[stop - 1]:  # sorted by family within a cell
                continue
            crossing = cell[begin] % GRID != cell[begin] // GRID
            for i in range(begin, stop - 1):
                others = np.arange(int(np.searchsorted(family[begin:stop], family[i], "right")) + begin, stop)
                small, large = np.minimum(size[i], size[others]), np.maximum(size[i], size[others])
                others = others[(100 * small >= PERCENT * large) & ((chunk[others] != chunk[i]) | (not crossing))]
                if len(others):
                    first.append(np.full(len(others), i))
                    second.append(others)
            if sum(map(len, second)) > 100_000:
                yield _pairs(first, second, node, measure)
                first, second = [], []
        if second:
            yield _pairs(first, second, node, measure)


def _pairs(first: list[np.ndarray], second: list[np.ndarray], node: np.ndarray, measure: np.ndarray) -> pa.RecordBatch:
    i, j = np.concatenate(first), np.concatenate(second)
    a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
    x, y = measure[i] >> 8, measure[j] >> 8
    overlap = -(-PERCENT * (x + y) // (100 + PERCENT))
    behind = np.maximum((PERCENT * x + 99) // 100 - (measure[i] & 255), (PERCENT * y + 99) // 100 - (measure[j] & 255))
    return pa.record_batch([pa.array(a), pa.array(b), pa.array(np.maximum(overlap - behind, np.minimum(measure[i] & 255, measure[j] & 255)))], names=["a", "b", "needed"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Similarity of pairs of rows (a, chunk, b, text): a's own text has a null b and comes first."""
    head, own = None, None
    for batch in batches:
        a, _, b = (batch.column(i).to_pylist() for i in range(3))
        found = []
        for x, y, s in zip(a, b, shingle_sets(batch.column(3))):
            if y is None:
                head, own = x, s
            elif head == x:
                both = len(own) + len(s) - len(np.unique(np.concatenate([own, s])))
                either = len(own) + len(s) - both
                found.append((x, y, 100 * both >= PERCENT * either, 1 - both / either))
        columns = list(zip(*found)) or [[], [], [], []]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.bool_(), pa.float64()))], names=["a", "b", "links", "distance"])


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that join parts, among rows (family, first, second, block, node, part, text) of
    two blocks; of many links between the same parts, those of a spanning forest."""
    at, held = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[:6]]
        for row, s in zip(zip(*columns), shingle_sets(batch.column(6))):
            if row[:3] != at and held:
                yield _block_links(held)
                held = []
            at = row[:3]
            held.append((row[3], row[4], row[5], s))
    if held:
        yield _block_links(held)


def _block_links(rows: list[tuple[int, int, int, np.ndarray]]) -> pa.RecordBatch:
    sizes = np.array([len(s) for *_, s in rows])
    _, place = np.unique(np.concatenate([s for *_, s in rows]), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), sizes)
    both = np.zeros((len(rows), len(rows)), np.int64)
    for begin in range(0, int(place.max()) + 1, 1 << 14):  # a stretch of shingles at a time
        inside = (place >= begin) & (place < begin + (1 << 14))
        held = np.zeros((len(rows), 1 << 14), np.float32)
        held[owner[inside], place[inside] - begin] = 1
        both += (held @ held.T).astype(np.int64)
    links = 100 * both >= PERCENT * (sizes[:, None] + sizes[None, :] - both)
    root = {p: p for _, _, p, _ in rows}

    def find(p: int) -> int:
        while root[p] != p:
            root[p] = root[root[p]]
            p = root[p]
        return p

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(links, 1)))):
        a, b = find(rows[i][2]), find(rows[j][2])
        if a != b:
            root[a] = b
            out.append((rows[i][1], rows[j][1]))
    return pa.record_batch([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["a", "b"])


def family_links(families: DataFrame, docs: DataFrame, nodes: DataFrame, folder: str, text: str = "text") -> DataFrame:
    """Links between parts inside each family (node, family, part)."""
    # Parts are dealt to a family's blocks by hash, a large part's members to several of them.
    sizes = keep(families.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("slots")), f"{folder}/sizes")
    parts = keep(families.groupBy("family", "part").agg(F.ceil(F.count("*") / BLOCK).alias("pieces")), f"{folder}/parts")
    slot, piece = F.pmod(F.xxhash64("part"), F.col("slots")), F.pmod(F.xxhash64("node"), F.col("pieces"))
    placed = keep(families.join(sizes, "family").join(parts, ["family", "part"]).select("node", "family", "part", (slot * F.lit(1 << 32) + piece).alias("block")), f"{folder}/members")
    blocks = placed.groupBy("family", "block").agg(F.min("part").alias("low"), F.max("part").alias("high"))
    a, b = blocks.select("family", F.col("block").alias("first"), "low", "high"), blocks.select("family", F.col("block").alias("second"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    pairs = a.join(b, "family").where((F.col("first") <= F.col("second")) & (F.least("low", "low2") != F.greatest("high", "high2")))
    # Every block meets itself in a pair with itself, so a pair of two needs no third look at either.
    wanted = pairs.select("family", "first", "second", F.explode(F.array_distinct(F.array("first", "second"))).alias("block"))
    rows = keep(wanted.join(placed, ["family", "block"]), f"{folder}/rows")
    texts = keep(node_texts(docs, nodes.join(rows.select("node").distinct(), "node").select("node", "text_hash"), text), f"{folder}/texts")
    dealt = rows.join(texts, "node").select("family", "first", "second", "block", "node", "part", "text").repartition("family", "first", "second").sortWithinPartitions("family", "first", "second")
    return keep(dealt.mapInArrow(tidy(_compare_blocks), "a long, b long"), f"{folder}/links")


def _each_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts by their hash, each once a task."""
    done: set[int] = set()
    for batch in batches:
        new = [i for i, h in enumerate(batch.column(0).to_pylist()) if h not in done and not done.add(h)]
        if new:
            yield batch.take(pa.array(new))


def node_texts(docs: DataFrame, nodes: DataFrame, text: str = "text") -> DataFrame:
    """(node, text) of each of ``nodes`` (node, text_hash)."""
    rows = docs.select(text_hash(text).alias("text_hash"), F.col(text).alias("text"))
    found = marked(rows, "text_hash", marks(nodes, "text_hash")).mapInArrow(tidy(_each_once), "text_hash long, text string")
    return found.join(nodes, "text_hash").dropDuplicates(["node"]).select("node", "text")


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, folder: str, text: str = "text") -> DataFrame:
    """``pairs`` (a, b) with ``links``, whether they are similar enough, and ``distance``."""
    pairs = keep(pairs, f"{folder}/pairs")
    chunks = keep(pairs.groupBy("a").agg(F.ceil(F.count("*").cast("double") / CHUNK).alias("chunks")), f"{folder}/chunks")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = keep(node_texts(docs, nodes.join(asked, "node").select("node", "text_hash"), text), f"{folder}/texts")
    dealt = pairs.join(chunks, "a").select("a", F.pmod(F.xxhash64("b"), F.col("chunks")).alias("chunk"), "b")
    partners = dealt.join(texts.withColumnRenamed("node", "b"), "b").select("a", "chunk", "b", "text")
    heads = dealt.select("a", "chunk").distinct().join(texts.withColumnRenamed("node", "a"), "a").select("a", "chunk", F.lit(None).cast("long").alias("b"), "text")
    rows = heads.unionByName(partners).repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())
    return keep(rows.mapInArrow(tidy(_verify), "a long, b long, links boolean, distance double"), f"{folder}/verified")


def near_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id of every row; ``component`` names the
    component without doubt (null for empty sets)."""
    spark = docs.sparkSession
    folder = scratch(spark, "similar")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_hash(text).alias("text_hash"), text)
    found = keep(rows.mapInArrow(tidy(_describe), f"doc_id {kind}, text_hash long, n_shingles long, node long, minima array<long>, part int, cells binary"), f"{folder}/found")
    described = found.where("part IS NULL").select("doc_id", "text_hash", "n_shingles", "node", "minima")

    sums = found.where("part IS NOT NULL").select("part", "cells").repartition("part").mapInArrow(tidy(_add_parts), "part int, cells binary")
    cells = np.zeros(1 << SKETCH_BITS, np.uint32)
    for row in sums.collect():  # 4 MB in all, in one job instead of one a partition
        cells[row["part"] * SKETCH_PART : (row["part"] + 1) * SKETCH_PART] = np.frombuffer(row["cells"], "<u4")
    usual = int(np.median(cells))
    counts = spark.sparkContext.broadcast(cells)

    classes = keep(described.where("n_shingles > 0").groupBy("node").agg(F.min("text_hash").alias("text_hash"), F.first("n_shingles").alias("n"), F.first("minima").alias("minima")), f"{folder}/classes")
    nodes = classes.select("node", "text_hash")
    postings = docs.select(text).mapInArrow(tidy(_postings(counts, usual)), "token long, node long, measure long, chunks int, chunk int").repartition("token", "chunk").sortWithinPartitions("token", "chunk", "node")
    common = keep(postings.mapInArrow(tidy(_shared), "token long, node long, measure long, chunks int, chunk int"), f"{folder}/common")

    # Pairs of each class with the most central one that shares a minimum.
    central = common.groupBy("node").agg(F.count("*").alias("others"))
    shared = keep(classes.join(central, "node").select("node", "n", "others", F.posexplode("minima").alias("hash", "minimum")), f"{folder}/shared")
    best = shared.groupBy("hash", "minimum").agg(F.max(F.struct("others", "node", "n")).alias("best"), F.count("*").alias("many")).where("many > 1")
    best = keep(best.select("hash", "minimum", "best"), f"{folder}/best")
    close = shared.join(best, ["hash", "minimum"]).where((F.col("node") != F.col("best.node")) & (100 * F.least("n", "best.n") >= PERCENT * F.greatest("n", "best.n")))
    close = close.select(F.col("best.node").alias("a"), F.col("node").alias("b")).distinct()
    held = verified(close, docs, nodes, f"{folder}/close", text)
    first_links = held.where("links").select("a", "b")
    parts = components(first_links, f"{folder}/parts")
    near = held.where(F.col("distance") <= FAMILY).select("a", "b")
    families = components(near, f"{folder}/families").withColumnRenamed("root", "family")
    families = keep(families.join(parts, "node", "left").select("node", "family", F.coalesce("root", "node").alias("part")), f"{folder}/placed")
    inner = family_links(families, docs, nodes, f"{folder}/blocks", text)

    placed = common.join(families.select("node", "family"), "node", "left").select("token", "chunks", "chunk", F.coalesce("family", "node").alias("family"), "node", "measure")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    placed = placed.select("token", "chunk", "family", "node", "measure", other)
    placed = placed.select("token", (F.least("chunk", "other") * F.lit(GRID) + F.greatest("chunk", "other")).alias("cell"), "family", "node", "measure", "chunk")
    met = placed.repartition("token", "cell").sortWithinPartitions("token", "cell", "family", "node").mapInArrow(tidy(_meet), "a long, b long, needed long")
    pairs = met.groupBy("a", "b").agg(F.count("*").alias("shared"), F.max("needed").alias("needed")).where("shared >= needed").select("a", "b")
    links = verified(pairs, docs, nodes, f"{folder}/met", text).where("links").select("a", "b")
    roots = components(first_links.unionByName(inner).unionByName(links), f"{folder}/roots")

    named = described.join(roots, "node", "left").withColumn("component", F.when(F.col("n_shingles") > 0, F.coalesce("root", "node")))
    named = keep(named.select("doc_id", "text_hash", "n_shingles", "component"), f"{folder}/named")
    names = keep(named.where("component IS NOT NULL").groupBy(F.col("component").alias("of")).agg(F.min("doc_id").alias("least_id")), f"{folder}/names")
    out = named.join(names, named["component"] == names["of"], "left")
    return out.select("doc_id", "text_hash", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least_id")).alias("component_id"), "component")


def keep_one_of_each(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the least id, then the least text hash, of
    repeated rows one; rows with empty sets all stay. Columns of any name are carried."""
    found = near_duplicates(docs, text).where("component IS NOT NULL")
    row = F.xxhash64("doc_id", F.col("doc_id").isNull(), "text_hash")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", row.alias("row")))
    stay = found.groupBy("component").agg(first.alias("one")).select("one.row")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), row_hash(text).alias("row"), F.coalesce(F.col(text).rlike(WORD), F.lit(False)).alias("words"))
    # Of repeated rows, first() may see any: they differ in other columns at most.
    others = packed.where("words").select("row", "doc").dropDuplicates(["row"]).join(stay, "row").select("doc.*")
    return others.unionByName(packed.where("NOT words").select("doc.*"))


def op3_similarity(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
