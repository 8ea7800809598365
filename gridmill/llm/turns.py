"""A prefix trie of conversations, by ROLLUP over columns of turn ids.

A conversation is cut into blocks of ``BLOCK`` turns. A block is a row: the columns of
its turns' ids (two 64-bit hashes of role and text, and the text's bytes), and a key, which
stands for all turns before the block: the exclusive or of two 64-bit hashes of each turn
with its place, so that it is a running sum over a conversation's few blocks. One
``GROUP BY block, key, ROLLUP(turn 1, ..., turn 8)`` then aggregates every prefix of
every length at once, and ``grouping_id`` tells how long each is. A longer conversation
goes on as further rows keyed by the node where the block before ended; no round waits
for another. What many conversations share is summed before it is shuffled.

Sums over subtrees need no walk down the trie. A node's first member (least id) stands for
it, and stands for all nodes on its path from the first one that it stands for. So with
``q`` (bytes before that node) of each such conversation, the bytes of the different turns
below a node are sums over its members: a second ROLLUP of the same rows.

Positions come in two steps: conversations are cut into ranges of ``RANGE`` turn numbers,
which are ranked apart, and ranges get the number of turns before them. So a very long
conversation is dealt over tasks. The list of members that end at a node is joined in
stretches of ``CHUNK`` ids and hashed as a stream, so that no list is held as a whole.

Two different sequences would share a node if 128 bits of hash were equal.

Defined cases: rows without conv_id belong to no conversation; null role or text is empty;
turns of one number go by role, then by the MD5 of their text; repeated rows are turns
each; an empty table has no nodes, not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmill.llm.common import keep, scratch, table, tidy

BLOCK = 8
RANGE_BITS = 8
CHUNK = 4096
#: Turns that a conversation may take over, and the group that takes from its first.
HEADS, FAMILY = 9, 5
_EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = ["depth", "n1", "n2"]


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), role, digest (MD5 of the text), size (its bytes), n (turns of the
    conversation)."""
    text = F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.md5(text.cast("binary")).alias("digest"), F.octet_length(text).cast("long").alias("size")
    )
    rows = rows.withColumn("part", F.coalesce(F.shiftright("turn", RANGE_BITS), F.lit(-(1 << 62))))
    parts = rows.groupBy("conv_id", "part").agg(F.count("*").alias("own"))
    before, whole = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("conv_id")
    parts = parts.select("conv_id", "part", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("before"), F.sum("own").over(whole).alias("n"))
    own = Window.partitionBy("conv_id", "part").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return rows.withColumn("nth", F.row_number().over(own)).join(parts, ["conv_id", "part"]).select("conv_id", (F.col("nth") + F.col("before")).alias("pos"), "role", "digest", "size", "n")


def rebuilt_turns(turns: DataFrame) -> DataFrame:
    """conv_id, pos, role, digest, size of every rebuilt conversation: the first h turns of its
    family's first one, then its own after h. Turnless ones are a row of pos 0."""
    convs = turns.where("pos = 1").select("conv_id", "n")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    convs = convs.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    known = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    convs = convs.join(known, "base", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    heads = turns.where(F.col("pos") < HEADS).drop("n").withColumnRenamed("conv_id", "base").join(convs.select("base", "conv_id", "h"), "base").where("pos <= h")
    tails = turns.drop("n").join(convs.select("conv_id", "h", "taken"), "conv_id").where("pos > h").withColumn("pos", F.expr("pos - h + taken"))
    none = convs.where("taken = 0 AND n <= h").select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit("").alias("role"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("size"))
    columns = ["conv_id", "pos", "role", "digest", "size"]
    return heads.select(columns).unionByName(tails.select(columns)).unionByName(none)


def blocks_of(turns: DataFrame) -> DataFrame:
    """A row for each block of a conversation: a1, b1, s1, ... (ids and bytes of its turns),
    key1, key2 and pre (keys and bytes of what is before), and of the whole conversation
    its length, its bytes and its last node."""
    ids = turns.select("conv_id", "pos", "size", F.xxhash64("role", "digest").alias("a"), F.xxhash64("digest", "role", F.lit(1)).alias("b"))
    slot, real = (F.col("pos") - 1) % BLOCK, F.col("pos") > 0
    cells = [F.max(F.when(real & (slot == i), F.col(c))).alias(f"{o}{i + 1}") for i in range(BLOCK) for c, o in (("a", "a"), ("b", "b"), ("size", "s"))]
    marks = [F.bit_xor(F.when(real, _mark(F.col("pos"), F.col("a"), F.col("b"), k)).otherwise(F.lit(0))).alias(f"x{k}") for k in (1, 2)]
    rows = ids.groupBy("conv_id", F.floor(F.greatest(F.col("pos") - 1, F.lit(0)) / BLOCK).alias("block")).agg(*cells, *marks, F.sum("size").alias("bytes"), F.max("pos").alias("last"))
    before, whole = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("conv_id")
    keys = {f"key{k}": F.coalesce(F.bit_xor(f"x{k}").over(before), F.lit(0)) for k in (1, 2)} | {"pre": F.coalesce(F.sum("bytes").over(before), F.lit(0))}
    of_all = {f"end{k}": F.bit_xor(f"x{k}").over(whole) for k in (1, 2)} | {"total": F.sum("bytes").over(whole), "turns": F.max("last").over(whole)}
    return rows.withColumns(keys | of_all).drop("x1", "x2", "bytes", "last")


def _mark(pos: Column, a: Column, b: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), pos.cast("long"), a, b)


def _rolled_up(rows: DataFrame, measures: str) -> DataFrame:
    """``measures`` of every node: depth, n1, n2 (what it is known by), p1, p2 (its parent's),
    prefix (bytes before its last turn)."""
    slots = ", ".join(f"(a{i}, b{i}, s{i})" for i in range(1, BLOCK + 1))
    columns = ", ".join(f"{c}{i}" for i in range(1, BLOCK + 1) for c in "abs")
    found = rows.sparkSession.sql(
        f"SELECT block, key1, key2, pre, {columns}, {BLOCK} - CAST(bit_count(grouping_id()) DIV 3 AS INT) AS level, {measures} FROM {{rows}} GROUP BY block, key1, key2, pre, ROLLUP({slots})", rows=rows
    )
    # Level 0 of a later block is a node of the block before; a level whose turn is null is a shorter conversation.
    last = F.element_at(F.array(*[F.col(f"a{i}") for i in range(1, BLOCK + 1)]), F.greatest("level", F.lit(1)))
    found = found.where((F.col("level") > 0) & last.isNotNull() | (F.col("level") == 0) & (F.col("block") == 0))

    def mark(i: int, k: int, shorter: int) -> Column:
        """The turn's share in the key, where it is one of the first level - shorter."""
        return F.when(F.col("level") - shorter >= i, _mark(F.col("block") * BLOCK + i, F.col(f"a{i}"), F.col(f"b{i}"), k)).otherwise(F.lit(0))

    keys = {}
    for name, shorter in (("n", 0), ("p", 1)):
        for k in (1, 2):
            key = F.col(f"key{k}")
            for i in range(1, BLOCK + 1):
                key = key.bitwiseXOR(mark(i, k, shorter))
            keys[f"{name}{k}"] = key
    prefix = F.col("pre")
    for i in range(1, BLOCK + 1):
        prefix = prefix + F.when(F.col("level") > i, F.col(f"s{i}")).otherwise(F.lit(0))
    found = found.withColumns(keys | {"prefix": prefix, "depth": F.col("block") * BLOCK + F.col("level")})
    return found.drop("block", "key1", "key2", "pre", "level", *[f"{c}{i}" for i in range(1, BLOCK + 1) for c in "abs"])


def ends_of(rows: DataFrame) -> DataFrame:
    """Of each node at which conversations end, the SHA-256 of their ids, ascending, joined."""
    last = rows.where(F.col("block") == F.floor(F.greatest(F.col("turns") - 1, F.lit(0)) / BLOCK))
    ends = last.select(F.col("turns").alias("depth"), F.col("end1").alias("n1"), F.col("end2").alias("n2"), "conv_id", F.floor(F.col("conv_id") / CHUNK).alias("stretch"))
    lists = ends.groupBy(*_NODE, "stretch").agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string"))).alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for depth, n1, n2, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (depth, n1, n2) != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (depth, n1, n2), hashlib.sha256()
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield _batch(out)
        if node is not None:
            yield _batch([(*node, state.hexdigest())])

    streams = lists.repartition(*_NODE).sortWithinPartitions(*_NODE, "stretch").select(*_NODE, "ids")
    return streams.mapInArrow(tidy(hashed), "depth long, n1 long, n2 long, ends_sha256 string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * 4
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=[*_NODE, "ends_sha256"])


def prefix_trie(conversations: DataFrame, rebuilt: bool = True) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
    of every node; of the conversations as they are, unless ``rebuilt``."""
    spark = conversations.sparkSession
    folder = scratch(spark, "turns")
    turns = keep(numbered_turns(conversations), f"{folder}/turns")
    rows = keep(blocks_of(rebuilt_turns(turns) if rebuilt else turns), f"{folder}/blocks")
    nodes = keep(_rolled_up(rows, "min(conv_id) AS conv_id, count(*) AS n_convs, max(turns) AS longest, sum(total) AS total"), f"{folder}/nodes")
    first = nodes.groupBy("conv_id").agg(F.min("prefix").alias("q"), F.max((F.col("longest") == F.col("depth")).cast("long")).alias("leaf"))
    below = _rolled_up(rows.join(first, "conv_id"), "sum(total - q) AS own, min(q) AS least_q, sum(leaf) AS n_leaves").select(*_NODE, "own", "least_q", "n_leaves")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(F.count("*").alias("n_children"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    named = nodes.join(parents, ["depth", "p1", "p2"], "left")  # many children share a parent: a join of two stored tables, which can be split
    found = named.join(below, _NODE).join(children, _NODE, "left").join(ends_of(rows), _NODE, "left")
    saved = (F.col("total") - F.col("n_convs") * F.col("prefix")) - (F.col("own") + F.col("least_q") - F.col("prefix"))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", saved.alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"))


def op13_turns(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


OP13_SQL = r"""
WITH o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS p FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[]), lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1))))) % 9 AS h FROM o GROUP BY conv_id),
b AS (SELECT c.*, least(c.h, coalesce(x.n, 0)) AS taken FROM c LEFT JOIN c x ON x.conv_id = c.base),
r AS (SELECT b.conv_id, o.p AS d, o.role, o.text FROM b JOIN o ON o.conv_id = b.base AND o.p <= b.h UNION ALL SELECT b.conv_id, o.p - b.h + b.taken, o.role, o.text FROM b JOIN o ON o.conv_id = b.conv_id AND o.p > b.h),
m AS (SELECT conv_id, 0 AS d, '' AS node, 0 AS size FROM b UNION ALL SELECT conv_id, d, string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY d), strlen(text) FROM r),
n AS (SELECT d, node, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size FROM m GROUP BY d, node),
w AS (SELECT n.*, up.conv_id AS parent, up.node AS parent_node FROM n LEFT JOIN m ON m.conv_id = n.conv_id AND m.d = n.d - 1 LEFT JOIN n up ON up.d = m.d AND up.node = m.node),
k AS (SELECT d - 1 AS d, parent_node AS node, count(*) AS n_children FROM w WHERE d > 0 GROUP BY 1, 2),
u AS (SELECT m.d, m.node, count(*) FILTER (k.n_children IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.size) AS saved FROM n JOIN m ON m.conv_id = n.conv_id AND m.d <= n.d LEFT JOIN k ON k.d = n.d AND k.node = n.node GROUP BY m.d, m.node),
e AS (SELECT d, node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM (SELECT *, max(d) OVER (PARTITION BY conv_id) AS last FROM m) WHERE d = last GROUP BY d, node)
SELECT w.conv_id, w.d::BIGINT AS depth, w.parent AS parent_conv_id, w.n_convs::BIGINT AS n_convs, coalesce(k.n_children, 0)::BIGINT AS n_children, u.n_leaves::BIGINT AS n_leaves, u.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM w LEFT JOIN k ON k.d = w.d AND k.node = w.node JOIN u ON u.d = w.d AND u.node = w.node LEFT JOIN e ON e.d = w.d AND e.node = w.node
"""
