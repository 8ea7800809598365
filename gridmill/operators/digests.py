"""Where two tables differ, found from digests instead of rows.

A tree over the keys' hashes: a node of the first level holds the keys whose hash starts
with the same ``BITS`` bits, each of the next level those with as many more. A node's
digest is its number of rows and sums of two 64-bit hashes of them, so partial sums are
made where the rows lie, and a shuffle carries a row for each node at most. Both sides are
summed together, one of them negatively: what is not zero differs. Only under nodes that
differ the next level is looked at, and only rows under its differing nodes are then joined.
Equal tables are read once and move nothing but digests.

Rows of equal keys lie in one node, repeated ones too. Two nodes of different rows would
pass as equal if 128 bits of sums and the count agreed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 12
LEVELS = 2
_LOW = (1 << 32) - 1


def _node(keys: Sequence[str], level: int, bits: int) -> Column:
    return F.shiftrightunsigned(_hash(keys, 0), 64 - bits * level)


def _hash(columns: Sequence[str], salt: int) -> Column:
    """Nulls are hashed as such: the hash function alone would pass over them."""
    return F.xxhash64(F.lit(salt), *columns, *[F.col(c).isNull() for c in columns])


def _signed(rows: DataFrame, node: Column, columns: Sequence[str], sign: int) -> DataFrame:
    a, b = _hash(columns, 1), _hash(columns, 2)
    halves = (a.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(a, 32), b.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(b, 32))
    return rows.select(node.alias("node"), F.lit(sign).alias("rows"), *[(h * sign).alias(f"s{i}") for i, h in enumerate(halves)])


def differing_nodes(source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str], level: int = 1, bits: int = BITS) -> DataFrame:
    """Nodes of a level in which the tables' rows differ in ``columns``."""
    both = _signed(source, _node(keys, level, bits), columns, 1).unionByName(_signed(target, _node(keys, level, bits), columns, -1))
    sums = ["rows", *[f"s{i}" for i in range(4)]]
    found = both.groupBy("node").agg(*[F.sum(s).alias(s) for s in sums])
    unequal = F.lit(False)
    for s in sums:
        unequal = unequal | (F.col(s) != 0)
    return found.where(unequal).select("node")


def where_differing(source: DataFrame, target: DataFrame, keys: Sequence[str], levels: int = LEVELS, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """Both tables' rows under the nodes that differ in the columns that they share. All rows
    that differ are among them, and few others."""
    columns = [c for c in source.columns if c in target.columns]
    for level in range(1, levels + 1):
        nodes = differing_nodes(source, target, keys, columns, level, bits)
        if level == 1:
            nodes = F.broadcast(nodes)  # no more than 2**bits numbers
        source, target = (side.withColumn("_node", _node(keys, level, bits)).join(nodes.withColumnRenamed("node", "_node"), "_node", "left_semi").drop("_node") for side in (source, target))
    return source, target
