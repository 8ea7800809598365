"""Points near places: cells, distance join, coverage, hulls."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridmill.functions.places import KM_PER_DEGREE, circle, distance_km, hexagon, valid_place


def normal_points(df: DataFrame, lat: str, lon: str, *columns: str) -> DataFrame:
    """Rows with valid coordinates as numbers ``lat`` and ``lon``."""
    out = df.select(*columns, F.col(lat).try_cast("double").alias("lat"), F.col(lon).try_cast("double").alias("lon"))
    return out.where(valid_place(F.col("lat"), F.col("lon")))


#: Points of a leaf of the quadtree.
LEAF_POINTS = 20_000
#: Levels of the quadtree: the smallest cells are a quarter of the distance wide, each level's twice as wide as those below.
TREE_LEVELS = 8


def _smallest(value: str, size: float, shift: float) -> Column:
    return F.floor((F.col(value) + shift) / size).cast("long")


def quadtree(points: DataFrame, size: float, leaf_points: int = LEAF_POINTS, levels: int = TREE_LEVELS) -> DataFrame:
    """The leaf of each smallest cell (row, col of width ``size``) that holds points: its level,
    and in how many slices it is dealt. A leaf is the largest cell around with at most
    ``leaf_points``; smallest cells with more, which space cannot divide, get slices.
    Points are counted by smallest cell, and these counts summed level by level."""
    counts = points.groupBy("row", "col").agg(F.count("*").alias("n"))
    every = counts.select("row", "col", "n", F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level"))
    node = [F.expr("shiftright(row, level)").alias("up_row"), F.expr("shiftright(col, level)").alias("up_col")]
    sums = every.groupBy("level", *node).agg(F.sum("n").alias("n"))
    fits = sums.where((F.col("n") <= leaf_points) | (F.col("level") == 0)).select("level", "up_row", "up_col", F.ceil(F.col("n") / leaf_points).cast("int").alias("slices"))
    found = every.select("row", "col", "level", *node).join(fits, ["level", "up_row", "up_col"])
    return found.groupBy("row", "col").agg(F.max(F.struct("level", "slices")).alias("leaf")).select("row", "col", "leaf.level", "leaf.slices")


#: Tasks of a join of places for each core: its rows may be many times what is shuffled for it.
JOIN_TASKS = 32


def _join_tasks(df: DataFrame) -> int:
    return JOIN_TASKS * df.sparkSession.sparkContext.defaultParallelism


def _places(df: DataFrame, side: str) -> DataFrame:
    """The different places, and how many rows stand at each."""
    return df.groupBy(F.col("lat").alias(f"{side}_lat"), F.col("lon").alias(f"{side}_lon")).agg(F.count("*").alias(f"{side}_n"))


def near_places(points: DataFrame, centres: DataFrame, km: float, leaf_points: int = LEAF_POINTS) -> DataFrame:
    """p_lat, p_lon, p_n, c_lat, c_lon, km: the different places of points and of centres at most
    ``km`` apart, by the leaves of a quadtree over the points: each place lies in one leaf (or
    in one of its slices, by hash), and a centre is sent to the leaves that its square of
    ``km`` around touches. So however densely points lie, about ``leaf_points`` of them share a key."""
    size = km / KM_PER_DEGREE / 4
    place = [_smallest("p_lat", size, 90.0).alias("row"), _smallest("p_lon", size, 180.0).alias("col")]
    p = _places(points, "p").select("p_lat", "p_lon", "p_n", *place)
    cells = quadtree(p, size, leaf_points)
    key = ["level", "leaf_row", "leaf_col", "slice"]
    leaf = [F.expr("shiftright(row, level)").alias("leaf_row"), F.expr("shiftright(col, level)").alias("leaf_col")]
    slice_ = F.expr("pmod(xxhash64(p_lat, p_lon), slices)").cast("int").alias("slice")
    p = p.join(cells, ["row", "col"]).select("p_lat", "p_lon", "p_n", "level", *leaf, slice_)
    leaves = cells.select("level", *leaf, "slices").distinct()
    c = _places(centres, "c").select("c_lat", "c_lon")
    c = c.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(TREE_LEVELS - 1))))
    # A hair more than the distance, so that rounding at a cell's edge loses nothing.
    reach = 4 * size * (1 + 1e-9) + 1e-9
    for axis, value, shift in (("row", "c_lat", 90.0), ("col", "c_lon", 180.0)):
        low, high = (F.floor((F.col(value) + shift + sign * reach) / size).cast("long") for sign in (-1, 1))
        c = c.withColumn("_low", low).withColumn("_high", high)
        c = c.withColumn(f"leaf_{axis}", F.explode(F.expr("sequence(shiftright(_low, level), shiftright(_high, level))"))).drop("_low", "_high")
    c = c.join(leaves, key[:3]).withColumn("slice", F.explode(F.expr("sequence(0, slices - 1)")))
    pairs = p.repartition(_join_tasks(p), *key).join(c, key).withColumn("km", distance_km(F.col("p_lat"), F.col("p_lon"), F.col("c_lat"), F.col("c_lon")))
    return pairs.where(F.col("km") <= km).select("p_lat", "p_lon", "p_n", "c_lat", "c_lon", "km")


def within_distance(points: DataFrame, centres: DataFrame, km: float, point: str, centre: str, leaf_points: int = LEAF_POINTS) -> DataFrame:
    """Pairs of a point and a centre at most ``km`` apart. Distances are taken between places
    that differ; a pair of places gives a row for each point and centre that stand there,
    the points of one place in slices of ``leaf_points``."""
    near = near_places(points, centres, km, leaf_points)
    c = centres.select(F.col(centre).alias("centre"), F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon"))
    p = points.select(F.col(point).alias("point"), F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"))
    slices = F.ceil(F.col("p_n") / leaf_points).cast("int")
    sizes = _places(points, "p").select("p_lat", "p_lon", slices.alias("slices"))
    key, tasks = ["p_lat", "p_lon", "slice"], _join_tasks(points)
    p = p.join(sizes, key[:2]).select("point", "p_lat", "p_lon", F.expr("pmod(xxhash64(point), slices)").cast("int").alias("slice"))
    named = near.join(c, ["c_lat", "c_lon"]).select("centre", "p_lat", "p_lon", "km", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"))
    return named.repartition(tasks, *key).join(p.repartition(tasks, *key), key).select("centre", "point", "p_lat", "p_lon", "km")


def coverage(points: DataFrame, centres: DataFrame, km: float, centre: str) -> DataFrame:
    """centre, n_points: how many points lie at most ``km`` away, of centres that have any.
    Counts by place are summed; points are not paired."""
    counts = near_places(points, centres, km).groupBy("c_lat", "c_lon").agg(F.sum("p_n").alias("n"))
    c = centres.select(F.col(centre).alias("centre"), F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon"))
    return c.join(counts, ["c_lat", "c_lon"]).groupBy("centre").agg(F.sum("n").alias("n_points"))


def hexagon_counts(points: DataFrame, size: float) -> DataFrame:
    col, row = hexagon(F.col("lat"), F.col("lon"), size)
    return points.groupBy(col.alias("hex_col"), row.alias("hex_row")).agg(F.count("*").alias("n"))


def circles(centres: DataFrame, name: str, km: float) -> DataFrame:
    return centres.select(name, circle(F.col("lat"), F.col("lon"), km).alias("ring"))


def _half(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for x, y in points:
        while len(out) > 1 and (out[-1][0] - out[-2][0]) * (y - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (x - out[-2][0]):
            out.pop()
        out.append((x, y))
    return out


def hull_of(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Corners of the smallest convex ring, counter-clockwise, not closed; none of fewer than
    three different points."""
    ordered = sorted(set(points))
    if len(ordered) < 3:
        return []
    lower, upper = _half(ordered), _half(ordered[::-1])
    ring = lower[:-1] + upper[:-1]
    return ring if len(ring) > 2 else []


def _fewer(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each centre in a batch of rows only the hull's corners."""
    for f in frames:
        kept = []
        for centre, g in f.groupby("centre", sort=False):
            points = set(zip(g["p_lon"], g["p_lat"]))
            kept += [(centre, x, y) for x, y in hull_of(list(points)) or points]
        yield pd.DataFrame(kept, columns=["centre", "p_lon", "p_lat"])


def _ring(g: pd.DataFrame) -> pd.DataFrame:
    ring = hull_of(list(zip(g["p_lon"], g["p_lat"])))
    return pd.DataFrame({"centre": [g["centre"].iloc[0]], "ring": [[{"lon": x, "lat": y} for x, y in ring]]})


def hulls(points: DataFrame, centres: DataFrame, km: float, centre: str, bands: int = 64) -> DataFrame:
    """centre, ring: the convex hull of the points at most ``km`` from each centre.

    Only places count, and centres at the same places share a hull. A centre's points are
    dealt into bands by hash and sorted by centre; batches of them are cut to their hulls'
    corners, so that the task that ends a hull holds few.
    """
    kind = centres.schema[centre].dataType.simpleString()
    at = centres.groupBy(F.col(centre).alias("centre")).agg(F.sort_array(F.collect_set(F.struct(F.col("lat").alias("c_lat"), F.col("lon").alias("c_lon")))).alias("places"))
    first = at.groupBy("places").agg(F.min("centre").alias("first"))
    near = near_places(points, centres, km).select("c_lat", "c_lon", "p_lon", "p_lat")
    pairs = near.join(first.select(F.col("first").alias("centre"), F.inline("places")), ["c_lat", "c_lon"]).select("centre", "p_lon", "p_lat")
    dealt = pairs.repartition(_join_tasks(pairs) // 4, "centre", F.pmod(F.xxhash64("p_lon", "p_lat"), F.lit(bands))).sortWithinPartitions("centre")
    few = dealt.mapInPandas(_fewer, f"centre {kind}, p_lon double, p_lat double")
    whole = few.groupBy("centre").applyInPandas(_ring, f"centre {kind}, ring array<struct<lon:double,lat:double>>").where(F.size("ring") > 2)
    return at.join(first, "places").join(whole.withColumnRenamed("centre", "first"), "first").select("centre", "ring")


def ring_area(ring: Column) -> Column:
    """The area within a ring of corners in counter-clockwise order, in square degrees. Corners
    are taken from the first one on, so that little is lost to rounding."""
    x = lambda c: c["lon"] - ring[0]["lon"]
    y = lambda c: c["lat"] - ring[0]["lat"]
    turned = F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1))
    parts = F.zip_with(ring, turned, lambda a, b: x(a) * y(b) - x(b) * y(a))
    return F.aggregate(parts, F.lit(0.0), lambda total, part: total + part) / 2
