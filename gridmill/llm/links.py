"""Connected components over tables of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.llm.common import drop, keep


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, root): the least node that each node of ``links`` (a, b) reaches.

    Alternates two steps on the links (large star, then small star): every node ties
    its greater neighbours to its least one, then its smaller ones. Rounds grow with
    the logarithm of the longest path; nothing but a count reaches the driver. A node
    of many links stays many rows: minima are aggregated before they are joined.
    """
    spark = links.sparkSession
    edges = keep(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), f"{folder}/links0")
    last, number = f"{folder}/links0", 0
    while True:
        # Large star: greater neighbours of u go to the least of u and its neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: smaller neighbours of u, and u itself, go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        number += 1
        path = f"{folder}/links{number}"
        edges = keep(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), path)
        drop(spark, last)
        last = path
        # Done when all are stars: every node has one root, and no root has one itself.
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up + down > 1").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
