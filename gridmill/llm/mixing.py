"""Mixing sources to target weights by weighted fair queueing.

Every source is a flow. Its documents queue in a pseudo-random order that a seed
fixes; copy ``e`` of a document gets the virtual finish time

    (e * source size + sizes queued up to and with the document) / target.

Ordering all copies by that time and cutting at the total budget gives each
source words in proportion to its target, to within one document at the cut.

Sources are few against documents (a row each is numbered in one task). No step needs
one task for a source's documents: running sums are taken in two levels, over
hash ranges of the order first and inside each range after. The global order is
taken in the same way: a histogram of virtual time locates the range that holds
the cut, and only that range is sorted.

Defined cases: a null text has size 0; a null source is a source of its own, last
in order; a null id is an id like any other; repeated rows queue one after
another; documents of size 0 are never taken; an empty table gives an empty
result. Columns other than the three named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridmill.llm.common import WORD, drop, keep, row_hash, scratch, table

WEIGHTS = (1, 2, 3)
REPEATS = 3
SEED = "mix"
#: Hash ranges of a source's order, by so many hexadecimal digits; the first of them name a coarse range.
DIGITS, COARSE = 4, 2
#: Ranges of virtual time up to 1.
RANGES = 4096


def document_sizes(docs: DataFrame, text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(docs[text], F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """One row per source: rank, source_size, budget, target.

    Shares follow the weights; what would exceed ``repeats`` times a source is
    shared among the rest by weight. Sources sorted by cap/weight fill up in that
    order, so the last full one follows from running sums and needs no loop.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * repeats
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before, rest, every = filling.rowsBetween(Window.unboundedPreceding, -1), filling.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    filled = (
        ranked.withColumn("weight", weight)
        .withColumn("cap", cap.cast("double"))
        .withColumn("budget", F.sum("source_size").over(every))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weight_rest", F.sum("weight").over(rest))
        .withColumn("full", F.col("cap") * F.col("weight_rest") <= (F.col("budget") - F.col("caps_before")) * F.col("weight"))
    )
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).over(every)
    full_caps = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(every)
    target = F.when(F.col("full"), F.col("cap")).otherwise((F.col("budget") - full_caps) / open_weight * F.col("weight"))
    return filled.withColumn("target", target).select("source", "rank", "source_size", "budget", "target")


def _time_range(finish: Column) -> Column:
    """A range number that grows with virtual time: even steps up to 2, then by logarithm."""
    return F.when(finish < 2, F.floor(finish * RANGES)).otherwise(2 * RANGES - 256 + F.floor(F.log2(finish) * 256)).cast("long")


def _range_offsets(ranged: DataFrame) -> DataFrame:
    """of_source, of_range, offset: what each source queues before each of its ranges. Coarse
    ranges are summed up first, then the ranges inside each, so that one task never sees more
    than a coarse range's or a source's coarse ranges, ``16 ** COARSE`` rows either way."""
    fine = ranged.groupBy("source", "range").agg(F.sum("size").alias("range_size")).withColumn("coarse", F.floor(F.col("range") / 16 ** (DIGITS - COARSE)))
    before = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    coarse = fine.groupBy(F.col("source").alias("coarse_source"), F.col("coarse").alias("of_coarse")).agg(F.sum("range_size").alias("coarse_size"))
    coarse = coarse.withColumn("coarse_offset", F.coalesce(F.sum("coarse_size").over(before("coarse_source", "of_coarse")), F.lit(0)))
    inside = fine.withColumn("inside", F.coalesce(F.sum("range_size").over(before("source", "coarse", "range")), F.lit(0)))
    joined = inside.join(coarse, inside["source"].eqNullSafe(coarse["coarse_source"]) & (inside["coarse"] == coarse["of_coarse"]))
    return joined.select(F.col("source").alias("of_source"), F.col("range").alias("of_range"), (F.col("coarse_offset") + F.col("inside")).alias("offset"))


def mix(docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS, seed: str = SEED, text: str = "text", carry: bool = False) -> DataFrame:
    """doc_id, row, source, size, source_size, target, copies, taken and position of each document.

    ``row`` is the document's row hash; ``position`` is the place in the source's order, so a
    run can be repeated or extended. With ``carry``, a further column ``doc`` holds all of the
    document's own columns.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "mix")
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(docs["doc_id"].cast("string"), F.lit(""))))
    own = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if carry else []
    sized = keep(docs.select("doc_id", "source", document_sizes(docs, text).alias("size"), order.alias("order"), row_hash(text).alias("row"), *own), f"{folder}/sized")
    targets = keep(source_targets(sized, weights, repeats), f"{folder}/targets")

    ranged = sized.withColumn("range", F.conv(F.substring("order", 1, DIGITS), 16, 10).cast("int"))
    offsets = _range_offsets(ranged)
    inside = Window.partitionBy("source", "range").orderBy("order", F.col("doc_id").asc_nulls_first(), "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    within = ranged.withColumn("within", F.sum("size").over(inside))
    named = targets.withColumnRenamed("source", "target_source")
    queued = (
        within.join(offsets, within["source"].eqNullSafe(offsets["of_source"]) & (within["range"] == offsets["of_range"]))
        .join(named, F.col("source").eqNullSafe(named["target_source"]))
        .withColumn("position", F.col("offset") + F.col("within"))
        .select("doc_id", "row", "source", "size", "source_size", "rank", "budget", "target", "position", *(["doc"] if carry else []))
    )
    queued = keep(queued, f"{folder}/queued")
    drop(spark, f"{folder}/sized")

    def finish(copy: Column) -> Column:
        return (copy * F.col("source_size") + F.col("position")) / F.col("target")

    copies = queued.where("size > 0").select("*", F.explode(F.array(*[F.lit(e) for e in range(repeats)])).alias("copy"))
    copies = copies.select("size", "rank", "budget", finish(F.col("copy")).alias("finish")).withColumn("range", _time_range(F.col("finish")))
    histogram = copies.groupBy("range").agg(F.sum("size").alias("range_size"), F.first("budget").alias("budget"))
    running = histogram.withColumn("up_to", F.sum("range_size").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)))
    cut = running.where("up_to > budget").orderBy("range").first()  # one row
    if cut is None:  # everything fits
        takes = [F.col("size") > 0] * repeats
    else:
        left = cut["budget"] - (cut["up_to"] - cut["range_size"])
        at_cut = Window.orderBy("finish", "rank").rowsBetween(Window.unboundedPreceding, 0)
        last = copies.where(F.col("range") == cut["range"]).withColumn("sum", F.sum("size").over(at_cut)).where(F.col("sum") <= left).agg(F.max(F.struct("finish", "rank")).alias("last")).first()["last"]
        takes = []
        for e in range(repeats):
            time, taken = finish(F.lit(e)), _time_range(finish(F.lit(e))) < cut["range"]
            if last is not None:
                same = _time_range(time) == cut["range"]
                taken = taken | (same & ((time < last["finish"]) | ((time == last["finish"]) & (F.col("rank") <= last["rank"]))))
            takes.append((F.col("size") > 0) & taken)
    count = sum((F.when(x, 1).otherwise(0) for x in takes[1:]), F.when(takes[0], 1).otherwise(0))
    return queued.withColumn("copies", count.cast("long")).withColumn("taken", F.col("copies") * F.col("size")).select("doc_id", "row", "source", "size", "source_size", "target", "copies", "taken", "position", *(["doc"] if carry else []))


def op1_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """The mixture itself: every document as often as it is taken, with its own columns,
    whatever their names."""
    taken = mix(docs, weights, repeats, carry=True).where("copies > 0")
    return taken.select("doc", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("doc.*")


OP1_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
  md5(concat('mix:', coalesce(doc_id::VARCHAR, ''))) AS ord FROM documents),
r AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk FROM d GROUP BY source),
w AS (SELECT *, (rnk % 3 + 1)::DOUBLE AS weight, (source_size * 3)::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE AS budget FROM r),
f AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS caps_before,
  sum(weight) OVER (ORDER BY cap / weight, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_rest FROM w),
g AS (SELECT *, cap * weight_rest <= (budget - caps_before) * weight AS is_full FROM f),
t AS (SELECT source, rnk, source_size, budget, CASE WHEN is_full THEN cap ELSE
  (budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ()) / sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () * weight END AS target FROM g),
q AS (SELECT d.doc_id, d.source, d.size, t.source_size, t.rnk, t.budget, t.target, row_number() OVER () AS k,
  sum(d.size) OVER (PARTITION BY d.source ORDER BY d.ord, d.doc_id NULLS FIRST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pos
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT q.*, e.e, (e.e * source_size + pos)::DOUBLE / target AS finish FROM q, (SELECT unnest([0, 1, 2]) AS e) e WHERE size > 0),
s AS (SELECT k, size, sum(size) OVER (ORDER BY finish, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= budget AS fits FROM c),
n AS (SELECT k, sum(size)::BIGINT AS taken FROM s WHERE fits GROUP BY k)
SELECT q.doc_id, q.size, q.source_size, q.target, coalesce(n.taken, 0)::BIGINT AS taken FROM q LEFT JOIN n USING (k)
"""
