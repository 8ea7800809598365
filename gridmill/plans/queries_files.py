"""Queries that write files and read them back, and incremental loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.operators import aggregates, diff
from gridmill.plans import queries_jobs
from gridmill.plans.fixtures import Tables
from gridmill.plans.registry import query
from gridmill.sources import files, numbered, tables
from gridmill.sources.merged import MergedTable
from gridmill.streaming import first_seen, incremental


@query("S1_csv_scan", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(t: Tables) -> DataFrame:
    path = tables.scratch_folder(t.spark, "csv")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    files.write_csv(rows, path)
    return files.read_csv(t.spark, path, rows.schema)


@query("S2_csv_excluded_columns", "SELECT s_suppkey, s_name FROM supplier")
def _(t: Tables) -> DataFrame:
    path = tables.scratch_folder(t.spark, "csv")
    t.supplier.select("s_suppkey", "s_name", "s_acctbal").write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return files.read_csv(t.spark, path, "s_suppkey bigint, s_name string, s_acctbal double", encoding="ISO-8859-1", exclude=["s_acctbal"])


@query("S3_csv_dialect", "SELECT n_nationkey, concat(n_name, ' é') AS n_name FROM nation")
def _(t: Tables) -> DataFrame:
    path = tables.scratch_folder(t.spark, "csv")
    rows = t.nation.select("n_nationkey", F.concat("n_name", F.lit(" é")).alias("n_name"))
    rows.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    return files.read_csv_any(t.spark, path, ["n_nationkey", "n_name"]).select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), "n_name")


@query("S4_newest_file", "SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey")
def _(t: Tables) -> DataFrame:
    path = tables.scratch_folder(t.spark, "drop")
    for rows in (t.customer.groupBy("c_nationkey"), t.supplier.groupBy("s_nationkey")):  # two files of a row a nation
        rows.agg(F.count("*").alias("n")).coalesce(1).write.option("header", True).mode("append").csv(path)
    return files.read_csv(t.spark, files.newest_file(t.spark, path, "*.csv"), "s_nationkey bigint, n bigint")


@query("S6_snapshot_export", "SELECT (count(*) + 4999) // 5000 AS least_files, count(*) AS n FROM orders")
def _(t: Tables) -> DataFrame:
    path = tables.scratch_folder(t.spark, "export")
    tables.export_snapshot(t.orders, path)
    exported = t.spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"))
    # Each partition ends with a file that isn't full, so there may be more files than the least; none may be too long.
    least = F.when(F.coalesce(F.max("n"), F.lit(0)) <= tables.EXPORT_ROWS, F.ceil(F.coalesce(F.sum("n"), F.lit(0)) / tables.EXPORT_ROWS))
    return exported.agg(least.cast("bigint").alias("least_files"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


@query("S6_numbered_export", "SELECT (i // 5000 + 1)::INT AS part, count(*) AS n, min(o_orderkey) AS low, max(o_orderkey) AS high FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) GROUP BY 1")
def _(t: Tables) -> DataFrame:
    path = tables.scratch_folder(t.spark, "export")
    numbered.export_numbered(t.orders, path, order=["o_orderkey"])
    part = F.regexp_extract(F.input_file_name(), r"batch_(\d+)\.parquet$", 1).cast("int")
    return t.spark.read.parquet(path).groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))


@query("S10_monthly_append", "SELECT strftime(l_shipdate, '%Y%m')::INT AS yyyymm, count(*) AS n FROM lineitem GROUP BY 1")
def _(t: Tables) -> DataFrame:
    path = tables.scratch_folder(t.spark, "monthly")
    tables.append_monthly(t.lineitem.select("l_shipdate", "l_partkey"), path, "l_shipdate", "l_partkey")
    return t.spark.read.parquet(path).groupBy(F.col("yyyymm").cast("int").alias("yyyymm")).agg(F.count("*").alias("n"))


@query("S15_csv_export", "SELECT status, count(*) AS n FROM accounts GROUP BY status", "accounts")
def _(t: Tables) -> DataFrame:
    path = tables.scratch_folder(t.spark, "result")
    files.write_csv(t.accounts.groupBy("status").agg(F.count("*").alias("n")), path)
    return files.read_csv(t.spark, path, "status string, n bigint")


@query("D3_row_count_reconcile", "SELECT 'x' AS table_name, (SELECT count(*) FROM snapshot_old) AS source_rows, (SELECT count(*) FROM snapshot_new) AS target_rows, (SELECT count(*) FROM snapshot_new) - (SELECT count(*) FROM snapshot_old) AS difference", "snapshot_old", "snapshot_new")
def _(t: Tables) -> DataFrame:
    found = aggregates.row_count_comparison(aggregates.row_counts({"x": t.snapshot_old}), aggregates.row_counts({"x": t.snapshot_new}))
    return found.select("table_name", "source_rows", "target_rows", "difference")


@query("D3_row_count_status", """WITH c AS (SELECT 'snapshot' AS table_name, (SELECT count(*) FROM snapshot_old) AS s, (SELECT count(*) FROM snapshot_new) AS t UNION ALL SELECT 'customer', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer) UNION ALL SELECT 'account', (SELECT count(*) FROM accounts WHERE false), (SELECT count(*) FROM accounts)
 UNION ALL SELECT 'premises', (SELECT count(*) FROM customer), (SELECT count(*) FROM premises))
SELECT table_name, s AS source_rows, t AS target_rows, t - s AS difference, CASE WHEN s = 0 THEN CASE WHEN t = 0 THEN 0.0 ELSE 100.0 END ELSE round_even((t - s) / s * 100, 2) END AS percent, CASE WHEN t = s THEN 'MATCH' WHEN t > s THEN 'TARGET_HAS_MORE' ELSE 'SOURCE_HAS_MORE' END AS status FROM c""", "snapshot_old", "snapshot_new", "accounts", "premises")
def _(t: Tables) -> DataFrame:
    source = {"snapshot": t.snapshot_old, "customer": t.customer, "account": t.accounts.where("false"), "premises": t.customer}
    target = {"snapshot": t.snapshot_new, "customer": t.customer, "account": t.accounts, "premises": t.premises}
    return aggregates.row_count_comparison(aggregates.row_counts(source), aggregates.row_counts(target))


@query("D20_resumable_load", "SELECT CASE WHEN amount < 0 THEN 'rejected' ELSE 'loaded' END AS outcome, count(*) AS n FROM snapshot_new GROUP BY 1", "snapshot_new")
def _(t: Tables) -> DataFrame:
    base = tables.scratch_folder(t.spark, "load")
    rows = t.snapshot_new.select("id", "amount")

    def classify(df: DataFrame) -> DataFrame:
        return df.withColumn("outcome", F.when(F.col("amount") < 0, "rejected").otherwise("loaded"))

    for part in (0, 1):  # new files come, and the load goes on with them alone
        rows.where(F.col("id") % 2 == part).write.mode("append").parquet(f"{base}/in")
        incremental.resume_load(t.spark, f"{base}/in", rows.schema, f"{base}/out", f"{base}/state", classify)
    return incremental.batch_statistics(t.spark, f"{base}/out").groupBy("outcome").agg(F.sum("n").alias("n"))


@query("D21_watermark_sync", "SELECT o.id, CASE WHEN coalesce(u, false) THEN n.segment ELSE o.segment END AS segment, coalesce(u, false)::INT AS is_migrated FROM (SELECT o.*, n.updated_at > o.updated_at AND (o.segment IS DISTINCT FROM n.segment OR o.amount IS DISTINCT FROM n.amount) AS u FROM snapshot_old o LEFT JOIN snapshot_new n USING (id)) o LEFT JOIN snapshot_new n USING (id)", "snapshot_old", "snapshot_new")
def _(t: Tables) -> DataFrame:
    base = tables.scratch_folder(t.spark, "sync")
    old, new = (df.withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz")) for df in (t.snapshot_old, t.snapshot_new))
    table = MergedTable.create(t.spark, f"{base}/table", old.withColumn("is_migrated", F.lit(0)), ["id"])
    for part in (0, 1):  # the second run goes on where the first one stopped
        new.where(F.col("id") % 2 == part).write.mode("append").parquet(f"{base}/in")
        incremental.sync_updates(t.spark, f"{base}/in", new.schema, table, f"{base}/state", "id", "updated_at")
    return table.read().select("id", "segment", "is_migrated")


@query("S11_stored_upsert", "SELECT id, name, segment, amount FROM snapshot_new WHERE id % 7 = 0 UNION ALL SELECT id, name, segment, amount FROM snapshot_old WHERE id NOT IN (SELECT id FROM snapshot_new WHERE id % 7 = 0)", "snapshot_old", "snapshot_new")
def _(t: Tables) -> DataFrame:
    path = tables.scratch_folder(t.spark, "upsert")
    table = MergedTable.create(t.spark, path, t.snapshot_old, ["id"])
    table.merge(t.snapshot_new.where("id % 7 = 0"), lambda held, new: diff.upsert(held, new, ["id"], "updated_at"))
    return table.read().select("id", "name", "segment", "amount")


@query("D20_stateful_load", queries_jobs.D6_SQL, "leads_src")
def _(t: Tables) -> DataFrame:
    base = tables.scratch_folder(t.spark, "leads")
    staged = queries_jobs.staged_leads(t)
    loaded = staged.where("leadId LIKE '%7'").select("leadId", "mobilePhone")
    number = F.substring("leadId", 2, 8).cast("long")
    middle = staged.agg(F.percentile_approx(number, 0.5)).first()[0] or 0
    for part in (number < middle, number >= middle):  # a duplicate's first row can lie in the batch before, which an earlier run took in
        staged.where(part).write.mode("append").parquet(f"{base}/in")
        first_seen.resume_stateful(t.spark, f"{base}/in", staged.schema, f"{base}/out", f"{base}/state", lambda rows: first_seen.stream_leads(rows, loaded, "leadId"))
    return t.spark.read.parquet(f"{base}/out").select("leadId", "outcome", "failure_reason")
