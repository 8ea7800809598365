"""Queries of sources, joins, aggregations and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.operators import aggregates, dedupe, geo, quantiles, rules
from gridmill.plans import workflow
from gridmill.plans.fixtures import Tables
from gridmill.plans.registry import query
from gridmill.sources import tables


def _ntz(x: str):
    return F.lit(x).cast("timestamp_ntz")


@query("S5_projected_scan", "SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 100000")
def _(t: Tables) -> DataFrame:
    return tables.scan(t.spark, f"{t.folder}/orders.parquet", ["o_orderkey", "o_custkey"], where="o_totalprice > 100000")


@query("S7_table_predicate", "SELECT 'orders' AS table_name, count(*) AS n FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'customer', count(*) FROM customer")
def _(t: Tables) -> DataFrame:
    filters = {"orders": "o_orderstatus = 'F'"}
    return aggregates.row_counts({n: getattr(t, n).where(F.expr(filters.get(n, "true"))) for n in ("orders", "customer")}).withColumnRenamed("n_rows", "n")


@query("S8_page", "SELECT o_orderkey FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 200")
def _(t: Tables) -> DataFrame:
    return tables.page(t.orders.select("o_orderkey"), "o_orderkey", 1000, 200)


@query("S9_this_month", "SELECT o_orderkey FROM orders WHERE date_trunc('month', o_orderdate) = DATE '1996-02-01'")
def _(t: Tables) -> DataFrame:
    return tables.this_month(t.orders, "o_orderdate", F.lit("1996-02-17").cast("date")).select("o_orderkey")


@query("S9_since_yesterday", "SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1998-01-01'")
def _(t: Tables) -> DataFrame:
    return tables.since_yesterday(t.orders, "o_orderdate", F.lit("1998-01-02").cast("date")).select("o_orderkey")


@query("S11_upsert", """SELECT id, name, segment, amount FROM snapshot_new UNION ALL SELECT id, name, segment, amount FROM snapshot_old WHERE id NOT IN (SELECT id FROM snapshot_new)""", "snapshot_old", "snapshot_new")
def _(t: Tables) -> DataFrame:
    from gridmill.operators.diff import upsert

    return upsert(t.snapshot_old, t.snapshot_new, ["id"]).select("id", "name", "segment", "amount")


@query("S12_upsert_counts", "SELECT count(*) FILTER (WHERE o.id IS NULL) AS inserted, count(*) FILTER (WHERE o.id IS NOT NULL) AS updated FROM snapshot_new n LEFT JOIN snapshot_old o USING (id)", "snapshot_old", "snapshot_new")
def _(t: Tables) -> DataFrame:
    from gridmill.operators.diff import upsert_counts

    return upsert_counts(t.snapshot_old, t.snapshot_new, ["id"])


@query("S13_rejects", "SELECT lead_id, id_number, 'Missing required field: id_number' AS failure_reason FROM leads_src WHERE id_number IS NULL", "leads_src")
def _(t: Tables) -> DataFrame:
    leads = t.leads_src
    return leads.withColumn("failure_reason", rules.first_reason(leads, ["id_number"], {})).where("failure_reason IS NOT NULL").select("lead_id", "id_number", "failure_reason")


@query("S14_change_log", """SELECT n.id, o.segment AS segment_old, n.segment AS segment_new, o.amount AS amount_old, n.amount AS amount_new FROM snapshot_new n JOIN snapshot_old o USING (id) WHERE o.segment IS DISTINCT FROM n.segment OR o.amount IS DISTINCT FROM n.amount""", "snapshot_old", "snapshot_new")
def _(t: Tables) -> DataFrame:
    from gridmill.operators.diff import differing

    rows = differing(t.snapshot_old.select("id", "segment", "amount"), t.snapshot_new.select("id", "segment", "amount"), ["id"])
    return rows.select("id", F.col("segment_source").alias("segment_old"), F.col("segment_target").alias("segment_new"), F.col("amount_source").alias("amount_old"), F.col("amount_target").alias("amount_new"))


#: The derived tables of the enrichment, and its rows as SQL.
CRM = ("crm_leads", "crm_survey", "users_dim", "crm_agents", "crm_referrals", "crm_customers", "crm_sources", "crm_channels")
MASHUP = """s AS (SELECT *, row_number() OVER (PARTITION BY lead_id ORDER BY modified_at DESC, seq DESC, part_ref DESC) AS n FROM crm_survey),
m AS (SELECT DISTINCT l.* REPLACE (coalesce(l.lead_source, 'Others') AS lead_source, coalesce(l.channel, 'Others') AS channel), s.kin_name, s.kin_surname, s.relation, s.kin_phone, s.created_at AS kin_created_at, s.modified_at AS kin_modified_at,
 f.referral_id, a.employee_id AS agent_employee, u1.employee_id AS created_by, u2.employee_id AS modified_by, u3.employee_id AS kin_created_by, u4.employee_id AS kin_modified_by, c.customer_id, o.source_id, CASE WHEN l.channel = 'SALESAPP' THEN 8 ELSE h.channel_id END AS channel_id, coalesce(l.employee_id, a.employee_id) AS agent
 FROM crm_leads l LEFT JOIN s ON s.lead_id = l.lead_id AND s.n = 1 LEFT JOIN crm_referrals f ON lower(f.lead_id) = lower(l.lead_id) LEFT JOIN crm_agents a ON lower(a.agent_id) = lower(l.agent_id)
 LEFT JOIN users_dim u1 ON lower(u1.user_id) = lower(l.created_by_id) LEFT JOIN users_dim u2 ON lower(u2.user_id) = lower(l.modified_by_id) LEFT JOIN users_dim u3 ON lower(u3.user_id) = lower(s.created_by_id) LEFT JOIN users_dim u4 ON lower(u4.user_id) = lower(s.created_by_id)
 LEFT JOIN crm_customers c ON c.id_number = l.id_number LEFT JOIN crm_sources o ON lower(o.name) = lower(coalesce(l.lead_source, 'Others')) LEFT JOIN crm_channels h ON lower(h.name) = lower(coalesce(l.channel, 'Others')))"""
_MASHED = ["lead_id", "status", "lead_source", "channel", "relation", "kin_phone", "kin_modified_at", "referral_id", "agent", "created_by", "modified_by", "kin_created_by", "kin_modified_by", "customer_id", "source_id", "channel_id"]


def mashed(t: Tables) -> DataFrame:
    from gridmill.plans.transform import Dimensions, mashup

    return mashup(t.crm_leads, t.crm_survey, Dimensions(t.users_dim, t.crm_agents, t.crm_referrals, t.crm_customers, t.crm_sources, t.crm_channels))


@query("J1_enrichment", f"WITH {MASHUP} SELECT {', '.join(_MASHED)} FROM m", *CRM)
def _(t: Tables) -> DataFrame:
    return mashed(t).select(*_MASHED)


@query("J2_collated_join", "SELECT l.lead_id, u.employee_id FROM leads_src l JOIN users_dim u ON lower(u.user_id) = lower(l.created_by_id)", "leads_src", "users_dim")
def _(t: Tables) -> DataFrame:
    from gridmill.plans.transform import looked_up

    return looked_up(t.leads_src.select("lead_id", "created_by_id"), "created_by_id", t.users_dim, "user_id", "employee_id", "employee_id").where("employee_id IS NOT NULL").select("lead_id", "employee_id")


@query("J3_two_roles", "SELECT l.lead_id, a.user_name AS creator, b.user_name AS modifier FROM leads_src l LEFT JOIN users_dim a ON lower(a.user_id) = lower(l.created_by_id) LEFT JOIN users_dim b ON lower(b.user_id) = lower(l.modified_by_id)", "leads_src", "users_dim")
def _(t: Tables) -> DataFrame:
    l, u = t.leads_src.alias("l"), t.users_dim
    a, b = u.alias("a"), u.alias("b")
    joined = l.join(a, F.lower("a.user_id") == F.lower("l.created_by_id"), "left").join(b, F.lower("b.user_id") == F.lower("l.modified_by_id"), "left")
    return joined.select("l.lead_id", F.col("a.user_name").alias("creator"), F.col("b.user_name").alias("modifier"))


@query("J4_override", "SELECT l.lead_id, CASE WHEN l.lead_source = 'ipos' THEN 8 ELSE u.employee_id END AS agent FROM leads_src l LEFT JOIN users_dim u ON lower(u.user_id) = lower(l.created_by_id)", "leads_src", "users_dim")
def _(t: Tables) -> DataFrame:
    joined = t.leads_src.join(t.users_dim, F.lower("user_id") == F.lower("created_by_id"), "left")
    return joined.select("lead_id", F.when(F.col("lead_source") == "ipos", 8).otherwise(F.col("employee_id")).alias("agent"))


@query("J5_not_loaded", "SELECT receipt_num, card_num, count(*) AS n FROM fuel_raw f WHERE NOT EXISTS (SELECT 1 FROM fuel_raw g WHERE g.qty_raw = 'x' AND g.receipt_num = f.receipt_num AND g.card_num = f.card_num) GROUP BY ALL", "fuel_raw")
def _(t: Tables) -> DataFrame:
    fuel, keys = t.fuel_raw, ["receipt_num", "card_num"]
    rows = fuel.count()
    counts = dedupe.dealt(fuel.select(*keys), keys, rows).groupBy(*keys).agg(F.count("*").alias("n"))  # first, so that rows are shuffled once
    return dedupe.not_loaded(counts, fuel.where("qty_raw = 'x'"), keys, rows)


@query("J6_either_key", """SELECT n.id, CASE WHEN EXISTS (SELECT 1 FROM snapshot_old o WHERE o.name = n.name AND o.region_id < 10) THEN 'Duplicate name: ' || n.name WHEN EXISTS (SELECT 1 FROM snapshot_old o WHERE o.id = n.id) THEN 'Duplicate id' END AS failure_reason FROM snapshot_new n""", "snapshot_old", "snapshot_new")
def _(t: Tables) -> DataFrame:
    old, new = t.snapshot_old, t.snapshot_new.select("id", "name")
    return dedupe.loaded_reason(new, [(old, ["id"], F.lit("Duplicate id")), (old.where("region_id < 10"), ["name"], F.concat(F.lit("Duplicate name: "), F.col("name")))]).select("id", "failure_reason")


@query("J7_key_pair", "SELECT n.id, CASE WHEN EXISTS (SELECT 1 FROM snapshot_old o WHERE o.id = n.id AND o.segment = n.segment) THEN 'Duplicate id+segment' END AS failure_reason FROM snapshot_new n", "snapshot_old", "snapshot_new")
def _(t: Tables) -> DataFrame:
    return dedupe.loaded_reason(t.snapshot_new.select("id", "segment"), [(t.snapshot_old, ["id", "segment"], F.lit("Duplicate id+segment"))]).select("id", "failure_reason")


@query("J8_references", "SELECT account_id, status, customer_id IN (SELECT customer_id FROM premises) AS known FROM accounts", "accounts", "premises")
def _(t: Tables) -> DataFrame:
    good, bad = dedupe.references(t.accounts, t.premises, "customer_id", "customer_id")
    return good.withColumn("known", F.lit(True)).unionByName(bad.withColumn("known", F.lit(False))).select("account_id", "status", "known")


@query("J9_exclusion", "SELECT account_id FROM accounts WHERE account_id NOT IN (SELECT DISTINCT a.account_id FROM accounts a JOIN premises p USING (customer_id) JOIN repossessions r ON r.account_id = a.account_id)", "accounts", "premises", "repossessions")
def _(t: Tables) -> DataFrame:
    a = t.accounts
    done = a.join(t.premises, "customer_id").join(t.repossessions.select("account_id").distinct(), "account_id").select("account_id").distinct()
    return a.join(done, "account_id", "left_anti").select("account_id")


@query("J10_one_match", "SELECT a.account_id, min(p.premises_id) AS premises_id FROM accounts a LEFT JOIN premises p USING (customer_id) GROUP BY a.account_id", "accounts", "premises")
def _(t: Tables) -> DataFrame:
    return workflow.one_premise(t.accounts, t.premises).select("account_id", "premises_id")


@query("J11_not_found", "SELECT r.account_id, coalesce(a.status, 'NOT FOUND') AS status FROM (SELECT DISTINCT l_orderkey * 2 AS account_id FROM lineitem) r LEFT JOIN accounts a USING (account_id)", "accounts")
def _(t: Tables) -> DataFrame:
    return workflow.requested_status(t.lineitem.select((F.col("l_orderkey") * 2).alias("account_id")).distinct(), t.accounts, "account_id")


@query("J12_outer_diff", "SELECT coalesce(o.id, n.id) AS id, CASE WHEN n.id IS NULL THEN 'only_source' WHEN o.id IS NULL THEN 'only_target' ELSE 'both' END AS side FROM snapshot_old o FULL JOIN snapshot_new n ON o.id = n.id", "snapshot_old", "snapshot_new")
def _(t: Tables) -> DataFrame:
    from gridmill.operators.diff import keyed_outer

    return keyed_outer(t.snapshot_old, t.snapshot_new, ["id"])[0].select("id", "side")


@query("J12_one_sided", "SELECT coalesce(o.id, n.id) AS id, CASE WHEN n.id IS NULL THEN 'only_source' ELSE 'only_target' END AS side FROM snapshot_old o FULL JOIN snapshot_new n ON o.id = n.id WHERE o.id IS NULL OR n.id IS NULL", "snapshot_old", "snapshot_new")
def _(t: Tables) -> DataFrame:
    from gridmill.operators.diff import one_sided

    return one_sided(t.snapshot_old, t.snapshot_new, ["id"])


_GEO = """g AS (SELECT name, kind, try_cast(lat_raw AS DOUBLE) AS lat, try_cast(lon_raw AS DOUBLE) AS lon FROM geo_points),
v AS (SELECT * FROM g WHERE lat BETWEEN -5 AND 5 AND lon BETWEEN 28 AND 42 AND NOT (lat = 0 AND lon = 0)),
w AS (SELECT d.name AS centre, c.name AS point, sqrt(power(c.lon - d.lon, 2) + power(c.lat - d.lat, 2)) * 111.0 AS km FROM v d JOIN v c ON d.kind = 'Agro-Dealer' AND c.kind = 'Customer'),
x AS (SELECT * FROM w WHERE km <= 50)"""


def _customers_dealers(t: Tables) -> tuple[DataFrame, DataFrame]:
    points = geo.normal_points(t.geo_points, "lat_raw", "lon_raw", "name", "kind")
    return points.where("kind = 'Customer'"), points.where("kind = 'Agro-Dealer'")


@query("J13_distance_join", f"WITH {_GEO} SELECT centre, point, round(km, 6) AS km FROM x", "geo_points")
def _(t: Tables) -> DataFrame:
    return geo.within_distance(*_customers_dealers(t), 50.0, "name", "name").select("centre", "point", F.round("km", 6).alias("km"))


@query("J14_look_back", "SELECT account_ref, status FROM accounts WHERE account_id % 7 = 0 ORDER BY account_ref", "accounts")
def _(t: Tables) -> DataFrame:
    a = t.accounts
    return workflow.verify_actions(a, a.where("account_id % 7 = 0")).select("account_ref", "status")


@query("J15_counts_on_overview", "SELECT c_custkey, coalesce(n, 0) AS n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def _(t: Tables) -> DataFrame:
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    return t.customer.select("c_custkey").join(counts, "c_custkey", "left").fillna(0, ["n"])


@query("J16_snapshot_look_up", "SELECT n.id, o.amount AS old_amount, o.id IS NULL AS skipped FROM snapshot_new n LEFT JOIN snapshot_old o USING (id)", "snapshot_old", "snapshot_new")
def _(t: Tables) -> DataFrame:
    old = t.snapshot_old.select("id", F.col("amount").alias("old_amount"), F.lit(True).alias("there"))
    return t.snapshot_new.select("id").join(old, "id", "left").select("id", "old_amount", F.col("there").isNull().alias("skipped"))


@query("A1_count_by", "SELECT status, count(*) AS n FROM accounts GROUP BY status", "accounts")
def _(t: Tables) -> DataFrame:
    return aggregates.count_by(t.accounts, "status")


@query("A2_distinct", "SELECT count(DISTINCT customer_id) AS n FROM accounts", "accounts")
def _(t: Tables) -> DataFrame:
    return t.accounts.agg(F.count_distinct("customer_id").alias("n"))


@query("A3_distinct_by", "SELECT region, gender, count(DISTINCT customer_id) AS n_customer_id, count(DISTINCT district) AS n_district FROM survey_frame GROUP BY region, gender", "survey_frame")
def _(t: Tables) -> DataFrame:
    return aggregates.distinct_by(t.survey_frame, ["region", "gender"], ["customer_id", "district"])


@query("A4_approximate_distinct")
def _(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.approx_count_distinct("user_id").alias("users"))


@query("A4_exact_twin", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def _(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))


@query("A5_sum_by", "SELECT region, product, sum(units)::BIGINT AS units FROM survey_frame GROUP BY region, product", "survey_frame")
def _(t: Tables) -> DataFrame:
    return t.survey_frame.groupBy("region", "product").agg(F.sum("units").alias("units"))


@query("A6_share", "SELECT account_type, sum(units)::BIGINT AS units, round(sum(units) * 100.0 / sum(sum(units)) OVER (), 6) AS share FROM survey_frame GROUP BY account_type", "survey_frame")
def _(t: Tables) -> DataFrame:
    return aggregates.share_of_total(t.survey_frame, ["account_type"], "units").withColumn("share", F.round("share", 6))


@query("A7_average", "SELECT kind, round(avg(lat), 6) AS lat FROM (SELECT kind, try_cast(lat_raw AS DOUBLE) AS lat FROM geo_points) GROUP BY kind", "geo_points")
def _(t: Tables) -> DataFrame:
    return t.geo_points.groupBy("kind").agg(F.round(F.avg(F.col("lat_raw").try_cast("double")), 6).alias("lat"))


@query("A8_median", "SELECT income_level, median(balance) AS balance FROM persona_src GROUP BY income_level", "persona_src")
def _(t: Tables) -> DataFrame:
    return quantiles.wide_quantiles(t.persona_src, {"balance": ("balance", 0.5)}, ["income_level"])


@query("A9_mode", "SELECT income_level, water_source AS water FROM (SELECT income_level, water_source, row_number() OVER (PARTITION BY income_level ORDER BY count(*) DESC, water_source) AS n FROM persona_src WHERE water_source IS NOT NULL GROUP BY 1, 2) WHERE n = 1", "persona_src")
def _(t: Tables) -> DataFrame:
    return t.persona_src.groupBy("income_level").agg(F.mode("water_source", True).alias("water"))


@query("A10_describe", """SELECT 'balance' AS column_name, count(balance) AS n, count(DISTINCT balance) AS n_distinct, round(avg(balance), 4) AS mean, round(stddev_samp(balance), 4) AS std, round(quantile_cont(balance, 0.25), 4) AS q1, round(median(balance), 4) AS median, round(quantile_cont(balance, 0.75), 4) AS q3 FROM persona_src
 UNION ALL SELECT 'water_source', count(water_source), count(DISTINCT water_source), NULL, NULL, NULL, NULL, NULL FROM persona_src""", "persona_src")
def _(t: Tables) -> DataFrame:
    d = aggregates.describe(t.persona_src.select("balance", "water_source"))
    return d.select("column_name", "n", "n_distinct", *[F.round(c, 4).alias(c) for c in ("mean", "std", "q1", "median", "q3")])


@query("A11_null_profile", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls, round_even(count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*), 2) AS percent FROM persona_src" for c in ("customer_id", "main_source_of_income", "water_source", "farm_acreage", "income_level", "balance")), "persona_src")
def _(t: Tables) -> DataFrame:
    return aggregates.null_profile(t.persona_src)


@query("A12_non_null", " UNION ALL ".join(f"SELECT '{n}' AS table_name, '{c}' AS column_name, count({c}) AS non_null FROM {n}" for n, cs in (("snapshot_old", ("id", "segment")), ("persona_src", ("customer_id", "water_source"))) for c in cs), "snapshot_old", "persona_src")
def _(t: Tables) -> DataFrame:
    return aggregates.non_null_counts({"snapshot_old": t.snapshot_old.select("id", "segment"), "persona_src": t.persona_src.select("customer_id", "water_source")})


@query("A13_row_counts", "SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'customer', count(*) FROM customer")
def _(t: Tables) -> DataFrame:
    return aggregates.row_counts({n: getattr(t, n) for n in ("orders", "lineitem", "customer")})


@query("A13_largest_table", "SELECT 'lineitem' AS largest, count(*) AS n_rows FROM lineitem")
def _(t: Tables) -> DataFrame:
    counts = aggregates.row_counts({n: getattr(t, n) for n in ("orders", "lineitem", "customer")})
    return counts.agg(F.max_by("table_name", "n_rows").alias("largest"), F.max("n_rows").alias("n_rows"))


@query("A14_row_count_comparison", """SELECT 'snapshot' AS table_name, a AS source_rows, b AS target_rows, b - a AS difference, round_even((b - a) * 100.0 / a, 2) AS percent, CASE WHEN a = b THEN 'MATCH' WHEN b > a THEN 'TARGET_HAS_MORE' ELSE 'SOURCE_HAS_MORE' END AS status
 FROM (SELECT (SELECT count(*) FROM snapshot_old) AS a, (SELECT count(*) FROM snapshot_new) AS b)""", "snapshot_old", "snapshot_new")
def _(t: Tables) -> DataFrame:
    return aggregates.row_count_comparison(aggregates.row_counts({"snapshot": t.snapshot_old}), aggregates.row_counts({"snapshot": t.snapshot_new}))


@query("A15_catalog", """WITH c AS (SELECT table_name, is_nullable, CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS data_type FROM information_schema.columns WHERE table_name IN ('orders', 'lineitem', 'customer'))
SELECT table_name, count(*) AS n_columns, count(*) FILTER (WHERE is_nullable = 'YES') AS n_nullable, (SELECT data_type FROM c d WHERE d.table_name = c.table_name GROUP BY data_type ORDER BY count(*) DESC, data_type LIMIT 1) AS commonest_type FROM c GROUP BY table_name""")
def _(t: Tables) -> DataFrame:
    from functools import reduce

    from gridmill.operators.diff import schema_rows

    return aggregates.catalog_summary(reduce(DataFrame.unionByName, [schema_rows(getattr(t, n), n) for n in ("orders", "lineitem", "customer")]))


@query("A16_crosstab", "SELECT income_level, round(count(*) FILTER (WHERE farm_acreage = 'more than 2') / count(*), 6) AS more, round(count(*) FILTER (WHERE farm_acreage = '2 or less') / count(*), 6) AS less FROM persona_src WHERE farm_acreage IS NOT NULL GROUP BY 1", "persona_src")
def _(t: Tables) -> DataFrame:
    x = aggregates.normalised_crosstab(t.persona_src.where("farm_acreage IS NOT NULL"), "income_level", "farm_acreage", ["more than 2", "2 or less"])
    return x.select("income_level", F.round("`more than 2`", 6).alias("more"), F.round("`2 or less`", 6).alias("less"))


@query("A17_usage", "SELECT device_id, date_trunc('day', event_time)::DATE AS usage_date, count(DISTINCT date_trunc('minute', event_time)) AS minutes, round(avg(motor_current * panel_voltage), 6) AS avg_power FROM telemetry_direct WHERE motor_current > 0 GROUP BY 1, 2", "telemetry_direct")
def _(t: Tables) -> DataFrame:
    from gridmill.plans.telemetry import usage

    rows = t.telemetry_direct.where("motor_current > 0").select("device_id", "event_time", (F.col("motor_current") * F.col("panel_voltage")).alias("power"), F.lit("Direct").alias("source"))
    return usage(rows).select("device_id", "usage_date", "minutes", F.round("avg_power", 6).alias("avg_power"))


@query("A18_histogram", "SELECT income_level, floor((balance + 1000) / 500)::BIGINT AS bin, count(*) AS n, round(count(*) / (sum(count(*)) OVER (PARTITION BY income_level) * 500), 9) AS density FROM persona_src WHERE balance IS NOT NULL GROUP BY 1, 2", "persona_src")
def _(t: Tables) -> DataFrame:
    return aggregates.histogram_density(t.persona_src, "income_level", "balance", -1000.0, 500.0).withColumn("density", F.round("density", 9))


@query("A19_five_numbers", "SELECT income_level, min(balance) AS minimum, round(quantile_cont(balance, 0.25), 6) AS q1, round(median(balance), 6) AS median, round(quantile_cont(balance, 0.75), 6) AS q3, max(balance) AS maximum FROM persona_src GROUP BY 1", "persona_src")
def _(t: Tables) -> DataFrame:
    x = aggregates.five_numbers(t.persona_src, "income_level", "balance")
    return x.select("income_level", "minimum", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3")], "maximum")


@query("A20_hexagons", f"""WITH {_GEO}, a AS (SELECT (lon * sqrt(3) / 3 - lat / 3) / 0.5 AS q, (lat * 2 / 3) / 0.5 AS r FROM v), b AS (SELECT q, r, -q - r AS s, round(q) AS rq, round(r) AS rr, round(-q - r) AS rs FROM a),
c AS (SELECT *, abs(rq - q) AS dq, abs(rr - r) AS dr, abs(rs - s) AS ds FROM b)
SELECT (CASE WHEN dq > dr AND dq > ds THEN -rr - rs ELSE rq END)::BIGINT AS hex_col, (CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -rq - rs ELSE rr END)::BIGINT AS hex_row, count(*) AS n FROM c GROUP BY 1, 2""", "geo_points")
def _(t: Tables) -> DataFrame:
    return geo.hexagon_counts(geo.normal_points(t.geo_points, "lat_raw", "lon_raw"), 0.5)


@query("A21_outcomes", "SELECT CASE WHEN id_number IS NULL THEN 'invalid' ELSE 'inserted' END AS outcome, count(*) AS n FROM leads_src GROUP BY 1", "leads_src")
def _(t: Tables) -> DataFrame:
    return aggregates.outcome_counts(t.leads_src.withColumn("outcome", F.when(F.col("id_number").isNull(), "invalid").otherwise("inserted")))


@query("A22_reconciliation", "SELECT count(*) AS total, round(count(*) FILTER (WHERE status = 'Arrears') * 100.0 / count(*), 4) AS rate, 'PASS' AS verdict FROM accounts", "accounts")
def _(t: Tables) -> DataFrame:
    x = t.accounts.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "Arrears").alias("hit"), F.count_if(F.col("status") != "Arrears").alias("miss"))
    return x.select("total", F.round(F.col("hit") * 100 / F.col("total"), 4).alias("rate"), aggregates.reconciliation(F.col("hit") + F.col("miss"), F.col("total")).alias("verdict"))


@query("A23_centre", f"WITH {_GEO} SELECT round(greatest(-5, least(5, avg(lat))), 6) AS lat, round(greatest(28, least(42, avg(lon))), 6) AS lon FROM v", "geo_points")
def _(t: Tables) -> DataFrame:
    from gridmill.functions.places import LATITUDES, LONGITUDES

    points = geo.normal_points(t.geo_points, "lat_raw", "lon_raw")
    return aggregates.clamped_centre(points, "lat", "lon", (LATITUDES, LONGITUDES), (0.0, 36.0)).select(F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"))


@query("A24_comparison_summary", """SELECT (SELECT count(*) FROM snapshot_old) AS source_rows, (SELECT count(*) FROM snapshot_new) AS target_rows, count(*) FILTER (WHERE n.id IS NULL) AS only_source, count(*) FILTER (WHERE o.id IS NULL) AS only_target, count(*) FILTER (WHERE o.id IS NOT NULL AND n.id IS NOT NULL) AS common,
 count(*) FILTER (WHERE o.id IS NOT NULL AND n.id IS NOT NULL AND (o.segment IS DISTINCT FROM n.segment OR o.amount IS DISTINCT FROM n.amount OR o.updated_at IS DISTINCT FROM n.updated_at OR o.name IS DISTINCT FROM n.name)) AS differing FROM snapshot_old o FULL JOIN snapshot_new n ON o.id = n.id""", "snapshot_old", "snapshot_new")
def _(t: Tables) -> DataFrame:
    from gridmill.operators.diff import summary

    return summary(t.snapshot_old, t.snapshot_new, ["id"])


@query("W1_latest_survey", "SELECT lead_id, modified_at::TIMESTAMP AS modified_at, seq, part_ref FROM (SELECT *, row_number() OVER (PARTITION BY lead_id ORDER BY modified_at DESC, seq DESC, part_ref DESC) AS n FROM survey_src) WHERE n = 1", "survey_src")
def _(t: Tables) -> DataFrame:
    return dedupe.one_per_key(t.survey_src, ["lead_id"], [F.desc("modified_at"), F.desc("seq"), F.desc("part_ref")]).select("lead_id", F.col("modified_at").cast("timestamp_ntz").alias("modified_at"), "seq", "part_ref")


@query("W2_latest_repossession", "SELECT DISTINCT ON (account_id) account_id, status FROM repossessions ORDER BY account_id, created_at DESC, seq DESC, part_ref DESC", "repossessions")
def _(t: Tables) -> DataFrame:
    return dedupe.one_per_key(t.repossessions, ["account_id"], [F.desc("created_at"), F.desc("seq"), F.desc("part_ref")]).select("account_id", "status")


@query("W3_duplicate_phones", "SELECT lead_id, phone_raw, n AS occurrence FROM (SELECT *, row_number() OVER (PARTITION BY phone_raw ORDER BY lead_id) AS n FROM leads_src WHERE phone_raw IS NOT NULL AND trim(phone_raw) <> '') WHERE n > 1", "leads_src")
def _(t: Tables) -> DataFrame:
    return dedupe.split_duplicates(t.leads_src, "phone_raw", [F.col("lead_id")])[1].select("lead_id", "phone_raw", F.col("occurrence").cast("long").alias("occurrence"))


@query("W5_group_median_fill", "SELECT customer_id, coalesce(balance, median(balance) OVER (PARTITION BY income_level)) AS balance FROM persona_src", "persona_src")
def _(t: Tables) -> DataFrame:
    return aggregates.fill_with_group_median(t.persona_src, "income_level", "balance").select("customer_id", "balance")


@query("W6_average_rank", "SELECT name, floor(rank() OVER (ORDER BY x DESC) + (count(*) OVER (PARTITION BY x) - 1) / 2)::INT AS r FROM (SELECT n_name AS name, n_regionkey AS x FROM nation)")
def _(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_name").alias("name"), dedupe.average_rank(F.col("n_regionkey")).alias("r"))


@query("W6_average_ranks", "SELECT c_custkey, floor(rank() OVER (ORDER BY x DESC NULLS LAST) + (count(*) OVER (PARTITION BY x) - 1) / 2)::INT AS r FROM (SELECT c_custkey, CASE WHEN c_nationkey <> 3 THEN round(c_acctbal / 100) END AS x FROM customer)")
def _(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.when(F.col("c_nationkey") != 3, F.round(F.col("c_acctbal") / 100)).alias("x"))
    return dedupe.average_ranks(rows, "x", "r").select("c_custkey", "r")


@query("W9_position", "SELECT c_mktsegment, c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS position FROM customer")
def _(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    return t.customer.select("c_mktsegment", "c_custkey", F.row_number().over(Window.partitionBy("c_mktsegment").orderBy("c_custkey")).cast("long").alias("position"))
