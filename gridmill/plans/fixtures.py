"""Tables derived from the base tables, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridmill import ship

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

DERIVED = {
    "leads_src": r"""
SELECT concat('L', lpad(cast(o.o_orderkey AS STRING), 8, '0')) AS lead_id, concat('U', cast(o.o_custkey % 100 AS STRING)) AS created_by_id, concat('U', cast(o.o_orderkey % 120 AS STRING)) AS modified_by_id,
 CASE o.o_custkey % 4 WHEN 0 THEN c.c_name WHEN 1 THEN concat('Ann ', c.c_mktsegment) WHEN 2 THEN concat(' Jo  Van ', c.c_mktsegment, ' ') ELSE NULL END AS full_name,
 CASE o.o_orderkey % 8 WHEN 0 THEN concat('254', concat('7', lpad(cast(o.o_custkey AS STRING), 8, '0'))) WHEN 1 THEN concat('+254', concat('7', lpad(cast(o.o_custkey AS STRING), 8, '0'))) WHEN 2 THEN concat('2540', concat('7', lpad(cast(o.o_custkey AS STRING), 8, '0'))) WHEN 3 THEN concat('7', lpad(cast(o.o_custkey AS STRING), 8, '0')) WHEN 4 THEN concat('07', lpad(cast(o.o_custkey AS STRING), 8, '0')) WHEN 5 THEN concat('0 7-', lpad(cast(o.o_custkey AS STRING), 8, '0')) WHEN 6 THEN 'n/a' ELSE NULL END AS phone_raw,
 CASE c.c_mktsegment WHEN 'BUILDING' THEN 'ipos' WHEN 'MACHINERY' THEN 'Refer & Earn' WHEN 'FURNITURE' THEN 'Engineer Referral' WHEN 'HOUSEHOLD' THEN 'Reshuffled Leads' ELSE NULL END AS lead_source,
 CASE o.o_orderstatus WHEN 'F' THEN 'Converted' WHEN 'O' THEN 'New' ELSE 'Qualified' END AS status, CASE WHEN o.o_orderkey % 9 = 0 THEN NULL ELSE concat('ID', cast(o.o_custkey AS STRING)) END AS id_number,
 CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Now' WHEN '2-HIGH' THEN 'Two Weeks' WHEN '5-LOW' THEN NULL ELSE 'Default' END AS purchase_date,
 CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE concat('{"SmileJobID":"', cast(o.o_orderkey AS STRING), '","_status_":"', CASE o.o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'FAILED' ELSE 'X' END, '","DOB":"', CASE o.o_orderkey % 4 WHEN 0 THEN 'null' WHEN 1 THEN '' WHEN 2 THEN 'Not Available' ELSE '1990-01-31' END, '"}') END AS kyc_json,
 o.o_orderdate AS created_at, o.o_orderdate + INTERVAL '30' DAY AS updated_at FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
""",
    "survey_src": r"""
SELECT concat('L', lpad(cast(l_orderkey AS STRING), 8, '0')) AS lead_id, l_shipdate AS modified_at, l_linenumber AS seq, l_partkey AS part_ref, CASE l_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Wife' WHEN 2 THEN 'Parent' WHEN 3 THEN 'Husband' ELSE 'Sibling' END AS relation, CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE concat('07', lpad(cast(l_suppkey AS STRING), 8, '0')) END AS kin_phone, l_suppkey % 110 AS created_by FROM lineitem
""",
    "crm_leads": r"""
SELECT concat('L', lpad(cast(o.o_orderkey AS STRING), 8, '0')) AS lead_id, concat('U', cast(o.o_custkey % 100 AS STRING)) AS created_by_id, concat('U', cast(o.o_orderkey % 120 AS STRING)) AS modified_by_id, concat('A', cast(o.o_custkey % 90 AS STRING)) AS agent_id,
 CASE WHEN o.o_orderkey % 6 = 0 THEN o.o_orderkey % 50 + 2000 ELSE NULL END AS employee_id, CASE WHEN o.o_custkey % 4 = 0 THEN NULL ELSE 'Ann' END AS first_name, c.c_mktsegment AS last_name, c.c_name AS name, concat('2547', lpad(cast(o.o_custkey AS STRING), 8, '0')) AS phone,
 CASE WHEN o.o_orderkey % 9 = 0 THEN NULL ELSE concat('ID', cast(o.o_custkey AS STRING)) END AS id_number, CASE c.c_mktsegment WHEN 'BUILDING' THEN 'iPOs' WHEN 'MACHINERY' THEN 'Refer & Earn' WHEN 'FURNITURE' THEN 'Engineer Referral' WHEN 'HOUSEHOLD' THEN 'Reshuffled Leads' ELSE NULL END AS lead_source,
 CASE o.o_orderkey % 5 WHEN 0 THEN 'Web' WHEN 1 THEN 'SALESAPP' WHEN 2 THEN 'field' WHEN 3 THEN 'Radio' ELSE NULL END AS channel, CASE o.o_orderstatus WHEN 'F' THEN 'Converted' WHEN 'O' THEN 'New' ELSE 'Qualified' END AS status, CASE WHEN o.o_orderkey % 10 = 0 THEN NULL WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_converted,
 CASE o.o_custkey % 4 WHEN 0 THEN 'Hot' WHEN 1 THEN 'Cold' WHEN 2 THEN 'Warm' ELSE NULL END AS category, CASE WHEN o.o_custkey % 3 = 0 THEN NULL ELSE 'PAYG' END AS payment_method, CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Now' WHEN '2-HIGH' THEN 'Two Weeks' WHEN '5-LOW' THEN NULL ELSE 'Default' END AS purchase_date,
 o.o_orderpriority AS product, 'en' AS language, concat('K', cast(o.o_custkey AS STRING)) AS tax_pin, CASE WHEN o.o_custkey % 2 = 0 THEN 'Male' ELSE NULL END AS gender, o.o_custkey % 3 AS customer_type, CASE WHEN o.o_custkey % 7 = 0 THEN NULL ELSE '1980-05-05' END AS date_of_birth,
 CASE WHEN o.o_orderkey % 3 = 0 THEN NULL ELSE concat('{"SmileJobID":"', cast(o.o_orderkey AS STRING), '","ResultCode":"10', cast(o.o_orderkey % 5 AS STRING), '","_status_":"', CASE o.o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'FAILED' ELSE 'X' END, '","IDType":"PASSPORT",', CASE WHEN o.o_orderkey % 2 = 0 THEN '"IDNumber":"Z1",' ELSE '' END, '"ResultType":"Check","DOB":"', CASE o.o_orderkey % 4 WHEN 0 THEN 'null' WHEN 1 THEN '' WHEN 2 THEN 'Not Available' ELSE '1990-01-31' END, '"}') END AS kyc_json,
 o.o_orderdate AS created_at, o.o_orderdate + INTERVAL '30' DAY AS updated_at, CASE WHEN o.o_orderstatus = 'F' THEN o.o_orderdate + INTERVAL '9' DAY ELSE NULL END AS converted_at FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
""",
    "crm_survey": r"""
SELECT concat('L', lpad(cast(l_orderkey AS STRING), 8, '0')) AS lead_id, l_shipdate AS modified_at, l_shipdate - INTERVAL '5' DAY AS created_at, l_linenumber AS seq, l_partkey AS part_ref, concat('U', cast(l_suppkey % 110 AS STRING)) AS created_by_id, CASE l_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Wife' WHEN 2 THEN 'Parent' WHEN 3 THEN 'Husband' ELSE 'Sibling' END AS relation,
 CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE 'Mary' END AS kin_name, CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE 'Otieno' END AS kin_surname, CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE concat('07', lpad(cast(l_suppkey AS STRING), 8, '0')) END AS kin_phone FROM lineitem
""",
    "crm_agents": r"""
SELECT concat('a', cast(s_suppkey AS STRING)) AS agent_id, s_suppkey + 3000 AS employee_id FROM supplier WHERE s_suppkey % 9 <> 0
""",
    "crm_referrals": r"""
SELECT concat('l', lpad(cast(o_orderkey AS STRING), 8, '0')) AS lead_id, concat('R', cast(o_custkey AS STRING)) AS referral_id FROM orders WHERE o_orderkey % 11 = 0
""",
    "crm_customers": r"""
SELECT c_custkey AS customer_id, concat('ID', cast(c_custkey AS STRING)) AS id_number FROM customer WHERE c_custkey % 8 <> 0
""",
    "crm_sources": r"""
SELECT min(c_nationkey) + 100 AS source_id, CASE c_mktsegment WHEN 'BUILDING' THEN 'IPOS' WHEN 'MACHINERY' THEN 'REFER & EARN' WHEN 'FURNITURE' THEN 'ENGINEER REFERRAL' WHEN 'HOUSEHOLD' THEN 'RESHUFFLED LEADS' ELSE 'OTHERS' END AS name FROM customer GROUP BY c_mktsegment
""",
    "crm_channels": r"""
SELECT r_regionkey + 1 AS channel_id, CASE r_regionkey WHEN 0 THEN 'WEB' WHEN 1 THEN 'SalesApp' WHEN 2 THEN 'Field' WHEN 3 THEN 'Others' ELSE r_name END AS name FROM region
""",
    "users_dim": r"""
SELECT concat('u', cast(s_suppkey AS STRING)) AS user_id, s_suppkey + 1000 AS employee_id, s_name AS user_name FROM supplier
""",
    "accounts": r"""
SELECT o_orderkey AS account_id, o_custkey AS customer_id, concat('ACC', cast(o_orderkey AS STRING)) AS account_ref, CASE o_orderstatus WHEN 'F' THEN 'Arrears' WHEN 'O' THEN 'Active' ELSE 'arrears' END AS status, o_totalprice AS balance, o_orderdate AS updated_at FROM orders
""",
    "repossessions": r"""
SELECT l_orderkey AS account_id, CASE l_returnflag WHEN 'A' THEN 'PAID' WHEN 'R' THEN 'CANCELLED' ELSE CASE l_linestatus WHEN 'O' THEN 'NEW' ELSE 'IN_TRANSIT' END END AS status, l_shipdate AS created_at, l_linenumber AS seq, l_partkey AS part_ref FROM lineitem WHERE l_orderkey % 3 <> 0
""",
    "premises": r"""
SELECT c_custkey AS customer_id, concat('P', cast(c_custkey AS STRING)) AS premises_id FROM customer WHERE c_custkey % 5 <> 0
""",
    "telemetry_direct": r"""
SELECT user_id AS device_id, ts AS event_time, value - 5 AS motor_current, cast(12 + user_id % 3 AS DOUBLE) AS panel_voltage FROM events WHERE event_type IN ('view', 'click', 'error')
""",
    "telemetry_battery": r"""
SELECT user_id AS device_id, ts AS event_time, value - 10 AS output_current, cast(24 AS DOUBLE) AS output_voltage FROM events WHERE event_type IN ('purchase', 'signup')
""",
    "geo_points": r"""
SELECT concat('C', cast(c_custkey AS STRING)) AS name, 'Customer' AS kind, CASE WHEN c_custkey % 29 = 0 THEN '0' WHEN c_custkey % 31 = 0 THEN 'bad' ELSE cast(cast((c_custkey * 37) % 1200 AS DOUBLE) / 100 - 6 AS STRING) END AS lat_raw, CASE WHEN c_custkey % 29 = 0 THEN '0' ELSE cast(cast((c_custkey * 53) % 1500 AS DOUBLE) / 100 + 28 AS STRING) END AS lon_raw FROM customer
UNION ALL SELECT concat('D', cast(s_suppkey AS STRING)), 'Agro-Dealer', cast(cast((s_suppkey * 41) % 1000 AS DOUBLE) / 100 - 5 AS STRING), cast(cast((s_suppkey * 59) % 1300 AS DOUBLE) / 100 + 29 AS STRING) FROM supplier
""",
    "survey_frame": r"""
SELECT o.o_custkey AS customer_id, o.o_orderdate AS sale_date, r.r_name AS region, n.n_name AS district, c.c_mktsegment AS account_type, CASE WHEN c.c_custkey % 13 = 0 THEN NULL WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, substr(o.o_orderpriority, 1, 1) AS product, CASE WHEN c.c_custkey % 6 = 0 THEN NULL WHEN c.c_custkey % 17 = 0 THEN 'unknown' ELSE concat(cast(1950 + c.c_custkey % 55 AS STRING), '-06-15') END AS dob_raw, cast(o.o_orderkey % 4 AS INT) AS units FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
""",
    "persona_src": r"""
SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'farming' ELSE 'business' END AS main_source_of_income, CASE c_custkey % 4 WHEN 0 THEN 'well' WHEN 1 THEN 'rainfed' WHEN 2 THEN 'rain harvesting' ELSE NULL END AS water_source, CASE WHEN c_acctbal > 5000 THEN 'more than 2' WHEN c_acctbal < 0 THEN NULL ELSE '2 or less' END AS farm_acreage, CASE WHEN c_acctbal > 9000 THEN 'high' WHEN c_acctbal > 3000 THEN 'medium' ELSE 'low' END AS income_level, CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE c_acctbal END AS balance FROM customer
""",
    "snapshot_old": r"""
SELECT c_custkey AS id, c_name AS name, c_nationkey AS region_id, CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_mktsegment END AS segment, c_acctbal AS amount, TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM customer WHERE c_custkey % 17 <> 0
""",
    "snapshot_new": r"""
SELECT c_custkey AS id, c_name AS name, c_nationkey AS region_id, CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 23 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS segment, CASE WHEN c_custkey % 10 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS amount, CASE WHEN c_custkey % 5 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS updated_at FROM customer WHERE c_custkey % 13 <> 0
""",
    "fuel_raw": r"""
SELECT cast(l.l_suppkey AS STRING) AS customer_num, concat('CARD', cast(l.l_partkey AS STRING)) AS card_num, CASE WHEN l.l_orderkey % 50 = 0 THEN '31/02/2024' ELSE concat(lpad(cast(day(l.l_shipdate) AS STRING), 2, '0'), '/', lpad(cast(month(l.l_shipdate) AS STRING), 2, '0'), '/', cast(year(l.l_shipdate) AS STRING)) END AS date_raw, concat(lpad(cast(l.l_orderkey % 24 AS STRING), 2, '0'), ':', lpad(cast(l.l_partkey % 60 AS STRING), 2, '0'), ':00') AS hour_raw, concat('R', cast(l.l_orderkey AS STRING), '-', cast(l.l_linenumber AS STRING)) AS receipt_num, CASE WHEN l.l_orderkey % 40 = 0 THEN 'x' ELSE cast(cast(l.l_quantity AS INT) AS STRING) END AS qty_raw, l.l_extendedprice AS amount FROM lineitem l
""",
}


class Tables:
    """Base and derived tables of a folder, by attribute. Base tables are read when first
    used; a derived one is the query above over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        ship(spark)

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name not in DERIVED:
            raise AttributeError(name)
        for base in BASE:
            if f" {base}" in DERIVED[name]:
                getattr(self, base).createOrReplaceTempView(base)
        return self.spark.sql(DERIVED[name])


def with_derived(sql: str, names: tuple[str, ...]) -> str:
    """``sql`` with the derived tables it names put before it."""
    heads = [f"{n} AS ({DERIVED[n].strip()})" for n in names]
    body = sql.strip()
    if not heads:
        return body
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(heads) + ",\n" + body[5:]
    return "WITH " + ",\n".join(heads) + "\n" + body
