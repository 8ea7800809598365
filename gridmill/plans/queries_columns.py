"""Queries of column functions, projections, filters, sorts and set operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridmill.functions import codes, numbers, places, text
from gridmill.operators import rules, schema
from gridmill.plans.fixtures import Tables
from gridmill.plans.registry import query

_PHONE_SQL = """CASE WHEN phone_raw IS NULL OR phone_raw = '' THEN NULL ELSE CASE
 WHEN starts_with(d, '2540') THEN '0' || substr(d, 5) WHEN starts_with(d, '+254') THEN '0' || substr(d, 5)
 WHEN regexp_matches(d, '^25[4526]') THEN '0' || substr(d, 4) WHEN regexp_matches(d, '^[71]') THEN '0' || d ELSE d END END"""


@query("C1_standard_phone", f"SELECT lead_id, {_PHONE_SQL} AS phone FROM (SELECT lead_id, phone_raw, regexp_replace(CASE WHEN regexp_matches(phone_raw, '[eE]') THEN NULL ELSE trim(phone_raw) END, '[^0-9+]', '', 'g') AS d FROM leads_src)", "leads_src")
def _(t: Tables) -> DataFrame:
    return t.leads_src.select("lead_id", text.standard_phone(F.col("phone_raw")).alias("phone"))


@query("C2_phone_without_plus", "SELECT lead_id, replace(phone_raw, '+', '') AS phone FROM leads_src", "leads_src")
def _(t: Tables) -> DataFrame:
    return t.leads_src.select("lead_id", text.without_plus(F.col("phone_raw")).alias("phone"))


@query("C3_name_split", """SELECT lead_id, CASE WHEN trim(coalesce(full_name, '')) = '' THEN 'N/A' ELSE p[1] END AS first_name,
 CASE WHEN trim(coalesce(full_name, '')) = '' OR len(p) < 2 THEN 'N/A' ELSE array_to_string(p[2:], ' ') END AS last_name
 FROM (SELECT lead_id, full_name, regexp_split_to_array(trim(full_name), '\\s+') AS p FROM leads_src)""", "leads_src")
def _(t: Tables) -> DataFrame:
    return t.leads_src.select("lead_id", text.first_name(F.col("full_name")).alias("first_name"), text.last_name(F.col("full_name")).alias("last_name"))


@query("C4_error_category", """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'Duplicate Record' WHEN 1 THEN 'Missing Field' WHEN 2 THEN 'Invalid Field' WHEN 3 THEN 'API Error' ELSE 'Other Error' END AS category FROM orders""")
def _(t: Tables) -> DataFrame:
    messages = ["DUPLICATES_DETECTED: x", "REQUIRED_FIELD_MISSING [a]", "invalid_field b", "Malformed request", "timeout"]
    message = F.element_at(F.array(*map(F.lit, messages)), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return t.orders.select("o_orderkey", text.error_category(message).alias("category"))


@query("C5_normal_text", "SELECT customer_id, lower(trim(coalesce(water_source, 'missing'))) AS water FROM persona_src", "persona_src")
def _(t: Tables) -> DataFrame:
    return t.persona_src.select("customer_id", text.normal_text(F.col("water_source")).alias("water"))


@query("C6_decimal_zero", "SELECT c_custkey, regexp_replace((c_custkey::VARCHAR || '.0'), '\\.0$', '') AS x FROM customer")
def _(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", text.without_decimal_zero(F.concat(F.col("c_custkey").cast("string"), F.lit(".0"))).alias("x"))


@query("C7_composite_key", "SELECT id, id::VARCHAR || '||' || coalesce(segment, 'null') AS k FROM snapshot_old", "snapshot_old")
def _(t: Tables) -> DataFrame:
    return t.snapshot_old.select("id", text.composite_key(F.col("id"), F.col("segment")).alias("k"))


@query("C8_point_text", "SELECT name, try_cast(lon_raw AS DOUBLE) AS lon, try_cast(lat_raw AS DOUBLE) AS lat FROM geo_points", "geo_points")
def _(t: Tables) -> DataFrame:
    p = t.geo_points.withColumn("wkt", F.concat(F.lit("POINT("), "lon_raw", F.lit(" "), "lat_raw", F.lit(")")))
    return p.select("name", places.point_part(F.col("wkt"), 0).alias("lon"), places.point_part(F.col("wkt"), 1).alias("lat"))


@query("C9_prefix", "SELECT lead_id, 'sf-' || id_number AS ref FROM leads_src", "leads_src")
def _(t: Tables) -> DataFrame:
    return t.leads_src.select("lead_id", text.prefixed("sf-", F.col("id_number")).alias("ref"))


@query("C10_trim_coalesce", "SELECT lead_id, coalesce(trim(full_name), 'none') AS name, replace(coalesce(lead_source, '-'), ' ', '_') AS source FROM leads_src", "leads_src")
def _(t: Tables) -> DataFrame:
    return t.leads_src.select("lead_id", F.coalesce(F.trim("full_name"), F.lit("none")).alias("name"), F.replace(F.coalesce("lead_source", F.lit("-")), F.lit(" "), F.lit("_")).alias("source"))


@query("C11_day_first", "SELECT receipt_num, card_num, try_strptime(date_raw, '%d/%m/%Y')::DATE AS day FROM fuel_raw", "fuel_raw")
def _(t: Tables) -> DataFrame:
    return t.fuel_raw.select("receipt_num", "card_num", numbers.day_first(F.col("date_raw")).alias("day"))


@query("C12_day_and_hour", "SELECT receipt_num, card_num, coalesce(try_strptime(date_raw || ' ' || hour_raw, '%d/%m/%Y %H:%M:%S'), TIMESTAMP '2024-06-01 00:00:00') AS at FROM fuel_raw", "fuel_raw")
def _(t: Tables) -> DataFrame:
    fallback = F.lit("2024-06-01 00:00:00").cast("timestamp")
    return t.fuel_raw.select("receipt_num", "card_num", numbers.day_and_hour(F.col("date_raw"), F.col("hour_raw"), fallback).cast("timestamp_ntz").alias("at"))


@query("C13_day_and_minute", "SELECT event_id, date_trunc('day', ts)::DATE AS day, date_trunc('minute', ts)::TIMESTAMP AS minute FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", numbers.day_of(F.col("ts")).alias("day"), numbers.minute_of(F.col("ts")).cast("timestamp_ntz").alias("minute"))


@query("C14_age", "SELECT customer_id, sale_date::DATE AS sale_date, (2025 - year(try_cast(dob_raw AS DATE)))::INT AS age FROM survey_frame", "survey_frame")
def _(t: Tables) -> DataFrame:
    return t.survey_frame.select("customer_id", F.to_date("sale_date").alias("sale_date"), numbers.age(F.col("dob_raw").try_cast("date"), F.lit("2025-01-01").cast("date")).alias("age"))


@query("C15_any_time", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE o_orderdate::TIMESTAMP END AS at FROM orders")
def _(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = F.when(F.col("o_orderkey") % 4 == 0, F.concat(day, F.lit("T00:00:00.000Z"))).when(F.col("o_orderkey") % 4 == 1, F.concat(day, F.lit(" 00:00:00"))).when(F.col("o_orderkey") % 4 == 2, F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string")).otherwise("soon")
    return t.orders.select("o_orderkey", numbers.any_time(raw).cast("timestamp_ntz").alias("at"))


@query("C16_iso_time", "SELECT o_orderkey, o_orderdate::TIMESTAMP AS at FROM orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", numbers.iso_time(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00.000Z"))).cast("timestamp_ntz").alias("at"))


@query("C17_number", "SELECT receipt_num, card_num, try_cast(qty_raw AS DOUBLE) AS qty FROM fuel_raw", "fuel_raw")
def _(t: Tables) -> DataFrame:
    return t.fuel_raw.select("receipt_num", "card_num", numbers.as_number(F.col("qty_raw")).alias("qty"))


@query("C18_number_or_zero", "SELECT receipt_num, card_num, coalesce(try_cast(qty_raw AS DOUBLE), 0) AS qty FROM fuel_raw", "fuel_raw")
def _(t: Tables) -> DataFrame:
    return t.fuel_raw.select("receipt_num", "card_num", numbers.number_or_zero(F.col("qty_raw")).alias("qty"))


@query("C19_half_even", "SELECT o_orderkey, round_even(o_orderkey / 2, 0) AS x FROM orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", numbers.half_even(F.col("o_orderkey") / 2).alias("x"))


@query("C20_ratio", "SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN 0.0 ELSE round(c_custkey::DOUBLE / c_nationkey, 6) END AS r FROM customer")
def _(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.round(numbers.ratio(F.col("c_custkey"), F.col("c_nationkey")), 6).alias("r"))


@query("C21_distance", "SELECT name, round(sqrt(power(try_cast(lon_raw AS DOUBLE) - 36, 2) + power(try_cast(lat_raw AS DOUBLE), 2)) * 111, 6) AS km FROM geo_points", "geo_points")
def _(t: Tables) -> DataFrame:
    lat, lon = F.col("lat_raw").try_cast("double"), F.col("lon_raw").try_cast("double")
    return t.geo_points.select("name", F.round(places.distance_km(lat, lon, F.lit(0.0), F.lit(36.0)), 6).alias("km"))


@query("C22_circle", "SELECT s_suppkey, a AS angle, round(cos(radians(a)) * 10 / 111.0, 9) + 0.0 AS x, round(sin(radians(a)) * 10 / 111.0, 9) + 0.0 AS y FROM (SELECT s_suppkey, unnest(range(0, 361, 10)) AS a FROM supplier)")
def _(t: Tables) -> DataFrame:
    ring = t.supplier.select("s_suppkey", F.posexplode(places.circle(F.lit(0.0), F.lit(0.0), 10.0)).alias("i", "p"))
    return ring.select("s_suppkey", (F.col("i") * 10).cast("long").alias("angle"), (F.round("p.lon", 9) + 0.0).alias("x"), (F.round("p.lat", 9) + 0.0).alias("y"))


@query("C23_json_text", "SELECT lead_id, json_extract_string(kyc_json, '$.SmileJobID') AS job, json_extract_string(kyc_json, '$.DOB') AS dob FROM leads_src", "leads_src")
def _(t: Tables) -> DataFrame:
    return t.leads_src.select("lead_id", text.json_text(F.col("kyc_json"), "SmileJobID").alias("job"), text.json_text(F.col("kyc_json"), "DOB").alias("dob"))


@query("C24_row_as_json", """SELECT id, '{"id":' || id || ',"segment":' || CASE WHEN segment IS NULL THEN 'null' ELSE '"' || segment || '"' END || '}' AS j FROM snapshot_old""", "snapshot_old")
def _(t: Tables) -> DataFrame:
    return t.snapshot_old.select("id", text.row_as_json(["id", "segment"]).alias("j"))


@query("C25_dirty_literals", "SELECT lead_id, CASE WHEN d IS NULL OR trim(d) = '' OR lower(d) IN ('null', 'not available') THEN 'unknown' ELSE d END AS dob FROM (SELECT lead_id, json_extract_string(kyc_json, '$.DOB') AS d FROM leads_src)", "leads_src")
def _(t: Tables) -> DataFrame:
    dob = text.cleaned(text.json_text(F.col("kyc_json"), "DOB"), "null", "not available")
    return t.leads_src.select("lead_id", F.coalesce(dob, F.lit("unknown")).alias("dob"))


@query("C26_code_mappings", """SELECT l.lead_id, CASE WHEN purchase_date = 'Now' THEN 'NOW' ELSE 'LATER' END AS purchase, CASE status WHEN 'New' THEN 'NEW' WHEN 'Converted' THEN 'CONVERTED' WHEN 'Qualified' THEN 'QUALIFIED' ELSE 'NEW' END AS status,
 CASE lower(lead_source) WHEN 'engineer referral' THEN 'EMPLOYEE' WHEN 'ipos' THEN 'IPOS' WHEN 'refer & earn' THEN 'CUSTOMER' WHEN 'refer and earn' THEN 'CUSTOMER' END AS referral FROM leads_src l""", "leads_src")
def _(t: Tables) -> DataFrame:
    return t.leads_src.select("lead_id", codes.mapped(F.col("purchase_date"), *codes.PURCHASE_DATE).alias("purchase"), codes.mapped(F.col("status"), *codes.STATUS).alias("status"), codes.mapped(F.lower("lead_source"), *codes.REFERRAL_TYPE).alias("referral"))


@query("C26_relationship_and_user", """SELECT lead_id, seq, part_ref, CASE WHEN relation IS NULL OR relation = 'Parent' THEN 'Other' WHEN relation IN ('Wife', 'Husband') THEN 'Spouse' ELSE relation END AS relation,
 CASE WHEN created_by = 7 THEN 895 ELSE coalesce(created_by, 895) END AS created_by FROM survey_src""", "survey_src")
def _(t: Tables) -> DataFrame:
    return t.survey_src.select("lead_id", "seq", "part_ref", codes.relationship(F.col("relation")).alias("relation"), codes.valid_user(F.col("created_by"), F.lit(None).cast("bigint"), (7,), 895).alias("created_by"))


@query("C27_persona", """SELECT customer_id, CASE WHEN income_level = 'high' THEN 'Business Customer' WHEN farm_acreage = '2 or less' AND main_source_of_income IS DISTINCT FROM 'farming' THEN 'Youth Side Hustle'
 WHEN farm_acreage = '2 or less' THEN 'Youth Primary Customer' WHEN farm_acreage = 'more than 2' AND water_source IN ('well', 'rain harvesting') THEN 'Older Irrigated/Seasonal'
 WHEN farm_acreage = 'more than 2' AND water_source = 'rainfed' THEN 'Older Rainfed/Seasonal' ELSE 'Unclassified' END AS persona FROM persona_src""", "persona_src")
def _(t: Tables) -> DataFrame:
    return t.persona_src.select("customer_id", codes.persona(F.col("income_level"), F.col("farm_acreage"), F.col("main_source_of_income"), F.col("water_source")).alias("persona"))


@query("C28_explode_accounts", "SELECT o_custkey, o_orderkey AS account_id FROM orders")
def _(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.collect_list("o_orderkey").alias("accounts")).select("o_custkey", F.explode("accounts").alias("account_id"))


@query("C29_indicator", "SELECT customer_id, sale_date::DATE AS sale_date, units, (units > 0)::INT AS sold, CASE gender WHEN 'F' THEN 0 WHEN 'M' THEN 1 END::INT AS male FROM survey_frame", "survey_frame")
def _(t: Tables) -> DataFrame:
    return t.survey_frame.select("customer_id", F.to_date("sale_date").alias("sale_date"), "units", numbers.indicator(F.col("units"), "positive").alias("sold"), numbers.indicator(F.col("gender"), "two", F.lit("F"), F.lit("M")).alias("male"))


@query("C30_load_range", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN DATE '2024-05-02' WHEN c_custkey % 3 = 1 THEN DATE '2024-05-20' ELSE DATE '2024-05-31' END AS first_day, DATE '2024-05-31' AS last_day FROM customer")
def _(t: Tables) -> DataFrame:
    k, today = F.col("c_custkey") % 3, F.lit("2024-06-01").cast("date")
    start, end = numbers.load_range(F.when(k == 1, F.lit("2024-05-20").cast("date")), today, 30, k == 0)
    return t.customer.select("c_custkey", start.alias("first_day"), end.alias("last_day"))


@query("P1_normal_names", "SELECT l_orderkey AS order_key, l_linenumber AS line_no, l_quantity AS qty_per_unit FROM lineitem")
def _(t: Tables) -> DataFrame:
    return schema.normal_names(t.lineitem.select(F.col("l_orderkey").alias("Order  Key"), F.col("l_linenumber").alias("Line No"), F.col("l_quantity").alias("Qty per/Unit")))


@query("P2_fuel_names", "SELECT customer_num AS customer_number, receipt_num AS receipt_number, amount FROM fuel_raw", "fuel_raw")
def _(t: Tables) -> DataFrame:
    return schema.normal_names(t.fuel_raw.select(F.col("customer_num").alias("Customer num."), F.col("receipt_num").alias("Receipt num"), F.col("amount").alias("Amount")), [*schema.FUEL])


@query("P3_alias_rename", "SELECT card_num AS card_number, receipt_num AS receipt FROM fuel_raw", "fuel_raw")
def _(t: Tables) -> DataFrame:
    raw = t.fuel_raw.select(F.when(F.length("card_num") > 6, F.col("card_num")).alias("Card"), F.col("card_num").alias("Card num."), F.col("receipt_num").alias("Receipt num."))
    return schema.rename_aliases(raw, {"Card": "card_number", "Card num.": "card_number", "Receipt num.": "receipt"})


@query("P4_subset", "SELECT lead_id, status, created_at::TIMESTAMP AS created_at FROM leads_src", "leads_src")
def _(t: Tables) -> DataFrame:
    return schema.subset(t.leads_src, ["lead_id", "status", "created_at", "created_by_id", "absent"], "_by_id$").withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("P5_cast_columns", "SELECT receipt_num, card_num, try_cast(qty_raw AS INT) AS qty_raw FROM fuel_raw", "fuel_raw")
def _(t: Tables) -> DataFrame:
    return schema.cast_columns(t.fuel_raw.select("receipt_num", "card_num", "qty_raw"), {"qty_raw": "int", "absent": "int"})


@query("P6_coerce", "SELECT o_orderkey AS \"Id\", CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS \"Flag\", CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS \"Price\" FROM orders")
def _(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    raw = t.orders.select(k.cast("string").alias("id"), F.when(k % 3 == 0, "TRUE").when(k % 3 == 1, "0").otherwise("").alias("flag"), F.when(k % 2 == 0, F.col("o_totalprice").cast("string")).otherwise(" ").alias("price"), F.lit(1).alias("other"))
    return schema.coerce_to(raw, T.StructType([T.StructField("Id", T.LongType()), T.StructField("Flag", T.BooleanType()), T.StructField("Price", T.DoubleType())]))


@query("P7_intersect", "SELECT lead_id, id_number FROM leads_src WHERE id_number IS NOT NULL", "leads_src")
def _(t: Tables) -> DataFrame:
    return schema.intersect(t.leads_src, T.StructType([T.StructField("Lead_Id", T.StringType()), T.StructField("id_number", T.StringType())]), "id_number")


@query("P8_drop_compound", "SELECT c_custkey, c_name FROM customer")
def _(t: Tables) -> DataFrame:
    return schema.drop_compound(t.customer.select("c_custkey", "c_name", F.struct("c_nationkey", "c_acctbal").alias("address")))


@query("P9_truncate", "SELECT c_custkey, substr(c_name, 1, 12) AS c_name, substr(c_mktsegment, 1, 12) AS c_mktsegment FROM customer")
def _(t: Tables) -> DataFrame:
    return schema.truncate_texts(t.customer.select("c_custkey", "c_name", "c_mktsegment"), 12)


@query("P10_prepare", "SELECT nullif(segment, '') AS segment, nullif(name, '') AS name, 1 AS is_migrated FROM snapshot_old", "snapshot_old")
def _(t: Tables) -> DataFrame:
    return schema.prepare_record(t.snapshot_old.select("id", "segment", "name"))


@query("P11_map_fields", "SELECT coalesce(nullif(full_name, ''), 'N/A') AS \"Name\", lead_source AS \"LeadSource\", 'N/A' AS \"Company\" FROM leads_src", "leads_src")
def _(t: Tables) -> DataFrame:
    return schema.map_fields(t.leads_src, {"full_name": "Name", "lead_source": "LeadSource", "company": "Company"}, {"Name": "N/A", "Company": "N/A"})


@query("P12_layout", "SELECT lead_id AS \"leadId\", NULL::VARCHAR AS email, 1::INT AS \"isActive\", NULL::BIGINT AS \"formId\" FROM leads_src", "leads_src")
def _(t: Tables) -> DataFrame:
    return schema.to_layout(t.leads_src, [("leadId", "string", F.col("lead_id")), ("email", "string", None), ("isActive", "int", F.lit(1)), ("formId", "bigint", None)])


@query("P13_computed", "SELECT device_id, event_time::TIMESTAMP AS event_time, motor_current * panel_voltage AS power FROM telemetry_direct", "telemetry_direct")
def _(t: Tables) -> DataFrame:
    return t.telemetry_direct.select("device_id", F.col("event_time").cast("timestamp_ntz").alias("event_time"), (F.col("motor_current") * F.col("panel_voltage")).alias("power"))


@query("P14_map_lookup", "SELECT name, CASE kind WHEN 'Customer' THEN 'blue' WHEN 'Agro-Dealer' THEN 'green' ELSE 'grey' END AS colour FROM geo_points", "geo_points")
def _(t: Tables) -> DataFrame:
    return t.geo_points.select("name", codes.mapped(F.col("kind"), {"Customer": "blue", "Agro-Dealer": "green"}, "grey").alias("colour"))


_ACTIONS = "SELECT account_ref AS \"accountRef\", CASE WHEN account_id % 2 = 0 THEN 'jsf' ELSE 'dispatch' END AS action, strftime(updated_at, '%Y-%m-%d') AS \"actionDate\", 'J' || account_id AS \"jsfId\" FROM accounts"


@query("P15_action_payload", f"""SELECT '{{"accountRef":"' || "accountRef" || '","action":"' || action || '","actionDate":"' || "actionDate" || '"' || CASE WHEN action = 'jsf' THEN ',"jsfId":"' || "jsfId" || '"' ELSE '' END || '}}' AS payload FROM ({_ACTIONS})""", "accounts")
def _(t: Tables) -> DataFrame:
    k = F.col("account_id")
    a = t.accounts.select(F.col("account_ref").alias("accountRef"), F.when(k % 2 == 0, "jsf").otherwise("dispatch").alias("action"), F.date_format("updated_at", "yyyy-MM-dd").alias("actionDate"), F.concat(F.lit("J"), k.cast("string")).alias("jsfId"))
    return a.select(schema.action_payload("accountRef", "action", "actionDate", {"jsf": ["jsfId"]}).alias("payload"))


@query("P16_nested_payload", """SELECT '{"account_ref":"' || account_ref || '","selectedBank":{"id":' || customer_id || '}}' AS payload FROM accounts""", "accounts")
def _(t: Tables) -> DataFrame:
    return t.accounts.select(schema.nested_payload(["account_ref"], {"selectedBank": "customer_id"}).alias("payload"))


@query("F1_required", "SELECT * FROM persona_src WHERE water_source IS NOT NULL AND balance IS NOT NULL", "persona_src")
def _(t: Tables) -> DataFrame:
    return rules.with_required(t.persona_src, ["water_source", "balance"])


@query("F2_not_blank", "SELECT lead_id, full_name FROM leads_src WHERE trim(full_name) <> ''", "leads_src")
def _(t: Tables) -> DataFrame:
    return rules.not_blank(t.leads_src, "full_name").select("lead_id", "full_name")


@query("F3_time_and_measure", "SELECT device_id, motor_current FROM telemetry_direct WHERE event_time BETWEEN TIMESTAMP '2024-01-02' AND TIMESTAMP '2024-01-20' AND motor_current > 0", "telemetry_direct")
def _(t: Tables) -> DataFrame:
    first, last = (F.lit(x).cast("timestamp_ntz") for x in ("2024-01-02 00:00:00", "2024-01-20 00:00:00"))
    return rules.in_time(t.telemetry_direct, "event_time", first, last, "motor_current").select("device_id", "motor_current")


@query("F4_one_of", "SELECT account_id, status FROM accounts WHERE status IN ('Active', 'Arrears')", "accounts")
def _(t: Tables) -> DataFrame:
    return rules.one_of(t.accounts, "status", ["Active", "Arrears"]).select("account_id", "status")


@query("F5_in_month", "SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1995 AND month(o_orderdate) = 3")
def _(t: Tables) -> DataFrame:
    return rules.in_month(t.orders, "o_orderdate", 1995, 3).select("o_orderkey")


@query("F6_valid_places", "SELECT name, lat, lon FROM (SELECT name, try_cast(lat_raw AS DOUBLE) AS lat, try_cast(lon_raw AS DOUBLE) AS lon FROM geo_points) WHERE lat BETWEEN -5 AND 5 AND lon BETWEEN 28 AND 42 AND NOT (lat = 0 AND lon = 0)", "geo_points")
def _(t: Tables) -> DataFrame:
    from gridmill.operators.geo import normal_points

    return normal_points(t.geo_points, "lat_raw", "lon_raw", "name")


@query("F7_selected", "SELECT name FROM geo_points WHERE kind IN ('Customer')", "geo_points")
def _(t: Tables) -> DataFrame:
    return rules.selected(rules.selected(t.geo_points, "kind", ["All"]), "kind", ["Customer"]).select("name")


_LEAD_REASON = """CASE WHEN coalesce(id_number, '') = '' THEN 'Missing required field: id_number' WHEN coalesce(purchase_date, '') = '' THEN 'Missing required field: purchase_date'
 WHEN status NOT IN ('New', 'Converted') THEN 'Invalid status: ' || status END"""


@query("F8_first_reason", f"SELECT lead_id, {_LEAD_REASON} AS failure_reason FROM leads_src", "leads_src")
def _(t: Tables) -> DataFrame:
    leads = t.leads_src
    return leads.select("lead_id", rules.first_reason(leads, ["id_number", "purchase_date"], {"status": ["New", "Converted"]}).alias("failure_reason"))


@query("F9_region_rule", """SELECT id, CASE WHEN coalesce(segment, '') = '' THEN 'Invalid segment: None' WHEN region_id = 3 AND amount < 0 THEN 'amount is required for region 3' END AS failure_reason FROM snapshot_old""", "snapshot_old")
def _(t: Tables) -> DataFrame:
    rows = t.snapshot_old
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    check = ((F.col("region_id") == 3) & (F.col("amount") < 0), F.lit("amount is required for region 3"))
    return rows.select("id", rules.first_reason(rows, [], {"segment": segments}, [check], always=("segment",)).alias("failure_reason"))


@query("F10_all_reasons", """SELECT lead_id, nullif(concat_ws(', ', CASE WHEN id_number IS NULL THEN 'missing id' END, CASE WHEN full_name IS NULL THEN 'missing name' END, CASE WHEN purchase_date IS NULL THEN 'missing date' END), '') AS reasons FROM leads_src""", "leads_src")
def _(t: Tables) -> DataFrame:
    tests = [(F.col("id_number").isNull(), F.lit("missing id")), (F.col("full_name").isNull(), F.lit("missing name")), (F.col("purchase_date").isNull(), F.lit("missing date"))]
    return t.leads_src.select("lead_id", rules.all_reasons(tests).alias("reasons"))


@query("F11_after_projection", "SELECT lead_id, 'sf-' || id_number AS ref FROM leads_src WHERE id_number IS NOT NULL", "leads_src")
def _(t: Tables) -> DataFrame:
    return t.leads_src.select("lead_id", text.prefixed("sf-", F.col("id_number")).alias("ref")).where("ref IS NOT NULL")


@query("F12_newer_than", "SELECT id FROM snapshot_new WHERE updated_at > TIMESTAMP '2024-01-15'", "snapshot_new")
def _(t: Tables) -> DataFrame:
    return rules.newer_than(t.snapshot_new, "updated_at", F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).select("id")


@query("F13_clean_ids", "SELECT trim(id_number) AS lead_id FROM leads_src WHERE id_number IS NOT NULL AND lower(trim(id_number)) NOT IN ('', 'nan')", "leads_src")
def _(t: Tables) -> DataFrame:
    return rules.clean_ids(t.leads_src.select(F.col("id_number").alias("LeadId")))


@query("T1_descending_time", "SELECT lead_id, updated_at::TIMESTAMP AS updated_at FROM leads_src ORDER BY updated_at DESC", "leads_src")
def _(t: Tables) -> DataFrame:
    return t.leads_src.select("lead_id", F.col("updated_at").cast("timestamp_ntz").alias("updated_at")).orderBy(F.desc("updated_at"))


@query("T2_limit_by_key", "SELECT lead_id FROM leads_src ORDER BY lead_id LIMIT 50", "leads_src")
def _(t: Tables) -> DataFrame:
    return t.leads_src.select("lead_id").orderBy("lead_id").limit(50)


@query("T3_top_per_group", "SELECT c_mktsegment, c_custkey FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS n FROM customer) WHERE n <= 5")
def _(t: Tables) -> DataFrame:
    from gridmill.operators.dedupe import top_per_key

    return top_per_key(t.customer, ["c_mktsegment"], [F.desc("c_acctbal"), F.col("c_custkey")], 5).select("c_mktsegment", "c_custkey")


@query("T4_multi_key_sort", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment ORDER BY n DESC, c_mktsegment")
def _(t: Tables) -> DataFrame:
    return t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "c_mktsegment")


@query("T5_sorted_distinct", "SELECT DISTINCT kind FROM geo_points ORDER BY kind", "geo_points")
def _(t: Tables) -> DataFrame:
    return t.geo_points.select("kind").distinct().orderBy("kind")


@query("U1_tagged_union", "SELECT device_id, motor_current AS amps, 'Direct' AS source FROM telemetry_direct WHERE motor_current > 0 UNION ALL SELECT device_id, output_current, 'Battery' FROM telemetry_battery WHERE output_current > 0", "telemetry_direct", "telemetry_battery")
def _(t: Tables) -> DataFrame:
    d = t.telemetry_direct.where("motor_current > 0").select("device_id", F.col("motor_current").alias("amps"), F.lit("Direct").alias("source"))
    return d.unionByName(t.telemetry_battery.where("output_current > 0").select("device_id", F.col("output_current").alias("amps"), F.lit("Battery").alias("source")))


@query("U2_three_sets", "SELECT c_name AS name, 'c' AS kind FROM customer UNION ALL SELECT s_name, 's' FROM supplier UNION ALL SELECT n_name, 'n' FROM nation")
def _(t: Tables) -> DataFrame:
    one = lambda df, c, k: df.select(F.col(c).alias("name"), F.lit(k).alias("kind"))
    return one(t.customer, "c_name", "c").unionByName(one(t.supplier, "s_name", "s")).unionByName(one(t.nation, "n_name", "n"))


@query("U3_missing_columns", "SELECT c_custkey AS k, c_name AS name, NULL::DOUBLE AS balance FROM customer UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier")
def _(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")).unionByName(t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("balance")), allowMissingColumns=True)


@query("U4_outcome_union", "SELECT lead_id, 'failed' AS outcome FROM leads_src WHERE id_number IS NULL UNION ALL SELECT lead_id, 'success' FROM leads_src WHERE id_number IS NOT NULL", "leads_src")
def _(t: Tables) -> DataFrame:
    leads = t.leads_src
    return leads.where("id_number IS NULL").select("lead_id", F.lit("failed").alias("outcome")).unionByName(leads.where("id_number IS NOT NULL").select("lead_id", F.lit("success").alias("outcome")))


@query("U5_distinct", "SELECT DISTINCT created_by_id, status FROM leads_src", "leads_src")
def _(t: Tables) -> DataFrame:
    return t.leads_src.select("created_by_id", "status").distinct()


@query("U6_key_sets", "SELECT id, 'source' AS side FROM snapshot_old WHERE id NOT IN (SELECT id FROM snapshot_new) UNION ALL SELECT id, 'target' FROM snapshot_new WHERE id NOT IN (SELECT id FROM snapshot_old) UNION ALL SELECT id, 'both' FROM snapshot_old WHERE id IN (SELECT id FROM snapshot_new)", "snapshot_old", "snapshot_new")
def _(t: Tables) -> DataFrame:
    a, b = t.snapshot_old.select("id"), t.snapshot_new.select("id")
    tag = lambda df, x: df.withColumn("side", F.lit(x))
    return tag(a.join(b, "id", "left_anti"), "source").unionByName(tag(b.join(a, "id", "left_anti"), "target")).unionByName(tag(a.join(b, "id", "left_semi"), "both"))


@query("U7_column_sets", "SELECT * FROM (VALUES ('orders', 'o_comment_x', 'missing_in_source'), ('orders', 'o_orderkey', 'match')) v(table_name, column_name, status) WHERE (SELECT count(*) FROM orders) >= 0")
def _(t: Tables) -> DataFrame:
    from gridmill.operators.diff import schema_diff, schema_rows

    target = schema_rows(t.orders.withColumn("o_comment_x", F.lit("")).select("o_orderkey", "o_comment_x"), "orders_v2")
    found = schema_diff(schema_rows(t.orders.select("o_orderkey"), "orders"), target, renamed={"orders": "orders_v2"})
    return found.select(F.lit("orders").alias("table_name"), "column_name", "status")
