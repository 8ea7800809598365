"""Queries of composed jobs: reconciliation, migration, workflows, telemetry, segments, surveys, places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridmill.operators import diff, geo, sampling, segment, sweep
from gridmill.plans import migration, telemetry, transform, workflow
from gridmill.plans.fixtures import Tables
from gridmill.plans.queries_tables import _GEO, CRM, MASHUP, _customers_dealers, _ntz, mashed
from gridmill.plans.registry import query

_SNAPSHOTS = ("snapshot_old", "snapshot_new")
_DIFFERS = "(o.segment IS DISTINCT FROM n.segment OR o.amount IS DISTINCT FROM n.amount OR o.updated_at IS DISTINCT FROM n.updated_at)"


def _slim(df: DataFrame) -> DataFrame:
    return df.select("id", "segment", "amount")


@query("D1_reconcile_differing", "SELECT id, 'segment' AS \"column\", o.segment AS source_value, n.segment AS target_value FROM snapshot_old o JOIN snapshot_new n USING (id) WHERE o.segment IS DISTINCT FROM n.segment UNION ALL SELECT id, 'region_id', o.region_id::VARCHAR, n.region_id::VARCHAR FROM snapshot_old o JOIN snapshot_new n USING (id) WHERE o.region_id IS DISTINCT FROM n.region_id", *_SNAPSHOTS)
def _(t: Tables) -> DataFrame:
    columns = ["id", "segment", "region_id"]
    return diff.differing_long(t.snapshot_old.select(*columns), t.snapshot_new.select(*columns), ["id"])


@query("D1_reconcile_wide", "SELECT id, o.segment AS segment_source, n.segment AS segment_target, o.amount AS amount_source, n.amount AS amount_target FROM snapshot_old o JOIN snapshot_new n USING (id) WHERE o.segment IS DISTINCT FROM n.segment OR o.amount IS DISTINCT FROM n.amount", *_SNAPSHOTS)
def _(t: Tables) -> DataFrame:
    return diff.differing(_slim(t.snapshot_old), _slim(t.snapshot_new), diff.choose_keys(t.snapshot_old, t.snapshot_new))


# What the catalogs of these tables hold: one column's type differs, and each half of the split table has its share.
_D2 = ", ".join(
    [f"('orders', 'o_{c}', '{k}', '{k}', 'match')" for c, k in (("orderkey", "bigint"), ("custkey", "bigint"), ("orderstatus", "string"), ("totalprice", "double"), ("orderdate", "timestamp_ntz"), ("orderpriority", "string"))]
    + [f"('snapshot_v2', '{c}', '{k}', '{k}', 'match')" for c, k in (("id", "bigint"), ("name", "string"), ("segment", "string"), ("amount", "double"), ("updated_at", "timestamp"))]
    + ["('snapshot_v2', 'region_id', 'int', 'string', 'type_mismatch')"]
)


@query("D2_schema_reconcile", f"SELECT * FROM (VALUES {_D2}) v(table_name, column_name, source_type, target_type, status)")
def _(t: Tables) -> DataFrame:
    a = diff.schema_rows(t.snapshot_old, "snapshot").unionByName(diff.schema_rows(t.orders, "orders"))
    b = diff.schema_rows(t.snapshot_new.withColumn("region_id", F.col("region_id").cast("string")), "snapshot_v2").unionByName(diff.schema_rows(t.orders.select("o_orderkey", "o_custkey"), "orders_a")).unionByName(diff.schema_rows(t.orders.drop("o_custkey"), "orders_b"))
    return diff.schema_diff(a, b, renamed={"snapshot": "snapshot_v2"}, split={"orders": ["orders_a", "orders_b"]})


@query("D4_deltas", """SELECT n.id, CASE WHEN o.id IS NULL OR n.updated_at <= o.updated_at THEN 'skipped' WHEN n.segment IS DISTINCT FROM o.segment OR n.amount IS DISTINCT FROM o.amount THEN 'updated' ELSE 'no_change' END AS outcome,
 CASE WHEN o.id IS NULL OR n.updated_at <= o.updated_at THEN 0 ELSE (n.segment IS DISTINCT FROM o.segment)::INT + (n.amount IS DISTINCT FROM o.amount)::INT END AS n_changes FROM snapshot_new n LEFT JOIN snapshot_old o USING (id)""", *_SNAPSHOTS)
def _(t: Tables) -> DataFrame:
    return diff.deltas(t.snapshot_new, t.snapshot_old, "id", "updated_at").select("id", "outcome", F.size("changes").alias("n_changes"))


@query("D5_apply_deltas", f"SELECT o.id, CASE WHEN u THEN n.segment ELSE o.segment END AS segment, CASE WHEN u THEN n.amount ELSE o.amount END AS amount, u::INT AS is_migrated FROM (SELECT o.*, coalesce(n.updated_at > o.updated_at AND (o.segment IS DISTINCT FROM n.segment OR o.amount IS DISTINCT FROM n.amount), false) AS u FROM snapshot_old o LEFT JOIN snapshot_new n USING (id)) o LEFT JOIN snapshot_new n USING (id)", *_SNAPSHOTS)
def _(t: Tables) -> DataFrame:
    found = diff.deltas(t.snapshot_new, t.snapshot_old, "id", "updated_at")
    return diff.apply_deltas(t.snapshot_old, found, "id").select("id", "segment", "amount", "is_migrated")


_STAGED = """st AS (SELECT lead_id AS leadId, full_name AS firstName, phone_raw AS mobilePhone, CASE status WHEN 'New' THEN 'NEW' WHEN 'Converted' THEN 'CONVERTED' ELSE 'Qualified' END AS status, id_number AS leadSourceId FROM leads_src),
ld AS (SELECT leadId, mobilePhone FROM st WHERE leadId LIKE '%7'),
c1 AS (SELECT *, CASE WHEN coalesce(firstName, '') = '' THEN 'Missing required field: firstName' WHEN coalesce(mobilePhone, '') = '' THEN 'Missing required field: mobilePhone' WHEN coalesce(leadSourceId, '') = '' THEN 'Missing required field: leadSourceId' WHEN status = 'Qualified' THEN 'Invalid status: Qualified' END AS bad FROM st),
c2 AS (SELECT *, CASE WHEN bad IS NULL THEN row_number() OVER (PARTITION BY mobilePhone, bad IS NULL ORDER BY leadId) END AS n FROM c1),
c3 AS (SELECT c2.*, EXISTS (SELECT 1 FROM ld WHERE ld.mobilePhone = c2.mobilePhone) AS has_phone, EXISTS (SELECT 1 FROM ld WHERE ld.leadId = c2.leadId) AS has_id FROM c2)"""


@query("W4_batch_first", """WITH a AS (SELECT *, row_number() OVER (PARTITION BY lead_id ORDER BY modified_at, seq, part_ref) > 1 AS again FROM survey_src), v AS (SELECT *, NOT again AND kin_phone IS NOT NULL AND relation IS NOT NULL AS valid FROM a)
SELECT lead_id, seq, part_ref, CASE WHEN again THEN 'duplicate' WHEN NOT valid THEN 'invalid' WHEN row_number() OVER (PARTITION BY kin_phone, valid ORDER BY modified_at, lead_id, seq, part_ref) > 1 THEN 'duplicate phone' ELSE 'first' END AS outcome FROM v""", "survey_src")
def _(t: Tables) -> DataFrame:
    batch = t.survey_src.withColumn("position", F.struct("modified_at", "lead_id", "seq", "part_ref"))
    reason = F.when(F.col("kin_phone").isNull() | F.col("relation").isNull(), "Missing required field")
    found = migration.first_valid_first(batch, "lead_id", reason, "kin_phone", "position")
    outcome = F.when(F.col("_again"), "duplicate").when(F.col("_invalid").isNotNull(), "invalid").when(F.col("_second_again"), "duplicate phone").otherwise("first")
    return found.select("lead_id", "seq", "part_ref", outcome.alias("outcome"))


D6_SQL = f"""WITH {_STAGED} SELECT leadId, CASE WHEN bad IS NOT NULL THEN 'invalid' WHEN n > 1 OR has_phone OR has_id THEN 'duplicate' ELSE 'inserted' END AS outcome,
 CASE WHEN bad IS NOT NULL THEN 'Validation failed: ' || bad WHEN n > 1 THEN 'Duplicate mobilePhone within batch: ' || mobilePhone WHEN has_phone THEN 'Duplicate mobilePhone: ' || mobilePhone WHEN has_id THEN 'Duplicate leadId' END AS failure_reason FROM c3"""


def staged_leads(t: Tables) -> DataFrame:
    s = F.col("status")
    return t.leads_src.select(
        F.col("lead_id").alias("leadId"), F.col("full_name").alias("firstName"), F.col("phone_raw").alias("mobilePhone"), F.lit(1).alias("companyRegionId"), F.col("created_at").alias("createdAt"), F.col("updated_at").alias("updatedAt"), F.col("id_number").alias("leadSourceId"),
        F.lit("CASH").alias("paymentMethod"), F.when(s == "New", "NEW").when(s == "Converted", "CONVERTED").otherwise("Qualified").alias("status"), F.lit("CONVERTED").alias("leadStatus"), F.lit("NOW").alias("purchaseDate"), F.lit("INDIVIDUAL").alias("entityType"),
    )


@query("D6_migrate_leads", D6_SQL, "leads_src")
def _(t: Tables) -> DataFrame:
    staged = staged_leads(t)
    loaded = staged.where("leadId LIKE '%7'").select("leadId", "mobilePhone")
    return migration.migrate_leads(staged, loaded, "leadId").select("leadId", "outcome", "failure_reason")


@query("D7_migrate_kyc", """WITH k AS (SELECT 'sf-' || json_extract_string(kyc_json, '$.SmileJobID') AS externalRefId, lead_id AS leadId, id_number AS idNumber, json_extract_string(kyc_json, '$.DOB') AS dob FROM leads_src WHERE kyc_json IS NOT NULL),
l AS (SELECT * FROM k WHERE leadId LIKE '%4'),
c AS (SELECT *, CASE WHEN coalesce(idNumber, '') = '' THEN 'Missing required field: idNumber' WHEN coalesce(dob, '') = '' THEN 'Missing required field: dob' END AS bad, EXISTS (SELECT 1 FROM l WHERE l.externalRefId = k.externalRefId) AS has_ref, EXISTS (SELECT 1 FROM l WHERE l.leadId = k.leadId AND l.idNumber = k.idNumber) AS has_pair FROM k)
SELECT externalRefId, CASE WHEN bad IS NOT NULL THEN 'invalid' WHEN has_ref OR has_pair THEN 'duplicate' WHEN leadId LIKE '%1' THEN 'fk_failed' ELSE 'inserted' END AS outcome,
 CASE WHEN bad IS NOT NULL THEN 'Validation failed: ' || bad WHEN has_pair THEN 'Duplicate leadId+idNumber' WHEN has_ref THEN 'Duplicate externalRefId' WHEN leadId LIKE '%1' THEN 'Missing leadId FK: ' || leadId END AS failure_reason FROM c""", "leads_src")
def _(t: Tables) -> DataFrame:
    j = lambda p: F.get_json_object("kyc_json", f"$.{p}")
    staged = t.leads_src.where("kyc_json IS NOT NULL").select(
        F.concat(F.lit("sf-"), j("SmileJobID")).alias("externalRefId"), F.col("lead_id").alias("leadId"), F.col("id_number").alias("idNumber"), j("DOB").alias("dob"), F.lit("SUCCESS").alias("status"), F.lit("PASSPORT").alias("documentType"), F.lit(1).alias("companyRegionId"), F.lit(None).cast("string").alias("serialNumber")
    )
    leads = t.leads_src.select(F.col("lead_id").alias("leadId")).where("leadId NOT LIKE '%1'")
    return migration.migrate_kyc(staged, staged.where("leadId LIKE '%4'"), leads, "leadId").select("externalRefId", "outcome", "failure_reason")


@query("D8_migrate_kin", """WITH l AS (SELECT lead_id, kin_phone FROM survey_src WHERE part_ref % 50 = 0), c AS (SELECT s.*, EXISTS (SELECT 1 FROM l WHERE l.lead_id = s.lead_id AND l.kin_phone = s.kin_phone) AS has_pair FROM survey_src s)
SELECT lead_id AS leadId, seq, part_ref, CASE WHEN has_pair THEN 'duplicate' WHEN lead_id LIKE '%3' THEN 'fk_failed' ELSE 'inserted' END AS outcome FROM c""", "survey_src")
def _(t: Tables) -> DataFrame:
    staged = t.survey_src.select(F.col("lead_id").alias("leadId"), F.col("kin_phone").alias("phoneNumber"), "seq", "part_ref")
    leads = t.leads_src.select(F.col("lead_id").alias("leadId")).where("leadId NOT LIKE '%3'")
    return migration.migrate_kin(staged, staged.where("part_ref % 50 = 0"), leads).select("leadId", "seq", "part_ref", "outcome")


@query("D9_leads_layout", f"""WITH {MASHUP} SELECT lead_id AS "leadId", coalesce(first_name, name) AS "firstName", last_name AS "lastName", phone AS "mobilePhone", id_number AS "idNumber", 1::INT AS "companyRegionId", converted_at AS "leadConvertedDate", coalesce(payment_method, 'CASH') AS "paymentMethod",
 CASE WHEN purchase_date = 'Now' THEN 'NOW' ELSE 'LATER' END AS "purchaseDate", CASE status WHEN 'Converted' THEN 'CONVERTED' WHEN 'Qualified' THEN 'QUALIFIED' ELSE 'NEW' END AS status, CASE is_converted WHEN 0 THEN 'LEAD_CREATION' WHEN 1 THEN 'CONVERTED' END AS "leadStatus", CASE category WHEN 'Hot' THEN 'HOT' WHEN 'Cold' THEN 'COLD' ELSE 'WARM' END AS "leadCategory",
 referral_id AS "referralId", product AS "productOfInterest", language AS "preferredLanguage", agent AS "agentId", agent AS "createdById", modified_by AS "lastUpdatedById", lead_id AS "throughPartnerLeadId", (lead_source = 'Reshuffled Leads')::INT AS "isReshuffleLead", created_at AS "createdAt", updated_at AS "updatedAt", phone AS "phoneNumber", name, tax_pin AS "kraPinNumber", lead_source AS source,
 customer_id AS "leadAmtCustomerId", 'INDIVIDUAL' AS "entityType", customer_type AS "customerTypeId", channel_id::BIGINT AS "leadChannelId", CASE lead_source WHEN 'Engineer Referral' THEN 'EMPLOYEE' WHEN 'iPOs' THEN 'IPOS' WHEN 'Refer & Earn' THEN 'CUSTOMER' END AS "referralType", CASE WHEN lead_source = 'Engineer Referral' THEN employee_id END AS "employeeReferralId", 1::INT AS "isActive", source_id::BIGINT AS "leadSourceId", updated_at AS "lastModifiedAt", modified_by AS "lastModifiedBy", 1::INT AS is_migrated,
 NULL::VARCHAR AS "middleName", NULL::VARCHAR AS "email", NULL::VARCHAR AS "alternatePhoneNumber", NULL::VARCHAR AS "companyName", NULL::VARCHAR AS "paymentTerms", NULL::VARCHAR AS "formVersion",
 NULL::BIGINT AS "sundeskUserId", NULL::BIGINT AS "agent_provider_id", NULL::BIGINT AS "kycId", NULL::BIGINT AS "tdhId", NULL::BIGINT AS "deletedBy", NULL::BIGINT AS "formId", NULL::BIGINT AS "archivedBy", NULL::TIMESTAMP AS "deletedAt", NULL::TIMESTAMP AS "archivedAt" FROM m""", *CRM)
def _(t: Tables) -> DataFrame:
    return transform.leads_layout(mashed(t))


@query("D9_kyc_layout", f"""WITH {MASHUP}, k AS (SELECT m.*, json_extract_string(kyc_json, '$.DOB') AS born, json_extract_string(kyc_json, '$.SmileJobID') AS job FROM m)
 SELECT 'sf-' || job AS "externalRefId", lead_id AS "leadId", coalesce(json_extract_string(kyc_json, '$.IDNumber'), id_number) AS "idNumber", CASE WHEN born IN ('null', '', 'Not Available') OR born IS NULL THEN date_of_birth ELSE born END AS dob, CASE json_extract_string(kyc_json, '$._status_') WHEN 'COMPLETED' THEN 'SUCCESS' WHEN 'FAILED' THEN 'FAILED' ELSE 'PENDING' END AS status, 1::INT AS "companyRegionId", kyc_json AS meta,
 agent AS "createdBy", CASE WHEN modified_by = 1007 THEN agent ELSE modified_by END AS "updatedBy", created_at AS "createdAt", updated_at AS "updatedAt", json_extract_string(kyc_json, '$.IDType') AS "documentType", job AS "smileJobId", json_extract_string(kyc_json, '$.ResultCode') AS "resultCode", json_extract_string(kyc_json, '$.ResultType') AS source, gender, 1::INT AS "isActive", updated_at AS "lastModifiedAt", modified_by AS "lastModifiedBy", 1::INT AS is_migrated,
 NULL::VARCHAR AS "serialNumber", NULL::VARCHAR AS "description", NULL::VARCHAR AS "documentType_temp", NULL::VARCHAR AS "callbackJsonBlob", NULL::VARCHAR AS "resultText", NULL::VARCHAR AS "actions", NULL::VARCHAR AS "description2", NULL::VARCHAR AS "formVersion",
 NULL::BIGINT AS "formId", NULL::BIGINT AS "deletedBy", NULL::BIGINT AS "archivedBy", NULL::TIMESTAMP AS "deletedAt", NULL::TIMESTAMP AS "archivedAt"
 FROM k WHERE job IS NOT NULL AND coalesce(json_extract_string(kyc_json, '$.IDNumber'), id_number) IS NOT NULL AND (date_of_birth IS NOT NULL OR born NOT IN ('null', '', 'Not Available'))""", *CRM)
def _(t: Tables) -> DataFrame:
    return transform.kyc_layout(mashed(t), invalid=(1007,))


@query("D9_kin_layout", f"""WITH {MASHUP} SELECT 'SALESFORCE' AS "sourceSystemId", lead_id AS "leadId", coalesce(kin_name, kin_surname, 'Not Specified') AS "firstName", coalesce(kin_surname, kin_name, 'Not Specified') AS "lastName", kin_phone AS "phoneNumber", CASE WHEN relation IS NULL OR relation = 'Parent' THEN 'Other' WHEN relation IN ('Wife', 'Husband') THEN 'Spouse' ELSE relation END AS relationship, 'NEXT_OF_KIN' AS type, 1::INT AS "isActive", kin_created_at AS "createdAt",
 CASE WHEN kin_created_by = 1007 THEN 895 ELSE coalesce(kin_created_by, kin_modified_by, 895) END AS "createdBy", kin_modified_at AS "updatedAt", kin_modified_by AS "updatedBy", 1::INT AS is_migrated, NULL::VARCHAR AS "sourceSystem", NULL::VARCHAR AS "alternativePhoneNumber", NULL::VARCHAR AS "gender", NULL::VARCHAR AS "id_number_c" FROM m WHERE kin_phone IS NOT NULL""", *CRM)
def _(t: Tables) -> DataFrame:
    return transform.kin_layout(mashed(t), invalid=(1007,))


@query("D10_delete_audit", """SELECT 'snapshot' AS table_name, id::VARCHAR AS record_id, '{"id":' || id || ',"segment":' || CASE WHEN segment IS NULL THEN 'null' ELSE '"' || segment || '"' END || '}' AS deleted_data FROM snapshot_old WHERE id NOT IN (SELECT id FROM snapshot_new)""", *_SNAPSHOTS)
def _(t: Tables) -> DataFrame:
    return diff.deleted_rows(t.snapshot_old.select("id", "segment"), t.snapshot_new, "id", "snapshot", _ntz("2024-06-01 00:00:00")).select("table_name", "record_id", "deleted_data")


@query("D10_audit_read_back", "SELECT id::VARCHAR AS record_id, name FROM snapshot_old WHERE id NOT IN (SELECT id FROM snapshot_new)", *_SNAPSHOTS)
def _(t: Tables) -> DataFrame:
    audit = diff.deleted_rows(t.snapshot_old.select("id", "name"), t.snapshot_new, "id", "snapshot", _ntz("2024-06-01 00:00:00"))
    return audit.select("record_id", F.get_json_object("deleted_data", "$.name").alias("name"))


@query("D11_repossession_action", """WITH l AS (SELECT DISTINCT ON (account_id) account_id, status FROM repossessions ORDER BY account_id, created_at DESC, seq DESC, part_ref DESC)
SELECT a.account_id, l.status AS latest, CASE WHEN l.status IS NULL OR l.status IN ('PAID', 'CANCELLED') THEN 'create' WHEN l.status = 'NEW' THEN 'skip_new' ELSE 'skip_other' END AS action FROM accounts a LEFT JOIN l USING (account_id) WHERE lower(a.status) = 'arrears'""", "accounts", "repossessions")
def _(t: Tables) -> DataFrame:
    return workflow.repossession_action(t.accounts.where("lower(status) = 'arrears'"), t.repossessions, [F.desc("created_at"), F.desc("seq"), F.desc("part_ref")])


@query("D12_guarded_update", "SELECT account_id, CASE WHEN account_id % 3 = 0 AND lower(status) = 'arrears' THEN 'Pending Repossession' ELSE status END AS status, account_id % 3 = 0 AND lower(status) = 'arrears' AS updated FROM accounts", "accounts")
def _(t: Tables) -> DataFrame:
    a = t.accounts
    return workflow.guarded_update(a, a.where("account_id % 3 = 0")).select("account_id", "status", "updated")


@query("D13_reverse_tagging", "SELECT account_id, seq, part_ref, CASE WHEN account_id % 5 = 0 AND status IN ('NEW', 'IN_TRANSIT') THEN 'PAID' ELSE status END AS status, CASE WHEN account_id % 5 = 0 AND status IN ('NEW', 'IN_TRANSIT') THEN 0 ELSE 1 END AS is_active FROM repossessions", "repossessions")
def _(t: Tables) -> DataFrame:
    r = t.repossessions
    return workflow.reverse_tagging(r, r.where("account_id % 5 = 0")).select("account_id", "seq", "part_ref", "status", "is_active")


@query("D14_workflow_rows", """WITH p AS (SELECT customer_id, min(premises_id) AS premises_id FROM premises GROUP BY 1), x AS (SELECT account_id, a.customer_id, premises_id, CASE WHEN premises_id IS NULL THEN 'invalid' WHEN account_id % 4 = 0 THEN 'skipped' ELSE 'processed' END AS outcome FROM accounts a LEFT JOIN p USING (customer_id)),
y AS (SELECT *, CASE WHEN outcome = 'processed' THEN substr(sha256('assignment|' || account_id || '|' || premises_id), 1, 32) END AS assignment_id FROM x), z AS (SELECT *, substr(sha256('schedule|' || assignment_id), 1, 32) AS schedule_id FROM y)
SELECT *, substr(sha256('form|' || schedule_id), 1, 32) AS form_id FROM z""", "accounts", "premises")
def _(t: Tables) -> DataFrame:
    a = t.accounts
    return workflow.workflow_rows(a, t.premises, a.where("account_id % 4 = 0"))


@query("D15_assign_unless_equal", "SELECT id, 'MACHINERY' AS segment, CASE WHEN segment IS NOT DISTINCT FROM 'MACHINERY' THEN 'skipped' ELSE 'updated' END AS outcome FROM snapshot_old", "snapshot_old")
def _(t: Tables) -> DataFrame:
    return workflow.assign_unless_equal(t.snapshot_old.select("id", "segment"), {"segment": F.lit("MACHINERY")}).select("id", "segment", "outcome")


@query("D16_apply_actions", """WITH x AS (SELECT account_ref, CASE WHEN l_linenumber % 2 = 0 THEN 'jsf' ELSE 'dispatch' END AS action, l_shipdate AS d FROM lineitem JOIN accounts ON account_id = l_orderkey)
SELECT a.account_id, max(d) FILTER (WHERE action = 'jsf')::TIMESTAMP AS jsf_date, max(d) FILTER (WHERE action = 'dispatch')::TIMESTAMP AS dispatch_date FROM accounts a LEFT JOIN x USING (account_ref) GROUP BY a.account_id""", "accounts")
def _(t: Tables) -> DataFrame:
    a = t.accounts
    actions = t.lineitem.join(a, F.col("l_orderkey") == F.col("account_id")).select("account_ref", F.when(F.col("l_linenumber") % 2 == 0, "jsf").otherwise("dispatch").alias("action"), F.col("l_shipdate").alias("action_date"))
    return workflow.apply_actions(a, actions).select("account_id", F.col("jsf_date").cast("timestamp_ntz").alias("jsf_date"), F.col("dispatch_date").cast("timestamp_ntz").alias("dispatch_date"))


@query("D17_load_fuel", """WITH f AS (SELECT card_num, receipt_num, coalesce(try_strptime(date_raw || ' ' || hour_raw, '%d/%m/%Y %H:%M:%S'), TIMESTAMP '2024-06-01 00:00:00') AS done FROM fuel_raw)
SELECT DISTINCT card_num AS card_number, receipt_num AS receipt_number, done AS transaction_datetime FROM f WHERE NOT EXISTS (SELECT 1 FROM f g WHERE g.done < TIMESTAMP '1994-01-01' AND g.card_num = f.card_num AND g.receipt_num = f.receipt_num AND g.done = f.done)""", "fuel_raw")
def _(t: Tables) -> DataFrame:
    load = F.lit("2024-06-01 00:00:00").cast("timestamp")
    typed = migration.fuel_transactions(t.fuel_raw, load)
    return migration.load_fuel(t.fuel_raw, typed.where(F.col("transaction_datetime") < _ntz("1994-01-01 00:00:00")), load).select("card_number", "receipt_number", "transaction_datetime")


@query("D18_intake", """WITH d AS (SELECT *, regexp_replace(CASE WHEN regexp_matches(phone_raw, '[eE]') THEN NULL ELSE trim(phone_raw) END, '[^0-9+]', '', 'g') AS d FROM leads_src),
p AS (SELECT *, CASE WHEN phone_raw IS NULL OR phone_raw = '' THEN NULL WHEN starts_with(d, '2540') THEN '0' || substr(d, 5) WHEN starts_with(d, '+254') THEN '0' || substr(d, 5) WHEN regexp_matches(d, '^25[4526]') THEN '0' || substr(d, 4) WHEN regexp_matches(d, '^[71]') THEN '0' || d ELSE d END AS phone FROM d),
q AS (SELECT *, row_number() OVER (PARTITION BY coalesce(nullif(phone, ''), lead_id) ORDER BY lead_id) AS n FROM p)
SELECT lead_id, phone AS "MobilePhone", CASE WHEN n > 1 THEN 'duplicate' WHEN phone IS NULL OR length(phone) <> 10 OR NOT starts_with(phone, '0') THEN 'invalid' ELSE 'accepted' END AS outcome FROM q""", "leads_src")
def _(t: Tables) -> DataFrame:
    return migration.intake_leads(t.leads_src, "lead_id").select("lead_id", "MobilePhone", "outcome")


_ENERGY = """WITH u AS (SELECT device_id, event_time, motor_current * panel_voltage AS power, 'Direct' AS source FROM telemetry_direct WHERE event_time BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00' AND motor_current > 0
 UNION ALL SELECT device_id, event_time, output_current * output_voltage, 'Battery' FROM telemetry_battery WHERE event_time BETWEEN TIMESTAMP '2024-01-02 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00' AND output_current > 0),
a AS (SELECT device_id, cast(date_trunc('DAY', event_time) AS DATE) AS event_date, source, count(DISTINCT date_trunc('MINUTE', event_time)) AS minutes, avg(power) AS avg_power FROM u GROUP BY ALL)
SELECT event_date AS usage_date, device_id AS meter_id, source, minutes AS time_interval_minutes, round(avg_power * minutes / 60.0 / 1000.0, 3) AS energy_kwh FROM a WHERE device_id < 100"""


@query("D19_telemetry_energy", _ENERGY, "telemetry_direct", "telemetry_battery")
def _(t: Tables) -> DataFrame:
    return telemetry.energy(t.telemetry_direct, t.telemetry_battery, _ntz("2024-01-02 00:00:00"), _ntz("2024-01-20 00:00:00"), F.col("device_id") < 100)


@query("D22_dry_run", f"WITH {_STAGED} SELECT CASE WHEN bad IS NOT NULL THEN 'invalid' WHEN n > 1 OR has_phone OR has_id THEN 'duplicate' ELSE 'inserted' END AS outcome, count(*) AS n FROM c3 GROUP BY 1", "leads_src")
def _(t: Tables) -> DataFrame:
    from gridmill.operators.aggregates import outcome_counts
    from gridmill.plans.registry import QUERIES

    return outcome_counts(QUERIES["D6_migrate_leads"](t.spark, t.folder))


_TEXTS = ("main_source_of_income", "water_source", "farm_acreage", "income_level")


@query("M1_impute", """WITH a AS (SELECT median(balance) AS b, (SELECT water_source FROM persona_src WHERE water_source IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS w FROM persona_src)
SELECT customer_id, coalesce(water_source, w) AS water_source, coalesce(balance, b) AS balance FROM persona_src, a""", "persona_src")
def _(t: Tables) -> DataFrame:
    return segment.impute(t.persona_src.select("customer_id", "water_source", "balance"), "customer_id")


@query("M2_label_codes", "SELECT customer_id, water_source, CASE WHEN water_source IS NOT NULL THEN (dense_rank() OVER (PARTITION BY water_source IS NULL ORDER BY water_source) - 1)::INT END AS code FROM persona_src", "persona_src")
def _(t: Tables) -> DataFrame:
    return segment.label_codes(t.persona_src.select("customer_id", "water_source"), "water_source", "code").select("customer_id", "water_source", "code")


def _encoded(t: Tables) -> DataFrame:
    rows = segment.impute(t.persona_src, "customer_id")
    return segment.encoder(_TEXTS, ["balance"]).fit(rows).transform(rows).select("customer_id", *_TEXTS, "balance", "features")


def _components(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", F.col("c_nationkey").cast("double").alias("nation"), "c_acctbal")
    return segment.component_clusters(["nation", "c_acctbal"]).fit(rows).transform(rows)


@query("M3_encoded")
def _(t: Tables) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    return _encoded(t).select("customer_id", F.transform(vector_to_array("features"), lambda x: F.round(x, 6)).alias("features"))


_MODES = ", ".join(f"(SELECT {c} FROM persona_src WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS {c}" for c in _TEXTS)
_SLOTS = " UNION ALL ".join(f"SELECT customer_id, {i} AS c, coalesce(p.{c}, a.{c}) AS v FROM persona_src p, a" for i, c in enumerate(_TEXTS))


@query("M3_values", f"""WITH a AS (SELECT median(balance) AS balance, {_MODES} FROM persona_src), f AS ({_SLOTS}),
cats AS (SELECT c, v, row_number() OVER (PARTITION BY c ORDER BY v) - 1 AS code, count(*) OVER (PARTITION BY c) + 2 AS size FROM (SELECT DISTINCT c, v FROM f)),
sizes AS (SELECT c, size, sum(size) OVER (ORDER BY c) - size AS start FROM (SELECT DISTINCT c, size FROM cats)), slots AS (SELECT c, start, unnest(range(size)) AS s FROM sizes),
x AS (SELECT customer_id, start + s AS i, (code = s)::INT::DOUBLE AS x FROM f JOIN cats USING (c, v) JOIN slots USING (c) UNION ALL SELECT customer_id, (SELECT sum(size) FROM sizes), coalesce(p.balance, a.balance)::DOUBLE FROM persona_src p, a)
SELECT customer_id, i::BIGINT AS i, round(coalesce((x - avg(x) OVER o) / nullif(stddev_samp(x) OVER o, 0), 0), 6) + 0.0::DOUBLE AS value FROM x WINDOW o AS (PARTITION BY i)""", "persona_src")
def _(t: Tables) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    values = _encoded(t).select("customer_id", F.posexplode(vector_to_array("features")).alias("i", "value"))
    return values.select("customer_id", F.col("i").cast("long").alias("i"), (F.round("value", 6) + F.lit(0.0)).alias("value"))


@query("M4_component_clusters")
def _(t: Tables) -> DataFrame:
    return _components(t).select("c_custkey", "cluster")


# Two standardised columns have the components (z1 + z2) / sqrt(2) and (z1 - z2) / sqrt(2), the larger first; signs are free.
@query("M4_components", """WITH z AS (SELECT c_custkey, (c_nationkey - avg(c_nationkey) OVER ()) / stddev_samp(c_nationkey) OVER () AS a, (c_acctbal - avg(c_acctbal) OVER ()) / stddev_samp(c_acctbal) OVER () AS b, sign(corr(c_nationkey, c_acctbal) OVER ()) AS s FROM customer)
SELECT c_custkey, round(abs(a + s * b) / sqrt(2), 6) AS first, round(abs(a - s * b) / sqrt(2), 6) AS second FROM z""")
def _(t: Tables) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    values = _components(t).select("c_custkey", vector_to_array("features").alias("v"))
    return values.select("c_custkey", *[F.round(F.abs(F.col("v")[i]), 6).alias(name) for i, name in enumerate(("first", "second"))])


@query("M5_kmeans")
def _(t: Tables) -> DataFrame:
    rows = _encoded(t)
    return segment.best_kmeans(rows, 4).transform(rows).select("customer_id", "cluster")


@query("M6_elbow")
def _(t: Tables) -> DataFrame:
    return segment.elbow(_encoded(t), range(1, 10))


@query("M7_silhouette")
def _(t: Tables) -> DataFrame:
    return segment.silhouettes(_encoded(t), range(2, 8))


@query("M6_elbow_sweep")
def _(t: Tables) -> DataFrame:
    return sweep.elbow(_encoded(t), range(1, 10), range(42, 52))


@query("M7_silhouette_sweep")
def _(t: Tables) -> DataFrame:
    return sweep.silhouette_sweep(_encoded(t), range(2, 8), range(42, 52))


@query("M8_kept_components")
def _(t: Tables) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    rows = segment.components_for(_encoded(t)).select("customer_id", "components")
    found = segment.best_kmeans(rows, 5, features="components").transform(rows)
    return found.select("customer_id", F.transform(vector_to_array("components"), lambda x: F.round(x, 6)).alias("components"), "cluster")


@query("M9_spread_ranking", """WITH c AS (SELECT c_mktsegment AS g, avg(c_acctbal) AS a, avg(c_nationkey) AS b FROM customer GROUP BY 1), s AS (SELECT 'c_acctbal' AS feature, stddev_samp(a) AS spread FROM c UNION ALL SELECT 'c_nationkey', stddev_samp(b) FROM c)
SELECT feature, round(spread, 6) AS spread, rank() OVER (ORDER BY spread DESC)::INT AS "rank" FROM s""")
def _(t: Tables) -> DataFrame:
    return segment.spread_ranking(t.customer, "c_mktsegment", ["c_acctbal", "c_nationkey"]).withColumn("spread", F.round("spread", 6))


@query("M10_profile", "SELECT income_level, count(*) AS n, (SELECT water_source FROM persona_src q WHERE q.income_level = p.income_level AND water_source IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS water_source FROM persona_src p GROUP BY income_level", "persona_src")
def _(t: Tables) -> DataFrame:
    return segment.profile(t.persona_src, "income_level", ["water_source"])


@query("M11_weighted", "SELECT c_custkey, c_acctbal * 0.5 AS c_acctbal FROM customer")
def _(t: Tables) -> DataFrame:
    return segment.weighted(t.customer.select("c_custkey", "c_acctbal"), {"c_acctbal": 0.5})


@query("X1_survey_frame", """WITH a AS (SELECT customer_id, region, gender, units, 2025 - year(try_cast(dob_raw AS DATE)) AS age FROM survey_frame), b AS (SELECT * FROM a WHERE gender IS NOT NULL)
SELECT customer_id, region, gender, units, coalesce(age, median(age) OVER (PARTITION BY region))::DOUBLE AS age FROM b""", "survey_frame")
def _(t: Tables) -> DataFrame:
    return _frame(t)


def _frame(t: Tables) -> DataFrame:
    from gridmill.functions.numbers import age
    from gridmill.operators.aggregates import fill_with_group_median
    from gridmill.operators.rules import with_required

    rows = t.survey_frame.select("customer_id", "region", "gender", "units", age(F.col("dob_raw").try_cast("date"), F.lit("2025-01-01").cast("date")).alias("age"))
    return with_required(fill_with_group_median(with_required(rows, ["customer_id", "gender"]), "region", "age"), ["age"])


@query("X2_sales_breakdown", "SELECT region, gender, count(DISTINCT customer_id) AS customers, sum(units)::BIGINT AS units FROM survey_frame GROUP BY region, gender", "survey_frame")
def _(t: Tables) -> DataFrame:
    return t.survey_frame.groupBy("region", "gender").agg(F.count_distinct("customer_id").alias("customers"), F.sum("units").alias("units"))


@query("X2_units_by_region", "SELECT region, sum(units)::BIGINT AS units FROM survey_frame GROUP BY region", "survey_frame")
def _(t: Tables) -> DataFrame:
    return t.survey_frame.groupBy("region").agg(F.sum("units").alias("units"))


@query("X2_account_type_share", "SELECT account_type, count(*) AS sales, round(count(*) / sum(count(*)) OVER () * 100, 6) AS share FROM survey_frame GROUP BY account_type", "survey_frame")
def _(t: Tables) -> DataFrame:
    from gridmill.operators.aggregates import share_of_total

    rows = t.survey_frame.select("account_type", F.lit(1).alias("sales"))
    return share_of_total(rows, ["account_type"], "sales").withColumn("share", F.round("share", 6))


@query("X2_region_by_type", "SELECT region, account_type, count(DISTINCT customer_id) AS customers, sum(units)::BIGINT AS units FROM survey_frame GROUP BY region, account_type", "survey_frame")
def _(t: Tables) -> DataFrame:
    return t.survey_frame.groupBy("region", "account_type").agg(F.count_distinct("customer_id").alias("customers"), F.sum("units").alias("units"))


@query("X2_region_by_product", "SELECT region, product, count(DISTINCT customer_id) AS customers, sum(units)::BIGINT AS units FROM survey_frame GROUP BY region, product", "survey_frame")
def _(t: Tables) -> DataFrame:
    return t.survey_frame.groupBy("region", "product").agg(F.count_distinct("customer_id").alias("customers"), F.sum("units").alias("units"))


@query("X3_observed", "SELECT round(avg((units > 0)::INT), 6) AS proportion, count(DISTINCT customer_id) AS population FROM survey_frame", "survey_frame")
def _(t: Tables) -> DataFrame:
    from gridmill.functions.numbers import indicator

    return sampling.observed(t.survey_frame, indicator(F.col("units"), "positive"), "customer_id").withColumn("proportion", F.round("proportion", 6))


_STRATA = ["region", "district", "account_type", "product"]
def _allocation(columns: list[str], table: str, total: int) -> str:
    strata, ordered = ", ".join(columns), ", ".join(f"{c} NULLS FIRST" for c in columns)
    return f"""WITH s AS (SELECT {strata}, count(*) AS available, row_number() OVER (ORDER BY {ordered}) - 1 AS p FROM {table} GROUP BY {strata}),
r AS (SELECT *, round_even(available / sum(available) OVER () * {total}, 0)::BIGINT AS x, count(*) OVER () AS total FROM s), g AS (SELECT *, ({total} - sum(x) OVER ())::BIGINT AS gap FROM r),
f AS (SELECT *, greatest(x + sign(gap) * (abs(gap) // total + (p < abs(gap) % total)::INT), 1)::BIGINT AS y FROM g), e AS (SELECT *, greatest(sum(y) OVER () - {total}, 0) AS excess FROM f),
u AS (SELECT p, excess, unnest(range(2, y + 1)) AS h FROM e), k AS (SELECT p, count(*) AS taken FROM (SELECT *, row_number() OVER (ORDER BY h DESC, p) AS n FROM u) WHERE n <= excess GROUP BY p)
SELECT {strata}, available, (y - coalesce(taken, 0))::BIGINT AS allocated FROM e LEFT JOIN k USING (p)"""


def _drawn(columns: list[str], table: str, total: int, id_column: str, key: str) -> str:
    strata, same = ", ".join(columns), " AND ".join(f"f.{c} IS NOT DISTINCT FROM al.{c}" for c in columns)
    return f"""WITH al AS ({_allocation(columns, table, total)}), f AS (SELECT *, row_number() OVER (PARTITION BY {strata} ORDER BY md5({key} || ':42'), {key}) AS nth FROM {table})
SELECT f.* EXCLUDE (nth) FROM (SELECT {id_column}, {strata}, nth FROM f) f JOIN al ON {same} WHERE nth <= allocated"""


@query("X4_allocation", _allocation(_STRATA, "survey_frame", 400), "survey_frame")
def _(t: Tables) -> DataFrame:
    return sampling.allocate(t.survey_frame, _STRATA, 400)


@query("X5_draw", _drawn(_STRATA, "survey_frame", 400, "customer_id", "concat_ws('|', customer_id, sale_date::VARCHAR, units, product)"), "survey_frame")
def _(t: Tables) -> DataFrame:
    frame = t.survey_frame.withColumn("row_key", F.concat_ws("|", "customer_id", F.col("sale_date").cast("string"), "units", "product"))
    return sampling.draw(frame, sampling.allocate(frame, _STRATA, 400), _STRATA, "row_key").select("customer_id", *_STRATA)


@query("W7_stratified_sample", _drawn(["c_mktsegment"], "customer", 100, "c_custkey", "c_custkey::VARCHAR"))
def _(t: Tables) -> DataFrame:
    frame = t.customer.select("c_custkey", "c_mktsegment")
    return sampling.draw(frame, sampling.allocate(frame, ["c_mktsegment"], 100), ["c_mktsegment"], "c_custkey")


@query("W8_allocation", "SELECT c_mktsegment, count(*) AS available, round_even(count(*) / (SELECT count(*) FROM customer) * 0, 0)::BIGINT + 1 AS allocated FROM customer GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return sampling.allocate(t.customer, ["c_mktsegment"], 5)


@query("W8_nation_segments", _allocation(["c_nationkey", "c_mktsegment"], "customer", 500))
def _(t: Tables) -> DataFrame:
    return sampling.allocate(t.customer, ["c_nationkey", "c_mktsegment"], 500)


@query("G1_points", f"WITH {_GEO} SELECT name, kind, lat, lon FROM v", "geo_points")
def _(t: Tables) -> DataFrame:
    return geo.normal_points(t.geo_points, "lat_raw", "lon_raw", "name", "kind")


@query("G2_coverage", f"WITH {_GEO} SELECT centre, count(*) AS n_points FROM x GROUP BY centre", "geo_points")
def _(t: Tables) -> DataFrame:
    return geo.coverage(*_customers_dealers(t), 50.0, "name")


@query("G2_hulls")
def _(t: Tables) -> DataFrame:
    return geo.hulls(*_customers_dealers(t), 50.0, "name").select("centre", F.size("ring").alias("corners"))


# A point is a corner if all others of its centre lie within less than half a turn. Points on a line between two
# corners may count as corners or not by a last bit, so the rings are held by their areas.
@query("G2_hull_areas", f"""WITH {_GEO}, y AS (SELECT DISTINCT x.centre, v.lon, v.lat FROM x JOIN v ON v.name = x.point AND v.kind = 'Customer'),
a AS (SELECT p.centre, p.lon, p.lat, atan2(q.lat - p.lat, q.lon - p.lon) AS angle FROM y p JOIN y q ON p.centre = q.centre AND (p.lon <> q.lon OR p.lat <> q.lat)),
b AS (SELECT *, coalesce(lead(angle) OVER o, min(angle) OVER (PARTITION BY centre, lon, lat) + 2 * pi()) - angle AS gap FROM a WINDOW o AS (PARTITION BY centre, lon, lat ORDER BY angle)),
c AS (SELECT centre, lon, lat FROM b GROUP BY ALL HAVING max(gap) > pi() + 1e-9), m AS (SELECT centre, lon - avg(lon) OVER o AS lon, lat - avg(lat) OVER o AS lat FROM c WINDOW o AS (PARTITION BY centre)),
r AS (SELECT *, coalesce(lead(lon) OVER o, first_value(lon) OVER o) AS lon2, coalesce(lead(lat) OVER o, first_value(lat) OVER o) AS lat2 FROM m WINDOW o AS (PARTITION BY centre ORDER BY atan2(lat, lon)))
SELECT centre, round(sum(lon * lat2 - lon2 * lat) / 2, 6) AS area FROM r GROUP BY centre HAVING area > 0""", "geo_points")
def _(t: Tables) -> DataFrame:
    return geo.hulls(*_customers_dealers(t), 50.0, "name").select("centre", F.round(geo.ring_area(F.col("ring")), 6).alias("area")).where("area > 0")


@query("G3_rings", "SELECT name, i, round(lon + 50 / 111.0 * cos(radians(i * 10)), 6) AS lon, round(lat + 50 / 111.0 * sin(radians(i * 10)), 6) AS lat FROM (SELECT name, try_cast(lat_raw AS DOUBLE) AS lat, try_cast(lon_raw AS DOUBLE) AS lon FROM geo_points WHERE kind = 'Agro-Dealer'), range(37) r(i) WHERE lat BETWEEN -5 AND 5 AND lon BETWEEN 28 AND 42 AND NOT (lat = 0 AND lon = 0)", "geo_points")
def _(t: Tables) -> DataFrame:
    dealers = geo.normal_points(t.geo_points.where("kind = 'Agro-Dealer'"), "lat_raw", "lon_raw", "name")
    corners = geo.circles(dealers, "name", 50.0).select("name", F.posexplode("ring").alias("i", "at"))
    return corners.select("name", F.col("i").cast("long").alias("i"), F.round("at.lon", 6).alias("lon"), F.round("at.lat", 6).alias("lat"))


@query("G3_circles", f"WITH {_GEO} SELECT name, 37 AS corners FROM v WHERE kind = 'Agro-Dealer'", "geo_points")
def _(t: Tables) -> DataFrame:
    points = geo.normal_points(t.geo_points, "lat_raw", "lon_raw", "name", "kind").where("kind = 'Agro-Dealer'")
    return geo.circles(points, "name", 10.0).select("name", F.size("ring").alias("corners"))
