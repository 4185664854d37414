"""Source/sink round trips, catalog inventory, keyed reads and change sets."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from workpulse.operators import changes, hours
from workpulse.plans import bindings as B
from workpulse.plans.queries_kpi import WH_SQL
from workpulse.plans.queries_silver import REASON_SQL
from workpulse.plans.registry import register
from workpulse.sources import io, versions

RAW_DATA_COLS = ["client_employee_id", "department_id", "department_name", "pay_code",
                 "hours_worked", "punch_apply_date", "punch_in_datetime", "punch_out_datetime",
                 "scheduled_start_datetime", "scheduled_end_datetime"]


@register("extract_roundtrip", f"""
SELECT {', '.join(RAW_DATA_COLS)}, '20240201_000000' AS _batch_id, _source_file AS origin_file FROM b_raw""")
def extract_roundtrip(spark, sf):
    """SRC1/SRC2/SRC3/SRC7: write the bronze rows as two pipe-delimited gzip
    extracts ([NULL] token), read them back through a glob with lineage."""
    raw = B.raw_extract(spark, sf)
    root = io.scratch_path(spark, "extracts")
    for name in ("extract_a.csv", "extract_b.csv"):
        part = raw.filter(F.col("_source_file") == name).select(*RAW_DATA_COLS)
        io.write_extract(part, f"{root}/timesheet_{name.split('.')[0]}", compression="gzip")
    back = io.with_lineage(io.read_extract(spark, f"{root}/timesheet_extract_*"),
                           batch_id=B.BATCH_ID)
    origin = F.regexp_extract("_source_file", r"timesheet_(extract_[ab])", 1)
    return back.select(*RAW_DATA_COLS, "_batch_id",
                       F.concat(origin, F.lit(".csv")).alias("origin_file"))


EMP_OUT = ["client_employee_id", "full_name", "department_code", "department_name", "hire_date",
           "term_date", "tenure_days", "tenure_years", "is_early_attrition", "manager_exists"]


@register("publish_roundtrip", f"SELECT {', '.join(EMP_OUT)} FROM b_employee")
def publish_roundtrip(spark, sf):
    """SNK1/SNK2/SNK4/SRC4: publish a silver table as parquet and load it back."""
    root = io.scratch_path(spark, "lake")
    io.publish(B.employee(spark, sf).select(*EMP_OUT), root, "silver", "employee")
    return io.load(spark, root, "silver", "employee")


@register("serving_copy", """
SELECT client_employee_id, total_working_days, total_hours_worked, avg_hours_per_day,
  first_work_date FROM (""" + WH_SQL + """) w JOIN (SELECT client_employee_id, min(punch_apply_date) AS first_work_date
               FROM t_silver GROUP BY 1) f USING (client_employee_id)""")
def serving_copy(spark, sf):
    """SNK6: allow-listed serving copy (wipe and reload), read back."""
    wh = hours.working_hours(B.timesheet(spark, sf))
    root = io.scratch_path(spark, "serving")
    io.publish_serving(wh, ["client_employee_id", "total_working_days", "total_hours_worked",
                            "avg_hours_per_day", "first_work_date"], root, "working_hours")
    return io.load(spark, root, "serving", "working_hours")


@register("catalog_inventory", """
SELECT * FROM (VALUES ('wp_employee', (SELECT count(*) FROM b_employee), 23, TRUE),
                      ('wp_punch', (SELECT count(*) FROM b_punch), 10, TRUE),
                      ('wp_missing', NULL, NULL, FALSE))
  AS t(table_name, row_count, column_count, "exists")""")
def catalog_inventory(spark, sf):
    """SNK5/CAT1: register temp views and list rows/columns per table."""
    io.register_views({"wp_employee": B.employee(spark, sf), "wp_punch": B.punch(spark, sf)})
    return io.catalog_inventory(spark, ["wp_employee", "wp_punch", "wp_missing"])


# ----------------------------------------------------------------------------- keyed reads

@register("lookup_many", """
SELECT * FROM customer WHERE c_custkey IN
  (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')""")
def lookup_many(spark, sf):
    """RD1: batch lookup of many keys at once (semi join)."""
    keys = B.table(spark, sf, "orders").filter(
        (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    return changes.lookup_many(B.table(spark, sf, "customer"), "c_custkey", keys, "o_custkey")


@register("lookup_page", """
SELECT client_employee_id, punch_apply_date, timesheet_id, hours_worked FROM t_silver
WHERE punch_apply_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'
ORDER BY punch_apply_date, timesheet_id OFFSET 100 LIMIT 1000""", doubles=("hours_worked",))
def lookup_page(spark, sf):
    """RD2/FLT10/SRT5: inclusive date window, ordered by (date, id), one page."""
    ts = B.timesheet(spark, sf).select("client_employee_id", "punch_apply_date", "timesheet_id",
                                       "hours_worked")
    return changes.lookup_page(ts, ["punch_apply_date", "timesheet_id"], offset=100, limit=1000,
                               filters=changes.date_window_filters(
                                   "punch_apply_date", "2024-01-08", "2024-01-21"))


_PAGE = ["punch_apply_date", "timesheet_id"]


@register("lookup_page_after", """
SELECT client_employee_id, punch_apply_date, timesheet_id, hours_worked FROM t_silver
WHERE punch_apply_date <= DATE '2024-01-21'
  AND (punch_apply_date, timesheet_id) > (DATE '2024-01-10', '8000')
ORDER BY punch_apply_date, timesheet_id LIMIT 500""", doubles=("hours_worked",))
def lookup_page_after(spark, sf):
    """RD2: the page after a key, of a table written in ranges of (date, id): a filter
    that skips files and row groups, no offset."""
    root = io.scratch_path(spark, "clustered")
    ts = B.timesheet(spark, sf).select("client_employee_id", *_PAGE, "hours_worked")
    versions.publish_version(ts, root, "serving", "timesheet", cluster_by=_PAGE)
    return changes.lookup_after(io.load(spark, root, "serving", "timesheet"), _PAGE, ["2024-01-10", "8000"],
                                limit=500, filters=changes.date_window_filters("punch_apply_date", end="2024-01-21"))


@register("lookup_many_bucketed", """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey IN
  (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def lookup_many_bucketed(spark, sf):
    """RD1: batch lookup in a table bucketed by the key: only the asked keys are shuffled."""
    schema = f"wp_{uuid.uuid4().hex[:8]}_serving"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{io.scratch_path(spark, 'bucketed')}'")
    io.publish(B.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), None, schema, "customer",
               bucket_by=(8, ["c_custkey"]))
    asked = B.table(spark, sf, "orders").where("o_orderstatus = 'F'")
    return changes.lookup_many(io.load(spark, None, schema, "customer"), "c_custkey", asked, "o_custkey")


# ----------------------------------------------------------------------------- change sets

CHANGES_SQL = """
base AS (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer),
ch AS (
  SELECT c_custkey,
    CASE WHEN c_custkey % 11 = 0 THEN 'D' WHEN c_custkey % 7 = 0 THEN 'U'
         WHEN c_custkey % 13 = 0 THEN 'U' ELSE 'I' END AS op,
    CASE WHEN c_custkey % 11 = 0 THEN []::VARCHAR[] WHEN c_custkey % 7 = 0 THEN ['c_acctbal']
         WHEN c_custkey % 13 = 0 THEN ['c_mktsegment'] ELSE ['c_name', 'c_acctbal', 'c_mktsegment'] END
      AS set_fields,
    c_name, c_acctbal + 1 AS c_acctbal, NULL::VARCHAR AS c_mktsegment
  FROM customer WHERE c_custkey % 11 = 0 OR c_custkey % 7 = 0 OR c_custkey % 13 = 0 OR c_custkey % 70 = 1
  UNION ALL
  SELECT c_custkey + 1000000, 'I', ['c_name', 'c_acctbal', 'c_mktsegment'], c_name || '-new', c_acctbal,
    c_mktsegment FROM customer WHERE c_custkey % 50 = 0
  UNION ALL
  SELECT c_custkey + 2000000, 'U', ['c_acctbal'], NULL, 0.0, NULL FROM customer WHERE c_custkey % 90 = 0
  UNION ALL
  SELECT c_custkey + 3000000, 'D', []::VARCHAR[], NULL, NULL, NULL FROM customer WHERE c_custkey % 120 = 0
  UNION ALL
  SELECT c_custkey + 4000000, 'I', ['c_name'], 'dup', 0.0, NULL FROM customer WHERE c_custkey % 400 = 0
  UNION ALL
  SELECT c_custkey + 4000000, 'I', ['c_name'], 'dup2', 0.0, NULL FROM customer WHERE c_custkey % 400 = 0
)"""


def _changes(spark, sf):
    cust = B.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    k = F.col("c_custkey")
    all3 = F.array(F.lit("c_name"), F.lit("c_acctbal"), F.lit("c_mktsegment"))
    empty = F.array().cast("array<string>")
    main = cust.filter((k % 11 == 0) | (k % 7 == 0) | (k % 13 == 0) | (k % 70 == 1)).select(
        "c_custkey",
        F.when(k % 11 == 0, "D").when(k % 7 == 0, "U").when(k % 13 == 0, "U").otherwise("I").alias("op"),
        F.when(k % 11 == 0, empty).when(k % 7 == 0, F.array(F.lit("c_acctbal")))
        .when(k % 13 == 0, F.array(F.lit("c_mktsegment"))).otherwise(all3).alias("set_fields"),
        "c_name", (F.col("c_acctbal") + 1).alias("c_acctbal"),
        F.lit(None).cast("string").alias("c_mktsegment"))
    ins = cust.filter(k % 50 == 0).select(
        (k + 1000000).alias("c_custkey"), F.lit("I").alias("op"), all3.alias("set_fields"),
        F.concat("c_name", F.lit("-new")).alias("c_name"), "c_acctbal", "c_mktsegment")
    upd_missing = cust.filter(k % 90 == 0).select(
        (k + 2000000).alias("c_custkey"), F.lit("U").alias("op"),
        F.array(F.lit("c_acctbal")).alias("set_fields"), F.lit(None).cast("string").alias("c_name"),
        F.lit(0.0).alias("c_acctbal"), F.lit(None).cast("string").alias("c_mktsegment"))
    del_missing = cust.filter(k % 120 == 0).select(
        (k + 3000000).alias("c_custkey"), F.lit("D").alias("op"), empty.alias("set_fields"),
        F.lit(None).cast("string").alias("c_name"), F.lit(None).cast("double").alias("c_acctbal"),
        F.lit(None).cast("string").alias("c_mktsegment"))
    dups = [cust.filter(k % 400 == 0).select(
        (k + 4000000).alias("c_custkey"), F.lit("I").alias("op"),
        F.array(F.lit("c_name")).alias("set_fields"), F.lit(v).alias("c_name"),
        F.lit(0.0).alias("c_acctbal"), F.lit(None).cast("string").alias("c_mktsegment"))
        for v in ("dup", "dup2")]
    ch = main.unionByName(ins).unionByName(upd_missing).unionByName(del_missing)
    for d in dups:
        ch = ch.unionByName(d)
    return cust, ch


@register("changes_applied", "WITH " + CHANGES_SQL.strip() + """,
cnt AS (SELECT c_custkey, count(*) AS n FROM ch GROUP BY 1),
valid AS (
  SELECT ch.* FROM ch JOIN cnt USING (c_custkey) WHERE n = 1 AND (
    (op = 'I' AND c_custkey NOT IN (SELECT c_custkey FROM base)) OR
    (op IN ('U', 'D') AND c_custkey IN (SELECT c_custkey FROM base))))
SELECT b.c_custkey,
  CASE WHEN list_contains(v.set_fields, 'c_name') THEN v.c_name ELSE b.c_name END AS c_name,
  CASE WHEN list_contains(v.set_fields, 'c_acctbal') THEN v.c_acctbal ELSE b.c_acctbal END AS c_acctbal,
  CASE WHEN list_contains(v.set_fields, 'c_mktsegment') THEN v.c_mktsegment ELSE b.c_mktsegment END
    AS c_mktsegment
FROM base b LEFT JOIN (SELECT * FROM valid WHERE op IN ('U', 'D')) v ON b.c_custkey = v.c_custkey
WHERE v.op IS NULL OR v.op <> 'D'
UNION ALL
SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM valid WHERE op = 'I'""")
def changes_applied(spark, sf):
    """WR1/WR2/WR3: new snapshot after inserts, partial updates, deletes."""
    base, ch = _changes(spark, sf)
    return changes.apply_changes(base, ch, "c_custkey")[0]


@register("changes_rejected", "WITH " + CHANGES_SQL.strip() + """,
cnt AS (SELECT c_custkey, count(*) AS n FROM ch GROUP BY 1)
SELECT * FROM (
  SELECT ch.c_custkey, ch.op, array_to_string(ch.set_fields, ',') AS set_fields, ch.c_name,
    ch.c_acctbal, ch.c_mktsegment,
    CASE WHEN n > 1 THEN 'duplicate_change'
      WHEN op = 'I' AND ch.c_custkey IN (SELECT c_custkey FROM base) THEN 'key_exists'
      WHEN op IN ('U', 'D') AND ch.c_custkey NOT IN (SELECT c_custkey FROM base) THEN 'key_not_found'
    END AS reject_reason
  FROM ch JOIN cnt USING (c_custkey)) WHERE reject_reason IS NOT NULL""")
def changes_rejected(spark, sf):
    """WR1-3: rejected changes with a reason."""
    base, ch = _changes(spark, sf)
    rej = changes.apply_changes(base, ch, "c_custkey")[1]
    return rej.withColumn("set_fields", F.array_join("set_fields", ","))


@register("merge_written_once", "WITH " + CHANGES_SQL.strip() + """,
verdicts AS (
  SELECT c_custkey, op, CASE WHEN count(*) OVER (PARTITION BY c_custkey) > 1 THEN 'duplicate_change'
    WHEN op = 'I' AND c_custkey IN (SELECT c_custkey FROM base) THEN 'key_exists'
    WHEN op <> 'I' AND c_custkey NOT IN (SELECT c_custkey FROM base) THEN 'key_not_found' END AS why FROM ch)
SELECT 'row' AS merge_side, c_custkey, '' AS reject_reason FROM base
  WHERE c_custkey NOT IN (SELECT c_custkey FROM verdicts WHERE op = 'D' AND why IS NULL)
UNION ALL SELECT 'row', c_custkey, '' FROM verdicts WHERE op = 'I' AND why IS NULL
UNION ALL SELECT 'reject', c_custkey, why FROM verdicts WHERE why IS NOT NULL""")
def merge_written_once(spark, sf):
    """WR1-3: the merged frame written once, its sides read back as partitions."""
    base, ch = _changes(spark, sf)
    root = io.scratch_path(spark, "merged")
    versions.publish_version(changes.merge_changes(base, ch, "c_custkey"), root, "silver", "customer",
                             partition_by=["merge_side"])
    both = io.load(spark, root, "silver", "customer")
    return both.where("merge_side = 'row'").union(both.where("merge_side = 'reject'")).select(
        "merge_side", "c_custkey", F.coalesce("reject_reason", F.lit("")).alias("reject_reason"))


@register("stream_bronze_ingest", f"""
SELECT {', '.join(RAW_DATA_COLS)} FROM b_raw
WHERE ({REASON_SQL}) IS NULL""")
def stream_bronze_ingest(spark, sf):
    """Structured Streaming bronze step: extract files landing in a folder are
    ingested incrementally (availableNow), split into clean and quarantined
    rows and appended; the clean rows are read back."""
    from workpulse.plans import pipeline
    from workpulse.streaming import ingest
    raw = B.raw_extract(spark, sf)
    root = io.scratch_path(spark, "stream")
    for name in ("extract_a.csv", "extract_b.csv"):
        io.write_extract(raw.filter(F.col("_source_file") == name).select(*RAW_DATA_COLS),
                         f"{root}/landing/{name.split('.')[0]}")
    q = ingest.start_bronze_ingest(spark, f"{root}/landing/*", RAW_DATA_COLS, f"{root}/lake",
                                   f"{root}/checkpoint", pipeline.timesheet_reasons())
    if not q.awaitTermination(1800):
        q.stop()
        raise TimeoutError("bronze stream did not drain its backlog")
    return spark.read.parquet(f"{root}/lake/bronze/timesheet").select(*RAW_DATA_COLS)
