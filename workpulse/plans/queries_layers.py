"""Malformed lines, one-pass quarantine, replaced and managed tables, counts of the
writes, the contract as data, and the run from extracts to verdict."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from workpulse.operators import clean, dq, quarantine
from workpulse.plans import bindings as B
from workpulse.plans import contract, pipeline
from workpulse.plans.dq_suite import CONTRACT_RELATIONS, SPARK_TYPE, contract_tables
from workpulse.plans.queries_dq import CHECKED_AT, PUNCH_AS_OF, SILVER_CTES, dq_frames, dq_layers
from workpulse.plans.queries_silver import REASON_SQL
from workpulse.plans.registry import register
from workpulse.sources import extracts, io, versions

RAW = ", ".join(B.RAW_COLUMNS)
_FIELDS = [f"CASE WHEN {c} IS NULL THEN '[NULL]' WHEN {c} = '' THEN '\"\"' WHEN contains({c}, '|') "
           f"THEN '\"' || {c} || '\"' ELSE {c} END" for c in B.RAW_COLUMNS]
_ODD = "event_id % 61 = 0 OR event_id % 67 = 0 OR event_id % 71 = 0"
#: Bronze rows as lines, the reason of malformed ones, and the rows that remain.
LINES_CTE = f"""
x_lines AS (
  SELECT *, {" || '|' || ".join(_FIELDS[:-1])} AS body, {_FIELDS[-1]} AS last_field,
    CASE WHEN event_id % 61 = 0 THEN 'wrong_field_count' WHEN event_id % 67 = 0 THEN 'wrong_field_count'
      WHEN event_id % 71 = 0 THEN 'broken_quote' END AS line_reason FROM b_raw_e),
x_rows AS (
  SELECT {", ".join(f"CASE WHEN line_reason IS NULL THEN {c} END AS {c}" for c in B.RAW_COLUMNS)},
    CASE WHEN event_id % 61 = 0 THEN body WHEN event_id % 67 = 0 THEN body || '|' || last_field || '|surplus'
      WHEN event_id % 71 = 0 THEN '"' || body || '|' || last_field END AS _corrupt_record,
    line_reason AS _corrupt_reason, _source_file AS origin FROM x_lines)"""


def write_lines(spark, sf, root: str) -> str:
    """The two extract files of ``bindings.extract_lines`` in folders under ``root``,
    every part with a header of its own."""
    lines = B.extract_lines(spark, sf)
    for name in ("extract_a", "extract_b"):
        path = f"{root}/timesheet_{name}"
        lines.where(F.col("origin") == f"{name}.csv").select("line").write.text(path)
        spark.range(1).select(F.lit("|".join(B.RAW_COLUMNS))).coalesce(1).write.mode("append").text(path)
    return f"{root}/timesheet_*"


@register("extract_corrupt", f"WITH {LINES_CTE.strip()} SELECT * FROM x_rows")
def extract_corrupt(spark, sf):
    """SRC1: short lines, long lines and open quotes keep their text and a reason;
    good + corrupt = lines."""
    paths = write_lines(spark, sf, io.scratch_path(spark, "lines"))
    back = extracts.read_checked_extract(spark, paths, B.RAW_COLUMNS)
    origin = F.concat(F.regexp_extract("_source_file", r"timesheet_(extract_[ab])", 1), F.lit(".csv"))
    return back.withColumn("origin", origin).drop("_source_file")


@register("quarantine_tagged", f"""
SELECT {RAW}, coalesce({REASON_SQL}, '') AS dq_reason,
  CASE WHEN ({REASON_SQL}) IS NULL THEN 'good' ELSE 'quarantined' END AS verdict FROM b_raw""")
def quarantine_tagged(spark, sf):
    """FLT4: one write of the tagged rows, both sides read back as partitions."""
    root = io.scratch_path(spark, "tagged")
    tagged = quarantine.tag(B.raw_extract(spark, sf), pipeline.timesheet_reasons(), F.lit(CHECKED_AT))
    versions.publish_version(tagged, root, "bronze", "timesheet", partition_by=[quarantine.VERDICT],
                             metrics=quarantine.verdict_metrics())
    both = versions.load_version(spark, root, "bronze", "timesheet")
    good = quarantine.good_side(both).select(*B.RAW_COLUMNS, F.lit("").alias("dq_reason"), F.lit("good").alias("verdict"))
    bad = quarantine.bad_side(both).select(*B.RAW_COLUMNS, "dq_reason", F.lit("quarantined").alias("verdict"))
    return good.union(bad)


_ODD_EMPLOYEE = """
WITH o AS (
  SELECT k, CASE WHEN k % 83 = 0 THEN ' ' ELSE client_employee_id END AS client_employee_id,
    CASE WHEN k % 59 = 0 THEN strftime(hire_date, '%d/%m/%Y') ELSE strftime(hire_date, '%Y-%m-%d') END AS hire_date,
    CASE WHEN k % 61 = 0 THEN 'unknown' ELSE strftime(term_date, '%Y-%m-%d') END AS term_date
  FROM (SELECT *, CAST(client_employee_id AS BIGINT) AS k FROM e_raw)),
r AS (
  SELECT *, CASE WHEN trim(client_employee_id) = '' THEN 'missing_employee_id'
    WHEN hire_date IS NOT NULL AND TRY_CAST(hire_date AS DATE) IS NULL THEN 'invalid_hire_date'
    WHEN term_date IS NOT NULL AND TRY_CAST(term_date AS DATE) IS NULL THEN 'invalid_term_date' END AS dq_reason
  FROM o)"""


@register("strict_cast", _ODD_EMPLOYEE + """
SELECT NULLIF(trim(client_employee_id), '') AS client_employee_id, dq_reason,
  CASE WHEN dq_reason IS NULL THEN CAST(hire_date AS DATE) END AS hire_date,
  CASE WHEN dq_reason IS NULL THEN CAST(term_date AS DATE) END AS term_date,
  CASE WHEN dq_reason IS NOT NULL THEN hire_date END AS hire_text,
  CASE WHEN dq_reason IS NOT NULL THEN term_date END AS term_text FROM r""")
def strict_cast(spark, sf):
    """PRJ5: employees whose dates cannot be read are quarantined with their text,
    the others are cast strictly (a date that got past the rules would raise)."""
    raw = B.employee_raw_odd_dates(spark, sf)
    root = io.scratch_path(spark, "employees")
    versions.publish_version(quarantine.tag(raw, pipeline.employee_reasons(raw.columns)), root, "bronze", "employee",
                             partition_by=[quarantine.VERDICT], metrics=quarantine.verdict_metrics())
    both = versions.load_version(spark, root, "bronze", "employee")
    good = clean.cast_dates(clean.blank_to_null(quarantine.good_side(both)), ["hire_date", "term_date"], strict=True)
    text = F.lit(None).cast("string")
    good = good.select("client_employee_id", text.alias("dq_reason"), "hire_date", "term_date",
                       text.alias("hire_text"), text.alias("term_text"))
    date = F.lit(None).cast("date")
    bad = clean.blank_to_null(quarantine.bad_side(both), ["client_employee_id"]).select(
        "client_employee_id", "dq_reason", date.alias("hire_date"), date.alias("term_date"),
        F.col("hire_date").alias("hire_text"), F.col("term_date").alias("term_text"))
    return good.union(bad)


# ----------------------------------------------------------------------------- counts of the writes

_COUNTS = [("bronze.employee.rows", "(SELECT count(*) FROM e_raw)"),
           ("bronze.employee.good", "(SELECT count(*) FROM e_raw)"),
           ("bronze.employee.quarantined", "0"),
           ("bronze.timesheet.rows", "(SELECT count(*) FROM b_raw)"),
           ("bronze.timesheet.good", "(SELECT count(*) FROM s_good)"),
           ("bronze.timesheet.quarantined", "(SELECT count(*) FROM q_bad)"),
           ("silver.employee.rows", "(SELECT count(*) FROM b_employee)"),
           ("silver.employee_quarantine.rows", "0"),
           ("silver.timesheet_quarantine.rows", "(SELECT count(*) FROM q_bad)"),
           ("silver.timesheet.rows", "(SELECT count(*) FROM s_silver)"),
           ("silver.timesheet.copies_removed", "(SELECT sum(source_duplicate_count - 1) FROM s_silver)"),
           ("silver.timesheet.codes", "(SELECT sum(pay_code_count) FROM s_silver)"),
           ("silver.timesheet_pay_code.rows", "(SELECT sum(pay_code_count) FROM s_silver)"),
           ("silver.pay_code_dimension.rows",
            "(SELECT count(DISTINCT c) FROM (SELECT trim(unnest(string_split(pay_code, '|'))) AS c FROM s_silver))")]


def _counts_sql(counts) -> str:
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, CAST({v} AS BIGINT) AS value" for m, v in counts)


@register("layer_counts", SILVER_CTES + _counts_sql(_COUNTS))
def layer_counts(spark, sf):
    """DQ-CNT/AG2: rows of each layer, of each verdict, copies removed and codes, as
    the writes observed them; no layer is scanned to be counted."""
    return dq_layers(spark, sf)["layer_counts"]


@register("layers_reconciled", SILVER_CTES + """
SELECT 'DQ011_1' AS check_id, CAST((SELECT count(*) FROM e_raw) - (SELECT count(*) FROM b_employee) AS BIGINT) AS gap,
  'PASS' AS status
UNION ALL SELECT 'DQ011_2', CAST((SELECT count(*) FROM s_good) - (SELECT sum(source_duplicate_count) FROM s_silver)
  AS BIGINT), 'PASS'
UNION ALL SELECT 'DQ011_3', (SELECT count(*) FROM b_raw) - (SELECT count(*) FROM s_good)
  - (SELECT count(*) FROM q_bad), 'PASS'""")
def layers_reconciled(spark, sf):
    """DQ-REC: bronze, silver and quarantine balance, from the counts of their writes."""
    from workpulse.plans.dq_suite import counted_reconciliations
    rows = dq.dq_report(spark, {"layer_counts": dq_layers(spark, sf)["layer_counts"]}, counted_reconciliations())
    return rows.select("check_id", F.regexp_extract("actual_value", r"unexplained_gap=(-?\d+)", 1).cast("long")
                       .alias("gap"), "status")


# ----------------------------------------------------------------------------- tables replaced in one step

@register("publish_schema_replaced", """
SELECT client_employee_id, tenure_years, employment_status, full_name AS full_name_before FROM b_employee""")
def publish_schema_replaced(spark, sf):
    """SNK1/SNK2: a table replaced by one of another schema; a frame read before the
    replacement still reads the version it was planned on."""
    root, emp = io.scratch_path(spark, "replaced"), B.employee(spark, sf)
    versions.publish_version(emp.select("client_employee_id", "full_name", "hire_date"), root, "silver", "employee")
    before = io.load(spark, root, "silver", "employee")
    versions.publish_version(emp.select("client_employee_id", "tenure_years", "employment_status"),
                             root, "silver", "employee")
    after = io.load(spark, root, "silver", "employee")
    old = before.select(F.col("client_employee_id").alias("i"), F.col("full_name").alias("full_name_before"))
    return after.join(old, F.col("client_employee_id") == F.col("i")).drop("i")


# ----------------------------------------------------------------------------- managed tables, contract

def _prefix() -> str:
    return f"wp_{uuid.uuid4().hex[:8]}_"


def _schemas(spark, prefix: str) -> None:
    """The schemas of a query's own tables, in the session's shared folder."""
    for layer in ("bronze", "silver", "gold"):
        place = io.scratch_path(spark, f"managed-{layer}")
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}{layer} LOCATION '{place}'")


@register("managed_tables", """
SELECT table_name, column_name, data_type, CASE WHEN table_name = 'silver.employee'
  THEN (SELECT count(*) FROM b_employee) ELSE (SELECT count(*) FROM t_silver) END AS table_rows
FROM (VALUES
  ('silver.employee', 'client_employee_id', 'string'), ('silver.employee', 'hire_date', 'date'),
  ('silver.employee', 'tenure_years', 'double'), ('silver.employee', 'active_status', 'boolean'),
  ('silver.timesheet', 'timesheet_id', 'string'), ('silver.timesheet', 'punch_apply_date', 'date'),
  ('silver.timesheet', 'is_overtime', 'boolean')) AS c(table_name, column_name, data_type)""")
def managed_tables(spark, sf):
    """SNK4/CAT1/SRC4: schemas and managed tables made, one replaced by another
    schema, then described and read through the catalog by qualified name."""
    prefix = _prefix()
    _schemas(spark, prefix)
    layers = pipeline.Layers(spark, None, prefix)
    layers.put("silver", "employee", B.master_ids(spark, sf))
    tables = {"silver.employee": layers.put("silver", "employee", B.employee(spark, sf).select(
                  "client_employee_id", "hire_date", "tenure_years", "active_status")),
              "silver.timesheet": layers.put("silver", "timesheet", B.timesheet(spark, sf).select(
                  "timesheet_id", "punch_apply_date", "is_overtime"))}
    found = contract.managed_columns(spark, [prefix + t for t in (*tables, "silver.absent")])
    found = found.withColumn("table_name", F.replace("table_name", F.lit(prefix), F.lit("")))
    marks = [df.select(F.lit(t).alias("t")) for t, df in tables.items()]
    sizes = marks[0].union(marks[1]).groupBy("t").agg(F.count(F.lit(1)).alias("table_rows"))
    return found.join(sizes, F.col("table_name") == F.col("t")).drop("t")


#: The one table that the availability query leaves out.
ABSENT = "gold.department_tenure"


@register("table_availability", " UNION ALL ".join(
    f"SELECT 'DQ_TBL_{t.replace('.', '_')}' AS check_id, "
    f"'{'CRITICAL' if t in contract.CRITICAL_TABLES else 'WARNING'}' AS severity, "
    f"'{'missing' if t == ABSENT else 'exists'}' AS actual_value, '{'FAIL' if t == ABSENT else 'PASS'}' AS status"
    for t in contract.TABLES))
def table_availability(spark, sf):
    """DQ-AVL: the 18 tables by qualified name in the catalog, a critical one absent."""
    prefix = _prefix()
    _schemas(spark, prefix)
    layers = pipeline.Layers(spark, None, prefix)
    ids = {"bronze": B.master_ids(spark, sf), "silver": B.employee(spark, sf).select("client_employee_id", "tenure_days"),
           "gold": B.employee(spark, sf).groupBy("department_id").agg(F.count(F.lit(1)).alias("employees"))}
    for table in contract.TABLES:
        if table != ABSENT:
            layers.put(*table.split("."), ids[table.split(".")[0]])
    return dq.dq_report(spark, {}, dq.check_available("DQ_TBL", spark, contract.TABLES, contract.CRITICAL_TABLES,
                                                      layers.exists)).select(
        "check_id", "severity", "actual_value", "status")


def _contract_rows_sql() -> str:
    parts = []
    for table, (rel, absent) in CONTRACT_RELATIONS.items():
        rules = [("EXIST", c, "present") for c in contract.REQUIRED.get(table, ())]
        rules += [("TYPE", c, kind) for c, kind in contract.TYPES[table].items()]
        rows = ", ".join(f"('DQ_SCHEMA_{rule}_{table.split('.')[1]}_{c}', '{kind}', "
                         + ("NULL" if c in absent else f"(SELECT typeof({c}) FROM {rel} LIMIT 1)") + ")"
                         for rule, c, kind in rules)
        parts.append(f"SELECT i, k, {SPARK_TYPE} AS t FROM (VALUES {rows}) AS r(i, k, t)")
    return f"""SELECT i AS check_id, CASE WHEN k = 'present' AND t IS NOT NULL THEN 'present'
    ELSE coalesce(t, 'missing') END AS actual_value, k AS expected_value,
  CASE WHEN t IS NOT NULL AND (k = 'present' OR contains(t, k)) THEN 'PASS' ELSE 'FAIL' END AS status
  FROM ({" UNION ALL ".join(parts)})"""


@register("contract_columns", SILVER_CTES + _contract_rows_sql())
def contract_columns(spark, sf):
    """DQ-COL/DQ-TYP: 10 required columns and 45 types, joined to the catalog's
    columns; the master has two of the dates only under the names of other systems."""
    columns = contract.catalog_columns(spark, contract_tables(dq_frames(spark, sf)))
    return contract.contract_report(spark, columns, CHECKED_AT).select(
        "check_id", "actual_value", "expected_value", "status")


@register("absent_columns", """
SELECT 'client_employee_id' AS column_name, FALSE AS absent, count(client_employee_id) AS filled FROM e_raw
UNION ALL SELECT 'hire_date', FALSE, count(hire_date) FROM e_raw
UNION ALL SELECT 'term_date', FALSE, count(term_date) FROM e_raw
UNION ALL SELECT 'first_name', FALSE, count(first_name) FROM e_raw
UNION ALL SELECT 'middle_name', FALSE, 0
UNION ALL SELECT 'recent_hire_date', TRUE, 0 UNION ALL SELECT 'dob', TRUE, 0""")
def absent_columns(spark, sf):
    """PRJ2/SRC6: blank-to-null on an explicit list, with a record per listed
    column that says whether the table has it and how many values it holds."""
    asked = ["client_employee_id", "hire_date", "term_date", "first_name", "middle_name", "recent_hire_date", "dob"]
    raw = clean.blank_to_null(B.employee_raw(spark, sf), asked)
    missing = clean.missing_columns(raw, asked)
    records = io.frame_from_records(spark, [(c, c in missing) for c in asked], "column_name string, absent boolean")
    there = [c for c in asked if c not in missing]
    filled = clean.all_null_columns(raw, there).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).alias("n")) for c in there])).alias("x")).select("x.*")
    return records.join(filled, F.col("column_name") == F.col("c"), "left").select(
        "column_name", "absent", F.coalesce("n", F.lit(0)).cast("long").alias("filled"))


# ----------------------------------------------------------------------------- from extracts to verdict

_RUN_CTES = "WITH " + LINES_CTE.strip() + f""",
x_raw AS (SELECT {RAW}, origin AS _source_file, TIMESTAMP '2024-02-01' AS _ingested_at, 'b' AS _batch_id
          FROM x_rows WHERE _corrupt_reason IS NULL),""" + SILVER_CTES.strip()[4:].replace("b_raw", "x_raw")


@register("pipeline_run", _RUN_CTES + """
SELECT 'bronze.timesheet.rows' AS metric, (SELECT count(*) FROM x_rows) AS value
UNION ALL SELECT 'silver.timesheet_quarantine.rows',
  (SELECT count(*) FROM x_rows WHERE _corrupt_reason IS NOT NULL) + (SELECT count(*) FROM q_bad)
UNION ALL SELECT 'bronze.timesheet.good', (SELECT count(*) FROM s_good)
UNION ALL SELECT 'silver.timesheet.rows', (SELECT count(*) FROM s_silver)
UNION ALL SELECT 'silver.timesheet_pay_code.rows', (SELECT CAST(sum(pay_code_count) AS BIGINT) FROM s_silver)
UNION ALL SELECT 'silver.employee.rows', (SELECT count(*) FROM b_employee)
UNION ALL SELECT 'gold.daily_headcount.rows', (SELECT count(*) FROM dq_hc)
UNION ALL SELECT 'gold.monthly_turnover.rows', (SELECT count(*) FROM dq_mt)
UNION ALL SELECT 'gold.department_tenure.rows', (SELECT count(*) FROM dq_dt)
UNION ALL SELECT 'gold.employee_working_hours.rows', (SELECT count(*) FROM dq_wh)
UNION ALL SELECT 'gold.attendance_metrics.rows', (SELECT count(*) FROM dq_am)
UNION ALL SELECT 'gold.rolling_avg_hours.rows', (SELECT count(*) FROM dq_ra)
UNION ALL SELECT 'gold.early_attrition_overall.rows', 1
UNION ALL SELECT 'verdict.' || CASE WHEN EXISTS (SELECT 1 FROM s_silver WHERE hours_worked < 0) THEN 'FAIL'
  ELSE 'PASS' END, 0""")
def pipeline_run(spark, sf):
    """The whole run: extract files with malformed lines to bronze, silver, gold and
    the verdict; the rows of its tables as their writes counted them."""
    root = io.scratch_path(spark, "run")
    paths = write_lines(spark, sf, root)
    io.write_extract(B.employee_raw(spark, sf), f"{root}/employee")
    out = pipeline.run(spark, f"{root}/employee", paths, f"{root}/lake", as_of=B.AS_OF, punch_as_of=PUNCH_AS_OF,
                       batch_id=B.BATCH_ID, strict=False, timesheet_columns=B.RAW_COLUMNS)
    asked = ["bronze.timesheet.rows", "silver.timesheet_quarantine.rows", "bronze.timesheet.good", "silver.timesheet.rows",
             "silver.timesheet_pay_code.rows", "silver.employee.rows", "gold.daily_headcount.rows",
             "gold.monthly_turnover.rows", "gold.department_tenure.rows", "gold.employee_working_hours.rows",
             "gold.attendance_metrics.rows", "gold.rolling_avg_hours.rows", "gold.early_attrition_overall.rows"]
    verdict = io.frame_from_records(spark, [(f"verdict.{out['gate']}", 0)], "metric string, value long")
    return out["layers"].layer_counts().where(F.col("metric").isin(asked)).union(verdict)
