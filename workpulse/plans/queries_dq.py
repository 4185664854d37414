"""Full silver timesheet step and the data-quality report, status and gate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from workpulse.operators import dq, quarantine
from workpulse.plans import bindings as B
from workpulse.plans import dq_suite, gates, pipeline
from workpulse.plans.oracles import PCT, R, silver_chain
from workpulse.plans.queries_model import HEADCOUNT_SQL
from workpulse.plans.queries_core import KEY
from workpulse.plans.queries_silver import KEY_SQL, ORDER_SQL, REASON_SQL
from workpulse.plans.registry import register
from workpulse.sources import io

PUNCH_AS_OF = dt.date(2024, 2, 1)
CHECKED_AT = dt.datetime(2024, 2, 1, 0, 0, 0)

SILVER_CTES = f"""
WITH s_good AS (
  SELECT NULLIF(trim(client_employee_id), '') AS client_employee_id,
    NULLIF(trim(department_id), '') AS department_id, NULLIF(trim(department_name), '') AS department_name,
    NULLIF(trim(pay_code), '') AS pay_code, CAST(hours_worked AS DECIMAL(10,2)) AS hours_worked,
    CAST(punch_apply_date AS DATE) AS punch_apply_date,
    TRY_CAST(punch_in_datetime AS TIMESTAMP) AS punch_in_datetime,
    TRY_CAST(punch_out_datetime AS TIMESTAMP) AS punch_out_datetime,
    TRY_CAST(scheduled_start_datetime AS TIMESTAMP) AS scheduled_start_datetime,
    TRY_CAST(scheduled_end_datetime AS TIMESTAMP) AS scheduled_end_datetime,
    _source_file, _ingested_at, _batch_id
  FROM b_raw WHERE ({REASON_SQL}) IS NULL
),
q_bad AS (SELECT * FROM b_raw WHERE ({REASON_SQL}) IS NOT NULL),
s_dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, count(*) OVER (PARTITION BY {KEY_SQL}) AS source_duplicate_count,
      row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY {ORDER_SQL}) AS rn
    FROM s_good) WHERE rn = 1
),
{silver_chain("s_dedup", "s").strip()},
dq_hc AS ({HEADCOUNT_SQL}),
dq_mt AS (SELECT CAST(p AS TIMESTAMP) AS month, {PCT("coalesce(n, 0)", "a")} AS turnover_rate_pct,
    CAST(coalesce(n, 0) AS BIGINT) AS terminations
  FROM (SELECT date_trunc('month', calendar_date) AS p, avg(active_headcount) AS a FROM dq_hc GROUP BY 1)
  LEFT JOIN (SELECT date_trunc('month', term_date) AS q, count(*) AS n FROM b_employee
             WHERE term_date IS NOT NULL GROUP BY 1) ON p = q),
dq_dt AS (SELECT department_id, {R("avg(tenure_years)")} AS avg_tenure_years FROM b_employee
          GROUP BY department_id, department_code, department_name),
dq_wh AS (SELECT client_employee_id, {R("sum(actual_duration_hours)")} AS total_hours_worked,
            {R("avg(actual_duration_hours) * 5")} AS avg_hours_per_week
          FROM s_silver GROUP BY client_employee_id),
dq_am AS (SELECT client_employee_id, count(*) FILTER (WHERE is_late_arrival) AS late_arrival_count,
   count(*) FILTER (WHERE is_early_departure) AS early_departure_count,
   count(*) FILTER (WHERE is_overtime) AS overtime_count,
   {PCT("count(*) FILTER (WHERE is_late_arrival)", "count(timesheet_id)")} AS late_arrival_rate_pct,
   {PCT("count(*) FILTER (WHERE is_overtime)", "count(timesheet_id)")} AS overtime_rate_pct
   FROM s_silver GROUP BY client_employee_id),
dq_ra AS (SELECT client_employee_id, punch_apply_date, h AS rolling_7day_avg_hours, h AS rolling_30day_avg_hours
  FROM (SELECT client_employee_id, punch_apply_date, {R("sum(actual_duration_hours)")} AS h FROM s_silver
        WHERE actual_duration_hours IS NOT NULL GROUP BY client_employee_id, punch_apply_date)),
dq_ea AS (SELECT {PCT("count(*) FILTER (WHERE is_early_attrition)", "count(*)")} AS early_attrition_rate_pct
          FROM b_employee)
"""


def silver_pair(spark, sf, raw=None):
    raw = B.raw_extract(spark, sf) if raw is None else raw
    silver, bad = pipeline.silver_timesheet(raw, B.master_ids(spark, sf),
                                            checked_at=F.lit(CHECKED_AT).cast("timestamp"))
    return raw, silver, bad


def dq_layers(spark, sf):
    """The layers that the suite and the gates read, each written once as Parquet
    (``spark.checkpoint.dir``) and counted by its write: bronze tagged with the
    verdict of each row, so that good and quarantined rows are its partitions."""
    root = io.scratch_path(spark, "dq")
    checked_at = F.lit(CHECKED_AT).cast("timestamp")
    layers = pipeline.Layers(spark, root)
    employee = layers.put("bronze", "employee", quarantine.tag(
        B.employee_raw(spark, sf), pipeline.employee_reasons(B.employee_raw(spark, sf).columns), checked_at))
    timesheet = layers.put("bronze", "timesheet", quarantine.tag(
        B.raw_extract(spark, sf), pipeline.timesheet_reasons(), checked_at))
    return pipeline.build_silver(layers, employee, timesheet, B.AS_OF)


def dq_frames(spark, sf):
    frames = dq_layers(spark, sf)
    frames.update(dq_suite.gold_frames(frames["employee"], frames["timesheet"]))
    return frames


def report(spark, sf):
    return dq_suite.run_suite(spark, dq_frames(spark, sf), B.AS_OF, PUNCH_AS_OF, CHECKED_AT)


@register("silver_timesheet", SILVER_CTES + "SELECT * FROM s_silver", doubles=("hours_worked",))
def silver_timesheet(spark, sf):
    """Bronze extract -> quarantine -> typing -> dedup -> rules -> flags (the silver timesheet step)."""
    return silver_pair(spark, sf)[1]


@register("dq_report")
def dq_report(spark, sf):
    """DQ-RPT: the full report (one aggregate per frame); text fields, rows-only check."""
    return report(spark, sf)


STATUS_SQL = dq_suite.status_sql(B.AS_OF, PUNCH_AS_OF)


@register("dq_status", SILVER_CTES + "SELECT * FROM (" + STATUS_SQL + ")")
def dq_status(spark, sf):
    """Per-check status of the standard suite."""
    return report(spark, sf).select("check_id", "status")


SEVERITY = {"DQ006_3m": "INFO", "DQ005_3": "WARNING", "DQ006_4b": "WARNING", "DQ006_5a": "WARNING", "DQ006_6a": "WARNING",
            "DQ007": "WARNING", "DQ008_3": "WARNING", "DQ010_4": "WARNING", "DQ011_1": "WARNING",
            "DQ011_2": "WARNING", "DQ011_3": "WARNING"}
_SEV_SQL = "CASE " + " ".join(f"WHEN check_id LIKE '{k}%' THEN '{v}'" for k, v in SEVERITY.items()) + \
    " ELSE 'CRITICAL' END"


@register("dq_summary", SILVER_CTES + f"""
SELECT status, {_SEV_SQL} AS severity, count(*) AS checks FROM (""" + STATUS_SQL + """)
GROUP BY 1, 2""")
def dq_summary(spark, sf):
    """DQ-RPT: checks per status and severity."""
    return dq.dq_summary(report(spark, sf))


@register("dq_gate", SILVER_CTES + """
SELECT count(*) AS total_checks, count(*) FILTER (WHERE status = 'PASS') AS passed,
  count(*) FILTER (WHERE status = 'WARNING') AS warnings,
  count(*) FILTER (WHERE status = 'FAIL') AS failed,
  CASE WHEN count(*) FILTER (WHERE status = 'FAIL') > 0 THEN 'FAIL'
       WHEN count(*) FILTER (WHERE status = 'WARNING') > 0 THEN 'PASS_WITH_WARNINGS'
       ELSE 'PASS' END AS gate_status
FROM (""" + STATUS_SQL + ")")
def dq_gate(spark, sf):
    """DQ-GATE: verdict over the report."""
    return dq.dq_gate(report(spark, sf))


def _gate(cid: str, holds: str) -> str:
    return f"SELECT 'GATE_{cid}' AS check_id, CASE WHEN {holds} THEN 'PASS' ELSE 'FAIL' END AS status"


def _no_row(rel: str, bad: str) -> str:
    return f"NOT EXISTS (SELECT 1 FROM {rel} WHERE {bad})"


def _rows(rel: str, value: str = "count(*)") -> str:
    return f"(SELECT coalesce({value}, 0) FROM {rel})"


def _blank(col: str) -> str:
    return f"{col} IS NULL OR trim(CAST({col} AS VARCHAR)) = ''"


_BRIDGE = ("(SELECT trim(unnest(string_split(pay_code, '|'))) AS pay_code FROM s_silver)")
_FULL_KEY = " AND ".join(f"{k} IS NOT NULL" for k in KEY)

GATES_SQL = SILVER_CTES + "\nUNION ALL\n".join([
    _gate("bronze_employee_rows", _rows("e_raw") + " > 0"),
    _gate("bronze_timesheet_rows", _rows("b_raw") + " > 0"),
    _gate("employee_id", _no_row("b_employee", _blank("client_employee_id"))),
    _gate("employee_unique", _rows("b_employee", "count(*) - count(DISTINCT client_employee_id)") + " = 0"),
    _gate("employee_rows", _rows("e_raw") + " = " + _rows("b_employee")),
    _gate("timesheet_employee_id", _no_row("s_silver", _blank("client_employee_id"))),
    _gate("timesheet_pay_code", _no_row("s_silver", _blank("pay_code"))),
    _gate("timesheet_duration", _no_row("s_silver", "actual_duration_minutes < 0")),
    _gate("timesheet_chronology", _no_row("s_silver", "punch_out_datetime < punch_in_datetime OR "
                                          "scheduled_end_datetime < scheduled_start_datetime")),
    _gate("timesheet_id_unique", _rows("s_silver", "count(*) - count(DISTINCT timesheet_id)") + " = 0"),
    _gate("residual_duplicates", f"NOT EXISTS (SELECT {KEY_SQL} FROM s_silver WHERE {_FULL_KEY} "
                                 f"GROUP BY {KEY_SQL} HAVING count(*) > 1)"),
    _gate("conflicting_copies", f"NOT EXISTS (SELECT {KEY_SQL} FROM s_good WHERE {_FULL_KEY} GROUP BY "
          f"{KEY_SQL} HAVING " + " OR ".join(f"count(DISTINCT {c}) > 1" for c in gates.CONFLICT_COLUMNS) + ")"),
    _gate("quarantine_rows", _rows("b_raw") + " = " + _rows("s_good") + " + " + _rows("q_bad")),
    _gate("timesheet_rows", _rows("s_good") + " = " + _rows("s_silver", "sum(source_duplicate_count)")),
    _gate("bridge_pay_code", _no_row(_BRIDGE, _blank("pay_code"))),
    _gate("bridge_rows", _rows("s_silver", "sum(pay_code_count)") + " = " + _rows(_BRIDGE)),
    _gate("employee_dates", _no_row("e_raw", " OR ".join(
        f"({c} IS NOT NULL AND TRY_CAST(CAST({c} AS VARCHAR) AS DATE) IS NULL)"
        for c in ("hire_date", "term_date")))),
    _gate("punch_times", _no_row("b_raw", " OR ".join(
        f"(trim({c}) <> '' AND TRY_CAST({c} AS TIMESTAMP) IS NULL)"
        for c in pipeline.TIMESHEET_TIMESTAMPS))),
])


@register("pipeline_gates", GATES_SQL)
def pipeline_gates(spark, sf):
    """Hard gates between bronze, silver and gold: status of each."""
    frames = dq_layers(spark, sf)
    return dq.dq_report(spark, frames, gates.gate_checks(frames), CHECKED_AT).select("check_id", "status")
