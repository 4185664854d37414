"""Standard data-quality suite over the pipeline's tables, and the DuckDB
status oracle of every check in it (``STATUS_SQL``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workpulse.operators import dq, hours, workforce
from workpulse.operators.dq import (check_complete, check_count_equals, check_flag_rule, check_grain,
                                    check_predicate, check_range, check_reconcile,
                                    check_reconcile_counted, check_reference, check_unique)
from workpulse.plans import contract

def gold_frames(employee: DataFrame, timesheet: DataFrame) -> dict[str, DataFrame]:
    headcount = workforce.daily_headcount(employee)
    return {"daily_headcount": headcount,
            "monthly_turnover": workforce.monthly_turnover(employee, headcount),
            "department_tenure": workforce.group_tenure(employee),
            "working_hours": hours.working_hours(timesheet),
            "attendance_metrics": hours.attendance_metrics(timesheet),
            "rolling_avg_hours": hours.rolling_hours(timesheet),
            "early_attrition_overall": workforce.attrition(employee)}


def contract_tables(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The suite's frames by the names that the contract gives the tables."""
    names = {"silver.employee": "employee", "silver.timesheet": "timesheet",
             "gold.employee_working_hours": "working_hours"}
    return {t: frames[names.get(t, t.split(".")[1])] for t in contract.TYPES}


def standard_checks(frames: dict[str, DataFrame], as_of: dt.date, punch_as_of: dt.date,
                    grace_minutes: float = 5, max_hours: float = 24) -> list[dq.Check]:
    """Checks over ``bronze_employee``, ``employee``, ``timesheet`` (silver),
    ``bronze_timesheet``, ``quarantine``, ``timesheet_typed`` and the gold frames."""
    a, p = f"DATE '{as_of}'", f"DATE '{punch_as_of}'"
    checks = [
        check_complete("DQ005_1", "employee", "client_employee_id"),
        check_unique("DQ005_2", "employee", ["client_employee_id"]),
        *[check_complete(f"DQ005_3_{k}", "employee", k, severity="WARNING")
          for k in ("department_id", "department_code", "department_name")],
        check_predicate("DQ005_4", "employee", "Employment status consistency", {
            "active_with_term": "active_status = TRUE AND term_date IS NOT NULL",
            "terminated_no_term": "active_status = FALSE AND term_date IS NULL"},
            check_type="consistency"),
        check_predicate("DQ005_5", "employee", "Hire/termination chronology", {
            "term_before_hire": "term_date IS NOT NULL AND hire_date IS NOT NULL AND term_date < hire_date",
            "future_hires": f"hire_date > {a}"}),
        check_range("DQ005_6", "employee", "scheduled_weekly_hour", 0, 80),
        check_unique("DQ006_1", "timesheet", ["timesheet_id"], nulls_fail=True),
        check_complete("DQ006_2", "timesheet", "client_employee_id"),
        check_complete("DQ006_3", "timesheet", "pay_code"),
        dq.check_info("DQ006_3m", "timesheet", "rows with several pay codes", "pay_code LIKE '%|%'"),
        check_range("DQ006_4a", "timesheet", "hours_worked", low=0, name="hours_worked negatives"),
        check_range("DQ006_4b", "timesheet", "hours_worked", high=24, severity="WARNING",
                    name="hours_worked above 24"),
        check_predicate("DQ006_5a", "timesheet", "Punch completeness", {
            "missing_punch_in": "punch_in_datetime IS NULL",
            "missing_punch_out": "punch_out_datetime IS NULL"},
            severity="WARNING", check_type="completeness"),
        check_predicate("DQ006_5b", "timesheet", "Punch chronology", {
            "out_before_in": "punch_out_datetime < punch_in_datetime"}),
        check_predicate("DQ006_6a", "timesheet", "Schedule completeness", {
            "missing_schedule": "scheduled_start_datetime IS NULL OR scheduled_end_datetime IS NULL"},
            severity="WARNING", check_type="completeness"),
        check_predicate("DQ006_6b", "timesheet", "Schedule chronology", {
            "end_before_start": "scheduled_end_datetime < scheduled_start_datetime"}),
        check_predicate("DQ006_6c", "timesheet", "Schedulable flag consistency", {
            "flagged_but_missing": "is_schedulable AND (scheduled_start_datetime IS NULL OR "
                                   "scheduled_end_datetime IS NULL)"}),
        check_reference("DQ007", "timesheet", "client_employee_id", "employee", "client_employee_id"),
        check_unique("DQ008_1", "employee", ["client_employee_id"]),
        check_unique("DQ008_2", "timesheet", ["timesheet_id"], nulls_fail=True),
        check_unique("DQ008_3", "timesheet",
                     ["client_employee_id", "punch_apply_date", "punch_in_datetime",
                      "punch_out_datetime"], severity="WARNING", fail_status="WARNING",
                     require_non_null=True),
        check_predicate("DQ009_1", "timesheet", "No future punch dates", {
            "future_punches": f"punch_apply_date > {p}"}),
        check_predicate("DQ009_2", "employee", "No future hire/term dates", {
            "future_hires": f"hire_date > {a}", "future_terms": f"term_date > {a}"}),
        check_predicate("DQ010_0", "timesheet", "No negative minutes", {
            k: f"{k} < 0" for k in ("actual_duration_minutes", "scheduled_duration_minutes",
                                    "late_arrival_minutes", "early_departure_minutes",
                                    "overtime_minutes")}),
        check_flag_rule("DQ010_1", "timesheet", "is_late_arrival", "arrival_variance_minutes",
                        grace_minutes, guard="is_schedulable"),
        check_flag_rule("DQ010_2", "timesheet", "is_early_departure", "departure_variance_minutes",
                        grace_minutes, guard="is_schedulable"),
        check_flag_rule("DQ010_3", "timesheet", "is_overtime", "schedule_variance_minutes",
                        grace_minutes, guard="is_schedulable"),
        check_count_equals("DQ010_4", "timesheet", "Excessive duration flag count",
                           "is_excessive_duration", f"actual_duration_hours > {max_hours}"),
        *(counted_reconciliations() if "layer_counts" in frames else scanned_reconciliations()),
        check_grain("DQ012_1", "daily_headcount", "Gold: active headcount", ["calendar_date"],
                    ["calendar_date", "active_headcount"], ["active_headcount"]),
        check_grain("DQ012_2", "monthly_turnover", "Gold: turnover trend", ["month"]),
        check_grain("DQ012_3", "department_tenure", "Gold: tenure by department", (),
                    ["department_id", "avg_tenure_years"], ["avg_tenure_years"]),
        check_grain("DQ012_4", "working_hours", "Gold: working hours per employee", ["client_employee_id"],
                    ["client_employee_id", "total_hours_worked"], ["total_hours_worked"]),
        check_grain("DQ012_5", "attendance_metrics", "Gold: attendance metrics", ["client_employee_id"],
                    ["client_employee_id"]),
        check_grain("DQ012_6", "rolling_avg_hours", "Gold: rolling average hours",
                    ["client_employee_id", "punch_apply_date"], ["client_employee_id", "punch_apply_date"]),
        dq.Check("DQ012_7", "Gold: early attrition rate", "early_attrition_overall", "validity", "CRITICAL",
                 {"rows": "count(1)", "valid": dq.cnt("early_attrition_rate_pct BETWEEN 0 AND 100")},
                 "{rows} > 0 AND {valid} = {rows}", dq.concat("rows=", dq.txt("rows"), ", valid=", dq.txt("valid")),
                 "0<=rate<=100", dq.concat(dq.txt("valid"), " of ", dq.txt("rows"), " rates are percentages."),
                 layer="gold"),
        # Rules of our own, so with ids of their own.
        check_range("DQ013_1", "attendance_metrics", "late_arrival_rate_pct", 0, 100, layer="gold"),
        check_range("DQ013_2", "attendance_metrics", "overtime_rate_pct", 0, 100, layer="gold"),
    ]
    return checks


def scanned_reconciliations() -> list[dq.Check]:
    return [
        check_reconcile("DQ011_1", "Bronze employee = silver employee", "bronze_employee",
                        "employee", max_gap=0),
        check_reconcile("DQ011_2", "Typed = silver + duplicate copies removed", "timesheet_typed",
                        "timesheet", [("duplicates_removed", "timesheet",
                                       "source_duplicate_count - 1")], max_gap=0),
        check_reconcile("DQ011_3", "Bronze = typed + quarantined", "bronze_timesheet",
                        "timesheet_typed", ["quarantine"], max_gap=0)]


def counted_reconciliations() -> list[dq.Check]:
    """The same from what the writes counted: no layer is scanned to be counted."""
    return [
        check_reconcile_counted("DQ011_1", "Bronze employee = silver employee + quarantined",
                                "bronze.employee.rows", "silver.employee.rows",
                                ["silver.employee_quarantine.rows"], max_gap=0),
        check_reconcile_counted("DQ011_2", "Good = silver + duplicate copies removed", "bronze.timesheet.good",
                                "silver.timesheet.rows", ["silver.timesheet.copies_removed"], max_gap=0),
        check_reconcile_counted("DQ011_3", "Bronze = good + quarantined", "bronze.timesheet.rows",
                                "bronze.timesheet.good", ["silver.timesheet_quarantine.rows"], max_gap=0)]


def run_suite(spark: SparkSession, frames: dict[str, DataFrame], as_of: dt.date, punch_as_of: dt.date,
              checked_at: dt.datetime | None = None, grace_minutes: float = 5, extra: tuple = ()) -> DataFrame:
    """The report of the standard checks, the contract's columns and types, and ``extra`` checks."""
    checks = standard_checks(frames, as_of, punch_as_of, grace_minutes)
    columns = contract.catalog_columns(spark, contract_tables(frames))
    return dq.dq_report(spark, frames, [*checks, *extra], checked_at).union(
        contract.contract_report(spark, columns, checked_at))


# --------------------------------------------------------------------------- DuckDB status oracle
# Relations: b_employee, s_silver (silver timesheet), b_raw (bronze), q_bad,
# s_good (typed good rows), dq_wh, dq_am, dq_hc (gold).


def _st(cid: str, cond: str, rel: str, fail: str = "FAIL") -> str:
    return (f"SELECT '{cid}' AS check_id, CASE WHEN coalesce(({cond}), FALSE) THEN 'PASS' "
            f"ELSE '{fail}' END AS status FROM {rel}")


def _complete(cid, rel, col, fail="FAIL"):
    return _st(cid, f"count(*) FILTER (WHERE {col} IS NULL OR trim(CAST({col} AS VARCHAR)) = '') = 0",
               rel, fail)


def _unique(cid, rel, keys, fail="FAIL", non_null=False):
    where = (" WHERE " + " AND ".join(f"{k} IS NOT NULL" for k in keys)) if non_null else ""
    return _st(cid, "count(*) FILTER (WHERE n > 1) = 0",
               f"(SELECT count(*) AS n FROM {rel}{where} GROUP BY {', '.join(keys)})", fail)


def _none(cid, rel, pred, fail="FAIL"):
    return _st(cid, f"count(*) FILTER (WHERE {pred}) = 0", rel, fail)


def _grain(cid, rel, keys, not_null=(), not_negative=()):
    bad = " OR ".join([f"{c} IS NULL" for c in not_null] + [f"{c} < 0" for c in not_negative]) or "FALSE"
    twice = (f" AND (SELECT count(*) FROM (SELECT 1 FROM {rel} GROUP BY {', '.join(keys)} HAVING count(*) > 1)) = 0"
             if keys else "")
    return (f"SELECT '{cid}' AS check_id, CASE WHEN (SELECT count(*) FROM {rel}) > 0 AND "
            f"(SELECT count(*) FROM {rel} WHERE {bad}) = 0{twice} THEN 'PASS' ELSE 'FAIL' END AS status")


#: The relation of each contracted table and the contracted columns it does not have.
CONTRACT_RELATIONS = {
    "silver.employee": ("b_employee", ("recent_hire_date", "anniversary_date")),
    "silver.timesheet": ("s_silver", ()), "gold.daily_headcount": ("dq_hc", ()), "gold.monthly_turnover": ("dq_mt", ()),
    "gold.department_tenure": ("dq_dt", ()), "gold.employee_working_hours": ("dq_wh", ()),
    "gold.attendance_metrics": ("dq_am", ()), "gold.rolling_avg_hours": ("dq_ra", ()),
    "gold.early_attrition_overall": ("dq_ea", ())}
SPARK_TYPE = ("replace(replace(replace(lower(t), 'varchar', 'string'), 'integer', 'int'), 'int64', 'bigint')")


def contract_sql() -> str:
    """Status of every rule of the contract, from the types DuckDB gives the columns."""
    parts = []
    for table, (rel, absent) in CONTRACT_RELATIONS.items():
        rules = [("EXIST", c, "") for c in contract.REQUIRED.get(table, ())]
        rules += [("TYPE", c, kind) for c, kind in contract.TYPES[table].items()]
        rows = ", ".join(f"('DQ_SCHEMA_{rule}_{table.split('.')[1]}_{c}', '{kind}', "
                         + ("NULL" if c in absent else f"(SELECT typeof({c}) FROM {rel} LIMIT 1)") + ")"
                         for rule, c, kind in rules)
        parts.append(f"SELECT i AS check_id, CASE WHEN t IS NOT NULL AND contains({SPARK_TYPE}, k) THEN 'PASS' "
                     f"ELSE 'FAIL' END AS status FROM (VALUES {rows}) AS r(i, k, t)")
    return " UNION ALL ".join(parts)


def status_sql(as_of: dt.date, punch_as_of: dt.date) -> str:
    a, p = f"DATE '{as_of}'", f"DATE '{punch_as_of}'"
    parts = [
        _complete("DQ005_1", "b_employee", "client_employee_id"),
        _unique("DQ005_2", "b_employee", ["client_employee_id"]),
        _complete("DQ005_3_department_id", "b_employee", "department_id", "WARNING"),
        _complete("DQ005_3_department_code", "b_employee", "department_code", "WARNING"),
        _complete("DQ005_3_department_name", "b_employee", "department_name", "WARNING"),
        _none("DQ005_4", "b_employee", "(active_status = TRUE AND term_date IS NOT NULL) OR "
              "(active_status = FALSE AND term_date IS NULL)"),
        _none("DQ005_5", "b_employee", f"term_date < hire_date OR hire_date > {a}"),
        _none("DQ005_6", "b_employee", "scheduled_weekly_hour < 0 OR scheduled_weekly_hour > 80"),
        _st("DQ006_1", "count(*) FILTER (WHERE n > 1) = 0 AND coalesce(sum(n) FILTER (WHERE k IS NULL), 0) = 0",
            "(SELECT timesheet_id AS k, count(*) AS n FROM s_silver GROUP BY 1)"),
        _complete("DQ006_2", "s_silver", "client_employee_id"),
        _complete("DQ006_3", "s_silver", "pay_code"),
        "SELECT 'DQ006_3m' AS check_id, 'PASS' AS status",
        _none("DQ006_4a", "s_silver", "hours_worked < 0"),
        _none("DQ006_4b", "s_silver", "hours_worked > 24", "WARNING"),
        _none("DQ006_5a", "s_silver", "punch_in_datetime IS NULL OR punch_out_datetime IS NULL",
              "WARNING"),
        _none("DQ006_5b", "s_silver", "punch_out_datetime < punch_in_datetime"),
        _none("DQ006_6a", "s_silver",
              "scheduled_start_datetime IS NULL OR scheduled_end_datetime IS NULL", "WARNING"),
        _none("DQ006_6b", "s_silver", "scheduled_end_datetime < scheduled_start_datetime"),
        _none("DQ006_6c", "s_silver", "is_schedulable AND (scheduled_start_datetime IS NULL OR "
              "scheduled_end_datetime IS NULL)"),
        _none("DQ007", "(SELECT DISTINCT client_employee_id FROM s_silver WHERE client_employee_id "
              "IS NOT NULL)", "client_employee_id NOT IN (SELECT client_employee_id FROM b_employee)",
              "WARNING"),
        _unique("DQ008_1", "b_employee", ["client_employee_id"]),
        _st("DQ008_2", "count(*) FILTER (WHERE n > 1) = 0 AND coalesce(sum(n) FILTER (WHERE k IS NULL), 0) = 0",
            "(SELECT timesheet_id AS k, count(*) AS n FROM s_silver GROUP BY 1)"),
        _unique("DQ008_3", "s_silver", ["client_employee_id", "punch_apply_date",
                                        "punch_in_datetime", "punch_out_datetime"], "WARNING", True),
        _none("DQ009_1", "s_silver", f"punch_apply_date > {p}"),
        _none("DQ009_2", "b_employee", f"hire_date > {a} OR term_date > {a}"),
        _none("DQ010_0", "s_silver", " OR ".join(f"{k} < 0" for k in (
            "actual_duration_minutes", "scheduled_duration_minutes", "late_arrival_minutes",
            "early_departure_minutes", "overtime_minutes"))),
        _none("DQ010_1", "s_silver", "is_schedulable AND (is_late_arrival <> "
              "coalesce(arrival_variance_minutes > 5, FALSE))"),
        _none("DQ010_2", "s_silver", "is_schedulable AND (is_early_departure <> "
              "coalesce(departure_variance_minutes > 5, FALSE))"),
        _none("DQ010_3", "s_silver", "is_schedulable AND (is_overtime <> "
              "coalesce(schedule_variance_minutes > 5, FALSE))"),
        _st("DQ010_4", "count(*) FILTER (WHERE is_excessive_duration) = "
            "count(*) FILTER (WHERE actual_duration_hours > 24)", "s_silver"),
        "SELECT 'DQ011_1' AS check_id, CASE WHEN (SELECT count(*) FROM e_raw) = (SELECT count(*) "
        "FROM b_employee) THEN 'PASS' ELSE 'WARNING' END AS status",
        "SELECT 'DQ011_3' AS check_id, CASE WHEN (SELECT count(*) FROM b_raw) - (SELECT count(*) "
        "FROM s_good) - (SELECT count(*) FROM q_bad) = 0 THEN 'PASS' ELSE 'WARNING' END AS status",
        "SELECT 'DQ011_2' AS check_id, CASE WHEN (SELECT count(*) FROM s_good) - (SELECT count(*) "
        "FROM s_silver) - (SELECT coalesce(sum(source_duplicate_count - 1), 0) FROM s_silver) = 0 "
        "THEN 'PASS' ELSE 'WARNING' END AS status",
        _grain("DQ012_1", "dq_hc", ["calendar_date"], ["calendar_date", "active_headcount"], ["active_headcount"]),
        _grain("DQ012_2", "dq_mt", ["month"]),
        _grain("DQ012_3", "dq_dt", [], ["department_id", "avg_tenure_years"], ["avg_tenure_years"]),
        _grain("DQ012_4", "dq_wh", ["client_employee_id"], ["client_employee_id", "total_hours_worked"],
               ["total_hours_worked"]),
        _grain("DQ012_5", "dq_am", ["client_employee_id"], ["client_employee_id"]),
        _grain("DQ012_6", "dq_ra", ["client_employee_id", "punch_apply_date"],
               ["client_employee_id", "punch_apply_date"]),
        _st("DQ012_7", "count(*) > 0 AND bool_and(early_attrition_rate_pct >= 0 AND early_attrition_rate_pct <= 100)",
            "dq_ea"),
        _none("DQ013_1", "dq_am", "late_arrival_rate_pct < 0 OR late_arrival_rate_pct > 100"),
        _none("DQ013_2", "dq_am", "overtime_rate_pct < 0 OR overtime_rate_pct > 100"),
        contract_sql(),
    ]
    return "\nUNION ALL\n".join(f"({x})" for x in parts)
