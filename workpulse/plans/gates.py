"""Hard gates between the layers: what must hold before gold is built.

Each gate is a CRITICAL check, so all gates of a table compile into one
aggregate (``operators.dq``); ``dq.require`` stops the run on a failing one.
Frames: ``bronze_employee``, ``employee``, ``bronze_timesheet``,
``timesheet_typed``, ``quarantine``, ``timesheet`` (silver), ``bridge``.  With a frame
``layer_counts`` (metric, value: what the writes of the layers counted) the gates on
row numbers read that and scan no table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.operators import clean, dq, keys
from workpulse.plans.pipeline import (EMPLOYEE_DATE_COLUMNS, TIMESHEET_STRINGS,
                                      TIMESHEET_TIMESTAMPS)

#: Columns whose copies must agree for one punch.
CONFLICT_COLUMNS = ("department_id", "pay_code", "hours_worked", "scheduled_start_datetime",
                    "scheduled_end_datetime")


def _unread(cols, fn: str, fmt: str) -> dict[str, str]:
    """Text that is there but is not a date or time of the format."""
    return {f"unread_{c}": f"trim(`{c}`) <> '' AND {fn}(`{c}`, '{fmt}') IS NULL" for c in cols}


def _strings(df: DataFrame, cols) -> list[str]:
    types = dict(df.dtypes)
    return [c for c in cols if types.get(c) == "string"]


def _conflicts(frames: dq.Frames) -> DataFrame:
    """One row per complete natural key with a flag: do its copies differ?  One
    aggregate of minima and maxima (no distinct counts, so rows are not multiplied)."""
    src = frames["timesheet_typed"]
    complete, differ = F.lit(True), F.lit(False)
    for k in keys.TIMESHEET_KEY:
        complete = complete & F.col(k).isNotNull()
    for c in CONFLICT_COLUMNS:
        differ = differ | F.coalesce(F.min(c) != F.max(c), F.lit(False))
    return src.where(complete).groupBy(*keys.TIMESHEET_KEY).agg(differ.alias("_differ"))


def counted_gates() -> list[dq.Check]:
    """The gates on row numbers, over the counts of ``pipeline.run``'s writes."""
    sure = {"severity": "CRITICAL", "fail_status": "FAIL", "max_gap": 0}
    return [
        dq.check_counted("GATE_bronze_employee_rows", "Bronze employee has rows", "bronze.employee.rows",
                         layer="bronze"),
        dq.check_counted("GATE_bronze_timesheet_rows", "Bronze timesheet has rows", "bronze.timesheet.rows",
                         layer="bronze"),
        dq.check_reconcile_counted("GATE_employee_rows", "Bronze employee = silver employee + quarantined",
                                   "bronze.employee.rows", "silver.employee.rows",
                                   ["silver.employee_quarantine.rows"], **sure),
        dq.check_reconcile_counted("GATE_quarantine_rows", "Bronze = good + quarantined",
                                   "bronze.timesheet.rows", "bronze.timesheet.good",
                                   ["silver.timesheet_quarantine.rows"], **sure),
        dq.check_reconcile_counted("GATE_timesheet_rows", "Good = silver + copies removed",
                                   "bronze.timesheet.good", "silver.timesheet.rows",
                                   ["silver.timesheet.copies_removed"], **sure),
        dq.check_reconcile_counted("GATE_bridge_rows", "Codes of all punches = bridge rows",
                                   "silver.timesheet.codes", "silver.timesheet_pay_code.rows", **sure)]


def gate_checks(frames: Mapping[str, DataFrame], expected_employees: int | None = None
                ) -> list[dq.Check]:
    counted = "layer_counts" in frames
    dates = _strings(frames["bronze_employee"], EMPLOYEE_DATE_COLUMNS)
    times = _strings(frames["bronze_timesheet"], TIMESHEET_TIMESTAMPS)
    sure = {"severity": "CRITICAL", "fail_status": "FAIL"}
    checks = [
        dq.check_complete("GATE_employee_id", "employee", "client_employee_id"),
        dq.check_unique("GATE_employee_unique", "employee", ["client_employee_id"]),
        dq.check_complete("GATE_timesheet_employee_id", "timesheet", "client_employee_id"),
        dq.check_complete("GATE_timesheet_pay_code", "timesheet", "pay_code"),
        dq.check_range("GATE_timesheet_duration", "timesheet", "actual_duration_minutes", low=0),
        dq.check_predicate("GATE_timesheet_chronology", "timesheet", "Times in order", {
            "out_before_in": "punch_out_datetime < punch_in_datetime",
            "end_before_start": "scheduled_end_datetime < scheduled_start_datetime"}),
        dq.check_unique("GATE_timesheet_id_unique", "timesheet", ["timesheet_id"], nulls_fail=True),
        dq.check_unique("GATE_residual_duplicates", "timesheet", list(keys.TIMESHEET_KEY),
                        require_non_null=True),
        dq.Check("GATE_conflicting_copies", "Copies of a punch agree", "timesheet_typed",
                 "consistency", "CRITICAL", {"keys": dq.cnt("_differ")}, "{keys} = 0",
                 dq.txt("keys"), "0", dq.concat(dq.txt("keys"), " punches have copies that differ."),
                 frame_key="timesheet_typed|conflicts", frame=_conflicts),
        dq.check_complete("GATE_bridge_pay_code", "bridge", "pay_code"),
    ]
    if counted:
        checks += counted_gates()
    else:
        checks += [
            dq.check_non_empty("GATE_bronze_employee_rows", "bronze_employee", layer="bronze"),
            dq.check_non_empty("GATE_bronze_timesheet_rows", "bronze_timesheet", layer="bronze"),
            dq.check_reconcile("GATE_employee_rows", "Bronze employee = silver employee",
                               "bronze_employee", "employee", max_gap=0, **sure),
            dq.check_reconcile("GATE_quarantine_rows", "Bronze = typed + quarantined",
                               "bronze_timesheet", "timesheet_typed", ["quarantine"], max_gap=0, **sure),
            dq.check_reconcile("GATE_timesheet_rows", "Typed = silver + copies removed",
                               "timesheet_typed", "timesheet",
                               [("copies_removed", "timesheet", "source_duplicate_count - 1")],
                               max_gap=0, **sure),
            dq.check_reconcile("GATE_bridge_rows", "Codes of all punches = bridge rows",
                               ("codes", "timesheet", "pay_code_count"), "bridge", max_gap=0, **sure),
        ]
    if dates:
        checks.append(dq.check_predicate("GATE_employee_dates", "bronze_employee", "Dates can be read",
                                         _unread(dates, "try_to_date", clean.DATE_FORMAT),
                                         layer="bronze"))
    if times:
        checks.append(dq.check_predicate(
            "GATE_punch_times", "bronze_timesheet", "Times can be read",
            _unread(times, "try_to_timestamp", clean.TIMESTAMP_FORMAT), layer="bronze"))
    if expected_employees is not None:
        checks.append(dq.Check("GATE_employee_expected", "Expected employee rows", "employee", "volume",
                               "CRITICAL", {"rows": "count(1)"}, f"{{rows}} = {int(expected_employees)}",
                               dq.txt("rows"), str(expected_employees),
                               dq.concat(dq.txt("rows"), " employee rows.")))
    return checks


def column_checks(frames: Mapping[str, DataFrame]) -> list[dq.Check]:
    """Columns that the silver steps cannot do without."""
    timesheet = (*TIMESHEET_STRINGS, *TIMESHEET_TIMESTAMPS, "hours_worked", "punch_apply_date")
    employee = ("client_employee_id", "first_name", "last_name", "department_name", "hire_date",
                "term_date", "active_status")
    return [dq.check_columns("GATE_bronze_timesheet_columns", "bronze_timesheet",
                             frames["bronze_timesheet"], timesheet, layer="bronze"),
            dq.check_columns("GATE_bronze_employee_columns", "bronze_employee",
                             frames["bronze_employee"], employee, layer="bronze")]
