"""The contract of the published tables, as data: which tables there must be, which
columns they must have, of which types.

``contract_report`` joins it to what a catalog says, so a table, column or type
that deviates is a row that fails, and a new rule is a new row here.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workpulse.operators.dq import REPORT_FIELDS
from workpulse.sources.io import frame_from_records

# The tables of the three layers, those without which nothing
# works, their required columns, and the types (texts that the type must contain).
TABLES = (
    "bronze.employee", "bronze.timesheet",
    "silver.employee", "silver.timesheet", "silver.pay_code_dimension", "silver.timesheet_pay_code",
    "gold.daily_headcount", "gold.monthly_turnover", "gold.department_tenure", "gold.employee_working_hours",
    "gold.attendance_metrics", "gold.attendance_rolling_trend", "gold.rolling_avg_hours",
    "gold.early_attrition_overall", "gold.early_attrition_by_department", "gold.early_attrition_by_cohort",
    "gold.employee_attendance_daily", "gold.employee_attendance_summary")
CRITICAL_TABLES = (
    "bronze.employee", "bronze.timesheet", "silver.employee", "silver.timesheet", "gold.daily_headcount",
    "gold.monthly_turnover", "gold.department_tenure", "gold.employee_working_hours", "gold.attendance_metrics")
REQUIRED = {
    "silver.employee": ("client_employee_id", "first_name", "last_name", "active_status", "hire_date"),
    "silver.timesheet": ("timesheet_id", "client_employee_id", "punch_apply_date", "punch_in_datetime",
                         "punch_out_datetime")}
TYPES = {
    "silver.employee": {
        "client_employee_id": "string", "first_name": "string", "last_name": "string", "hire_date": "date",
        "recent_hire_date": "date", "anniversary_date": "date", "term_date": "date", "active_status": "boolean",
        "scheduled_weekly_hour": "decimal", "employment_status": "string", "tenure_days": "int",
        "tenure_years": "double"},
    "silver.timesheet": {
        "timesheet_id": "string", "client_employee_id": "string", "punch_apply_date": "date",
        "punch_in_datetime": "timestamp", "punch_out_datetime": "timestamp", "hours_worked": "decimal",
        "scheduled_start_datetime": "timestamp", "scheduled_end_datetime": "timestamp",
        "actual_duration_minutes": "double", "actual_duration_hours": "double", "is_late_arrival": "boolean",
        "is_early_departure": "boolean", "is_overtime": "boolean", "is_excessive_duration": "boolean"},
    "gold.daily_headcount": {"calendar_date": "date", "active_headcount": "bigint"},
    "gold.monthly_turnover": {"month": "timestamp", "turnover_rate_pct": "double", "terminations": "bigint"},
    "gold.department_tenure": {"department_id": "string", "avg_tenure_years": "double"},
    "gold.employee_working_hours": {"client_employee_id": "string", "total_hours_worked": "double",
                                    "avg_hours_per_week": "double"},
    "gold.attendance_metrics": {"client_employee_id": "string", "late_arrival_count": "bigint",
                                "early_departure_count": "bigint", "overtime_count": "bigint"},
    "gold.rolling_avg_hours": {"client_employee_id": "string", "punch_apply_date": "date",
                               "rolling_7day_avg_hours": "double", "rolling_30day_avg_hours": "double"},
    "gold.early_attrition_overall": {"early_attrition_rate_pct": "double"}}

CATALOG = "table_name string, column_name string, data_type string"


def catalog_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, data_type) of every column of ``tables``: metadata
    only, a row per column."""
    return frame_from_records(spark, [(t, f.name, f.dataType.simpleString())
                                      for t, df in tables.items() for f in df.schema.fields], CATALOG)


def managed_columns(spark: SparkSession, tables: Iterable[str]) -> DataFrame:
    """The same from the catalog's managed tables; absent ones have no rows."""
    return frame_from_records(spark, [(t, c.name, c.dataType) for t in tables if spark.catalog.tableExists(t)
                                      for c in spark.catalog.listColumns(t)], CATALOG)


def contract_report(spark: SparkSession, columns: DataFrame, checked_at: dt.datetime | None = None) -> DataFrame:
    """The report rows of the required columns and the types of the contract."""
    wanted = frame_from_records(
        spark, [("EXIST", t, c, "") for t, cols in REQUIRED.items() for c in cols]
        + [("TYPE", t, c, kind) for t, cols in TYPES.items() for c, kind in cols.items()],
        "rule string, w_table string, w_column string, wanted string")
    met = wanted.join(columns, (F.col("w_table") == F.col("table_name"))
                      & (F.col("w_column") == F.col("column_name")), "left")
    there, found = F.col("column_name").isNotNull(), F.coalesce("data_type", F.lit("missing"))
    exists = F.col("rule") == "EXIST"
    short = F.substring_index("w_table", ".", -1)
    ok = F.when(exists, there).otherwise(there & F.contains("data_type", F.col("wanted")))
    name = F.concat_ws(".", short, "w_column")
    return met.select(
        F.concat_ws("_", F.lit("DQ_SCHEMA"), "rule", short, "w_column").alias("check_id"),
        F.concat(name, F.when(exists, " exists").otherwise(" type")).alias("check_name"),
        F.substring_index("w_table", ".", 1).alias("layer"), short.alias("table_name"),
        F.lit("schema").alias("check_type"), F.lit("CRITICAL").alias("severity"),
        F.when(exists & there, "present").otherwise(found).alias("actual_value"),
        F.when(exists, "present").otherwise(F.col("wanted")).alias("expected_value"),
        F.when(ok, "PASS").otherwise("FAIL").alias("status"),
        F.concat(name, F.lit(" is "), found, F.lit(".")).alias("message"),
        (F.current_timestamp() if checked_at is None else F.lit(checked_at).cast("timestamp")).alias("checked_at")
    ).select(*REPORT_FIELDS)
