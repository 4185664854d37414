"""Timesheet models: working hours, attendance metrics, employee-day and
employee summaries, weekly rolling trend, rolling worked-day averages,
buckets, long-shift review and distribution summaries.

Every window here runs on rows already aggregated to employee-day or
employee-week, so a window partition is bounded by the calendar (one row per
day or week), never by the raw punch volume of a hot employee.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workpulse.functions.expr import bucketize, pct, rnd

EMP = "client_employee_id"

# Hour buckets of the employee working-hours report.
HOUR_BUCKET_EDGES = (4, 6, 8, 10)
HOUR_BUCKET_LABELS = ("<4 hrs", "4-6 hrs", "6-8 hrs", "8-10 hrs", "10+ hrs")

# Long-shift investigation rules.
LEAVE_BLOCK_CODES = ("Vacation TM", "LOA - Un Paid TM")
EXTENDED_SHIFT_HOURS = 24.50
EXTENDED_SHIFT_CODE = "Hourly"


def working_hours(ts: DataFrame) -> DataFrame:
    """Per employee: record count ("working days" = rows), hour totals and
    per-record means (x5 for a week), min/max, first/last date."""
    h = F.col("actual_duration_hours")
    return ts.groupBy(EMP).agg(
        F.count("timesheet_id").alias("total_working_days"),
        rnd(F.sum(h), 2).alias("total_hours_worked"),
        rnd(F.avg(h), 2).alias("avg_hours_per_day"),
        rnd(F.avg(h) * 5, 2).alias("avg_hours_per_week"),
        rnd(F.min(h), 2).alias("min_daily_hours"),
        rnd(F.max(h), 2).alias("max_daily_hours"),
        F.min("punch_apply_date").alias("first_work_date"),
        F.max("punch_apply_date").alias("last_work_date"))


def attendance_metrics(ts: DataFrame) -> DataFrame:
    """Per employee: late / early / overtime counts, means, maxima and rates."""
    late, early, ot = (F.col("is_late_arrival"), F.col("is_early_departure"),
                       F.col("is_overtime"))
    out = ts.groupBy(EMP).agg(
        F.count("timesheet_id").alias("total_work_days"),
        F.count(F.when(late, 1)).alias("late_arrival_count"),
        rnd(F.avg(F.when(late, F.col("late_arrival_minutes"))), 1).alias("avg_late_minutes"),
        F.max(F.when(late, F.col("late_arrival_minutes"))).alias("max_late_minutes"),
        F.count(F.when(early, 1)).alias("early_departure_count"),
        rnd(F.avg(F.when(early, F.col("early_departure_minutes"))), 1).alias("avg_early_minutes"),
        F.max(F.when(early, F.col("early_departure_minutes"))).alias("max_early_minutes"),
        F.count(F.when(ot, 1)).alias("overtime_count"),
        rnd(F.sum(F.when(ot, F.col("overtime_hours"))), 2).alias("total_overtime_hours"),
        rnd(F.avg(F.when(ot, F.col("overtime_hours"))), 2).alias("avg_overtime_hours_per_ot_day"),
        rnd(F.max(F.when(ot, F.col("overtime_hours"))), 2).alias("max_overtime_hours"))
    return out.withColumns({
        "late_arrival_rate_pct": pct("late_arrival_count", "total_work_days"),
        "early_departure_rate_pct": pct("early_departure_count", "total_work_days"),
        "overtime_rate_pct": pct("overtime_count", "total_work_days"),
    })


def attendance_daily(ts: DataFrame, emp: DataFrame) -> DataFrame:
    """Employee x work date (rows with a duration only), enriched from the
    master; department = master's, else the punch's (max per day).

    The punch fact is aggregated to employee-day first (partial aggregation
    folds a hot employee map-side) and only the aggregate meets the master,
    deduplicated to one row per id, so the join never fans out or carries raw
    punches.  ``max(coalesce(master, punch))`` per day equals
    ``coalesce(master, max(punch))`` because the master value is constant per id."""
    one = F.lit(1)
    sums = {"total_working_hours": F.col("actual_duration_hours"), "total_scheduled_hours": F.col("scheduled_duration_hours"),
            "late_arrival_count": F.when(F.col("is_late_arrival"), one).otherwise(0),
            "total_late_minutes": F.col("late_arrival_minutes"),
            "early_departure_count": F.when(F.col("is_early_departure"), one).otherwise(0),
            "total_early_departure_minutes": F.col("early_departure_minutes"),
            "overtime_count": F.when(F.col("is_overtime"), one).otherwise(0),
            "total_overtime_hours": F.col("overtime_hours")}
    # The punches are added up with the department among the keys, where the
    # aggregate is a hash table of numbers; the greatest department is then taken
    # of an employee's few rows a day.
    parts = (ts.filter(F.col("actual_duration_hours").isNotNull())
             .groupBy(F.col(EMP), F.col("punch_apply_date").alias("work_date"),
                      F.col("department_name").alias("_dept_name"), F.col("department_id").alias("_dept_id")).agg(
        F.max("employee_master_match").alias("has_employee_master"),
        *[F.sum(v).alias(k) for k, v in sums.items()], F.count(one).alias("timesheet_record_count")))
    daily = parts.groupBy(EMP, "work_date").agg(
        F.max("_dept_name").alias("_t_dept_name"), F.max("_dept_id").alias("_t_dept_id"),
        F.max("has_employee_master").alias("has_employee_master"),
        *[F.sum(k).alias(k) for k in sums], F.sum("timesheet_record_count").alias("timesheet_record_count"))
    dim = emp.groupBy(F.col(EMP).alias("_e_id")).agg(
        F.max("full_name").alias("employee_name"), F.max("job_title").alias("job_title"),
        F.max("employment_status").alias("employment_status"),
        F.max("department_name").alias("_e_dept_name"), F.max("department_id").alias("_e_dept_id"))
    j = daily.join(dim, daily[EMP] == dim["_e_id"], "left")
    return j.select(
        EMP, "work_date", "employee_name", "job_title", "employment_status",
        F.coalesce("_e_dept_name", "_t_dept_name").alias("department_name"),
        F.coalesce("_e_dept_id", "_t_dept_id").alias("department_id"),
        "has_employee_master", "total_working_hours", "total_scheduled_hours",
        "late_arrival_count", "total_late_minutes", "early_departure_count",
        "total_early_departure_minutes", "overtime_count", "total_overtime_hours",
        "timesheet_record_count")


def attendance_summary(daily: DataFrame) -> DataFrame:
    """Per employee from the employee-day table (true per-day means)."""
    n = F.count(F.lit(1))
    return daily.groupBy(EMP).agg(
        F.max("employee_name").alias("employee_name"),
        F.max("job_title").alias("job_title"),
        F.max("employment_status").alias("employment_status"),
        F.max("department_name").alias("primary_department_name"),
        F.max("department_id").alias("primary_department_id"),
        F.max("has_employee_master").alias("has_employee_master"),
        n.alias("total_work_days"),
        F.sum("total_working_hours").alias("total_working_hours"),
        rnd(F.avg("total_working_hours"), 2).alias("avg_working_hours_per_day"),
        F.sum("total_scheduled_hours").alias("total_scheduled_hours"),
        F.sum("late_arrival_count").alias("total_late_arrivals"),
        F.sum("total_late_minutes").alias("total_late_minutes"),
        rnd(F.sum("late_arrival_count") / n * 100, 2).alias("late_arrival_rate_pct"),
        F.sum("early_departure_count").alias("total_early_departures"),
        F.sum("total_early_departure_minutes").alias("total_early_departure_minutes"),
        rnd(F.sum("early_departure_count") / n * 100, 2).alias("early_departure_rate_pct"),
        F.sum("overtime_count").alias("total_overtime_days"),
        F.sum("total_overtime_hours").alias("total_overtime_hours"),
        rnd(F.avg("total_overtime_hours"), 2).alias("avg_overtime_hours_per_day"),
        rnd(F.sum("overtime_count") / n * 100, 2).alias("overtime_frequency_pct"),
        F.min("work_date").alias("first_work_date"),
        F.max("work_date").alias("last_work_date"))


def attendance_trend(daily: DataFrame, weeks: int = 4) -> DataFrame:
    """Employee x week (Monday) with rolling ``weeks``-row metrics.

    Grouped by employee and week only (attributes carried as ``max``), so the
    window's order key is unique within each employee."""
    wk = daily.withColumn("week_start_date", F.date_trunc("week", F.col("work_date")))
    weekly = wk.groupBy(EMP, "week_start_date").agg(
        F.max("employee_name").alias("employee_name"),
        F.max("job_title").alias("job_title"),
        F.max("department_name").alias("department_name"),
        F.max("department_id").alias("department_id"),
        F.count(F.lit(1)).alias("weekly_work_days"),
        F.sum("total_working_hours").alias("weekly_working_hours"),
        rnd(F.avg("total_working_hours"), 2).alias("avg_hours_per_day"),
        F.sum("late_arrival_count").alias("weekly_late_arrivals"),
        F.sum("early_departure_count").alias("weekly_early_departures"),
        F.sum("total_overtime_hours").alias("weekly_overtime_hours"))
    w = Window.partitionBy(EMP).orderBy("week_start_date").rowsBetween(-(weeks - 1), 0)
    days = F.sum("weekly_work_days").over(w)
    return weekly.withColumns({
        f"rolling_{weeks}week_avg_hours": rnd(F.avg("weekly_working_hours").over(w), 2),
        f"rolling_{weeks}week_avg_days": rnd(F.avg("weekly_work_days").over(w), 2),
        f"rolling_{weeks}week_total_late": F.sum("weekly_late_arrivals").over(w),
        f"rolling_{weeks}week_total_early": F.sum("weekly_early_departures").over(w),
        f"rolling_{weeks}week_total_overtime": rnd(F.sum("weekly_overtime_hours").over(w), 2),
        f"rolling_{weeks}week_late_rate_pct": rnd(
            F.sum("weekly_late_arrivals").over(w) / days * 100, 2),
        f"rolling_{weeks}week_early_rate_pct": rnd(
            F.sum("weekly_early_departures").over(w) / days * 100, 2),
    })


def rolling_hours(ts: DataFrame, windows: Sequence[int] = (7, 30), frame: str = "rows"
                  ) -> DataFrame:
    """Per employee-date hours (2 dp) with rolling averages/counts over the last
    N worked days (``frame="rows"``) or N calendar days (``frame="range"``)."""
    daily = (ts.filter(F.col("actual_duration_hours").isNotNull())
             .groupBy(EMP, "punch_apply_date")
             .agg(rnd(F.sum("actual_duration_hours"), 2).alias("actual_duration_hours")))
    base = Window.partitionBy(EMP)
    cols = {}
    for n in windows:
        if frame == "rows":
            w = base.orderBy("punch_apply_date").rowsBetween(-(n - 1), 0)
        elif frame == "range":
            w = base.orderBy(F.unix_date("punch_apply_date")).rangeBetween(-(n - 1), 0)
        else:
            raise ValueError("frame must be 'rows' or 'range'")
        cols[f"rolling_{n}day_avg_hours"] = rnd(F.avg("actual_duration_hours").over(w), 2)
        cols[f"rolling_{n}day_count"] = F.count("actual_duration_hours").over(w)
    return daily.withColumns(cols)


def hours_buckets(wh: DataFrame, col: str = "avg_hours_per_day",
                  edges: Sequence[float] = HOUR_BUCKET_EDGES,
                  labels: Sequence[str] = HOUR_BUCKET_LABELS) -> DataFrame:
    return (wh.withColumn("hours_bucket", bucketize(col, edges, labels))
            .groupBy("hours_bucket").agg(F.count(EMP).alias("employee_count")))


def long_shift_review(ts: DataFrame, threshold: float = 24) -> DataFrame:
    """Records with declared hours above ``threshold`` grouped by an
    investigation class."""
    hw, code = F.col("hours_worked"), F.col("pay_code")
    cls = (F.when(code.isin(*LEAVE_BLOCK_CODES), "Likely payroll-valid leave block")
           .when((hw == F.lit(EXTENDED_SHIFT_HOURS)) & (code == EXTENDED_SHIFT_CODE),
                 "Likely legitimate extended shift")
           .otherwise("Manual review: exceptional long shift"))
    return (ts.filter(hw > threshold).withColumn("investigation_classification", cls)
            .groupBy("investigation_classification")
            .agg(F.count(F.lit(1)).alias("record_count"),
                 F.min(hw).alias("min_hours_worked"), F.max(hw).alias("max_hours_worked")))


def behaviour_segments(summary: DataFrame, thresholds: Mapping[str, tuple[str, float]] | None = None
                       ) -> DataFrame:
    """One row: employees above rate thresholds (strictly greater)."""
    thresholds = thresholds or {
        "high_late_rate_employees": ("late_arrival_rate_pct", 10),
        "high_early_departure_employees": ("early_departure_rate_pct", 10),
        "frequent_overtime_employees": ("overtime_frequency_pct", 20),
    }
    return summary.agg(*[F.count(F.when(F.col(c) > t, 1)).alias(name)
                         for name, (c, t) in thresholds.items()])


def metric_summary(df: DataFrame, cols: Sequence[str], scale: int = 2) -> DataFrame:
    """One row: min, max, range and mean of each column (single pass)."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"),
                 (F.max(c) - F.min(c)).alias(f"range_{c}"), rnd(F.avg(c), scale).alias(f"avg_{c}")]
    return df.agg(*aggs)


def volatility(rolling: DataFrame, value: str = "actual_duration_hours",
               smooth: str = "rolling_7day_avg_hours") -> DataFrame:
    """Per employee: spread of daily hours around the rolling mean."""
    diff = F.abs(F.col(value) - F.col(smooth))
    return rolling.groupBy(EMP).agg(
        F.count(F.lit(1)).alias("worked_days"),
        rnd(F.min(value), 2).alias("min_daily_hours"),
        rnd(F.max(value), 2).alias("max_daily_hours"),
        rnd(F.max(value) - F.min(value), 2).alias("range_daily_hours"),
        rnd(F.avg(diff), 2).alias("avg_abs_dev_from_7day"))
