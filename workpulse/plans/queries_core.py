"""Attendance, hours and workforce queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from workpulse.operators import attendance, hours, profile, workforce
from workpulse.plans import bindings as B
from workpulse.plans.oracles import PCT, R
from workpulse.plans.registry import register

KEY = ["client_employee_id", "punch_apply_date", "punch_in_datetime", "punch_out_datetime"]
KEY_SQL = ", ".join(KEY)

# ----------------------------------------------------------------------------- attendance

DUR = ["actual_duration_minutes", "actual_duration_hours", "is_schedulable",
       "scheduled_duration_minutes", "scheduled_duration_hours"]


@register("shift_durations", f"SELECT {KEY_SQL}, {', '.join(DUR)} FROM t_silver")
def shift_durations(spark, sf):
    """PRJ17/18: actual and scheduled durations."""
    return attendance.with_durations(B.punch(spark, sf)).select(*KEY, *DUR)


ADH = ["arrival_variance_minutes", "late_arrival_minutes", "is_late_arrival",
       "departure_variance_minutes", "early_departure_minutes", "is_early_departure",
       "schedule_variance_minutes", "overtime_minutes", "overtime_hours", "is_overtime",
       "is_excessive_duration"]


@register("schedule_adherence", f"SELECT {KEY_SQL}, {', '.join(ADH)} FROM t_silver")
def schedule_adherence(spark, sf):
    """PRJ19-22: late arrival, early departure, overtime, excessive duration (grace 5)."""
    return attendance.with_schedule_adherence(B.punch(spark, sf)).select(*KEY, *ADH)


@register("hours_variance",
          f"SELECT {KEY_SQL}, hours_worked, actual_duration_hours, hours_worked_vs_punch_variance "
          "FROM t_silver", doubles=("hours_worked",))
def hours_variance(spark, sf):
    """PRJ23: declared minus punched hours."""
    t = attendance.with_hours_variance(attendance.with_durations(B.punch(spark, sf)))
    return t.select(*KEY, "hours_worked", "actual_duration_hours", "hours_worked_vs_punch_variance")


@register("completeness_matrix", """
SELECT count(*) FILTER (WHERE punch_in_datetime IS NOT NULL AND punch_out_datetime IS NOT NULL) AS both_present,
  count(*) FILTER (WHERE punch_in_datetime IS NOT NULL AND punch_out_datetime IS NULL) AS only_punch_in_datetime,
  count(*) FILTER (WHERE punch_in_datetime IS NULL AND punch_out_datetime IS NOT NULL) AS only_punch_out_datetime,
  count(*) FILTER (WHERE punch_in_datetime IS NULL AND punch_out_datetime IS NULL) AS neither,
  count(*) AS total_rows
FROM b_punch""")
def completeness_matrix(spark, sf):
    """AG7: punch completeness."""
    return profile.completeness_matrix(B.punch(spark, sf), "punch_in_datetime", "punch_out_datetime")


@register("chronology_violation", """
SELECT count(*) FILTER (WHERE punch_in_datetime IS NOT NULL AND punch_out_datetime IS NOT NULL
         AND punch_out_datetime < punch_in_datetime) AS punch_out_before_in,
  count(*) FILTER (WHERE scheduled_start_datetime IS NOT NULL AND scheduled_end_datetime IS NOT NULL
         AND scheduled_end_datetime < scheduled_start_datetime) AS schedule_end_before_start,
  count(*) FILTER (WHERE punch_in_datetime IS NOT NULL AND scheduled_end_datetime IS NOT NULL
         AND scheduled_end_datetime < punch_in_datetime) AS schedule_end_before_punch_in
FROM b_punch""")
def chronology_violation(spark, sf):
    """FLT7: end before start (null-aware)."""
    t = attendance.with_chronology_flags(B.punch(spark, sf), {
        "punch_out_before_in": ("punch_in_datetime", "punch_out_datetime"),
        "schedule_end_before_start": ("scheduled_start_datetime", "scheduled_end_datetime"),
        "schedule_end_before_punch_in": ("punch_in_datetime", "scheduled_end_datetime"),
    })
    flags = ["punch_out_before_in", "schedule_end_before_start", "schedule_end_before_punch_in"]
    return t.agg(*[F.count(F.when(F.col(f), 1)).alias(f) for f in flags])


# ----------------------------------------------------------------------------- hours models

@register("attendance_metrics", f"""
SELECT client_employee_id,
  count(timesheet_id) AS total_work_days,
  count(*) FILTER (WHERE is_late_arrival) AS late_arrival_count,
  {R("avg(CASE WHEN is_late_arrival THEN late_arrival_minutes END)", 1)} AS avg_late_minutes,
  max(CASE WHEN is_late_arrival THEN late_arrival_minutes END) AS max_late_minutes,
  count(*) FILTER (WHERE is_early_departure) AS early_departure_count,
  {R("avg(CASE WHEN is_early_departure THEN early_departure_minutes END)", 1)} AS avg_early_minutes,
  max(CASE WHEN is_early_departure THEN early_departure_minutes END) AS max_early_minutes,
  count(*) FILTER (WHERE is_overtime) AS overtime_count,
  {R("sum(CASE WHEN is_overtime THEN overtime_hours END)")} AS total_overtime_hours,
  {R("avg(CASE WHEN is_overtime THEN overtime_hours END)")} AS avg_overtime_hours_per_ot_day,
  {R("max(CASE WHEN is_overtime THEN overtime_hours END)")} AS max_overtime_hours,
  {PCT("count(*) FILTER (WHERE is_late_arrival)", "count(timesheet_id)")} AS late_arrival_rate_pct,
  {PCT("count(*) FILTER (WHERE is_early_departure)", "count(timesheet_id)")} AS early_departure_rate_pct,
  {PCT("count(*) FILTER (WHERE is_overtime)", "count(timesheet_id)")} AS overtime_rate_pct
FROM t_silver GROUP BY client_employee_id""")
def attendance_metrics(spark, sf):
    """GLD5: per-employee late / early / overtime metrics."""
    return hours.attendance_metrics(B.timesheet(spark, sf))


@register("working_hours", f"""
SELECT client_employee_id, count(timesheet_id) AS total_working_days,
  {R("sum(actual_duration_hours)")} AS total_hours_worked,
  {R("avg(actual_duration_hours)")} AS avg_hours_per_day,
  {R("avg(actual_duration_hours) * 5")} AS avg_hours_per_week,
  {R("min(actual_duration_hours)")} AS min_daily_hours,
  {R("max(actual_duration_hours)")} AS max_daily_hours,
  min(punch_apply_date) AS first_work_date, max(punch_apply_date) AS last_work_date
FROM t_silver GROUP BY client_employee_id""")
def working_hours(spark, sf):
    """GLD4: per-employee working hours (per-record means)."""
    return hours.working_hours(B.timesheet(spark, sf))


DAILY_SQL = """
SELECT t.client_employee_id, t.punch_apply_date AS work_date,
  max(e.full_name) AS employee_name, max(e.job_title) AS job_title,
  max(e.employment_status) AS employment_status,
  max(coalesce(e.department_name, t.department_name)) AS department_name,
  max(coalesce(e.department_id, t.department_id)) AS department_id,
  bool_or(t.employee_master_match) AS has_employee_master,
  sum(t.actual_duration_hours) AS total_working_hours,
  sum(t.scheduled_duration_hours) AS total_scheduled_hours,
  CAST(sum(CASE WHEN t.is_late_arrival THEN 1 ELSE 0 END) AS BIGINT) AS late_arrival_count,
  sum(t.late_arrival_minutes) AS total_late_minutes,
  CAST(sum(CASE WHEN t.is_early_departure THEN 1 ELSE 0 END) AS BIGINT) AS early_departure_count,
  sum(t.early_departure_minutes) AS total_early_departure_minutes,
  CAST(sum(CASE WHEN t.is_overtime THEN 1 ELSE 0 END) AS BIGINT) AS overtime_count,
  sum(t.overtime_hours) AS total_overtime_hours,
  count(*) AS timesheet_record_count
FROM t_silver t LEFT JOIN b_employee e ON t.client_employee_id = e.client_employee_id
WHERE t.actual_duration_hours IS NOT NULL
GROUP BY t.client_employee_id, t.punch_apply_date"""

DAILY_FLOATS = ["total_working_hours", "total_scheduled_hours", "total_late_minutes",
                "total_early_departure_minutes", "total_overtime_hours"]


def _daily(spark, sf):
    return hours.attendance_daily(B.timesheet(spark, sf), B.employee(spark, sf))


def _round_cols(df, cols, scale=2):
    from workpulse.functions.expr import rnd
    return df.withColumns({c: rnd(c, scale) for c in cols})


def _round_sql(cols, scale=2):
    return ", ".join(f"{R(c, scale)} AS {c}" for c in cols)


@register("attendance_daily", f"""
SELECT * EXCLUDE ({', '.join(DAILY_FLOATS)}), {_round_sql(DAILY_FLOATS)} FROM ({DAILY_SQL})""")
def attendance_daily(spark, sf):
    """GLD7: employee x day, master-enriched (sums shown at 2 dp)."""
    return _round_cols(_daily(spark, sf), DAILY_FLOATS)


SUMMARY_FLOATS = ["total_working_hours", "total_scheduled_hours", "total_late_minutes",
                  "total_early_departure_minutes", "total_overtime_hours"]


def _summary_sql():
    return f"""
SELECT client_employee_id, max(employee_name) AS employee_name, max(job_title) AS job_title,
  max(employment_status) AS employment_status, max(department_name) AS primary_department_name,
  max(department_id) AS primary_department_id, bool_or(has_employee_master) AS has_employee_master,
  count(*) AS total_work_days,
  {R("sum(total_working_hours)")} AS total_working_hours,
  {R("avg(total_working_hours)")} AS avg_working_hours_per_day,
  {R("sum(total_scheduled_hours)")} AS total_scheduled_hours,
  CAST(sum(late_arrival_count) AS BIGINT) AS total_late_arrivals,
  {R("sum(total_late_minutes)")} AS total_late_minutes,
  {PCT("sum(late_arrival_count)", "count(*)")} AS late_arrival_rate_pct,
  CAST(sum(early_departure_count) AS BIGINT) AS total_early_departures,
  {R("sum(total_early_departure_minutes)")} AS total_early_departure_minutes,
  {PCT("sum(early_departure_count)", "count(*)")} AS early_departure_rate_pct,
  CAST(sum(overtime_count) AS BIGINT) AS total_overtime_days,
  {R("sum(total_overtime_hours)")} AS total_overtime_hours,
  {R("avg(total_overtime_hours)")} AS avg_overtime_hours_per_day,
  {PCT("sum(overtime_count)", "count(*)")} AS overtime_frequency_pct,
  min(work_date) AS first_work_date, max(work_date) AS last_work_date
FROM ({DAILY_SQL}) d GROUP BY client_employee_id"""


@register("attendance_summary", _summary_sql())
def attendance_summary(spark, sf):
    """GLD8: per employee from the employee-day table."""
    return _round_cols(hours.attendance_summary(_daily(spark, sf)), SUMMARY_FLOATS)


@register("behaviour_segments", f"""
SELECT count(*) FILTER (WHERE late_arrival_rate_pct > 10) AS high_late_rate_employees,
  count(*) FILTER (WHERE early_departure_rate_pct > 10) AS high_early_departure_employees,
  count(*) FILTER (WHERE overtime_frequency_pct > 20) AS frequent_overtime_employees
FROM ({_summary_sql()}) s""")
def behaviour_segments(spark, sf):
    """AG17: employees above rate thresholds."""
    return hours.behaviour_segments(hours.attendance_summary(_daily(spark, sf)))


TREND_FLOATS = ["weekly_working_hours", "weekly_overtime_hours"]


@register("attendance_trend", f"""
WITH w AS (
  SELECT client_employee_id, CAST(date_trunc('week', work_date) AS DATE) AS week_start_date,
    max(employee_name) AS employee_name, max(job_title) AS job_title,
    max(department_name) AS department_name, max(department_id) AS department_id,
    count(*) AS weekly_work_days, sum(total_working_hours) AS weekly_working_hours,
    {R("avg(total_working_hours)")} AS avg_hours_per_day,
    sum(late_arrival_count) AS weekly_late_arrivals,
    sum(early_departure_count) AS weekly_early_departures,
    sum(total_overtime_hours) AS weekly_overtime_hours
  FROM ({DAILY_SQL}) d GROUP BY client_employee_id, CAST(date_trunc('week', work_date) AS DATE)
), r AS (
  SELECT *,
    {R("avg(weekly_working_hours) OVER win")} AS rolling_4week_avg_hours,
    {R("avg(weekly_work_days) OVER win")} AS rolling_4week_avg_days,
    CAST(sum(weekly_late_arrivals) OVER win AS BIGINT) AS rolling_4week_total_late,
    CAST(sum(weekly_early_departures) OVER win AS BIGINT) AS rolling_4week_total_early,
    {R("sum(weekly_overtime_hours) OVER win")} AS rolling_4week_total_overtime,
    {R("sum(weekly_late_arrivals) OVER win / sum(weekly_work_days) OVER win * 100")} AS rolling_4week_late_rate_pct,
    {R("sum(weekly_early_departures) OVER win / sum(weekly_work_days) OVER win * 100")} AS rolling_4week_early_rate_pct
  FROM w WINDOW win AS (PARTITION BY client_employee_id ORDER BY week_start_date
    ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)
)
SELECT * EXCLUDE (weekly_working_hours, weekly_overtime_hours, weekly_late_arrivals, weekly_early_departures),
  CAST(weekly_late_arrivals AS BIGINT) AS weekly_late_arrivals,
  CAST(weekly_early_departures AS BIGINT) AS weekly_early_departures,
  {_round_sql(TREND_FLOATS)} FROM r""")
def attendance_trend(spark, sf):
    """GLD9/WN4: employee x week with rolling 4-week metrics."""
    t = hours.attendance_trend(_daily(spark, sf))
    t = t.withColumn("week_start_date", F.col("week_start_date").cast("date"))
    return _round_cols(t, TREND_FLOATS)


@register("rolling_hours", f"""
WITH d AS (
  SELECT client_employee_id, punch_apply_date, {R("sum(actual_duration_hours)")} AS actual_duration_hours
  FROM t_silver WHERE actual_duration_hours IS NOT NULL GROUP BY client_employee_id, punch_apply_date
)
SELECT *,
  {R("avg(actual_duration_hours) OVER w7")} AS rolling_7day_avg_hours,
  count(actual_duration_hours) OVER w7 AS rolling_7day_count,
  {R("avg(actual_duration_hours) OVER w30")} AS rolling_30day_avg_hours,
  count(actual_duration_hours) OVER w30 AS rolling_30day_count
FROM d WINDOW
  w7 AS (PARTITION BY client_employee_id ORDER BY punch_apply_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
  w30 AS (PARTITION BY client_employee_id ORDER BY punch_apply_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def rolling_hours(spark, sf):
    """GLD10/WN2/WN3: rolling 7/30 worked-day averages."""
    return hours.rolling_hours(B.timesheet(spark, sf))


@register("rolling_hours_calendar", f"""
WITH d AS (
  SELECT client_employee_id, punch_apply_date, {R("sum(actual_duration_hours)")} AS actual_duration_hours
  FROM t_silver WHERE actual_duration_hours IS NOT NULL GROUP BY client_employee_id, punch_apply_date
)
SELECT *,
  {R("avg(actual_duration_hours) OVER w7")} AS rolling_7day_avg_hours,
  count(actual_duration_hours) OVER w7 AS rolling_7day_count
FROM d WINDOW
  w7 AS (PARTITION BY client_employee_id ORDER BY punch_apply_date
         RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)""")
def rolling_hours_calendar(spark, sf):
    """GLD10 option: calendar-day (RANGE) frame instead of worked-day rows."""
    return hours.rolling_hours(B.timesheet(spark, sf), windows=(7,), frame="range")


@register("volatility", f"""
WITH d AS (
  SELECT client_employee_id, punch_apply_date, {R("sum(actual_duration_hours)")} AS actual_duration_hours
  FROM t_silver WHERE actual_duration_hours IS NOT NULL GROUP BY client_employee_id, punch_apply_date
), r AS (
  SELECT *, {R("avg(actual_duration_hours) OVER (PARTITION BY client_employee_id ORDER BY punch_apply_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)")} AS rolling_7day_avg_hours
  FROM d
)
SELECT client_employee_id, count(*) AS worked_days,
  {R("min(actual_duration_hours)")} AS min_daily_hours, {R("max(actual_duration_hours)")} AS max_daily_hours,
  {R("max(actual_duration_hours) - min(actual_duration_hours)")} AS range_daily_hours,
  {R("avg(abs(actual_duration_hours - rolling_7day_avg_hours))")} AS avg_abs_dev_from_7day
FROM r GROUP BY client_employee_id""")
def volatility(spark, sf):
    """AG16: per-employee spread of daily hours."""
    return hours.volatility(hours.rolling_hours(B.timesheet(spark, sf), windows=(7,)))


@register("hours_buckets", f"""
WITH wh AS (SELECT client_employee_id, {R("avg(actual_duration_hours)")} AS a
            FROM t_silver GROUP BY client_employee_id)
SELECT CASE WHEN a < 4 THEN '<4 hrs' WHEN a < 6 THEN '4-6 hrs' WHEN a < 8 THEN '6-8 hrs'
  WHEN a < 10 THEN '8-10 hrs' ELSE '10+ hrs' END AS hours_bucket,
  count(client_employee_id) AS employee_count
FROM wh GROUP BY 1""")
def hours_buckets(spark, sf):
    """PRJ28: employees per average-hours bucket."""
    return hours.hours_buckets(hours.working_hours(B.timesheet(spark, sf)))


@register("long_shift_review", """
SELECT CASE WHEN pay_code IN ('Vacation TM', 'LOA - Un Paid TM') THEN 'Likely payroll-valid leave block'
    WHEN hours_worked = 24.50 AND pay_code = 'Hourly' THEN 'Likely legitimate extended shift'
    ELSE 'Manual review: exceptional long shift' END AS investigation_classification,
  count(*) AS record_count, min(hours_worked) AS min_hours_worked, max(hours_worked) AS max_hours_worked
FROM t_silver WHERE hours_worked > 24 GROUP BY 1""", doubles=("min_hours_worked", "max_hours_worked"))
def long_shift_review(spark, sf):
    """GLD13: records with declared hours > 24 by investigation class."""
    return hours.long_shift_review(B.timesheet(spark, sf))


@register("metric_summary", f"""
WITH am AS (SELECT client_employee_id,
   {PCT("count(*) FILTER (WHERE is_late_arrival)", "count(timesheet_id)")} AS late_arrival_rate_pct,
   {PCT("count(*) FILTER (WHERE is_overtime)", "count(timesheet_id)")} AS overtime_rate_pct
   FROM t_silver GROUP BY client_employee_id)
SELECT min(late_arrival_rate_pct) AS min_late_arrival_rate_pct, max(late_arrival_rate_pct) AS max_late_arrival_rate_pct,
  max(late_arrival_rate_pct) - min(late_arrival_rate_pct) AS range_late_arrival_rate_pct,
  {R("avg(late_arrival_rate_pct)")} AS avg_late_arrival_rate_pct,
  min(overtime_rate_pct) AS min_overtime_rate_pct, max(overtime_rate_pct) AS max_overtime_rate_pct,
  max(overtime_rate_pct) - min(overtime_rate_pct) AS range_overtime_rate_pct,
  {R("avg(overtime_rate_pct)")} AS avg_overtime_rate_pct
FROM am""")
def metric_summary(spark, sf):
    """AG16: distribution summary of per-employee rates."""
    am = hours.attendance_metrics(B.timesheet(spark, sf))
    return hours.metric_summary(am, ["late_arrival_rate_pct", "overtime_rate_pct"])
