"""KPI report queries, written with the DataFrame API.

Inputs are the silver ``employee`` and ``timesheet`` frames and the gold
``working_hours`` / ``rolling_hours`` frames.  The punch fact is aggregated before
employee attributes are joined to it; no join carries a hint.  Top-k lists use ``orderBy().limit()``
(per-partition top-k then a merge, no global sort) and always end the sort key
with the employee id so ties resolve the same way every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workpulse.functions.expr import rnd
from workpulse.operators.combine import of, tagged_union

EMP = "client_employee_id"


def _dim(emp: DataFrame, cols) -> DataFrame:
    return emp.select(EMP, *cols)


def q01_headcount_on_punch_dates(emp: DataFrame, ts: DataFrame) -> DataFrame:
    """Distinct employees active on each distinct punch date (hire <= d <= term).

    Sweep instead of the spine x employee range join: start (+1) and end (-1, the
    day after the inclusive term) events and the punch dates are unioned, summed
    per date, and a running sum over the distinct dates gives the count at every
    punch date.  Intervals of an id that the master holds more than once are
    merged first, so it counts once a day; a null id is not counted.  Dates with
    nobody active are dropped like the inner join does."""
    valid = emp.filter(F.col(EMP).isNotNull() & F.col("hire_date").isNotNull() &
                       (F.col("term_date").isNull() | (F.col("term_date") >= F.col("hire_date"))))
    steps = valid.select(EMP, F.explode(F.array(
        F.struct(F.col("hire_date").alias("d"), F.lit(1).alias("delta")),
        F.struct(F.date_add("term_date", 1).alias("d"), F.lit(-1).alias("delta")))).alias("s")) \
        .select(EMP, "s.*").filter(F.col("d").isNotNull()).groupBy(EMP, "d").agg(F.sum("delta").alias("delta"))
    # after the aggregate an id has at most one row a day: its window is bounded by the calendar
    one = Window.partitionBy(EMP).orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    on = F.sum("delta").over(one)
    events = steps.select("d", (on > 0).cast("int").alias("now"),
                          (on - F.col("delta") > 0).cast("int").alias("before")).select(
        "d", (F.col("now") - F.col("before")).alias("delta"), F.lit(False).alias("spine"))
    spine = ts.select(F.col("punch_apply_date").alias("d")).filter(F.col("d").isNotNull()) \
        .distinct().select("d", F.lit(0).alias("delta"), F.lit(True).alias("spine"))
    per_day = events.unionByName(spine).groupBy("d").agg(
        F.sum("delta").alias("delta"), F.max("spine").alias("spine"))
    # one row per calendar day: a single ordered window is bounded by the calendar
    w = Window.orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    out = per_day.withColumn("active_headcount", F.sum("delta").over(w).cast("long"))
    return out.filter(F.col("spine") & (F.col("active_headcount") > 0)).select(
        F.col("d").alias("calendar_date"), "active_headcount")


def q02_monthly_terminations(emp: DataFrame) -> DataFrame:
    return (emp.filter(F.col("term_date").isNotNull())
            .groupBy(F.date_trunc("month", "term_date").cast("date").alias("termination_month"))
            .agg(F.count(F.lit(1)).alias("termination_count")))


def q03_tenure_by_department(emp: DataFrame) -> DataFrame:
    return (emp.filter(F.col("tenure_days").isNotNull()).groupBy("department_code")
            .agg(F.count(F.lit(1)).alias("employee_count"),
                 rnd(F.avg("tenure_days") / 365.25, 2).alias("avg_tenure_years"))
            .select(F.coalesce("department_code", F.lit("Unknown")).alias("department"),
                    "employee_count", "avg_tenure_years"))


def q04_top_average_hours(wh: DataFrame, k: int = 20) -> DataFrame:
    return (wh.filter(F.col("total_working_days") > 0)
            .select(EMP, "total_working_days", "total_hours_worked", "avg_hours_per_day")
            .orderBy(F.col("avg_hours_per_day").desc(), F.col(EMP)).limit(k))


def q05_department_hours(wh: DataFrame, emp: DataFrame) -> DataFrame:
    j = wh.filter(F.col("total_working_days") > 0).join(_dim(emp, ["department_code"]), EMP)
    return j.groupBy("department_code").agg(
        F.countDistinct(EMP).alias("employee_count"),
        rnd(F.avg("avg_hours_per_day"), 2).alias("avg_hours_per_day"),
        rnd(F.sum("total_hours_worked"), 2).alias("total_dept_hours"))


def _by_employee(ts, emp, flag, minutes, count_name, hours_name, k):
    """Aggregate the flagged punches per employee first, then attach names."""
    per = ts.filter(F.col(flag)).groupBy(EMP).agg(
        F.count(F.lit(1)).alias(count_name), F.sum(minutes).alias("_m"))
    j = per.join(_dim(emp, ["first_name", "last_name"]), EMP)
    g = j.select(EMP, "first_name", "last_name", count_name,
                 rnd(F.col("_m") / 60.0, 2).alias(hours_name))
    return g.orderBy(F.col(count_name).desc(), F.col(EMP)).limit(k)


def _by_department(ts, emp, flag, count_name, distinct_name, minutes=None, hours_name=None):
    """Per-employee partial counts joined to the department, then summed:
    distinct employees per department = rows of the per-employee aggregate."""
    aggs = [F.count(F.lit(1)).alias("_n")] + ([F.sum(minutes).alias("_m")] if minutes else [])
    per = ts.filter(F.col(flag)).groupBy(EMP).agg(*aggs)
    j = per.join(_dim(emp, ["department_code"]), EMP)
    out = [F.sum("_n").alias(count_name)]
    if minutes:
        out.append(rnd(F.sum("_m") / 60.0, 2).alias(hours_name))
    out.append(F.count(F.lit(1)).alias(distinct_name))
    return j.groupBy("department_code").agg(*out)


def q06_late_by_employee(ts, emp, k=20):
    return _by_employee(ts, emp, "is_late_arrival", "late_arrival_minutes",
                        "late_arrival_count", "total_late_hours", k)


def q07_late_by_department(ts, emp):
    return _by_department(ts, emp, "is_late_arrival", "late_arrival_count",
                          "employees_with_late_arrivals")


def q08_early_by_employee(ts, emp, k=20):
    return _by_employee(ts, emp, "is_early_departure", "early_departure_minutes",
                        "early_departure_count", "total_early_departure_hours", k)


def q09_early_by_department(ts, emp):
    return _by_department(ts, emp, "is_early_departure", "early_departure_count",
                          "employees_with_early_departures")


def q10_overtime_by_employee(ts, emp, k=20):
    return _by_employee(ts, emp, "is_overtime", "overtime_minutes",
                        "overtime_event_count", "total_overtime_hours", k)


def q11_overtime_by_department(ts, emp):
    return _by_department(ts, emp, "is_overtime", "overtime_event_count", "employees_with_overtime",
                          "overtime_minutes", "total_overtime_hours")


def q12_recent_rolling(rolling: DataFrame, k: int = 30) -> DataFrame:
    return (rolling.filter(F.col("punch_apply_date").isNotNull())
            .orderBy(F.col("punch_apply_date").desc(), F.col(EMP)).limit(k)
            .select("punch_apply_date",
                    rnd("actual_duration_hours", 2).alias("daily_hours"),
                    rnd("rolling_7day_avg_hours", 2).alias("avg_7day"),
                    rnd("rolling_30day_avg_hours", 2).alias("avg_30day")))


def qa_attrition_rate(emp: DataFrame) -> DataFrame:
    s = emp.agg(F.count(F.lit(1)).alias("total_employees"),
                F.sum(F.when(F.col("is_early_attrition"), 1).otherwise(0)).cast("long")
                .alias("early_attrition_count"))
    return s.withColumn("early_attrition_rate_pct",
                        F.when(F.col("total_employees") > 0,
                               rnd(F.col("early_attrition_count") * 100.0 / F.col("total_employees"), 2))
                        .otherwise(F.lit(0.0)))


def q13_employee_timesheet_summary(emp: DataFrame, ts: DataFrame, k: int = 20) -> DataFrame:
    """Every employee (left join), punch count and declared hours; top k."""
    per = ts.groupBy(EMP).agg(F.count("timesheet_id").alias("_n"),
                              F.sum("hours_worked").alias("_h"))
    j = emp.select(EMP, "first_name", "last_name", "department_code", "employment_status") \
        .join(per, EMP, "left")
    g = j.groupBy(EMP, "first_name", "last_name", "department_code", "employment_status").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("total_timesheet_records"),
        F.round(F.sum("_h"), 2).alias("total_hours_worked"))
    return g.orderBy(F.col("total_hours_worked").desc_nulls_last(), F.col(EMP)).limit(k)


def q14_tenure_category(emp: DataFrame, k: int = 30) -> DataFrame:
    t, term = F.col("tenure_days"), F.col("term_date")
    cat = (F.when(term.isNotNull() & (t <= 90), "Early Attrition")
           .when(term.isNotNull(), "Terminated")
           .when(t > 365, "Tenured Employee")
           .when(t.between(91, 365), "New Employee")
           .otherwise("Very New Employee"))
    return (emp.select(EMP, "first_name", "last_name", "hire_date", "term_date", "tenure_days",
                       cat.alias("employee_category"))
            .orderBy(t.desc_nulls_last(), F.col(EMP)).limit(k))


def q15_department_rank(emp: DataFrame, ts: DataFrame) -> DataFrame:
    """Aggregate first (one row per department), then the global window."""
    per = ts.groupBy(EMP).agg(F.sum("hours_worked").alias("_h"))
    j = per.join(_dim(emp.filter(F.col("department_code").isNotNull()), ["department_code"]), EMP)
    dept = j.groupBy("department_code").agg(
        F.count(F.lit(1)).alias("employee_count"),
        F.round(F.sum("_h"), 2).alias("total_hours"))
    w_all = Window.partitionBy()
    return dept.select(
        "department_code", "employee_count", "total_hours",
        F.rank().over(Window.orderBy(F.col("total_hours").desc())).alias("hours_rank"),
        rnd(F.col("total_hours").cast("double") * 100.0 /
            F.sum("total_hours").over(w_all).cast("double"), 2).alias("pct_of_total_hours"))


def q16_kpi_summary(emp: DataFrame, wh: DataFrame, ts: DataFrame) -> DataFrame:
    """One row from ONE conditional aggregate over the three inputs (tagged
    union): each input scanned once, no scalar subqueries, no joins."""
    u = tagged_union({
        "e": emp.select("active_status", "term_date", "is_early_attrition"),
        "w": wh.filter(F.col("total_working_days") > 0).select("avg_hours_per_day"),
        "t": ts.select("is_late_arrival", "is_early_departure", "is_overtime", "overtime_minutes"),
    })
    n_emp = F.count(of("e"))
    early = F.count(of("e", F.when(F.col("is_early_attrition"), 1)))
    return u.agg(
        F.count(of("e", F.when(F.col("active_status"), 1))).alias("active_employees"),
        F.count(of("e", F.when(F.col("term_date").isNotNull(), 1))).alias("total_terminations"),
        early.alias("early_attrition_count"),
        rnd(early * 100.0 / F.when(n_emp != 0, n_emp), 2).alias("early_attrition_rate_pct"),
        rnd(F.avg(of("w", F.col("avg_hours_per_day"))), 2).alias("avg_working_hours_per_day"),
        F.count(of("t", F.when(F.col("is_late_arrival"), 1))).alias("total_late_arrivals"),
        F.count(of("t", F.when(F.col("is_early_departure"), 1))).alias("total_early_departures"),
        F.count(of("t", F.when(F.col("is_overtime"), 1))).alias("total_overtime_events"),
        rnd(F.sum(of("t", F.when(F.col("is_overtime"), F.col("overtime_minutes")))) / 60.0, 2)
        .alias("total_overtime_hours"))
