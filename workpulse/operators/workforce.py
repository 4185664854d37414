"""Employee-master models: tenure, early attrition, daily headcount, turnover,
group tenure and attrition cohorts.

``daily_headcount`` is an interval-coverage count.  Instead of the cross join
of a date spine with every employee (O(days x employees), a nested-loop join),
it sweeps: +1 on the hire date, -1 the day after the (inclusive) term date,
a partial/final aggregate per date (at most one row per calendar day leaves
each map task), then a running sum over the date spine.  Work is
O(employees + days) and no step holds a group larger than the calendar.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workpulse.functions.expr import pct, rnd

DEPARTMENT_KEYS = ("department_id", "department_code", "department_name")


def _date(value) -> F.Column:
    if isinstance(value, (dt.date, str)):
        return F.lit(str(value)).cast("date")
    return value


# --------------------------------------------------------------------------- row level

def with_tenure(df: DataFrame, as_of, hire: str = "hire_date", term: str = "term_date"
                ) -> DataFrame:
    """tenure_end_date = coalesce(term, as_of); tenure_days; tenure_years (/365.25, 2 dp)."""
    out = df.withColumn("tenure_end_date", F.coalesce(F.col(term), _date(as_of)))
    out = out.withColumn("tenure_days", F.datediff("tenure_end_date", hire))
    return out.withColumn("tenure_years", rnd(F.col("tenure_days") / 365.25, 2))


def with_early_attrition(df: DataFrame, max_days: int = 90, hire: str = "hire_date",
                         term: str = "term_date") -> DataFrame:
    """days_to_termination (null unless terminated) and is_early_attrition:
    0 <= days <= max_days, never null."""
    out = df.withColumn("days_to_termination",
                        F.when(F.col(term).isNotNull(), F.datediff(term, hire)))
    d = F.col("days_to_termination")
    return out.withColumn("is_early_attrition",
                          F.coalesce((d >= 0) & (d <= max_days), F.lit(False)))


def employment_status(active: str = "active_status") -> F.Column:
    a = F.col(active)
    return F.when(a == F.lit(True), "Active").when(a == F.lit(False), "Terminated") \
        .otherwise("Unknown")


def status_inconsistency(active: str = "active_status", term: str = "term_date") -> dict:
    """Two predicates: active with a termination date, terminated without one."""
    a = F.col(active)
    return {"active_with_term": (a == F.lit(True)) & F.col(term).isNotNull(),
            "terminated_no_term": (a == F.lit(False)) & F.col(term).isNull()}


# --------------------------------------------------------------------------- headcount

def date_spine(bounds: DataFrame, start: str = "start_date", end: str = "end_date",
               out: str = "calendar_date") -> DataFrame:
    """Explode every day between the two date columns of a one-row frame.  The
    bounds never travel through the driver."""
    return bounds.select(F.explode(F.sequence(F.col(start), F.col(end),
                                              F.expr("INTERVAL 1 DAY"))).alias(out))


def _spine_for(emp: DataFrame, hire: str, end_col, until=None) -> DataFrame:
    last = F.max(end_col) if until is None else F.least(F.max(end_col), _date(until))
    bounds = emp.agg(F.min(hire).alias("start_date"), last.alias("end_date")).where("start_date <= end_date")
    return date_spine(bounds.filter(F.col("start_date").isNotNull()))


def daily_headcount(emp: DataFrame, as_of=None, hire: str = "hire_date", term: str = "term_date",
                    fill_zero: bool = False, until=None) -> DataFrame:
    """Active employees per day between the first hire and the last tenure end
    (``tenure_end_date`` if present, else ``coalesce(term, as_of)``).

    Active on d: ``hire <= d`` and (``term`` is null or ``d <= term``).  Days
    with nobody active are dropped unless ``fill_zero``.  ``until`` is the last day
    at the latest, for masters that write "never" as a date of the year 9999."""
    if "tenure_end_date" in emp.columns:
        end_col = F.col("tenure_end_date")
    elif as_of is not None:
        end_col = F.coalesce(F.col(term), _date(as_of))
    else:
        raise ValueError("need tenure_end_date or as_of")
    spine = _spine_for(emp, hire, end_col, until)

    valid = emp.filter(F.col(hire).isNotNull() &
                       (F.col(term).isNull() | (F.col(term) >= F.col(hire))))
    starts = valid.select(F.col(hire).alias("calendar_date"), F.lit(1).alias("_d"))
    ends = valid.filter(F.col(term).isNotNull()).select(
        F.date_add(F.col(term), 1).alias("calendar_date"), F.lit(-1).alias("_d"))
    deltas = starts.unionByName(ends).groupBy("calendar_date").agg(F.sum("_d").alias("_d"))
    # The spine holds one row per calendar day (bounded by the date range, not
    # by the data), so a single ordered window over it is cheap.
    w = Window.orderBy("calendar_date").rowsBetween(Window.unboundedPreceding, 0)
    out = (spine.join(deltas, "calendar_date", "left")
           .withColumn("active_headcount",
                       F.sum(F.coalesce(F.col("_d"), F.lit(0))).over(w).cast("long"))
           .drop("_d"))
    return out if fill_zero else out.filter(F.col("active_headcount") > 0)


def headcount_on_event_dates(headcount: DataFrame, emp: DataFrame, date_col: str = "term_date"
                             ) -> DataFrame:
    """Headcount on each distinct event date (inner join on the date)."""
    dates = emp.select(F.col(date_col).alias("calendar_date")) \
        .filter(F.col("calendar_date").isNotNull()).distinct()
    return headcount.join(dates, "calendar_date").select("calendar_date", "active_headcount")


# --------------------------------------------------------------------------- turnover

def monthly_turnover(emp: DataFrame, headcount: DataFrame, grain: str = "month",
                     term: str = "term_date", reason: str = "termination_reason") -> DataFrame:
    """Per period (``month``/``quarter``/``year``): avg/min/max daily headcount,
    terminations, turnover % (unrounded mean), sorted distinct reasons.
    Periods come from the headcount days; periods without terminations get 0."""
    terms = (emp.filter(F.col(term).isNotNull())
             .withColumn("_p", F.date_trunc(grain, F.col(term)))
             .groupBy("_p").agg(F.count(F.lit(1)).alias("terminations"),
                                F.array_sort(F.collect_set(reason)).alias("termination_reasons")))
    heads = (headcount.withColumn("_p", F.date_trunc(grain, F.col("calendar_date")))
             .groupBy("_p").agg(F.avg("active_headcount").alias("_avg"),
                                F.min("active_headcount").alias("min_headcount"),
                                F.max("active_headcount").alias("max_headcount")))
    j = heads.join(terms, "_p", "left").withColumn(
        "terminations", F.coalesce(F.col("terminations"), F.lit(0)).cast("long"))
    return j.select(
        F.col("_p").alias(grain),
        rnd("_avg", 1).alias("avg_headcount"),
        "min_headcount", "max_headcount", "terminations",
        pct("terminations", "_avg").alias("turnover_rate_pct"),
        "termination_reasons")


# --------------------------------------------------------------------------- group models

def group_tenure(emp: DataFrame, by: Sequence[str] = DEPARTMENT_KEYS,
                 active: str = "active_status") -> DataFrame:
    """Headcounts and tenure means per group, split active / terminated."""
    a = F.col(active)
    act, term = a == F.lit(True), a == F.lit(False)
    return emp.groupBy(*by).agg(
        F.count("client_employee_id").alias("total_employees"),
        F.count(F.when(act, 1)).alias("active_employees"),
        F.count(F.when(term, 1)).alias("terminated_employees"),
        rnd(F.avg("tenure_days"), 1).alias("avg_tenure_days"),
        rnd(F.avg("tenure_years"), 2).alias("avg_tenure_years"),
        rnd(F.avg(F.when(act, F.col("tenure_days"))), 1).alias("avg_tenure_days_active"),
        rnd(F.avg(F.when(act, F.col("tenure_years"))), 2).alias("avg_tenure_years_active"),
        rnd(F.avg(F.when(term, F.col("tenure_days"))), 1).alias("avg_tenure_days_terminated"),
        rnd(F.avg(F.when(term, F.col("tenure_years"))), 2).alias("avg_tenure_years_terminated"),
        F.min("tenure_days").alias("min_tenure_days"),
        F.max("tenure_days").alias("max_tenure_days"))


def attrition(emp: DataFrame, by: str | Sequence[str] | None = None,
              hire: str = "hire_date", active: str = "active_status") -> DataFrame:
    """Early-attrition rate overall (``by=None``), per group columns, or per hire
    year cohort (``by="hire_year"``)."""
    early = F.count(F.when(F.col("is_early_attrition") == F.lit(True), 1))
    a = F.col(active)
    if by is None:
        out = emp.agg(F.count("client_employee_id").alias("total_employees"),
                      early.alias("early_attrition_count"))
        return out.withColumn("early_attrition_rate_pct",
                              pct("early_attrition_count", "total_employees"))
    if by == "hire_year":
        out = emp.withColumn("hire_year", F.year(hire)).groupBy("hire_year").agg(
            F.count("client_employee_id").alias("total_hires"),
            early.alias("early_attrition_count"),
            F.count(F.when(a == F.lit(True), 1)).alias("still_active"),
            F.count(F.when(a == F.lit(False), 1)).alias("total_terminated"))
        return out.withColumn("early_attrition_rate_pct",
                              pct("early_attrition_count", "total_hires"))
    cols = [by] if isinstance(by, str) else list(by)
    out = emp.groupBy(*cols).agg(
        F.count("client_employee_id").alias("total_employees"),
        early.alias("early_attrition_count"),
        F.count(F.when(a == F.lit(True), 1)).alias("active_employees"),
        F.count(F.when(a == F.lit(False), 1)).alias("terminated_employees"))
    return out.withColumn("early_attrition_rate_pct",
                          pct("early_attrition_count", "total_employees"))


def attrition_detail(emp: DataFrame) -> DataFrame:
    """One row: true / false / null breakdown of the flag and the tenure range of
    the early leavers (single pass)."""
    flag = F.col("is_early_attrition")
    is_true = flag == F.lit(True)
    return emp.agg(
        F.count("client_employee_id").alias("total_employees"),
        F.count(F.when(is_true, 1)).alias("early_attrition_true"),
        F.count(F.when(flag == F.lit(False), 1)).alias("early_attrition_false"),
        F.count(F.when(flag.isNull(), 1)).alias("early_attrition_null"),
        F.min(F.when(is_true, F.col("tenure_days"))).alias("min_tenure_days"),
        F.max(F.when(is_true, F.col("tenure_days"))).alias("max_tenure_days"),
        rnd(F.avg(F.when(is_true, F.col("tenure_days"))), 1).alias("avg_tenure_days"))


def early_leavers(emp: DataFrame) -> DataFrame:
    """Detail list of early-attrition employees."""
    return emp.filter(F.col("is_early_attrition") == F.lit(True)).select(
        "client_employee_id", "hire_date", "term_date", "tenure_days", "department_name",
        "termination_reason", "active_status")
