"""Employee-master queries: cleaning steps, tenure, headcount, turnover,
department tenure and attrition."""

from __future__ import annotations

from pyspark.sql import functions as F

from workpulse.functions import expr as X
from workpulse.operators import clean, refs, workforce
from workpulse.plans import bindings as B
from workpulse.plans.oracles import PCT, R
from workpulse.plans.registry import register

EMP_COLS = ["client_employee_id", "first_name", "last_name", "full_name", "job_title",
            "department_id", "department_code", "department_name", "hire_date", "term_date",
            "active_status", "employment_status", "termination_reason", "fte_status",
            "manager_employee_id", "manager_exists", "scheduled_weekly_hour",
            "tenure_end_date", "tenure_days", "tenure_years", "days_to_termination",
            "is_early_attrition"]


@register("silver_employee", f"SELECT {', '.join(EMP_COLS)} FROM b_employee", doubles=("scheduled_weekly_hour",))
def silver_employee(spark, sf):
    """Bronze employee -> silver (PRJ1-16, JN1) in one chain."""
    return B.employee(spark, sf).select(*EMP_COLS)


# ----------------------------------------------------------------------------- single cleaning ops

@register("blank_to_null", """
SELECT client_employee_id, first_name, NULL::VARCHAR AS middle_name, manager_employee_id FROM e_raw""")
def blank_to_null(spark, sf):
    """PRJ1/2: trim and blank -> NULL over every string column."""
    return clean.blank_to_null(B.employee_raw(spark, sf)).select(
        "client_employee_id", "first_name", "middle_name", "manager_employee_id")


@register("split_code_name", """
SELECT client_employee_id, department_code, department_name FROM e1""")
def split_code_name(spark, sf):
    """PRJ4: ``<code>-<name>`` split at the first dash with fallbacks."""
    return clean.split_code_name(B.employee_raw(spark, sf)).select(
        "client_employee_id", "department_code", "department_name")


@register("decode_flag", """
SELECT client_employee_id, active_status, employment_status FROM b_employee""")
def decode_flag(spark, sf):
    """PRJ10/PRJ13: tri-state flag and status label."""
    e = B.employee_raw(spark, sf).withColumn("active_status", X.decode_flag("active_status"))
    return e.withColumn("employment_status", workforce.employment_status()).select(
        "client_employee_id", "active_status", "employment_status")


@register("employment_status", """
SELECT employment_status, count(*) AS employees FROM b_employee GROUP BY 1""")
def employment_status(spark, sf):
    """PRJ13: Active / Terminated / Unknown label from the tri-state flag."""
    e = B.employee_raw(spark, sf).withColumn("active_status", X.decode_flag("active_status"))
    return e.groupBy(workforce.employment_status().alias("employment_status")).agg(
        F.count(F.lit(1)).alias("employees"))


@register("strip_prefix", "SELECT client_employee_id, termination_reason FROM e1")
def strip_prefix(spark, sf):
    """PRJ12: remove ``^Terminate_Employee_``."""
    return B.employee_raw(spark, sf).select(
        "client_employee_id",
        X.strip_prefix("termination_reason", clean.TERMINATION_PREFIX).alias("termination_reason"))


@register("prettify_enum", "SELECT client_employee_id, fte_status FROM e1")
def prettify_enum(spark, sf):
    """PRJ11: ``Full_time`` -> ``Full Time``."""
    return B.employee_raw(spark, sf).select("client_employee_id",
                                            X.prettify_enum("fte_status").alias("fte_status"))


@register("full_name", "SELECT client_employee_id, full_name FROM e1")
def full_name(spark, sf):
    """PRJ14: null-skipping full name."""
    return B.employee_raw(spark, sf).select(
        "client_employee_id", X.full_name("first_name", "last_name").alias("full_name"))


@register("cast_tolerant", """
SELECT client_employee_id, hire_date, term_date, scheduled_weekly_hour,
  TRY_CAST(client_employee_id AS BIGINT) AS employee_number FROM e_raw""", doubles=("scheduled_weekly_hour",))
def cast_tolerant(spark, sf):
    """PRJ5-9: tolerant date and decimal casts (bad text -> NULL)."""
    e = B.employee_raw(spark, sf)
    e = clean.cast_dates(e, ["hire_date", "term_date"])
    e = clean.cast_columns(e, {"scheduled_weekly_hour": "decimal(10,2)"}, strict=False)
    e = e.withColumn("employee_number", F.col("client_employee_id").try_cast("bigint"))
    return e.select("client_employee_id", "hire_date", "term_date", "scheduled_weekly_hour",
                    "employee_number")


@register("drop_all_null_columns", """
SELECT client_employee_id, first_name, last_name, job_title, department_id, department_name,
  CAST(hire_date AS VARCHAR) AS hire_date, CAST(term_date AS VARCHAR) AS term_date, active_status,
  termination_reason, fte_status, manager_employee_id,
  CAST(scheduled_weekly_hour AS VARCHAR) AS scheduled_weekly_hour FROM e_raw""")
def drop_all_null_columns(spark, sf):
    """PRJ3/PRJ3b: profile non-null counts in one pass and drop empty columns."""
    return clean.drop_all_null_columns(clean.blank_to_null(B.employee_raw(spark, sf)))


@register("tenure", f"""
SELECT client_employee_id, hire_date, term_date, tenure_end_date, tenure_days, tenure_years,
  days_to_termination, is_early_attrition FROM b_employee""")
def tenure(spark, sf):
    """PRJ15/PRJ16: tenure and early-attrition flag (as of 2003-01-01)."""
    e = B.employee_raw(spark, sf)
    e = clean.cast_dates(e, ["hire_date", "term_date"])
    e = workforce.with_early_attrition(workforce.with_tenure(e, B.AS_OF))
    return e.select("client_employee_id", "hire_date", "term_date", "tenure_end_date",
                    "tenure_days", "tenure_years", "days_to_termination", "is_early_attrition")


@register("self_reference_flag", """
SELECT client_employee_id, manager_employee_id, manager_exists FROM b_employee""")
def self_reference_flag(spark, sf):
    """JN1: nullable existence flag of the manager in the same master."""
    e = B.employee_raw(spark, sf)
    return refs.with_reference_flag(e, "manager_employee_id", e, "client_employee_id",
                                    "manager_exists", null_when_missing=True).select(
        "client_employee_id", "manager_employee_id", "manager_exists")


# ----------------------------------------------------------------------------- headcount

HEADCOUNT_SQL = """
SELECT CAST(d.x AS DATE) AS calendar_date, count(*) AS active_headcount
FROM (SELECT min(hire_date) AS s, max(tenure_end_date) AS e FROM b_employee) b,
     generate_series(CAST(b.s AS TIMESTAMP), CAST(b.e AS TIMESTAMP), INTERVAL 1 DAY) d(x)
JOIN b_employee p ON p.hire_date <= CAST(d.x AS DATE)
  AND (p.term_date IS NULL OR CAST(d.x AS DATE) <= p.term_date)
GROUP BY 1"""


def _headcount(spark, sf):
    return workforce.daily_headcount(B.employee(spark, sf))


@register("daily_headcount", HEADCOUNT_SQL)
def daily_headcount(spark, sf):
    """GLD1/JN8/SRC5: active headcount per day (delta sweep, not a range join)."""
    return _headcount(spark, sf)


@register("headcount_on_event_dates", f"""
WITH hc AS ({HEADCOUNT_SQL})
SELECT calendar_date, active_headcount FROM hc
WHERE calendar_date IN (SELECT term_date FROM b_employee WHERE term_date IS NOT NULL)""")
def headcount_on_event_dates(spark, sf):
    """JN11: headcount on termination dates."""
    return workforce.headcount_on_event_dates(_headcount(spark, sf), B.employee(spark, sf))


def _turnover_sql(grain: str) -> str:
    return f"""
WITH hc AS ({HEADCOUNT_SQL}),
terms AS (SELECT CAST(date_trunc('{grain}', term_date) AS DATE) AS p, count(*) AS terminations,
            array_to_string(list_sort(list(DISTINCT termination_reason)
              FILTER (WHERE termination_reason IS NOT NULL)), ',') AS termination_reasons
          FROM b_employee WHERE term_date IS NOT NULL GROUP BY 1),
heads AS (SELECT CAST(date_trunc('{grain}', calendar_date) AS DATE) AS p, avg(active_headcount) AS a,
            min(active_headcount) AS min_headcount, max(active_headcount) AS max_headcount
          FROM hc GROUP BY 1)
SELECT heads.p AS {grain}, {R("a", 1)} AS avg_headcount, min_headcount, max_headcount,
  CAST(coalesce(terms.terminations, 0) AS BIGINT) AS terminations,
  {PCT("coalesce(terms.terminations, 0)", "a")} AS turnover_rate_pct, termination_reasons
FROM heads LEFT JOIN terms ON heads.p = terms.p"""


def _turnover(spark, sf, grain):
    t = workforce.monthly_turnover(B.employee(spark, sf), _headcount(spark, sf), grain=grain)
    return t.withColumns({grain: F.col(grain).cast("date"),
                          "termination_reasons": F.array_join("termination_reasons", ",")})


@register("monthly_turnover", _turnover_sql("month"))
def monthly_turnover(spark, sf):
    """GLD2/JN10: monthly headcount, terminations, rate, reasons."""
    return _turnover(spark, sf, "month")


@register("quarterly_turnover", _turnover_sql("quarter"))
def quarterly_turnover(spark, sf):
    """GLD2 at quarter grain."""
    return _turnover(spark, sf, "quarter")


# ----------------------------------------------------------------------------- group models

DEPT = "department_id, department_code, department_name"


@register("status_inconsistency", """
SELECT count(*) FILTER (WHERE active_status = TRUE AND term_date IS NOT NULL) AS active_with_term,
  count(*) FILTER (WHERE active_status = FALSE AND term_date IS NULL) AS terminated_no_term,
  count(*) FILTER (WHERE term_date < hire_date) AS term_before_hire
FROM b_employee""")
def status_inconsistency(spark, sf):
    """FLT8/FLT7: status vs term-date consistency and term-before-hire."""
    e = B.employee(spark, sf)
    preds = workforce.status_inconsistency()
    preds["term_before_hire"] = X.chronology_violation("hire_date", "term_date")
    return e.agg(*[F.count(F.when(p, 1)).alias(k) for k, p in preds.items()])


@register("recent_headcount", f"""
SELECT * FROM (SELECT * FROM ({HEADCOUNT_SQL}) ORDER BY calendar_date DESC LIMIT 30)""")
def recent_headcount(spark, sf):
    """SRT3: last 30 headcount days, re-sorted ascending."""
    from workpulse.operators import changes
    return changes.recent(_headcount(spark, sf), "calendar_date", 30)


@register("department_tenure", f"""
SELECT {DEPT}, count(client_employee_id) AS total_employees,
  count(*) FILTER (WHERE active_status = TRUE) AS active_employees,
  count(*) FILTER (WHERE active_status = FALSE) AS terminated_employees,
  {R("avg(tenure_days)", 1)} AS avg_tenure_days,
  {R("avg(tenure_years)")} AS avg_tenure_years,
  {R("avg(CASE WHEN active_status = TRUE THEN tenure_days END)", 1)} AS avg_tenure_days_active,
  {R("avg(CASE WHEN active_status = TRUE THEN tenure_years END)")} AS avg_tenure_years_active,
  {R("avg(CASE WHEN active_status = FALSE THEN tenure_days END)", 1)} AS avg_tenure_days_terminated,
  {R("avg(CASE WHEN active_status = FALSE THEN tenure_years END)")} AS avg_tenure_years_terminated,
  min(tenure_days) AS min_tenure_days, max(tenure_days) AS max_tenure_days
FROM b_employee GROUP BY {DEPT}""")
def department_tenure(spark, sf):
    """GLD3: tenure per department."""
    return workforce.group_tenure(B.employee(spark, sf))


@register("attrition_overall", f"""
SELECT count(client_employee_id) AS total_employees,
  count(*) FILTER (WHERE is_early_attrition) AS early_attrition_count,
  {PCT("count(*) FILTER (WHERE is_early_attrition)", "count(client_employee_id)")} AS early_attrition_rate_pct
FROM b_employee""")
def attrition_overall(spark, sf):
    """GLD6: overall early-attrition rate."""
    return workforce.attrition(B.employee(spark, sf))


@register("attrition_by_department", f"""
SELECT {DEPT}, count(client_employee_id) AS total_employees,
  count(*) FILTER (WHERE is_early_attrition) AS early_attrition_count,
  count(*) FILTER (WHERE active_status = TRUE) AS active_employees,
  count(*) FILTER (WHERE active_status = FALSE) AS terminated_employees,
  {PCT("count(*) FILTER (WHERE is_early_attrition)", "count(client_employee_id)")} AS early_attrition_rate_pct
FROM b_employee GROUP BY {DEPT}""")
def attrition_by_department(spark, sf):
    """GLD6: early attrition per department."""
    return workforce.attrition(B.employee(spark, sf), by=list(workforce.DEPARTMENT_KEYS))


@register("attrition_by_cohort", f"""
SELECT CAST(year(hire_date) AS INTEGER) AS hire_year, count(client_employee_id) AS total_hires,
  count(*) FILTER (WHERE is_early_attrition) AS early_attrition_count,
  count(*) FILTER (WHERE active_status = TRUE) AS still_active,
  count(*) FILTER (WHERE active_status = FALSE) AS total_terminated,
  {PCT("count(*) FILTER (WHERE is_early_attrition)", "count(client_employee_id)")} AS early_attrition_rate_pct
FROM b_employee GROUP BY 1""")
def attrition_by_cohort(spark, sf):
    """GLD6: early attrition per hire-year cohort."""
    return workforce.attrition(B.employee(spark, sf), by="hire_year")


@register("attrition_detail", f"""
SELECT count(client_employee_id) AS total_employees,
  count(*) FILTER (WHERE is_early_attrition = TRUE) AS early_attrition_true,
  count(*) FILTER (WHERE is_early_attrition = FALSE) AS early_attrition_false,
  count(*) FILTER (WHERE is_early_attrition IS NULL) AS early_attrition_null,
  min(CASE WHEN is_early_attrition THEN tenure_days END) AS min_tenure_days,
  max(CASE WHEN is_early_attrition THEN tenure_days END) AS max_tenure_days,
  {R("avg(CASE WHEN is_early_attrition THEN tenure_days END)", 1)} AS avg_tenure_days
FROM b_employee""")
def attrition_detail(spark, sf):
    """GLD14: early-attrition breakdown and tenure range."""
    return workforce.attrition_detail(B.employee(spark, sf))


@register("early_leavers", """
SELECT client_employee_id, hire_date, term_date, tenure_days, department_name, termination_reason,
  active_status FROM b_employee WHERE is_early_attrition""")
def early_leavers(spark, sf):
    """GLD14: early-attrition detail list."""
    return workforce.early_leavers(B.employee(spark, sf))
