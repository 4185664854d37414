import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from workpulse.operators import workforce

SCHEMA = "client_employee_id string, hire_date date, term_date date, active_status boolean"
D = dt.date


def test_headcount_term_inclusive_and_term_before_hire_ignored(spark):
    rows = [("1", D(2024, 1, 1), D(2024, 1, 3), False),
            ("2", D(2024, 1, 2), None, True),
            ("3", D(2024, 1, 5), D(2024, 1, 1), False),   # term before hire: never active
            ("4", None, None, True)]                       # no hire date: never active
    emp = spark.createDataFrame(rows, SCHEMA)
    hc = {r.calendar_date: r.active_headcount
          for r in workforce.daily_headcount(emp, as_of=D(2024, 1, 6)).collect()}
    assert hc[D(2024, 1, 1)] == 1 and hc[D(2024, 1, 3)] == 2 and hc[D(2024, 1, 4)] == 1
    assert max(hc) == D(2024, 1, 6)


def test_zero_days_dropped_unless_fill_zero(spark):
    rows = [("1", D(2024, 1, 1), D(2024, 1, 1), False), ("2", D(2024, 1, 4), D(2024, 1, 4), False)]
    emp = spark.createDataFrame(rows, SCHEMA)
    dropped = workforce.daily_headcount(emp, as_of=D(2024, 1, 4)).count()
    filled = workforce.daily_headcount(emp, as_of=D(2024, 1, 4), fill_zero=True).count()
    assert (dropped, filled) == (2, 4)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.one_of(st.none(), st.integers(-5, 40))),
                min_size=1, max_size=15))
def test_sweep_equals_range_join(spark, spans):
    base = D(2024, 1, 1)
    rows = [(str(i), base + dt.timedelta(days=h),
             None if t is None else base + dt.timedelta(days=h + t), True)
            for i, (h, t) in enumerate(spans)]
    emp = spark.createDataFrame(rows, SCHEMA)
    as_of = base + dt.timedelta(days=50)
    a = sorted(map(tuple, workforce.daily_headcount(emp, as_of=as_of).collect()))
    # brute force on the small fixture: every day x every employee
    end = max([as_of] + [r[2] for r in rows if r[2] is not None])
    days = [base + dt.timedelta(days=i) for i in range((end - base).days + 1)]
    counts = {d: sum(1 for _, h, t, _ in rows if h <= d and (t is None or d <= t)) for d in days}
    b = sorted((d, n) for d, n in counts.items() if n > 0)
    assert a == b


def test_early_attrition_bounds(spark):
    rows = [("a", D(2024, 1, 1), D(2024, 1, 1), False),     # day 0
            ("b", D(2024, 1, 1), D(2024, 3, 31), False),    # day 90
            ("c", D(2024, 1, 1), D(2024, 4, 1), False),     # day 91
            ("d", D(2024, 1, 10), D(2024, 1, 1), False),    # negative
            ("e", D(2024, 1, 1), None, True)]
    emp = workforce.with_early_attrition(
        workforce.with_tenure(spark.createDataFrame(rows, SCHEMA), D(2025, 1, 1)))
    got = {r.client_employee_id: r.is_early_attrition for r in emp.collect()}
    assert got == {"a": True, "b": True, "c": False, "d": False, "e": False}
    e = [r for r in emp.collect() if r.client_employee_id == "e"][0]
    assert e.tenure_days == 366 and e.tenure_years == 1.0


def test_turnover_keeps_months_without_terminations(spark):
    rows = [("1", D(2024, 1, 1), D(2024, 3, 15), False), ("2", D(2024, 1, 1), None, True)]
    emp = spark.createDataFrame(rows, SCHEMA).withColumn(
        "termination_reason", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("Voluntary"))
    hc = workforce.daily_headcount(emp, as_of=D(2024, 4, 30))
    t = {r.month.date(): r for r in workforce.monthly_turnover(emp, hc).collect()}
    assert t[D(2024, 1, 1)].terminations == 0 and t[D(2024, 1, 1)].termination_reasons is None
    assert t[D(2024, 3, 1)].terminations == 1
    assert t[D(2024, 3, 1)].turnover_rate_pct == round(1 / ((15 * 2 + 16) / 31) * 100, 2)
