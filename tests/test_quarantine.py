from pyspark.sql import functions as F

from workpulse.plans import pipeline
from workpulse.operators import quarantine

SCHEMA = "client_employee_id string, pay_code string, hours_worked string, punch_apply_date string"


def test_partition_is_exact_and_first_reason_wins(spark):
    rows = [("00001", "Hourly", "8.00", "2024-01-01"),
            (None, None, "x", "2024-01-01"),              # invalid id wins over the rest
            ("Meal break", "Hourly", "8", "2024-01-01"),
            ("00002", "  ", "8", "2024-01-01"),
            ("00003", "Hourly", "2024-01-01 08:00:00.000", "2024-01-01"),
            ("00004", "Hourly", None, "2024-01-01"),
            ("00005", "Hourly", "1", "not a date"),
            ("0 0 6", "Hourly", "1", "2024-01-01"),
            ("00007ADJ FOR", "Hourly", "1", "2024-01-01"),
            ("tardy1", "Hourly", "1", "2024-01-01")]
    df = spark.createDataFrame(rows, SCHEMA)
    good, bad = quarantine.split_quarantine(df, pipeline.timesheet_reasons())
    assert good.count() + bad.count() == df.count()
    reasons = dict((r.pay_code or "", r.dq_reason) for r in bad.collect() if r.client_employee_id == "00002")
    assert reasons == {"  ": "missing_pay_code"}
    got = {r.client_employee_id: r.dq_reason for r in bad.collect()}
    assert got[None] == "invalid_employee_id"
    assert got["Meal break"] == "invalid_employee_id"
    assert got["00003"] == "malformed_hours_worked"
    assert got["00004"] == "missing_hours_worked"
    assert got["00005"] == "invalid_punch_apply_date"
    assert got["tardy1"] == "invalid_employee_id"
    assert [r.client_employee_id for r in good.collect()] == ["00001"]
    assert bad.filter(F.col("dq_checked_at").isNull()).count() == 0


def test_null_predicate_fails_closed(spark):
    df = spark.createDataFrame([("a",), (None,)], "v string")
    good, bad = quarantine.split_quarantine(df, {"v_is_a": F.col("v") != "a"})
    assert good.count() == 1 and bad.count() == 1
