import datetime as dt

import pytest

from workpulse.operators import dq


def frames(spark):
    emp = spark.createDataFrame([("1", 10.0), ("1", -1.0), (None, 5.0), ("", 90.0)],
                                "client_employee_id string, h double")
    return {"emp": emp}


def test_report_single_pass_per_frame_and_statuses(spark):
    f = frames(spark)
    checks = [dq.check_complete("C1", "emp", "client_employee_id"),
              dq.check_range("C2", "emp", "h", 0, 80, severity="WARNING"),
              dq.check_unique("C3", "emp", ["client_employee_id"]),
              dq.check_predicate("C4", "emp", "no negative", {"neg": "h < 0"}),
              dq.check_columns("C5", "emp", f["emp"], ["client_employee_id", "missing_col"])]
    rep = dq.dq_report(spark, f, checks, checked_at=dt.datetime(2024, 1, 1))
    got = {r.check_id: r for r in rep.collect()}
    assert got["C1"].status == "FAIL" and got["C1"].actual_value == "nulls=1, blanks=1"
    assert got["C2"].status == "WARNING" and got["C2"].actual_value.startswith("out_of_range=2")
    assert got["C3"].status == "FAIL" and got["C4"].status == "FAIL"
    assert got["C5"].status == "FAIL" and "missing_col" in got["C5"].actual_value
    assert set(rep.columns) == set(dq.REPORT_FIELDS)
    # C1, C2 and C4 read the same frame: one aggregate for the three of them
    plan = rep._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") <= 5
    gate = dq.dq_gate(rep).first()
    assert gate.gate_status == "FAIL" and gate.failed == 4 and gate.warnings == 1
    with pytest.raises(RuntimeError):
        dq.enforce_gate(rep, strict=True)
    assert dq.enforce_gate(rep, strict=False) == "FAIL"


def test_gate_pass_with_warnings(spark):
    f = frames(spark)
    rep = dq.dq_report(spark, f, [dq.check_range("W", "emp", "h", 0, 50, severity="WARNING")])
    assert dq.dq_gate(rep).first().gate_status == "PASS_WITH_WARNINGS"


def test_reconcile_gap(spark):
    a = spark.range(10)
    b = spark.range(7)
    c = spark.range(2)
    rep = dq.dq_report(spark, {"a": a, "b": b, "c": c},
                       [dq.check_reconcile("R", "r", "a", "b", ["c"]),
                        dq.check_reconcile("R2", "r", "a", "b", ["c"], max_gap=0)])
    got = {r.check_id: r for r in rep.collect()}
    assert got["R"].status == "PASS" and got["R"].actual_value.endswith("unexplained_gap=1")
    assert got["R2"].status == "WARNING"


def test_empty_suite(spark):
    rep = dq.dq_report(spark, {}, [])
    assert rep.count() == 0 and dq.dq_gate(rep).first().gate_status == "PASS"
