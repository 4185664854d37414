"""Hard gates see lost, conflicting and unreadable rows; Q1 counts an employee once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from workpulse.operators import codes, dq, quarantine
from workpulse.plans import bindings as B
from workpulse.plans import gates, kpis, pipeline
from workpulse.plans.queries_dq import silver_pair

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def frames(spark):
    raw, silver, bad = silver_pair(spark, SF)
    silver = silver.cache()
    good, _ = quarantine.split_quarantine(raw, pipeline.timesheet_reasons())
    return {"bronze_employee": B.employee_raw(spark, SF), "employee": B.employee(spark, SF),
            "bronze_timesheet": raw, "timesheet_typed": pipeline.type_timesheet(good),
            "quarantine": bad, "timesheet": silver, "bridge": codes.explode_codes(silver)}


def failing(spark, frames):
    rep = dq.dq_report(spark, frames, gates.gate_checks(frames))
    return {r.check_id for r in rep.where("status <> 'PASS'").collect()}


def test_lost_rows_fail_their_gate(spark, frames):
    before = failing(spark, frames)
    assert not before & {"GATE_employee_rows", "GATE_quarantine_rows", "GATE_timesheet_rows",
                         "GATE_bridge_rows", "GATE_punch_times", "GATE_employee_dates"}
    assert "GATE_conflicting_copies" in before            # the bindings hold such copies
    first = frames["timesheet"].agg(F.min("timesheet_id")).first()[0]
    lossy = {**frames,
             "employee": frames["employee"].where("client_employee_id <> '000001'"),
             "quarantine": frames["quarantine"].where("dq_reason <> 'missing_pay_code'"),
             "timesheet": frames["timesheet"].where(F.col("timesheet_id") != first),
             "bridge": frames["bridge"].where("pay_code_position = 0")}
    assert failing(spark, lossy) >= {"GATE_employee_rows", "GATE_quarantine_rows",
                                     "GATE_timesheet_rows", "GATE_bridge_rows"}


def test_unreadable_dates_and_empty_tables_fail(spark, frames):
    bad = {**frames,
           "bronze_employee": frames["bronze_employee"].withColumn("hire_date", F.lit("13/45/2020")),
           "bronze_timesheet": frames["bronze_timesheet"].where("false")}
    got = failing(spark, bad)
    assert got >= {"GATE_employee_dates", "GATE_bronze_timesheet_rows", "GATE_quarantine_rows"}
    rep = dq.dq_report(spark, bad, gates.gate_checks(bad, expected_employees=3))
    with pytest.raises(RuntimeError, match="GATE_employee_expected"):
        dq.require(rep)


def test_missing_columns_are_named(spark, frames):
    short = {**frames, "bronze_timesheet": frames["bronze_timesheet"].drop("pay_code")}
    with pytest.raises(RuntimeError, match="GATE_bronze_timesheet_columns"):
        dq.require(dq.dq_report(spark, {}, gates.column_checks(short)))
    dq.require(dq.dq_report(spark, {}, gates.column_checks(frames)))


def test_headcount_counts_an_employee_once(spark):
    d = dt.date
    emp = spark.createDataFrame(
        [("1", d(2024, 1, 1), None), ("1", d(2024, 1, 1), None), ("1", d(2024, 1, 3), d(2024, 1, 4)),
         ("2", d(2024, 1, 2), d(2024, 1, 3)), ("2", d(2024, 1, 5), d(2024, 1, 5)),
         ("3", d(2024, 1, 5), d(2024, 1, 2)), (None, d(2024, 1, 1), None), ("4", None, None)],
        "client_employee_id string, hire_date date, term_date date")
    ts = spark.createDataFrame([(d(2024, 1, i),) for i in range(1, 7)], "punch_apply_date date")
    got = {r.calendar_date.day: r.active_headcount
           for r in kpis.q01_headcount_on_punch_dates(emp, ts).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 1, 5: 2, 6: 1}
