"""Malformed lines, one-pass quarantine, tables replaced in one step, counts of the
writes, managed tables, the contract, and hard gates that stop by default."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from workpulse.operators import dq, quarantine
from workpulse.plans import bindings as B
from workpulse.plans import contract, gates, pipeline
from workpulse.plans.registry import QUERIES
from workpulse.sources import extracts, io, versions

SF = "/root/testdata/sf0.001"
COLS = ["id", "name", "hours"]


def lines_file(tmp_path, text, name="x.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def test_every_line_is_a_row_or_a_reason(spark, tmp_path):
    path = lines_file(tmp_path, "\n".join([
        "id|name|hours", "1|Ann|8", "2|Bob", "3|Cy|7|extra", '4|"open|6', '5|"a|b"|5', '6|"say ""hi"""|4', "",
        "[NULL]||", "id|name|hours", "hours|id|name", '7|""|0']) + "\n")
    rows = [r.asDict() for r in extracts.read_checked_extract(spark, path).collect()]
    good = [(r["id"], r["name"], r["hours"]) for r in rows if r["_corrupt_reason"] is None]
    bad = {r["_corrupt_record"]: r["_corrupt_reason"] for r in rows if r["_corrupt_reason"]}
    assert good == [("1", "Ann", "8"), ("5", "a|b", "5"), ("6", 'say "hi"', "4"), (None, None, None), ("7", "", "0")]
    assert bad == {"2|Bob": "wrong_field_count", "3|Cy|7|extra": "wrong_field_count", '4|"open|6': "broken_quote",
                   "hours|id|name": "other_header"}
    assert all(r["id"] is None and r["name"] is None for r in rows if r["_corrupt_reason"])
    assert all(r["_corrupt_record"] is None for r in rows if r["_corrupt_reason"] is None)


def test_checked_extract_equals_the_plain_one_on_clean_files(spark, tmp_path):
    raw = B.raw_extract(spark, SF).select(*B.RAW_COLUMNS)
    path = str(tmp_path / "clean")
    io.write_extract(raw, path, compression="gzip")
    plain = io.read_extract(spark, path).select(*B.RAW_COLUMNS)
    checked = extracts.read_checked_extract(spark, path)
    assert checked.where("_corrupt_reason IS NOT NULL").count() == 0
    checked = checked.select(*B.RAW_COLUMNS)
    assert checked.exceptAll(plain).count() == 0 and plain.exceptAll(checked).count() == 0
    assert plain.count() == raw.count()


def test_tag_fails_closed_and_keeps_every_row(spark, tmp_path):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, -1.0), (None, 2.0)], "k int, v double")
    tagged = quarantine.tag(df, {"negative": F.col("v") < 0, "no_key": F.col("k").isNull()})
    root = str(tmp_path)
    entry = versions.publish_version(tagged, root, "bronze", "t", partition_by=[quarantine.VERDICT],
                                     metrics=quarantine.verdict_metrics())
    assert entry["metrics"] == {"rows": 4, "good": 1, "quarantined": 3}
    both = versions.load_version(spark, root, "bronze", "t")
    assert [r.k for r in quarantine.good_side(both).collect()] == [1]
    bad = quarantine.bad_side(both).orderBy(F.col("v").asc_nulls_first()).collect()
    assert [(r.k, r.dq_reason) for r in bad] == [(2, "negative"), (3, "negative"), (None, "no_key")]
    assert all(r.dq_checked_at for r in bad)
    assert quarantine.good_side(both).columns == ["k", "v"]


def test_sides_are_partitions_not_filters(spark):
    plan = QUERIES["quarantine_tagged"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(dq_verdict") == 2 and "events.parquet" not in plan
    assert "PushedFilters: []" in plan


def test_a_replacement_is_one_step(spark, tmp_path):
    root = str(tmp_path)
    versions.publish_version(spark.range(5), root, "silver", "t")
    before = io.load(spark, root, "silver", "t")
    broken = spark.range(3).select(F.expr("CAST(raise_error('no') AS INT)").alias("x"))
    with pytest.raises(Exception):
        versions.publish_version(broken, root, "silver", "t")
    assert io.load(spark, root, "silver", "t").count() == 5          # the failed write is not seen
    versions.publish_version(spark.createDataFrame([("a", 1.0)], "k string, v double"), root, "silver", "t")
    assert io.load(spark, root, "silver", "t").columns == ["k", "v"]
    assert before.count() == 5                                      # an old reader goes on
    assert versions.load_version(spark, root, "silver", "t", -2).count() == 5
    assert versions.drop_old(spark, root, "silver", "t", keep=1) == 1
    assert len(versions.manifests(spark, root, "silver", "t")) == 1
    assert io.load(spark, root, "silver", "t").first().k == "a"
    with pytest.raises(FileNotFoundError):
        versions.load_version(spark, root, "silver", "other")


def test_versions_of_empty_and_partitioned_tables(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([], "d string, v long, p string")
    assert versions.publish_version(df, root, "gold", "e", partition_by=["p"])["metrics"]["rows"] == 0
    assert io.load(spark, root, "gold", "e").count() == 0
    df = spark.createDataFrame([("x", 1, "b"), ("y", None, "a")], "d string, v long, p string")
    found = versions.publish_version(df, root, "gold", "e", partition_by=["p"], metrics={"v": F.col("v")})
    assert found["metrics"] == {"rows": 2, "v": 1}
    assert {tuple(r) for r in io.load(spark, root, "gold", "e").collect()} == {("x", 1, "b"), ("y", None, "a")}


def test_counts_of_writes_equal_scans(spark, tmp_path):
    layers = pipeline.Layers(spark, str(tmp_path))
    df = layers.put("silver", "punch", B.timesheet(spark, SF), partition_by=("punch_apply_date",),
                    metrics={"codes": F.col("pay_code_count")})
    got = {r.metric: r.value for r in layers.layer_counts().collect()}
    assert got == {"silver.punch.rows": df.count(),
                   "silver.punch.codes": df.agg(F.sum("pay_code_count")).first()[0]}


def test_counted_gates_see_lost_rows(spark):
    counts = {"bronze.employee.rows": 10, "silver.employee.rows": 8, "silver.employee_quarantine.rows": 1,
              "bronze.timesheet.rows": 20, "bronze.timesheet.good": 15, "silver.timesheet_quarantine.rows": 5,
              "silver.timesheet.rows": 12, "silver.timesheet.copies_removed": 3, "silver.timesheet.codes": 30,
              "silver.timesheet_pay_code.rows": 30}

    def failing(**other):
        frame = io.frame_from_records(spark, list((counts | other).items()), "metric string, value long")
        rep = dq.dq_report(spark, {"layer_counts": frame}, gates.counted_gates())
        return {r.check_id for r in rep.where("status <> 'PASS'").collect()}

    assert failing() == {"GATE_employee_rows"}
    assert failing(**{"silver.employee.rows": 9, "silver.timesheet_pay_code.rows": 29, "bronze.timesheet.rows": 0}) == {
        "GATE_bridge_rows", "GATE_bronze_timesheet_rows", "GATE_quarantine_rows"}


def write_inputs(spark, tmp_path, odd_dates=False):
    lines = B.extract_lines(spark, SF)
    for name in ("extract_a", "extract_b"):
        lines.where(F.col("origin") == f"{name}.csv").select("line").write.text(str(tmp_path / f"timesheet_{name}"))
    emp = (B.employee_raw_odd_dates if odd_dates else B.employee_raw)(spark, SF)
    io.write_extract(emp, str(tmp_path / "employee"))
    return lines.count(), emp.count()


def run(spark, tmp_path, **options):
    return pipeline.run(spark, str(tmp_path / "employee"), str(tmp_path / "timesheet_*"), options.pop("root", None),
                        as_of=B.AS_OF, punch_as_of=dt.date(2024, 2, 1), batch_id="b",
                        timesheet_columns=B.RAW_COLUMNS, **options)


def test_hard_gates_stop_by_default(spark, tmp_path):
    write_inputs(spark, tmp_path)
    root = str(tmp_path / "lake")
    with pytest.raises(RuntimeError, match="GATE_conflicting_copies"):
        run(spark, tmp_path, root=root)
    assert not os.path.isdir(f"{root}/gold")           # nothing was built on a failing gate
    assert io.load(spark, root, "silver", "pipeline_gates").count() == 18


def test_run_keeps_every_line_and_pins_the_verdict(spark, tmp_path):
    n_lines, n_emp = write_inputs(spark, tmp_path, odd_dates=True)
    root = str(tmp_path / "lake")
    zone = spark.conf.get("spark.sql.session.timeZone")
    for _ in range(2):                                  # the second run replaces every table
        out = run(spark, tmp_path, root=root, strict=False)
    assert spark.conf.get("spark.sql.session.timeZone") == zone
    counts = {r.metric: r.value for r in out["layers"].layer_counts().collect()}
    assert counts["bronze.timesheet.rows"] == n_lines
    bad = io.load(spark, root, "silver", "timesheet_quarantine")
    reasons = {r.dq_reason: r["rows"] for r in quarantine.quarantine_counts(bad).collect()}
    assert {"broken_quote", "wrong_field_count", "missing_pay_code", "invalid_employee_id"} <= set(reasons)
    assert all(r._corrupt_record for r in bad.where("dq_reason IN ('broken_quote', 'wrong_field_count')").collect())
    silver = io.load(spark, root, "silver", "timesheet")
    copies = silver.agg(F.sum(F.col("source_duplicate_count") - 1)).first()[0]
    assert silver.count() + copies + bad.count() == n_lines
    emp = io.load(spark, root, "silver", "employee")
    odd = io.load(spark, root, "silver", "employee_quarantine")
    assert emp.count() + odd.count() == n_emp and odd.count() > 0
    assert {r.dq_reason for r in odd.collect()} <= {"missing_employee_id", "invalid_hire_date", "invalid_term_date"}
    assert "_corrupt_record" not in emp.columns and "_corrupt_record" not in silver.columns
    report = io.load(spark, root, "gold", "data_quality_report")
    status = {r.check_id: r.status for r in report.collect()}
    assert len(status) == report.count()
    assert all(v == "PASS" for k, v in status.items() if k.startswith(("DQ_TBL", "DQ_CNT", "DQ011", "DQ012_1")))
    # the bindings' master lacks two contracted dates; two employees left before they came
    assert {k for k, v in status.items() if k.startswith("DQ_SCHEMA") and v == "FAIL"} == {
        "DQ_SCHEMA_TYPE_employee_recent_hire_date", "DQ_SCHEMA_TYPE_employee_anniversary_date"}
    assert out["gate"] == "FAIL" and out["gates_failed"] == ["GATE_conflicting_copies"] + (
        ["GATE_employee_dates"] if "GATE_employee_dates" in out["gates_failed"] else [])
    assert len(versions.manifests(spark, root, "gold", "daily_headcount")) == 2


def test_run_as_managed_tables(spark, tmp_path):
    write_inputs(spark, tmp_path)
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS wpt_{layer} LOCATION '{tmp_path}/wh_{layer}'")
    out = run(spark, tmp_path, prefix="wpt_", strict=False)
    assert all(spark.catalog.tableExists(f"wpt_{t}") for t in contract.TABLES)
    columns = contract.managed_columns(spark, [f"wpt_{t}" for t in contract.TABLES])
    assert columns.where("table_name = 'wpt_gold.daily_headcount'").count() == 2
    spark.sql("DROP TABLE wpt_gold.department_tenure")
    rep = dq.dq_report(spark, {}, dq.check_available("DQ_TBL", spark, contract.TABLES, contract.CRITICAL_TABLES,
                                                     out["layers"].exists))
    assert {r.check_id: r.status for r in rep.where("status <> 'PASS'").collect()} == {
        "DQ_TBL_gold_department_tenure": "FAIL"}


def test_contract_names_what_deviates(spark):
    frames = {"silver.employee": spark.createDataFrame([], "client_employee_id long, hire_date date"),
              "gold.daily_headcount": spark.createDataFrame([], "calendar_date date, active_headcount bigint")}
    rep = contract.contract_report(spark, contract.catalog_columns(spark, frames))
    assert rep.count() == 55 and rep.columns == list(dq.REPORT_FIELDS)
    got = {r.check_id: (r.status, r.actual_value, r.expected_value) for r in rep.collect()}
    assert got["DQ_SCHEMA_TYPE_employee_client_employee_id"] == ("FAIL", "bigint", "string")
    assert got["DQ_SCHEMA_TYPE_employee_hire_date"] == ("PASS", "date", "date")
    assert got["DQ_SCHEMA_EXIST_employee_last_name"] == ("FAIL", "missing", "present")
    assert got["DQ_SCHEMA_TYPE_daily_headcount_active_headcount"][0] == "PASS"


def test_grain_check_sees_nulls_negatives_and_repeats(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 3.0), (2, -1.0), (3, None)], "k int, v double")

    def status(frame, **rules):
        chk = dq.check_grain("G", "t", "g", **rules)
        row = dq.dq_report(spark, {"t": frame}, [chk]).first()
        return row.status, row.actual_value

    assert status(df, keys=["k"], not_null=["v"], not_negative=["v"]) == (
        "FAIL", "rows=4, nulls=1, negative=1, duplicates=1")
    assert status(df.where("v > 2"), keys=["k"], not_null=["v"], not_negative=["v"])[0] == "PASS"
    assert status(df.where("k > 9"), keys=["k"])[0] == "FAIL"
    assert status(df.where("k > 9"))[0] == "FAIL"
