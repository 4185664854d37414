import datetime as dt
import os

from pyspark.sql import functions as F

from workpulse.plans import bindings as B
from workpulse.plans import pipeline
from workpulse.sources import io
from workpulse.streaming import ingest

SF = "/root/testdata/sf0.001"
RAW_COLS = ["client_employee_id", "department_id", "department_name", "pay_code", "hours_worked",
            "punch_apply_date", "punch_in_datetime", "punch_out_datetime",
            "scheduled_start_datetime", "scheduled_end_datetime"]


def _write_inputs(spark, tmp_path):
    raw = B.raw_extract(spark, SF)
    for f in ("extract_a.csv", "extract_b.csv"):
        io.write_extract(raw.filter(F.col("_source_file") == f).select(*RAW_COLS),
                         str(tmp_path / "in" / f"timesheet_{f[:-4]}"))
    io.write_extract(B.employee_raw(spark, SF), str(tmp_path / "in" / "employee"))
    return raw.count()


def test_pipeline_end_to_end(spark, tmp_path):
    n_raw = _write_inputs(spark, tmp_path)
    out = pipeline.run(spark, str(tmp_path / "in" / "employee"),
                       str(tmp_path / "in" / "timesheet_*"), str(tmp_path / "lake"),
                       as_of=B.AS_OF, punch_as_of=dt.date(2024, 2, 1), batch_id="20240201_000000",
                       strict=False)      # the bindings hold copies that differ: a failing gate
    root = str(tmp_path / "lake")
    silver = io.load(spark, root, "silver", "timesheet")
    bad = io.load(spark, root, "silver", "timesheet_quarantine")
    dups = silver.agg(F.sum(F.col("source_duplicate_count") - 1)).first()[0]
    assert silver.count() + bad.count() + dups == n_raw        # nothing silently dropped
    assert out["gate"] in ("PASS", "PASS_WITH_WARNINGS", "FAIL")
    rep = io.load(spark, root, "gold", "data_quality_report")
    assert rep.count() >= 48 + 3
    assert rep.filter(F.col("check_id").startswith("DQ_TBL")).filter("status <> 'PASS'").count() == 0
    assert rep.filter(F.col("check_id") == "DQ011_1").first().status == "PASS"
    assert os.path.isdir(os.path.join(root, "gold", "attendance_rolling_trend"))


def test_stream_ingest_available_now(spark, tmp_path):
    raw = B.raw_extract(spark, SF).select(*RAW_COLS)
    folder = tmp_path / "landing"
    io.write_extract(raw.limit(300), str(folder / "f1"))
    q = ingest.start_bronze_ingest(spark, str(folder / "*"), RAW_COLS, str(tmp_path / "lake"),
                                   str(tmp_path / "ckpt"), pipeline.timesheet_reasons())
    q.awaitTermination(120)
    good = spark.read.parquet(str(tmp_path / "lake" / "bronze" / "timesheet"))
    bad = spark.read.parquet(str(tmp_path / "lake" / "bronze" / "timesheet_quarantine"))
    assert good.count() + bad.count() == 300
    assert bad.filter(F.col("dq_reason").isNull()).count() == 0


def test_stream_restart_is_exactly_once(spark, tmp_path):
    raw = B.raw_extract(spark, SF).select(*RAW_COLS)
    folder = tmp_path / "landing"
    lake, ckpt = str(tmp_path / "lake"), str(tmp_path / "ckpt")

    def run_once():
        q = ingest.start_bronze_ingest(spark, str(folder / "*"), RAW_COLS, lake, ckpt,
                                       pipeline.timesheet_reasons())
        q.awaitTermination(120)

    def total():
        good = spark.read.parquet(f"{lake}/bronze/timesheet").count()
        bad = spark.read.parquet(f"{lake}/bronze/timesheet_quarantine").count()
        return good + bad

    io.write_extract(raw.limit(200), str(folder / "f1"))
    run_once()
    assert total() == 200
    run_once()                                   # restart, nothing new: nothing re-ingested
    assert total() == 200
    io.write_extract(raw.limit(50), str(folder / "f2"))
    run_once()                                   # only the new file is read
    assert total() == 250


def test_pipeline_strict_gate_raises(spark, tmp_path):
    import pytest
    _write_inputs(spark, tmp_path)
    with pytest.raises(RuntimeError, match="data-quality gate FAIL"):
        pipeline.run(spark, str(tmp_path / "in" / "employee"), str(tmp_path / "in" / "timesheet_*"),
                     str(tmp_path / "lake"), as_of=B.AS_OF, punch_as_of=dt.date(2024, 2, 1),
                     strict=True)
