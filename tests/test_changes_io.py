import pytest
import os

from pyspark.sql import functions as F

from workpulse.operators import changes
from workpulse.sources import io

BASE = "k long, name string, seg string"
CH = "k long, op string, set_fields array<string>, name string, seg string"


def test_partial_update_null_vs_unset_and_rejects(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], BASE)
    ch = spark.createDataFrame([
        (1, "U", ["seg"], "ignored", None),      # set seg to NULL, keep name
        (2, "D", [], None, None),
        (4, "I", ["name", "seg"], "d", "w"),
        (3, "I", ["name"], "dup-key", None),     # key exists
        (9, "U", ["name"], "zz", None),          # key not found
        (5, "I", ["name"], "e", None), (5, "I", ["name"], "f", None),   # duplicate change
        (3, "X", [], None, None)], CH)
    snap, rej = changes.apply_changes(base, ch, "k")
    got = {r.k: (r.name, r.seg) for r in snap.collect()}
    assert got == {1: ("a", None), 3: ("c", "z"), 4: ("d", "w")}
    reasons = sorted((r.k, r.reject_reason) for r in rej.collect())
    assert reasons == [(3, "duplicate_change"), (3, "duplicate_change"), (5, "duplicate_change"),
                       (5, "duplicate_change"), (9, "key_not_found")]


def test_lookup_page_orders_and_rejects_a_larger_limit(spark):
    df = spark.range(3000).withColumn("d", F.lit("2024-01-01").cast("date"))
    rows = changes.lookup_page(df, ["d", "id"], offset=10, limit=1000).collect()
    assert len(rows) == changes.MAX_PAGE and rows[0].id == 10
    with pytest.raises(ValueError):
        changes.lookup_page(df, ["d", "id"], limit=5000)
    assert changes.lookup_page(df, ["d", "id"], limit=2000, max_page=2000).count() == 2000


def test_every_change_is_applied_or_rejected(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], BASE)
    ch = spark.createDataFrame([
        (1, None, ["seg"], "n", "s"), (None, "I", [], "p", None), (None, "I", [], "q", None),
        (2, "U", ["nope"], "z", None), (7, "I", [], "new", None)], CH)
    snap, rej = changes.apply_changes(base, ch, "k")
    assert sorted(r.reject_reason for r in rej.collect()) == ["null_key", "null_key", "unknown_field",
                                                              "unknown_op"]
    assert {r.k: r.name for r in snap.collect()} == {1: "a", 2: "b", 7: "new"}


def test_extract_roundtrip_with_lineage(spark, tmp_path):
    df = spark.createDataFrame([("00001", "A|B", None, "  "), ("00002", 'q"uote', "1.5", "")],
                               "id string, code string, h string, blank string")
    path = str(tmp_path / "timesheet_a")
    io.write_extract(df, path, compression="gzip")
    back = io.with_lineage(io.read_extract(spark, str(tmp_path / "timesheet_*")), batch_id="b1")
    rows = sorted(back.collect(), key=lambda r: r.id)
    assert [(r.id, r.code, r.h, r.blank) for r in rows] == \
        [("00001", "A|B", None, "  "), ("00002", 'q"uote', "1.5", "")]
    assert all(r._batch_id == "b1" and "timesheet_a" in r._source_file for r in rows)


def test_publish_and_load(spark, tmp_path):
    root = str(tmp_path / "lake")
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    io.publish(df, root, "gold", "t")
    assert os.path.isdir(os.path.join(root, "gold", "t"))
    assert io.load(spark, root, "gold", "t").count() == 5
    m = io.materialize(df)
    assert m.count() == 5


def test_serving_projection(spark):
    df = spark.createDataFrame([(1, float("nan"), "secret")], "id long, v double, pii string")
    out = io.serving_projection(df, ["id", "v"]).first()
    assert out.asDict() == {"id": 1, "v": None}


def test_managed_tables_and_catalog_checks(spark):
    from workpulse.operators import dq
    df = spark.range(4).withColumn("x", F.col("id") + 1)
    name = io.publish(df, None, "wp_silver", "t1")
    assert name == "wp_silver.t1"
    io.publish(df.withColumn("y", F.lit(1)), None, "wp_silver", "t1")     # schema replaced
    assert io.load(spark, None, "wp_silver", "t1").columns == ["id", "x", "y"]
    checks = dq.check_available("DQ_TBL", spark, ["wp_silver.t1", "wp_silver.nope"],
                                critical=["wp_silver.t1"])
    rep = {r.check_id: r.status for r in dq.dq_report(spark, {}, checks).collect()}
    assert rep == {"DQ_TBL_wp_silver_t1": "PASS", "DQ_TBL_wp_silver_nope": "WARNING"}
    inv = {r.table_name: (r.row_count, r.exists) for r in
           io.catalog_inventory(spark, ["wp_silver.t1", "wp_silver.nope"]).collect()}
    assert inv == {"wp_silver.t1": (4, True), "wp_silver.nope": (None, False)}
