"""Merges in one shuffle of the base, conflicts without multiplied rows, salted code
roll-up, uniqueness by grouping sets, keyed layouts, spines with sentinel dates."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from workpulse.operators import changes, codes, dq, hours, keys, workforce
from workpulse.plans import bindings as B
from workpulse.sources import io, versions

SF = "/root/testdata/sf0.001"
BASE = "k long, name string, seg string"
CH = "k long, op string, set_fields array<string>, name string, seg string"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_updates_without_fields_are_rejected(spark):
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (None, "n", "n"), (3, "c", "z")], BASE)
    ch = spark.createDataFrame([(1, "U", [], "z", "z"), (2, "U", None, "z", "z"), (3, "U", ["seg"], "z", None),
                                (9, "D", None, None, None), (None, "D", None, None, None)], CH)
    snap, rej = changes.apply_changes(base, ch, "k")
    assert {tuple(r) for r in snap.collect()} == {(1, "a", "x"), (2, "b", None), (None, "n", "n"), (3, "c", None)}
    assert {(r.k, r.reject_reason) for r in rej.collect()} == {(1, "no_field"), (2, "no_field"),
                                                              (9, "key_not_found"), (None, "null_key")}
    assert rej.columns == [*ch.columns, "reject_reason"] and snap.columns == base.columns


def test_rows_that_share_a_base_key_all_stay(spark):
    base = spark.createDataFrame([(1, "a", "x"), (1, "b", "y")], BASE)
    ch = spark.createDataFrame([(1, "U", ["seg"], None, "new")], CH)
    assert {tuple(r) for r in changes.apply_changes(base, ch, "k")[0].collect()} == {(1, "a", "new"), (1, "b", "new")}


def test_a_merge_reads_each_side_once(spark, tmp_path, no_broadcast):
    base, ch = str(tmp_path / "base"), str(tmp_path / "ch")
    spark.createDataFrame([(i, "a", "x") for i in range(50)], BASE).write.parquet(base)
    spark.createDataFrame([(i, "U", ["seg"], None, "y") for i in range(9)], CH).write.parquet(ch)
    snap, _ = changes.apply_changes(spark.read.parquet(base), spark.read.parquet(ch), "k")
    text = plan(snap)
    assert text.count("FileScan") == 2 and text.count("Exchange hashpartitioning") == 2
    hot = spark.range(5000).select(F.lit(7).cast("long").alias("k"), F.lit("U").alias("op"),
                                   F.array(F.lit("seg")).alias("set_fields"), F.lit(None).cast("string").alias("name"),
                                   F.col("id").cast("string").alias("seg"))
    snap, rej = changes.apply_changes(spark.read.parquet(base), hot, "k")
    assert rej.where("reject_reason = 'duplicate_change'").count() == 5000 and snap.where("seg = 'x'").count() == 50


def test_conflicts_equal_plain_distinct_counts(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", None), (1, "b", 1.0), (2, "a", 1.0), (2, "a", 1.0), (3, None, 1.0),
                                (3, "z", 1.0), (None, "a", 1.0), (None, "b", 1.0), (4, "c", 1.0), (4, "c", 2.0)],
                               "k int, p string, v double")
    got = {tuple(r) for r in keys.duplicate_conflicts(df, ["k"], ["p", "v"]).collect()}
    assert got == {(1, 2, 1), (4, 1, 2)}
    got = {tuple(r) for r in keys.duplicate_conflicts(df, ["k"], ["p", "v"], require_complete_key=False).collect()}
    assert got == {(1, 2, 1), (4, 1, 2), (None, 2, 1)}
    text = plan(keys.duplicate_conflicts(df, ["k"], ["p", "v"]))
    # rows are multiplied only above the semi join with the conflicting keys
    assert text.index("Expand") < text.index("LeftSemi")


def test_a_hot_pay_code_is_spread(spark, no_broadcast):
    bridge = spark.range(20000).select(F.col("id").cast("string").alias("timesheet_id"), F.when(
        F.col("id") % 10 == 0, F.concat(F.lit("c"), F.col("id") % 100)).otherwise("Hourly").alias("pay_code"))
    dim = codes.code_dimension(bridge)
    made = codes.rollup_code_flags(bridge, dim, salts=32)
    want = {r.timesheet_id: r.is_leave_pay_code for r in bridge.join(dim, "pay_code").collect()}
    assert {r.timesheet_id: r.has_leave_pay_code for r in made.collect()} == want
    text = plan(made)
    assert "SortMergeJoin [pay_code" in text and "_salt" in text
    spread = bridge.withColumn("_salt", F.pmod(F.xxhash64("timesheet_id"), F.lit(32)))
    tasks = sorted(r["count"] for r in spread.repartition(16, "pay_code", "_salt").groupBy(
        F.spark_partition_id()).count().collect())
    one_by_code = spread.repartition(16, "pay_code").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert one_by_code >= 18_000 and tasks[-1] <= 0.25 * 20_000


def test_all_uniqueness_checks_of_a_table_are_one_pass(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", None), (2, "a", None), (2, "a", None), (None, "c", 5)],
                               "k int, s string, n int")
    checks = [dq.check_unique("A", "t", ["k"]), dq.check_unique("B", "t", ["s", "n"]),
              dq.check_unique("C", "t", ["s", "n"], require_non_null=True), dq.check_unique("D", "t", ["k"], nulls_fail=True),
              dq.check_unique("E", "t", ["k", "s", "n"])]
    rep = dq.dq_report(spark, {"t": df}, checks)
    got = {r.check_id: (r.status, r.actual_value) for r in rep.collect()}
    assert got == {"A": ("FAIL", "duplicate_groups=2, null_keys=1"), "B": ("FAIL", "duplicate_groups=1, null_keys=3"),
                   "C": ("PASS", "duplicate_groups=0, null_keys=0"), "D": ("FAIL", "duplicate_groups=2, null_keys=1"),
                   "E": ("FAIL", "duplicate_groups=1, null_keys=4")}
    assert rep._jdf.queryExecution().optimizedPlan().toString().count("Expand") == 1


def test_employee_days_add_up_in_a_hash_aggregate(spark):
    text = plan(hours.attendance_daily(B.timesheet(spark, SF), B.employee(spark, SF)))
    leaf = text[text.rindex("HashAggregate"):]
    assert "SortAggregate" not in leaf          # nothing below the first aggregate sorts the punches


def test_a_year_9999_does_not_explode_the_spine(spark):
    d = dt.date
    emp = spark.createDataFrame([("1", d(2024, 1, 1), d(9999, 12, 31)), ("2", d(2024, 1, 2), d(2024, 1, 3))],
                                "client_employee_id string, hire_date date, term_date date")
    got = {r.calendar_date.day: r.active_headcount
           for r in workforce.daily_headcount(emp, as_of=d(2024, 1, 5), until=d(2024, 1, 5)).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 1, 5: 1}


def test_bucketed_lookups_leave_the_table_where_it_is(spark, tmp_path, no_broadcast):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS wpt_keyed LOCATION '{tmp_path}/keyed'")
    io.publish(spark.range(1000).withColumn("v", F.col("id") * 2), None, "wpt_keyed", "t", bucket_by=(4, ["id"]))
    asked = spark.createDataFrame([(i,) for i in (5, 7, 7, 2000)], "id long")
    found = changes.lookup_many(io.load(spark, None, "wpt_keyed", "t"), "id", asked)
    text = plan(found)
    assert sorted(r.id for r in found.collect()) == [5, 7]
    scan = text[text.index("FileScan"):]
    assert "Bucketed: true" in scan and text.index("Exchange") > text.index("FileScan")
    with pytest.raises(ValueError):
        io.publish(asked, str(tmp_path), "silver", "t", bucket_by=(4, ["id"]))


def test_pages_by_key_equal_pages_by_offset(spark, tmp_path):
    rows = [(f"2024-01-{1 + i % 5:02d}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "d string, id int").withColumn("d", F.col("d").cast("date"))
    versions.publish_version(df, str(tmp_path), "serving", "t", cluster_by=["d", "id"])
    table = io.load(spark, str(tmp_path), "serving", "t")
    page, seen = changes.lookup_page(table, ["d", "id"], limit=30).collect(), []
    while page:
        seen += page
        page = changes.lookup_after(table, ["d", "id"], [page[-1].d, page[-1].id], limit=30).collect()
    assert seen == changes.lookup_page(table, ["d", "id"], limit=200).collect()
    assert "PushedFilters: [IsNotNull(d), GreaterThanOrEqual(d" in plan(
        changes.lookup_after(table, ["d", "id"], ["2024-01-03", 5]))
