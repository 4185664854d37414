"""Plan-shape regressions for the scale design: hot keys fold map-side,
headcount never becomes a nested-loop join, no join carries a hint."""

import datetime as dt

from pyspark.sql import functions as F

from workpulse.operators import keys, workforce


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_partial_aggregate_before_shuffle_with_hot_key(spark):
    def rows(n, emp):
        return spark.range(n).select(emp.alias("client_employee_id"),
                                     F.lit(dt.date(2024, 1, 1)).alias("punch_apply_date"),
                                     F.lit(None).cast("timestamp").alias("punch_in_datetime"),
                                     F.lit(None).cast("timestamp").alias("punch_out_datetime"),
                                     F.col("id").cast("string").alias("pay_code"),
                                     F.lit("a.csv").alias("_source_file"),
                                     F.lit(dt.datetime(2024, 2, 1)).alias("_ingested_at"))
    df = rows(3000, F.lit("HOT")).unionByName(rows(6000, F.col("id").cast("string")))
    out = keys.deduplicate(df)
    plan = _plan(out)
    partial = plan.find("partial_min")
    exchange = plan.find("Exchange hashpartitioning")
    assert partial > exchange > 0          # partial agg sits below (before) the shuffle
    got = out.filter(F.col("client_employee_id") == "HOT").first()
    assert got.source_duplicate_count == 3000 and got.pay_code == "0"


def test_headcount_sweep_has_no_nested_loop_join(spark):
    emp = spark.range(500).select(
        F.col("id").cast("string").alias("client_employee_id"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 300).cast("int")).alias("hire_date"),
        F.lit(None).cast("date").alias("term_date"))
    plan = _plan(workforce.daily_headcount(emp, as_of=dt.date(2021, 1, 1)))
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_disabled_broadcast_threshold_is_respected(spark):
    """No join carries a hint, so a disabled threshold leaves shuffle joins."""
    from workpulse.operators import changes, refs
    df = spark.range(50).withColumnRenamed("id", "k")
    exploded = spark.range(3).select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(5000).cast("long"))).alias("p"))
    wide = spark.range(40).select(F.col("id").alias("k"), F.lit("x" * 3000).alias("w"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for made in (refs.with_reference_flag(df, "k", exploded, "p", "hit"), changes.lookup_many(df, "k", wide)):
            assert "BroadcastHashJoin" not in _plan(made)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
