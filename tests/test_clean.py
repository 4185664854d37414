import pytest

from workpulse.functions import expr as X
from workpulse.operators import clean


def test_split_code_name(spark):
    df = spark.createDataFrame([("72800-CT Scan",), ("NoDash",), ("1-A-B",), ("2- ",), (None,)],
                               "department_name string")
    got = [tuple(r) for r in clean.split_code_name(df).collect()]
    assert got == [("CT Scan", "72800"), ("NoDash", None), ("A-B", "1"), ("2- ", "2"), (None, None)]


def test_flags_enums_prefix_and_names(spark):
    df = spark.createDataFrame([("1", "Full_time", "Terminate_Employee_Voluntary", "A", None),
                                ("0", "part_time", None, None, None),
                                ("x", None, "Other", "A", "B")],
                               "a string, f string, t string, fn string, ln string")
    out = df.select(X.decode_flag("a").alias("a"), X.prettify_enum("f").alias("f"),
                    X.strip_prefix("t", clean.TERMINATION_PREFIX).alias("t"),
                    X.full_name("fn", "ln").alias("n")).collect()
    assert [tuple(r) for r in out] == [(True, "Full Time", "Voluntary", "A"),
                                       (False, "Part Time", None, ""),
                                       (None, None, "Other", "A B")]


def test_blank_to_null_and_casts(spark):
    df = spark.createDataFrame([("  x ", " ", "2024-02-30", "12.5"), (None, "", "2024-01-01", "abc")],
                               "a string, b string, d string, n string")
    out = clean.cast_columns(clean.cast_dates(clean.blank_to_null(df), ["d"]),
                             {"n": "decimal(10,2)"}, strict=False).collect()
    assert out[0].a == "x" and out[0].b is None and out[0].d is None and float(out[0].n) == 12.5
    assert out[1].n is None and str(out[1].d) == "2024-01-01"
    with pytest.raises(Exception):
        clean.cast_dates(df, ["d"], strict=True).collect()


def test_drop_all_null_columns(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "x string, y string")
    assert clean.drop_all_null_columns(df).columns == ["x"]


def test_bucketize(spark):
    df = spark.createDataFrame([(3.9,), (4.0,), (9.99,), (10.0,), (None,)], "v double")
    got = [r[0] for r in df.select(X.bucketize("v", (4, 6, 8, 10),
                                               ("<4", "4-6", "6-8", "8-10", "10+"))).collect()]
    assert got == ["<4", "4-6", "8-10", "10+", "10+"]


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(1.005,), (2.675,), (-1.005,), (0.0,)], "v double")
    assert [r[0] for r in df.select(X.rnd("v", 2)).collect()] == [1.01, 2.68, -1.01, 0.0]


def test_required_and_existing_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert clean.missing_columns(df, ["a", "c"]) == ["c"]
    with pytest.raises(ValueError):
        clean.require_columns(df, ["a", "c"])
    assert clean.drop_existing(df, ["b", "zz"]).columns == ["a"]


def test_tagged_union_aggregate(spark):
    from pyspark.sql import functions as F

    from workpulse.operators.combine import of, tagged_union
    u = tagged_union({"x": spark.range(3).select(F.col("id").alias("v")),
                      "y": spark.range(5).select()})
    r = u.agg(F.sum(of("x", F.col("v"))).alias("sx"), F.count(of("y")).alias("ny")).first()
    assert (r.sx, r.ny) == (3, 5)
    plan = u.agg(F.count(F.lit(1)))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
