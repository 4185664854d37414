import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from workpulse.operators import keys

SCHEMA = ("client_employee_id string, punch_apply_date date, punch_in_datetime timestamp, "
          "punch_out_datetime timestamp, pay_code string, _source_file string, "
          "_ingested_at timestamp")
D = dt.date(2024, 1, 1)
T = dt.datetime(2024, 1, 1, 8)
I1, I2 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)


def test_winner_is_first_file_then_ingest_then_payload(spark):
    rows = [("1", D, T, T, "B", "b.csv", I1), ("1", D, T, T, "A", "a.csv", I2),
            ("1", D, T, T, "C", "a.csv", I2)]
    out = keys.deduplicate(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 1
    assert out[0].pay_code == "A" and out[0].source_duplicate_count == 3


def test_null_key_policy(spark):
    rows = [("1", D, None, None, "X", "a.csv", I1), ("1", D, None, None, "Y", "a.csv", I1),
            ("1", D, T, T, "Z", "a.csv", I1)]
    df = spark.createDataFrame(rows, SCHEMA)
    collapsed = keys.deduplicate(df).collect()
    assert len(collapsed) == 2
    null_row = [r for r in collapsed if r.punch_in_datetime is None][0]
    assert null_row.pay_code == "X" and null_row.source_duplicate_count == 2
    kept = keys.deduplicate(df, null_key_policy="keep").collect()
    assert len(kept) == 3 and all(r.source_duplicate_count == 1 for r in kept)


def test_surrogate_key_drops_null_fields(spark):
    rows = [("1", D, T, None, "X", "a.csv", I1)]
    df = keys.with_surrogate_key(spark.createDataFrame(rows, SCHEMA))
    import hashlib
    text = '{"client_employee_id":"1","punch_apply_date":"2024-01-01","punch_in_datetime":"2024-01-01T08:00:00.000Z"}'
    assert df.first().timesheet_id == hashlib.sha256(text.encode()).hexdigest()


def test_duplicate_stats_and_conflicts(spark):
    rows = [("1", D, T, T, "A", "a.csv", I1), ("1", D, T, T, "B", "b.csv", I1),
            ("2", D, T, T, "A", "a.csv", I1), ("2", D, T, T, "A", "b.csv", I1),
            ("3", D, T, T, "A", "a.csv", I1)]
    df = spark.createDataFrame(rows, SCHEMA)
    s = keys.duplicate_stats(df, list(keys.TIMESHEET_KEY)).first()
    assert (s.duplicate_groups, s.rows_in_duplicate_groups, s.extra_copies) == (2, 4, 2)
    c = keys.duplicate_conflicts(df, list(keys.TIMESHEET_KEY), ["pay_code"]).collect()
    assert [r.client_employee_id for r in c] == ["1"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["1", "2"]), st.sampled_from([None, T]),
                          st.sampled_from(["A", "B"]), st.sampled_from(["a.csv", "b.csv"])),
                min_size=1, max_size=12))
def test_dedup_idempotent_and_counts_every_row(spark, rows):
    data = [(e, D, t, t, p, f, I1) for e, t, p, f in rows]
    df = spark.createDataFrame(data, SCHEMA)
    once = keys.deduplicate(df)
    assert once.agg({"source_duplicate_count": "sum"}).first()[0] == len(data)
    twice = keys.deduplicate(once.drop("source_duplicate_count"))
    assert sorted(map(tuple, once.drop("source_duplicate_count").collect()), key=str) == \
        sorted(map(tuple, twice.drop("source_duplicate_count").collect()), key=str)


def test_dedup_without_lineage_columns(spark):
    df = spark.createDataFrame([("1", "b"), ("1", "a"), ("2", "c")], "k string, v string")
    out = {r.k: (r.v, r.source_duplicate_count) for r in keys.deduplicate(df, keys=["k"]).collect()}
    assert out == {"1": ("a", 2), "2": ("c", 1)}
