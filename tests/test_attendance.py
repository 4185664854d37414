import datetime as dt

from workpulse.operators import attendance

T = dt.datetime


def frame(spark, rows):
    schema = ("punch_in_datetime timestamp, punch_out_datetime timestamp, "
              "scheduled_start_datetime timestamp, scheduled_end_datetime timestamp, "
              "hours_worked decimal(10,2)")
    return spark.createDataFrame(rows, schema)


def test_grace_is_strict_and_whole_seconds(spark):
    s0, s1 = T(2024, 1, 1, 8), T(2024, 1, 1, 16)
    rows = [
        (T(2024, 1, 1, 8, 5, 0), T(2024, 1, 1, 16), s0, s1, None),        # exactly 5 min late
        (T(2024, 1, 1, 8, 5, 1), T(2024, 1, 1, 16), s0, s1, None),        # 5 min 1 s
        (T(2024, 1, 1, 8, 5, 0, 900000), T(2024, 1, 1, 16), s0, s1, None),  # sub-second floored
    ]
    out = attendance.with_schedule_adherence(frame(spark, rows)).orderBy("punch_in_datetime").collect()
    assert [r.is_late_arrival for r in out] == [False, False, True]
    assert out[2].late_arrival_minutes == 5.02
    assert out[0].late_arrival_minutes == 0.0


def test_unscheduled_rows_never_flag_and_excessive_is_nullable(spark):
    rows = [
        (T(2024, 1, 1, 8), T(2024, 1, 2, 8, 1), None, None, None),   # 24.02 h, no schedule
        (T(2024, 1, 1, 8), None, T(2024, 1, 1, 8), T(2024, 1, 1, 16), None),
        (T(2024, 1, 1, 22), T(2024, 1, 2, 6), T(2024, 1, 1, 22), T(2024, 1, 2, 6), None),
    ]
    out = attendance.with_schedule_adherence(frame(spark, rows)).orderBy("punch_in_datetime").collect()
    first = out[0]
    assert first.is_schedulable is False and first.is_late_arrival is False
    assert first.is_overtime is False and first.is_excessive_duration is True
    missing_out = out[1]
    assert missing_out.actual_duration_minutes is None
    assert missing_out.is_excessive_duration is None
    midnight = out[2]
    assert midnight.actual_duration_hours == 8.0 and midnight.is_overtime is False


def test_exactly_24_hours_is_not_excessive(spark):
    rows = [(T(2024, 1, 1, 8), T(2024, 1, 2, 8), None, None, None)]
    r = attendance.with_schedule_adherence(frame(spark, rows)).first()
    assert r.actual_duration_hours == 24.0 and r.is_excessive_duration is False


def test_hours_variance(spark):
    rows = [(T(2024, 1, 1, 8), T(2024, 1, 1, 16, 30), None, None, 8.0),
            (T(2024, 1, 1, 8), None, None, None, 8.0)]
    import decimal
    rows = [r[:4] + (decimal.Decimal(str(r[4])),) for r in rows]
    out = attendance.with_hours_variance(attendance.with_durations(frame(spark, rows))) \
        .orderBy("punch_out_datetime").collect()
    assert out[0].hours_worked_vs_punch_variance is None
    assert out[1].hours_worked_vs_punch_variance == -0.5
