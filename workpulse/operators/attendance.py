"""Shift durations and schedule adherence (late arrival, early departure,
overtime, excessive duration, declared-vs-punched hours).

All row-local projections: no shuffle, one fused codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.functions.expr import ColLike, c, minutes_between, rnd

PUNCH_IN = "punch_in_datetime"
PUNCH_OUT = "punch_out_datetime"
SCHED_START = "scheduled_start_datetime"
SCHED_END = "scheduled_end_datetime"


def with_durations(df: DataFrame, punch_in: str = PUNCH_IN, punch_out: str = PUNCH_OUT,
                   sched_start: str = SCHED_START, sched_end: str = SCHED_END) -> DataFrame:
    """Actual and scheduled duration (minutes from whole seconds, hours at 2 dp)
    and ``is_schedulable``.  Durations are null when a bound is missing."""
    actual = F.when(c(punch_in).isNotNull() & c(punch_out).isNotNull(),
                    minutes_between(punch_in, punch_out))
    schedulable = c(sched_start).isNotNull() & c(sched_end).isNotNull()
    out = df.withColumns({
        "actual_duration_minutes": actual,
        "is_schedulable": schedulable,
    })
    out = out.withColumns({
        "actual_duration_hours": rnd(F.col("actual_duration_minutes") / 60, 2),
        "scheduled_duration_minutes": F.when(F.col("is_schedulable"),
                                             minutes_between(sched_start, sched_end)),
    })
    return out.withColumn("scheduled_duration_hours",
                          rnd(F.col("scheduled_duration_minutes") / 60, 2))


def _over_grace(variance: str, grace: float):
    return F.when(F.col(variance) > grace, rnd(variance, 2)).otherwise(F.lit(0.0))


def with_schedule_adherence(df: DataFrame, grace_minutes: float = 5, max_hours: float = 24,
                            punch_in: str = PUNCH_IN, punch_out: str = PUNCH_OUT,
                            sched_start: str = SCHED_START, sched_end: str = SCHED_END) -> DataFrame:
    """Late arrival, early departure, overtime and excessive-duration flags.

    Expects ``with_durations`` columns.  A variance counts only when strictly
    greater than ``grace_minutes``; unscheduled rows get 0 minutes and false
    flags; ``is_excessive_duration`` is null when the duration is null.
    """
    if "is_schedulable" not in df.columns:
        df = with_durations(df, punch_in, punch_out, sched_start, sched_end)
    sched = F.col("is_schedulable")
    out = df.withColumns({
        "arrival_variance_minutes": F.when(sched & c(punch_in).isNotNull(),
                                           minutes_between(sched_start, punch_in)),
        "departure_variance_minutes": F.when(sched & c(punch_out).isNotNull(),
                                             minutes_between(punch_out, sched_end)),
        "schedule_variance_minutes": F.when(
            sched & F.col("actual_duration_minutes").isNotNull(),
            F.col("actual_duration_minutes") - F.col("scheduled_duration_minutes")),
        "is_excessive_duration": F.col("actual_duration_hours") > max_hours,
    })
    out = out.withColumns({
        "late_arrival_minutes": _over_grace("arrival_variance_minutes", grace_minutes),
        "early_departure_minutes": _over_grace("departure_variance_minutes", grace_minutes),
        "overtime_minutes": _over_grace("schedule_variance_minutes", grace_minutes),
    })
    return out.withColumns({
        "is_late_arrival": F.col("late_arrival_minutes") > 0,
        "is_early_departure": F.col("early_departure_minutes") > 0,
        "overtime_hours": rnd(F.col("overtime_minutes") / 60, 2),
        "is_overtime": F.col("overtime_minutes") > 0,
    })


def with_hours_variance(df: DataFrame, declared: ColLike = "hours_worked",
                        punched: ColLike = "actual_duration_hours",
                        out: str = "hours_worked_vs_punch_variance") -> DataFrame:
    """Declared minus punched hours at 2 dp, null unless both are present."""
    d, p = c(declared), c(punched)
    return df.withColumn(out, F.when(d.isNotNull() & p.isNotNull(),
                                     rnd(d.cast("double") - p, 2)))


def with_chronology_flags(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """``{flag: (start, end)}`` -> flag true when both present and end < start."""
    from workpulse.functions.expr import chronology_violation
    return df.withColumns({k: chronology_violation(s, e) for k, (s, e) in pairs.items()})
