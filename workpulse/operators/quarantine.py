"""Lossless quarantine: every input row lands in exactly one of (good, bad);
bad rows carry the first matching reason and the check time.

``split_quarantine`` gives both sides as lazy filters, for a consumer of one of
them.  Where both sides are wanted, ``tag`` the rows, write the tagged table once,
partitioned by ``VERDICT``, and read the sides back: the input and the predicates
run once, and each side is a partition, not a filter."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workpulse.functions.expr import ColLike, c

VERDICT, REASON, CHECKED = "dq_verdict", "dq_reason", "dq_checked_at"
GOOD, BAD = "good", "quarantined"


def reason_column(reasons: Mapping[str, Column]) -> Column:
    """First reason whose predicate is true; a NULL predicate counts as a failure
    (fail closed).  NULL when the row is clean."""
    expr = None
    for name, pred in reasons.items():
        bad = F.coalesce(pred, F.lit(True))
        expr = F.when(bad, F.lit(name)) if expr is None else expr.when(bad, F.lit(name))
    return expr


def split_quarantine(df: DataFrame, reasons: Mapping[str, Column],
                     checked_at: ColLike | None = None,
                     reason_col: str = REASON, time_col: str = CHECKED
                     ) -> tuple[DataFrame, DataFrame]:
    """Return ``(good, bad)``, two filters over one tagged projection."""
    tagged = df.withColumn(reason_col, reason_column(reasons))
    good = tagged.filter(F.col(reason_col).isNull()).drop(reason_col)
    ts = F.current_timestamp() if checked_at is None else c(checked_at)
    bad = tagged.filter(F.col(reason_col).isNotNull()).withColumn(time_col, ts)
    return good, bad


def tag(df: DataFrame, reasons: Mapping[str, Column], checked_at: ColLike | None = None) -> DataFrame:
    """``df`` with ``dq_reason`` and ``dq_checked_at`` (NULL on good rows) and
    ``dq_verdict``, which is never NULL: the column to partition the table by."""
    ts = F.current_timestamp() if checked_at is None else c(checked_at)
    bad = F.col(REASON).isNotNull()
    return df.withColumn(REASON, reason_column(reasons)).withColumns(
        {CHECKED: F.when(bad, ts), VERDICT: F.when(bad, BAD).otherwise(GOOD)})


def verdict_metrics() -> dict[str, Column]:
    """What the write of a tagged table counts besides its rows."""
    return {v: (F.col(VERDICT) == v).cast("long") for v in (GOOD, BAD)}


def good_side(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(VERDICT) == GOOD).drop(VERDICT, REASON, CHECKED)


def bad_side(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(VERDICT) == BAD).drop(VERDICT)


def quarantine_counts(bad: DataFrame, reason_col: str = REASON) -> DataFrame:
    """Rows per reason."""
    return bad.groupBy(reason_col).agg(F.count(F.lit(1)).alias("rows"))
