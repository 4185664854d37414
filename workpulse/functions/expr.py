"""Column-expression helpers (JVM built-ins only, all codegen friendly).

Every function returns a ``Column`` and accepts column names or Columns, so the
operators in ``workpulse.operators`` stay column-parameterised.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColLike = str | Column


def c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --------------------------------------------------------------------------- numbers

ROUND_FUNCTION = "wp_round_half_up"
_ROUND_SQL = (f"CREATE OR REPLACE TEMPORARY FUNCTION {ROUND_FUNCTION}(x DOUBLE, k DOUBLE) "
              "RETURNS DOUBLE RETURN CAST(CASE WHEN x < 0 THEN -floor(-x * k + 0.500000001) "
              "ELSE floor(x * k + 0.500000001) END AS DOUBLE) / k")
_registered: set = set()


def _ensure_round_function() -> None:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    key = spark._jsparkSession.sessionUUID()
    if key not in _registered:
        spark.sql(_ROUND_SQL)
        _registered.add(key)


def rnd(x: ColLike, scale: int = 2) -> Column:
    """HALF_UP rounding of a double to ``scale`` decimals.

    Spark's ``round`` rounds the shortest decimal text of a double, so
    ``round(1.005, 2) = 1.01``.  ``floor(|x|*10^s + 0.500000001)`` reproduces
    that on every value we probed and is evaluated the same way by any IEEE
    engine, which keeps results comparable across engines.  The integer step
    also never yields ``-0.0``.  It is a SQL function (inlined by the
    analyzer, so it stays inside whole-stage codegen)."""
    _ensure_round_function()
    return F.call_function(ROUND_FUNCTION, c(x).cast("double"), F.lit(float(10 ** scale)))


def pct(numerator: ColLike, denominator: ColLike, scale: int = 2) -> Column:
    """``round(num / den * 100, scale)``; null when the denominator is 0/null
    (``try_divide``: no ANSI divide-by-zero error on empty groups)."""
    return rnd(F.try_divide(c(numerator), c(denominator)) * 100, scale)


def epoch_seconds(ts: ColLike) -> Column:
    """Whole epoch seconds of a timestamp (sub-second part floored), for
    TIMESTAMP and TIMESTAMP_NTZ inputs alike (NTZ is read in the session zone)."""
    return F.unix_seconds(c(ts).cast("timestamp"))


def minutes_between(start: ColLike, end: ColLike) -> Column:
    """(end - start) in minutes from whole seconds; null if either is null."""
    return (epoch_seconds(end) - epoch_seconds(start)) / 60


# --------------------------------------------------------------------------- strings

def blank_to_null(x: ColLike) -> Column:
    """trim, then '' -> NULL (null stays null)."""
    t = F.trim(c(x))
    return F.when(t != "", t)


def invalid_identifier(x: ColLike, keywords: Sequence[str] = ()) -> Column:
    """True when an identifier is null, blank, contains a space or contains one of
    ``keywords`` (case-insensitive).  Never null.  The keywords are one regex
    alternation (a single pass over the string, one predicate for the optimizer)."""
    import re
    v = c(x)
    bad = v.isNull() | (F.trim(v) == "") | v.contains(" ")
    if keywords:
        bad = bad | v.rlike("(?i)(" + "|".join(re.escape(k) for k in keywords) + ")")
    return F.coalesce(bad, F.lit(True))


def numeric_identifier(x: ColLike) -> Column:
    """Digits only (``^\\d+$``); null stays null."""
    return c(x).rlike(r"^\d+$")


def malformed_numeric(x: ColLike, to: str = "decimal(10,2)") -> Column:
    """Present but not parseable as ``to``: ``x is not null and try_cast(x) is null``."""
    v = c(x)
    return v.isNotNull() & v.try_cast(to).isNull()


def decode_flag(x: ColLike, true_value: str = "1", false_value: str = "0") -> Column:
    """Tri-state decode: true_value -> True, false_value -> False, other -> NULL."""
    v = F.trim(c(x))
    return F.when(v == true_value, F.lit(True)).when(v == false_value, F.lit(False))


def prettify_enum(x: ColLike) -> Column:
    """``Full_time`` -> ``Full Time``."""
    return F.initcap(F.regexp_replace(c(x), "_", " "))


def strip_prefix(x: ColLike, prefix_regex: str) -> Column:
    """Remove an anchored prefix; null stays null."""
    return F.regexp_replace(c(x), prefix_regex, "")


def full_name(*parts: ColLike) -> Column:
    """Space-joined non-null parts (``concat_ws``: all parts null gives '')."""
    return F.concat_ws(" ", *[c(p) for p in parts])


def bucketize(x: ColLike, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Half-open numeric buckets: ``x < e0 -> l0``, ``e(i-1) <= x < e(i) -> li``,
    else the last label (also for NULL, like an ``otherwise`` chain)."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need len(edges) + 1 labels")
    v = c(x)
    expr = None
    for edge, label in zip(edges, labels):
        expr = F.when(v < edge, label) if expr is None else expr.when(v < edge, label)
    return expr.otherwise(labels[-1])


def chronology_violation(start: ColLike, end: ColLike) -> Column:
    """True only when both are present and end < start."""
    s, e = c(start), c(end)
    return s.isNotNull() & e.isNotNull() & (e < s)


def any_match(values: Column, pattern: str) -> Column:
    """True when some element of an array matches ``pattern`` (no explode)."""
    return F.exists(values, lambda v: v.rlike(pattern))


def column_list(cols: Iterable[ColLike]) -> list[Column]:
    return [c(x) for x in cols]
