"""Referential checks: existence flags, self-references and orphan listings.

The reference side is reduced to its distinct key set first; that set is
left to Spark to broadcast from sizes it has measured, otherwise the
join is a shuffle join that AQE can split when a fact key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _key_set(ref: DataFrame, pk: str) -> DataFrame:
    return (ref.select(F.col(pk).alias("_ref_key")).filter(F.col("_ref_key").isNotNull())
            .distinct().withColumn("_ref_hit", F.lit(True)))


def with_reference_flag(df: DataFrame, fk: str, ref: DataFrame, pk: str, out: str,
                        null_when_missing: bool = False) -> DataFrame:
    """Add boolean ``out``: does ``df[fk]`` exist in ``ref[pk]``?

    ``null_when_missing=True`` gives NULL when ``fk`` itself is null (nullable
    existence flag, e.g. ``manager_exists``); otherwise the flag is total
    (``coalesce(match, false)``, e.g. ``employee_master_match``)."""
    ids = _key_set(ref, pk)
    j = df.join(ids, df[fk] == ids["_ref_key"], "left")
    hit = F.coalesce(F.col("_ref_hit"), F.lit(False))
    flag = F.when(F.col(fk).isNull(), F.lit(None).cast("boolean")).otherwise(hit) \
        if null_when_missing else hit
    return j.withColumn(out, flag).drop("_ref_key", "_ref_hit")


def orphans(df: DataFrame, fk: str, ref: DataFrame, pk: str) -> DataFrame:
    """Distinct non-null ``fk`` values absent from ``ref[pk]`` (left anti join)."""
    keys = df.select(F.col(fk)).filter(F.col(fk).isNotNull()).distinct()
    ids = _key_set(ref, pk)
    return keys.join(ids, keys[fk] == ids["_ref_key"], "left_anti")


def orphan_rate(df: DataFrame, fk: str, ref: DataFrame, pk: str) -> DataFrame:
    """One row: distinct fk values, how many are unmatched, and the percentage."""
    from workpulse.functions.expr import pct
    keys = df.select(F.col(fk)).filter(F.col(fk).isNotNull()).distinct()
    ids = _key_set(ref, pk)
    j = keys.join(ids, keys[fk] == ids["_ref_key"], "left")
    agg = j.agg(F.count(F.lit(1)).alias("distinct_keys"),
                F.count(F.when(F.col("_ref_hit").isNull(), 1)).alias("unmatched_keys"))
    return agg.withColumn("unmatched_pct", pct("unmatched_keys", "distinct_keys"))
