"""Natural keys, surrogate ids, duplicate statistics and deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIMESHEET_KEY = ("client_employee_id", "punch_apply_date", "punch_in_datetime",
                 "punch_out_datetime")
LINEAGE_ORDER = ("_source_file", "_ingested_at")


def surrogate_key_expr(keys: Sequence[str]):
    """sha256 of the JSON text of the key struct (null fields are omitted by
    ``to_json``; timestamps render in the session time zone, pin it to UTC)."""
    return F.sha2(F.to_json(F.struct(*[F.col(k).alias(k) for k in keys])), 256)


def with_surrogate_key(df: DataFrame, keys: Sequence[str] = TIMESHEET_KEY,
                       out: str = "timesheet_id") -> DataFrame:
    return df.withColumn(out, surrogate_key_expr(keys))


def deduplicate(df: DataFrame, keys: Sequence[str] = TIMESHEET_KEY,
                order: Sequence[str] = LINEAGE_ORDER,
                count_col: str | None = "source_duplicate_count",
                null_key_policy: str = "collapse") -> DataFrame:
    """Keep one row per natural key and count the copies.

    Winner = smallest ``order`` columns, then the remaining columns (ascending,
    nulls first), so ties are deterministic.  Planned as one hash/sort
    aggregate with ``min(struct)``: the map-side partial aggregate folds hot
    keys before the shuffle, unlike a ``row_number`` window that sends every
    copy of a hot key to one task.

    ``null_key_policy``: ``collapse`` groups null key parts as equal (grouping
    semantics); ``keep`` passes rows with a null key part through unchanged,
    each with a count of 1.
    """
    keys = list(keys)
    order = [o for o in order if o in df.columns]     # lineage columns are optional
    rest = [x for x in df.columns if x not in keys and x not in order]
    payload = list(order) + rest
    winner = F.min(F.struct(*[F.col(x) for x in payload])).alias("_w")
    aggs = [winner] + ([F.count(F.lit(1)).alias(count_col)] if count_col else [])

    def _dedup(frame: DataFrame) -> DataFrame:
        g = frame.groupBy(*keys).agg(*aggs)
        out = g.select(*keys, *[F.col("_w")[x].alias(x) for x in payload],
                       *([count_col] if count_col else []))
        return out.select(*df.columns, *([count_col] if count_col else []))

    if null_key_policy == "collapse":
        return _dedup(df)
    if null_key_policy != "keep":
        raise ValueError("null_key_policy must be 'collapse' or 'keep'")
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    kept = df.filter(~complete)
    if count_col:
        kept = kept.withColumn(count_col, F.lit(1).cast("long"))
    return _dedup(df.filter(complete)).unionByName(kept)


def duplicate_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: duplicate groups, rows inside them, and extra copies."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return g.agg(F.count(F.lit(1)).alias("duplicate_groups"),
                 F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows_in_duplicate_groups"),
                 F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("extra_copies"))


def duplicate_conflicts(df: DataFrame, keys: Sequence[str], payload: Sequence[str],
                        require_complete_key: bool = True) -> DataFrame:
    """Keys whose copies disagree on a payload column (``<col>_variants`` > 1).

    Minima and maxima find those keys in one aggregate of the whole table; only
    their rows, by a semi join, are counted by distinct values (a count of several
    distinct columns multiplies the rows it reads)."""
    src = df
    if require_complete_key:
        for k in keys:
            src = src.filter(F.col(k).isNotNull())
    differ = F.lit(False)
    for p in payload:
        differ = differ | F.coalesce(F.min(p) != F.max(p), F.lit(False))
    odd = src.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(differ.alias("_differ")).where("_differ")
    on = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return src.select(*keys, *payload).join(odd, on, "left_semi").groupBy(*keys).agg(
        *[F.countDistinct(p).alias(f"{p}_variants") for p in payload])
