"""Single-pass profiling aggregates: sources, nulls, ranges, keys, value
distributions, completeness and reconciliation.  Each returns a small frame
built by one aggregate over the input (partial aggregation map-side)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.operators.combine import of, tagged_union


def profile_sources(df: DataFrame, source: str = "_source_file", date_col: str = "punch_apply_date",
                    id_col: str = "client_employee_id", ingest_col: str = "_ingested_at"
                    ) -> DataFrame:
    """Per source file: rows, date range, distinct ids, first/last ingest."""
    return df.groupBy(source).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"),
        F.countDistinct(id_col).alias("distinct_ids"),
        F.min(ingest_col).alias("first_ingested_at"), F.max(ingest_col).alias("last_ingested_at"))


def reconcile_sources(df: DataFrame, source: str = "_source_file") -> DataFrame:
    """One row: number of sources, sum of per-source counts, table count and the
    difference -- one aggregate over (per-source counts) + (table rows)."""
    per = df.groupBy(source).agg(F.count(F.lit(1)).alias("_n"))
    u = tagged_union({"p": per.select("_n"), "w": df.select()})
    out = u.agg(F.count(of("p")).alias("source_count"),
                F.coalesce(F.sum(of("p", F.col("_n"))), F.lit(0)).cast("long").alias("sum_of_sources"),
                F.count(of("w")).alias("table_rows"))
    return out.withColumn("difference", F.col("table_rows") - F.col("sum_of_sources"))


def profile_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: ``<col>_nulls`` for every column plus the row count."""
    cols = list(cols or df.columns)
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}_nulls") for c in cols])


def profile_ranges(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: min and max of every date/timestamp column (or ``cols``)."""
    if cols is None:
        cols = [n for n, t in df.dtypes if t in ("date", "timestamp", "timestamp_ntz")]
    if not cols:
        return df.agg(F.count(F.lit(1)).alias("row_count"))
    return df.agg(*[a for c in cols for a in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))])


def profile_keys(df: DataFrame, key: str) -> DataFrame:
    """One row: total rows, populated keys, distinct keys, duplicate rows."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count(key).alias("populated"),
                  F.countDistinct(key).alias("distinct_keys")).withColumn(
        "duplicate_rows", F.col("populated") - F.col("distinct_keys"))


def value_distribution(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("row_count"))


def completeness_matrix(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: both present / only ``a`` / only ``b`` / neither."""
    pa, pb = F.col(a).isNotNull(), F.col(b).isNotNull()
    return df.agg(F.count(F.when(pa & pb, 1)).alias("both_present"),
                  F.count(F.when(pa & ~pb, 1)).alias(f"only_{a}"),
                  F.count(F.when(~pa & pb, 1)).alias(f"only_{b}"),
                  F.count(F.when(~pa & ~pb, 1)).alias("neither"),
                  F.count(F.lit(1)).alias("total_rows"))


def reconcile_totals(agg: DataFrame, agg_col: str, source: DataFrame,
                     source_filter=None) -> DataFrame:
    """One row: sum of a per-group count vs rows of the source it came from
    (one aggregate over a tagged union, no join)."""
    src = source if source_filter is None else source.filter(source_filter)
    u = tagged_union({"a": agg.select(agg_col), "s": src.select()})
    out = u.agg(F.coalesce(F.sum(of("a", F.col(agg_col))), F.lit(0)).cast("long")
                .alias("aggregated_total"),
                F.count(of("s")).alias("source_total"))
    return out.withColumn("matches", F.col("aggregated_total") == F.col("source_total"))
