"""Combine several inputs into one aggregate without joins.

Scalar metrics from different tables (a KPI summary row, a reconciliation)
are computed as ONE aggregate over a tagged union of the inputs' projected
columns, instead of cross-joining one-row aggregates: each input is scanned
once, partial aggregates run per partition, and no join is planned.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SRC = "_src"


def tagged_union(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Union of the frames (already projected to the needed columns) with a
    ``_src`` tag; columns missing from a frame are NULL there."""
    out = None
    for tag, df in frames.items():
        t = df.withColumn(SRC, F.lit(tag))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def of(tag: str, value: Column | None = None) -> Column:
    """``value`` for rows of input ``tag`` (NULL elsewhere); 1 when no value."""
    return F.when(F.col(SRC) == tag, F.lit(1) if value is None else value)
