"""Registered queries: every operator bound to the driver's tables, each with
its DuckDB oracle (``workpulse.plans.oracles``) where one can be written.

Each query is ``fn(spark, sf_dir) -> DataFrame`` over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

from workpulse.plans.oracles import q

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def finish(df: DataFrame) -> DataFrame:
    """Present results in collection-neutral types: timestamps as wall-clock
    TIMESTAMP_NTZ (UTC), so collected values do not depend on the caller's
    zone, and decimals as doubles (the oracles do the same), so values compare
    equal whether collected as Python objects or through pandas."""
    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, TimestampType):
            casts[f.name] = F.col(f.name).cast("timestamp_ntz")
        elif isinstance(f.dataType, DecimalType):
            casts[f.name] = F.col(f.name).cast("double")
    return df.withColumns(casts) if casts else df


def register(name: str, oracle: str | None = None, doubles: tuple[str, ...] = ()):
    """Register ``fn`` as query ``name`` with its DuckDB ``oracle``; ``doubles``
    names oracle columns of DECIMAL type presented as DOUBLE (like ``finish``)."""
    if oracle is not None and doubles:
        repl = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in doubles)
        oracle = f"SELECT * REPLACE ({repl}) FROM ({oracle.strip()})"

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = q(oracle)
        return run
    return deco


# Import the query modules for their registrations.
from workpulse.plans import (  # noqa: E402,F401
    queries_core, queries_dq, queries_io, queries_kpi, queries_layers, queries_model, queries_silver)
