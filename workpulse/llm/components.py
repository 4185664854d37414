"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.llm.scratch import stored


def _state(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node on an edge (u, v); component is the
    smallest node reachable.  Every round is one large-star and one small-star
    step, written to the shared folder; groups are only aggregated to a minimum
    (partially before the shuffle) and joined back, so a hot node is never
    gathered in one place.  The number of rounds is logarithmic in the nodes."""
    links = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                                F.least("u", "v").alias("v")).distinct(), "edges")
    before = _state(links)
    for _ in range(max_rounds if before[0] else 0):
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, F.col("u") == F.col("c")).select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "c")
        small = large.join(low, F.col("u") == F.col("c"))
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct()
        links = stored(small, "small")
        after = _state(links)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.union(links.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
