"""Exact top-k search by inner product: a Voronoi join.

Pivots, a bounded sample of the vectors, cut the space into cells; every vector
belongs to its nearest pivot.  From the summary of the cells (radius of queries
and data, and for each cell the ``top`` + 1 ids nearest to the pivot)
follow, for each cell of queries, a lower bound on the k-th best score of any of
its queries, and, for each data vector, an upper bound on its score with any of
them.  A vector goes to a group of query cells only where its upper bound reaches
the lower bound.  Groups of queries meet chunks of these vectors and solve them
with exact integer matrix products; the chunks' best are merged per query.

Bounds: at most ``pivots`` pivots and as many summary rows reach the driver.
Chunks hold about ``chunk`` vectors and blocks at most ``block`` queries, so a
crowded cell is cut over many tasks.  With ``dims`` numbers of magnitude under
2**28 scores are exact in 64 bits.

Defined cases: vectors that are null or hold a null or non-finite number, or
whose id is null, take no part; shorter vectors count as padded with zeros; rows
equal in id and vector are each a candidate but one query; a candidate with the
query's id is the query's own row; ties go to the smaller id; an empty table
gives no rows; only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from workpulse.llm.scratch import stored


def quantised(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component x as a long; unusable rows are left out."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    fine = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda e: F.floor(e * scale).cast("long")).alias("v"))


def _matrix(rows, dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of ``q`` and ``x``."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if top < 2.0 ** 53:  # every partial sum is an exact double
        return (q.astype(float) @ x.T.astype(float)).astype(np.int64)
    return q @ x.T


class Cells:
    """Pivots and the bounds that follow from the summary of their cells."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots.astype(float)
        self.norm = np.linalg.norm(self.pivots, axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = x.astype(float)
        d2 = (x * x).sum(1)[:, None] - 2 * x @ self.pivots.T + (self.norm ** 2)[None, :]
        cell = d2.argmin(axis=1)
        exact = np.linalg.norm(x - self.pivots[cell], axis=1)
        return cell, exact

    def floors(self, query_radius: np.ndarray, near: dict[int, list[tuple[float, int]]], top: int) -> np.ndarray:
        """For each cell of queries, a score that its queries' k-th best reaches:
        a vector at distance r from pivot p scores at least
        c.p - |c| r - R |p| - R r with any query within R of pivot c.  ``near``
        has (r, id) by pivot; each id counts with its best bound only, so of the
        ``top`` + 1 best one at most is the query's own id."""
        out = np.full(len(self.pivots), -np.inf)
        dots = self.pivots @ self.pivots.T
        for c in np.flatnonzero(query_radius >= 0):
            R = query_radius[c]
            low: dict[int, float] = {}
            for p, rows in near.items():
                for r, vec_id in rows:
                    bound = dots[c, p] - self.norm[c] * r - R * self.norm[p] - R * r
                    low[vec_id] = max(bound, low.get(vec_id, -np.inf))
            if len(low) > top:
                out[c] = sorted(low.values(), reverse=True)[top]
        return out

    def reach(self, x: np.ndarray, query_radius: np.ndarray) -> np.ndarray:
        """Upper bound of each vector's score with any query of each cell."""
        x = x.astype(float)
        return x @ self.pivots.T + np.linalg.norm(x, axis=1)[:, None] * np.maximum(query_radius, 0)[None, :]


def _groups(counts: np.ndarray, pivots: np.ndarray, block: int) -> np.ndarray:
    """Cells put together, nearest first, into groups of about ``block`` queries."""
    group, left = np.full(len(counts), -1), [int(c) for c in np.argsort(-counts) if counts[c]]
    g = 0
    while left:
        seed = left[0]
        near = sorted(left, key=lambda c: ((pivots[c] - pivots[seed]) ** 2).sum())
        held = 0
        for c in near:
            if held and held + counts[c] > block:
                break
            group[c], held = g, held + counts[c]
        left = [c for c in left if group[c] < 0]
        g += 1
    return group


def top_k(vectors: DataFrame, is_query: Column, top: int = 5, pivots: int = 64, block: int = 1024,
          chunk: int = 4096, scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``top`` best candidates of every query."""
    spark = vectors.sparkSession
    rows = stored(quantised(vectors, scale), "quantised")
    n, dims = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    fields = "query_id long, rank int, vec_id long, score long"
    if not n or not dims:
        return spark.createDataFrame([], fields)
    some = rows.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(pivots).collect()
    cells = Cells(np.unique(_matrix([r["v"] for r in some], dims), axis=0))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, far = cells.nearest(_matrix(batch.column("v").to_pylist(), dims))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"), pa.array(cell.astype(np.int32)), pa.array(far)],
                names=["vec_id", "v", "cell", "far"])

    placed = stored(rows.mapInArrow(assign, "vec_id long, v array<bigint>, cell int, far double"), "placed")
    queries = placed.where(is_query).dropDuplicates(["vec_id", "v"])
    per_query = queries.groupBy("cell").agg(F.max("far").alias("R"), F.count(F.lit(1)).alias("n")).collect()
    order = W.partitionBy("cell").orderBy("far", "vec_id")
    near: dict[int, list[tuple[float, int]]] = {}
    nearest = placed.groupBy("cell", "vec_id").agg(F.min("far").alias("far"))
    for r in nearest.withColumn("n", F.row_number().over(order)).where(
            F.col("n") <= top + 1).collect():  # at most (top + 1) ids a pivot
        near.setdefault(r["cell"], []).append((r["far"], r["vec_id"]))
    radius, counts = np.full(len(cells.pivots), -1.0), np.zeros(len(cells.pivots), np.int64)
    for r in per_query:
        radius[r["cell"]], counts[r["cell"]] = r["R"], r["n"]
    floor = cells.floors(radius, near, top)
    floor -= 1e-6 * (1 + np.abs(np.where(np.isfinite(floor), floor, 0)))  # rounding of the bounds
    group = _groups(counts, cells.pivots, block)
    blocks = [max(1, -(-int(counts[group == g].sum()) // block)) for g in range(group.max() + 1)]

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v").to_pylist(), dims)
            reach = cells.reach(x, radius)
            need = (reach + 1e-6 * (1 + np.abs(reach)) >= floor[None, :]) & (radius >= 0)[None, :]
            for g in range(len(blocks)):
                at = np.flatnonzero(need[:, group == g].any(axis=1))
                if len(at):
                    part = batch.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), g, np.int32)), part.column("vec_id"), part.column("v")],
                        names=["g", "vec_id", "v"])

    spread = stored(placed.select("vec_id", "v").mapInArrow(replicate, "g int, vec_id long, v array<bigint>"),
                    "replicas")
    held = {r["g"]: r["count"] for r in spread.groupBy("g").count().collect()}
    chunks = [max(1, -(-held.get(g, 0) // chunk)) for g in range(len(blocks))]
    literal = lambda xs: F.array(*[F.lit(int(x)) for x in xs])
    data = (spread.withColumn("chunk", F.pmod(F.xxhash64("vec_id", "v"), F.get(literal(chunks), "g")).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.get(literal(blocks), "g") - 1))))
    asked = (queries.withColumn("g", F.get(literal(group), "cell"))
             .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.get(literal(blocks), "g")).cast("int"))
             .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.get(literal(chunks), "g") - 1)))
             .select("g", "block", "chunk", "vec_id", "v"))

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "q": [], "vec_id": [], "score": []}, dtype="int64")
        qid, xid = left["vec_id"].to_numpy(np.int64), right["vec_id"].to_numpy(np.int64)
        q = _matrix(left["v"], dims)
        x_order = np.argsort(xid, kind="stable")
        xid, x = xid[x_order], _matrix(right["v"], dims)[x_order]
        out = []
        for at in range(0, len(q), 256):
            s = scores(q[at:at + 256], x)
            for i, row in enumerate(s):
                own = xid == qid[at + i]
                row = np.where(own, np.iinfo(np.int64).min, row)
                k = min(top, len(row) - int(own.sum()))
                if k <= 0:
                    continue
                least = np.partition(row, len(row) - k)[len(row) - k]
                sure, tied = np.flatnonzero(row > least), np.flatnonzero((row == least) & ~own)
                best = np.r_[sure, tied[:k - len(sure)]]  # candidates are in order of id
                out.append(pd.DataFrame({"query_id": qid[at + i], "q": xxhash.xxh64_intdigest(q[at + i].tobytes()) >> 1,
                                         "vec_id": xid[best], "score": row[best]}))
        return pd.concat(out) if out else solve(left[:0], right)

    keys = ["g", "block", "chunk"]
    found = asked.groupBy(*keys).cogroup(data.select(*keys, "vec_id", "v").groupBy(*keys)).applyInPandas(
        solve, "query_id long, q long, vec_id long, score long")
    best = W.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
