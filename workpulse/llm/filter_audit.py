"""How quality filters interact: every order of them, from one pass over the rows.

A document's failures are a mask with one bit per filter.  Under an order, the
document is removed at the first filter of its mask.  All orders that begin with
the same filters are neighbours in lexicographic (Lehmer) rank: a prefix of s
filters covers ``(n - s)!`` consecutive ranks.  So a mask is removed at step s
on a few intervals of ranks, which depend on the mask alone (``removal_intervals``).
The rows are counted by part and mask; each count is added where its interval
begins and subtracted after it ends, and a running sum over the ranks turns these
difference arrays into the removals of every order.  The rest are totals of them.

What moves: one narrow row per document (a digest of its text, no text), then at
most 2^n masks for each part.  A hot part or text is counted before the shuffle.

Defined cases: a null text is empty; a null source is the part ``''``; a document
without an id never repeats another one nor is repeated; rows of one id do not
repeat each other; of several labels of one id, any that says yes counts; a null
label says no; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from workpulse.llm.scratch import stored
from workpulse.llm.texts import WORD

FILTERS = "ABCDE"


def removal_intervals(n: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank after the last) of all non-zero masks of
    ``n`` filters; neighbouring intervals of one mask and step are joined."""
    out: list[list[int]] = []

    def below(mask: int, used: tuple[int, ...], rank: int) -> None:
        step, free = len(used) + 1, [f for f in range(n) if f not in used]
        width = factorial(n - step)
        for digit, f in enumerate(free):
            low = rank + digit * width
            if not mask >> f & 1:
                below(mask, (*used, f), low)
            else:
                out.append([mask, step, low, low + width])

    for mask in range(1, 1 << n):
        below(mask, (), 0)
    out.sort()
    joined = out[:1]
    for mask, step, low, high in out[1:]:
        if joined[-1][:2] == [mask, step] and joined[-1][3] == low:
            joined[-1][3] = high
        else:
            joined.append([mask, step, low, high])
    return [tuple(x) for x in joined]


def text_failures(text: Column) -> list[Column]:
    """Whether a text fails A to D: few words, repetitive, shouting, symbols."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return [F.size(words) < 50,
            100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
            100 * F.regexp_count(text, F.lit("[A-Z]")) > 5 * F.length(text),
            text.rlike(r"[#$%&*|]")]


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask) of every row; filter E fails where a smaller id has the same text."""
    text = F.coalesce("text", F.lit(""))
    rows = stored(docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"),
        sum(bad.cast("int") * (1 << k) for k, bad in enumerate(text_failures(text))).alias("base")), "failures")
    # The first holder of a text joins on digest and id together, so a text that
    # a third of all rows share is no hot key.
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id")).select(
        F.col("digest").alias("f_digest"), "first_id")
    return rows.join(first, (F.col("digest") == F.col("f_digest")) & (F.col("doc_id") == F.col("first_id")),
                     "left").select("doc_id", "part", (F.col("base") + F.when(
                         F.col("first_id").isNull() & F.col("doc_id").isNotNull(), 1 << 4).otherwise(0)).alias("mask"))


def interactions(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row per part, order of ``filters`` and step, from ``counts`` (part, mask,
    n, good, toxic)."""
    spark, n = counts.sparkSession, len(filters)
    measures, steps = ("n", "good", "toxic"), range(1, n + 1)
    orders = ["".join(p) for p in permutations(filters)]
    fails = [F.sum(F.when(F.col("mask").bitwiseAND(1 << k) != 0, F.col("n")).otherwise(0)) for k in range(n)]
    only = [F.sum(F.when(F.col("mask") == 1 << k, F.col("n")).otherwise(0)) for k in range(n)]
    parts = counts.groupBy("part").agg(F.sum("n").alias("total"), F.array(*fails).alias("fails"),
                                       F.array(*only).alias("only"))
    # Fixed size: the intervals of 2^n masks.
    spans = spark.createDataFrame(removal_intervals(n), "mask int, step int, low int, high int")
    met = counts.join(F.broadcast(spans), "mask")
    ends = met.select("part", "step", F.col("low").alias("rank"), *measures).union(
        met.select("part", "step", F.col("high").alias("rank"), *[-F.col(m) for m in measures]))
    every = counts.select("part").distinct().select(
        "part", F.lit(1).alias("step"), F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))).alias("rank"),
        *[F.lit(0).cast("long").alias(m) for m in measures])
    change = ends.union(every).groupBy("part", "rank").agg(*[
        F.sum(F.when(F.col("step") == s, F.col(m)).otherwise(0)).alias(f"{m}{s}") for s in steps for m in measures])
    upto = Window.partitionBy("part").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    run = change.select("part", "rank", *[F.sum(f"{m}{s}").over(upto).alias(f"{m}{s}")
                                          for s in steps for m in measures]).where(F.col("rank") < len(orders))
    rows = run.select("part", F.array(*map(F.lit, orders))[F.col("rank")].alias("filter_order"), F.explode(F.array(*[
        F.struct(F.lit(s).alias("step"), *[F.col(f"{m}{s}").alias(m) for m in measures],
                 sum(F.col(f"n{t}") for t in range(1, s + 1)).alias("gone")) for s in steps])).alias("x"))
    rows = rows.select("part", "filter_order", "x.*").withColumn(
        "filter", F.expr("substring(filter_order, step, 1)")).withColumn(
        "at", F.instr(F.lit(filters), F.col("filter")))
    per_filter = Window.partitionBy("part", "filter")
    rows = rows.withColumn("shapley", F.sum("n").over(per_filter)).join(
        parts.withColumnRenamed("part", "p"), F.col("part") == F.col("p"))
    return rows.select(
        "part", "filter_order", "step", (F.col("total") - F.col("gone")).alias("kept"), F.col("n").alias("removed"),
        (F.element_at("fails", F.col("at")) - F.col("n")).alias("redundant"),
        F.element_at("only", F.col("at")).alias("unique_fails"), F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"), "shapley")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters A to E over ``docs`` (doc_id, text, source), with what
    ``labels`` (doc_id, quality, toxic) call good or toxic."""
    said = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("l_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"))
    counts = masks(docs).join(said, F.col("doc_id") == F.col("l_id"), "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))
    return interactions(stored(counts, "mask_counts"))
