"""Mixing sources to target weights.

Every source gets a target number of words.  Its documents are cut into blocks,
the blocks are put into a fixed pseudo-random order, and the mix takes whole
passes over the source plus the leading part of one more pass.  The block
quotas of all sources are split among the output shards by a binary tree of
multivariate hypergeometric draws, so every shard is a random sample of the mix
with exact totals; the shards then draw disjoint runs of the permuted blocks
and order them by another hash.

Everything is DataFrame work: permutation ranks come from hash buckets of
bounded size with their prefix sums, never from a sort of a whole source, so a
source with a third of all rows is spread over as many tasks as its size asks.

Defined cases: a null text has size 0 and is never drawn; a null source is a
source of its own, last in order; a null id takes part like any other value;
rows equal in id, source and size are one unit whose rows are all cut alike (a
boundary unit leaves fewer words untaken than it has rows); an empty table gives
an empty mix; only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from workpulse.llm.scratch import stored
from workpulse.llm.texts import WORD, word_count

HASH_BITS = 60


def permutation_hash(seed: str, *cols: Column) -> Column:
    """60 bits of md5 over the text forms of ``cols``."""
    parts = [F.coalesce(c.cast("string"), F.lit("\\N")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(seed), *parts)), 1, HASH_BITS // 4),
                  16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
                   max_epochs: int = 2, block_words: int | None = 512) -> DataFrame:
    """One row per source: source, source_size, blocks, target (double), and
    the whole passes (``full``) and further words (``rest``) that make it up.

    Sources in code-point order (null last) weigh ``weights``, repeating.  A
    target stops at ``max_epochs`` times its source's size and the excess goes
    to the others by weight: with sources in order of size per weight, the
    stopped ones are a prefix, found by running sums over the source rows.
    """
    per = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(_blocks(block_words)).alias("blocks"))
    by_name = W.partitionBy().orderBy(F.col("source").asc_nulls_last())
    idx = F.row_number().over(by_name) - 1
    per = per.withColumn("idx", idx).withColumn(
        "weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                               (F.col("idx") % len(weights) + 1).cast("int")).cast("double"))
    per = per.withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    everything = W.partitionBy()
    order = everything.orderBy((F.col("cap") / F.col("weight")).asc(), "idx")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    per = per.withColumn("goal", F.sum("source_size").over(everything) * F.lit(float(share)))
    per = per.withColumn("stopped", (F.col("goal") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                         * F.col("weight") >= F.col("cap") * F.sum("weight").over(rest))
    spare = F.col("goal") - F.coalesce(
        F.sum(F.when(F.col("stopped"), F.col("cap"))).over(everything), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("stopped"), F.col("weight"))).over(everything)
    per = per.withColumn("target", F.when(F.col("stopped"), F.col("cap"))
                         .otherwise(F.least(spare * F.col("weight") / open_weight, F.col("cap"))))
    words = F.floor(F.col("target") + 0.5).cast("long")
    return (per.withColumn("full", F.when(F.col("source_size") > 0,
                                          F.expr("CAST(floor(target + 0.5) AS BIGINT) div source_size"))
                           .otherwise(F.lit(0)).cast("long"))
            .withColumn("rest", words - F.col("full") * F.col("source_size"))
            .select("source", "idx", "source_size", "blocks", "target", "full", "rest"))


def _blocks(block_words: int | None) -> Column:
    if block_words is None:
        return (F.col("size") > 0).cast("long")
    return F.ceil(F.col("size") / block_words).cast("long")


def draw_blocks(units: DataFrame, targets: DataFrame, seed: str, block_words: int | None,
                bucket_blocks: int = 512) -> DataFrame:
    """The blocks that the mix draws: doc_id, source, size, copies, block,
    words (of one row's block), rank (0-based place in the source's
    permutation), full (whole passes that take it) and part (words that the
    broken pass takes of it)."""
    width = F.lit(block_words).cast("long") if block_words else F.col("size")
    t = targets.select(F.col("source").alias("t_source"), "idx", "blocks", "full", "rest")
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("blocks") / bucket_blocks))).cast("int")
    blocks = (units.where("size > 0").join(t, F.col("source").eqNullSafe(F.col("t_source")))
              .withColumn("bits", bits)
              .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), _blocks(block_words) - 1)))
              .withColumn("words", F.least(width, F.col("size") - F.col("block") * width))
              .withColumn("h", permutation_hash(seed, F.col("doc_id"), F.col("source"),
                                                F.col("size"), F.col("block")))
              .withColumn("bucket", F.expr(f"shiftright(h, {HASH_BITS} - bits)"))
              .select("doc_id", "source", "idx", "size", "copies", "block", "words", "h", "bucket",
                      "full", "rest"))
    totals = blocks.groupBy("idx", "bucket").agg(
        F.sum(F.col("words") * F.col("copies")).alias("w"), F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("idx").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("idx").alias("o_idx"), F.col("bucket").alias("o_bucket"),
        F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("words_before"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("blocks_before"))
    inside = W.partitionBy("idx", "bucket").orderBy("h", "doc_id", "size", "block")
    ranked = (blocks
              .withColumn("seen", F.coalesce(F.sum(F.col("words") * F.col("copies")).over(
                  inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("place", F.row_number().over(inside) - 1)
              .join(offsets, (F.col("idx") == F.col("o_idx")) & (F.col("bucket") == F.col("o_bucket"))))
    left = F.col("rest") - F.col("words_before") - F.col("seen")
    return (ranked.withColumn("rank", F.col("blocks_before") + F.col("place"))
            .withColumn("room", F.greatest(F.lit(0).cast("long"),
                                           F.least(left, F.col("words") * F.col("copies"))))
            .withColumn("part", F.expr("room div copies"))
            .where((F.col("full") > 0) | (F.col("room") > 0))
            .select("doc_id", "source", "idx", "size", "copies", "block", "words", "rank", "h",
                    "full", "room", "part"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """Number of ``good`` items among ``draws`` taken from ``total`` without
    replacement, by inversion of the uniform ``u``: probabilities relative to
    the mode, summed outwards over 12 standard deviations on both sides (where
    the remaining mass is below double precision)."""
    as_double = lambda c: c.cast("double")
    n, k, m = as_double(total), as_double(good), as_double(draws)
    mode = F.least(F.floor((m + 1) * (k + 1) / (n + 2)).cast("double"), m, k)
    mode = F.greatest(mode, m - (n - k), F.lit(0.0))
    sd = F.sqrt(F.greatest(m * k * (n - k) * (n - m) / F.greatest(n * n * F.greatest(n - 1, F.lit(1.0)),
                                                                  F.lit(1.0)), F.lit(0.0)))
    start = F.struct(n.alias("n"), k.alias("k"), m.alias("m"), mode.alias("mode"),
                     F.sequence(F.lit(1), (F.ceil(sd * 12) + 12).cast("int")).alias("steps"))

    def draw(s: Column) -> Column:
        def up(f, x):
            return f * (s["k"] - x) * (s["m"] - x) / ((x + 1) * (s["n"] - s["k"] - s["m"] + x + 1))

        def down(f, x):
            return f * x * (s["n"] - s["k"] - s["m"] + x) / ((s["k"] - x + 1) * (s["m"] - x + 1))

        def total_of(step, sign):
            return F.aggregate(
                s["steps"], F.struct(F.lit(1.0).alias("f"), F.lit(0.0).alias("sum")),
                lambda a, t: _let(F.greatest(F.lit(0.0), step(a["f"], s["mode"] + sign * (t - 1))),
                                  lambda f: F.struct(f.alias("f"), (a["sum"] + f).alias("sum"))),
                lambda a: a["sum"])

        def walk(step, sign, mass):
            return F.aggregate(
                s["steps"], F.struct(F.lit(1.0).alias("f"), mass.alias("mass"), s["mode"].alias("x")),
                lambda a, t: _let(
                    F.greatest(F.lit(0.0), step(a["f"], s["mode"] + sign * (t - 1))),
                    lambda f: F.struct(
                        f.alias("f"), (a["mass"] - f).alias("mass"),
                        F.when((a["mass"] >= 0) & (f > 0), a["x"] + sign).otherwise(a["x"]).alias("x"))),
                lambda a: a["x"])

        return _let(
            F.struct(total_of(up, 1).alias("up"), total_of(down, -1).alias("down")),
            lambda z: _let((z["up"] + z["down"] + 1) * u, lambda r: F.when(r < 1, s["mode"]).when(
                r < 1 + z["up"], walk(up, 1, r - 1)).otherwise(walk(down, -1, r - 1 - z["up"]))))

    return _let(start, draw).cast("long")


def split_quotas(targets: DataFrame, quotas: DataFrame, shards: int, seed: str) -> DataFrame:
    """The splitting tree: one row per (idx, shard) with the run [start, end)
    of the source's drawn places that the shard takes.

    A node holds a run of shards and a block quota for each source; its left
    half draws its quotas from the node's by sequential hypergeometric draws, so
    they are jointly multivariate hypergeometric; the right half gets what is
    left.  Quotas of the leaves sum exactly to the quotas of the root."""
    per = targets.select("idx").join(quotas, "idx", "left").select(
        "idx", F.coalesce("quota", F.lit(0)).cast("long").alias("quota"))
    root = per.agg(F.sort_array(F.collect_list(F.struct("idx", "quota"))).alias("q")).select(
        F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("n"),
        F.col("q.quota").alias("quota"))
    nodes = root.withColumn("all", F.aggregate("quota", F.lit(0).cast("long"), lambda a, x: a + x))

    def cut(place: Column) -> Column:  # blocks of the shards before `place`
        whole, part = F.floor(F.col("all") / shards), F.col("all") % shards
        return (whole * place + F.floor(part * place / shards)).cast("long")

    left_n = F.floor(F.col("n") / 2).cast("long")
    empty = F.array().cast("array<bigint>")

    def draws() -> Column:
        slots = cut(F.col("lo") + left_n) - cut(F.col("lo"))
        pool = F.aggregate("quota", F.lit(0).cast("long"), lambda a, x: a + x)
        first = F.struct(pool.alias("pool"), slots.alias("slots"), empty.alias("out"))

        def step(acc, i):
            good = F.element_at(F.col("quota"), i + 1)
            u = (F.abs(F.xxhash64(F.lit(seed), F.col("lo"), F.col("n"), i)) % (1 << 53)) / float(1 << 53)
            x = hypergeometric(acc["pool"], good, acc["slots"], u)
            return _let(x, lambda v: F.struct(
                (acc["pool"] - good).alias("pool"), (acc["slots"] - v).alias("slots"),
                F.concat(acc["out"], F.array(v)).alias("out")))

        return F.aggregate(F.sequence(F.lit(0), F.size("quota") - 1), first, step, lambda a: a["out"])

    for _ in range(max(0, (shards - 1).bit_length())):
        halves = _let(draws(), lambda left: F.array(
            F.struct(F.col("lo").alias("lo"), left_n.alias("n"), left.alias("quota")),
            F.struct((F.col("lo") + left_n).alias("lo"), (F.col("n") - left_n).alias("n"),
                     F.zip_with("quota", left, lambda a, b: a - b).alias("quota"))))
        alone = F.array(F.struct("lo", "n", "quota"))
        nodes = stored(nodes.where(F.size("quota") > 0).select(
            F.explode(F.when(F.col("n") > 1, halves).otherwise(alone)).alias("x"), "all")
            .select("x.*", "all"), "nodes")
    leaves = nodes.select(F.col("lo").alias("shard"), F.posexplode("quota").alias("idx", "take"))
    earlier = W.partitionBy("idx").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return leaves.withColumn("start", F.coalesce(F.sum("take").over(earlier), F.lit(0))).select(
        "idx", "shard", "start", (F.col("start") + F.col("take")).alias("end")).where("end > start")


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
        max_epochs: int = 2, block_words: int | None = 512, shard_words: int = 8_000_000,
        seed: str = "mix") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sizes, targets, placements) of the mix of ``docs`` (doc_id, source, text).

    placements: shard, order (place key in the shard), source, doc_id, size,
    copies, block, epoch and words (taken of this block in this epoch, for each
    of the ``copies`` equal rows).  ``block_words=None`` makes each document one
    block."""
    sizes = stored(docs.select("doc_id", "source", word_count("text").alias("size")), "sizes")
    units = sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies"))
    targets = stored(source_targets(sizes, weights, share, max_epochs, block_words), "targets")
    # One row per source each, stored: their size is known, so no join deals the
    # blocks by source, the hot key.
    per = stored(_unit_blocks(units, targets, block_words), "unit_blocks")
    draws = stored(draw_blocks(units, per, seed, block_words), "draws")
    quotas = stored(draws.groupBy("idx").agg(
        (F.sum("full") + F.sum((F.col("room") > 0).cast("long"))).alias("quota"),
        F.count(F.lit(1)).alias("blocks")), "quotas")
    words = targets.agg(F.sum("target")).first()[0] or 0.0
    shards = max(1, int(-(-words // shard_words)))
    runs = stored(split_quotas(targets, quotas, shards, seed), "runs")
    grain = quotas.select(F.col("idx").alias("g_idx"), "blocks",
                          F.ceil(F.col("quota") / shards).cast("long").alias("grain"))
    cells = (runs.join(grain, F.col("idx") == F.col("g_idx"))
             .withColumn("cell", F.explode(F.sequence(F.expr("start div grain"),
                                                      F.expr("(end - 1) div grain"))))
             .select(F.col("idx").alias("c_idx"), "cell", "shard", "start", "end"))
    # Places 0, 1, ... of a source: its whole passes one after another, then the broken one.
    epochs = F.expr("sequence(0L, full - IF(room > 0, 0L, 1L))")
    taken = (draws.join(grain, F.col("idx") == F.col("g_idx"))
             .withColumn("epoch", F.explode(epochs))
             .withColumn("place", F.col("epoch") * F.col("blocks") + F.col("rank"))
             .withColumn("words", F.when(F.col("epoch") < F.col("full"), F.col("words"))
                         .otherwise(F.col("part")))
             .withColumn("p_cell", F.expr("place div grain")))
    placements = (taken.join(cells, (F.col("idx") == F.col("c_idx")) & (F.col("p_cell") == F.col("cell"))
                             & (F.col("place") >= F.col("start")) & (F.col("place") < F.col("end")))
                  .select("shard", permutation_hash(seed + "-order", F.col("shard"), F.col("h"),
                                                    F.col("epoch")).alias("order"),
                          "source", "doc_id", "size", "copies", "block", "epoch", "words"))
    return sizes, targets, placements


def _unit_blocks(units: DataFrame, targets: DataFrame, block_words: int | None) -> DataFrame:
    """``targets`` with ``blocks`` counted over units (equal rows count once)."""
    per = units.groupBy("source").agg(F.sum(_blocks(block_words)).alias("unit_blocks"))
    per = per.withColumnRenamed("source", "u_source")
    return (targets.join(per, F.col("source").eqNullSafe(F.col("u_source")))
            .withColumn("blocks", F.col("unit_blocks")).drop("u_source", "unit_blocks"))


def shuffled(placed: DataFrame, pieces: int = 16) -> DataFrame:
    """Rows with (shard, order) dealt by shard, each shard in its own random order.
    ``order`` is a hash of ``HASH_BITS`` bits, so ``pieces`` equal ranges of it cut a
    shard into runs of about equal size, each sorted in a task of its own."""
    piece = F.shiftright("order", HASH_BITS - (pieces - 1).bit_length())
    parts = max(1, int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return placed.withColumn("piece", piece).repartition(parts, "shard", "piece").sortWithinPartitions(
        "shard", "piece", "order")


def taken_words(sizes: DataFrame, targets: DataFrame, placements: DataFrame) -> DataFrame:
    """One row per row of ``sizes``: doc_id, size, source_size, target, taken."""
    keys = ("doc_id", "source", "size")
    per = placements.groupBy(*keys).agg(F.sum("words").alias("taken"))
    per = per.select(*[F.col(k).alias(f"p_{k}") for k in keys], "taken")
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    on = [F.col(k).eqNullSafe(F.col(f"p_{k}")) for k in keys]
    return (sizes.join(per, on, "left").join(t, F.col("source").eqNullSafe(F.col("t_source")))
            .select("doc_id", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix as documents: a document as often as the mix takes it, whole, with
    the columns of ``docs``, by shard and in the shard's random order.  Blocks are
    whole documents here; of a source's broken pass the last document is taken
    whole as well, so a source may exceed its target by less than one document."""
    _, _, placements = mix(docs, block_words=None, **options)
    keys = ("doc_id", "source", "size")
    drawn = placements.where("words > 0").select(*[F.col(k).alias(f"p_{k}") for k in keys], "shard", "order")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"),
                       word_count("text").alias("size"))
    made = rows.join(drawn, F.col("d.doc_id").eqNullSafe(F.col("p_doc_id"))
                     & F.col("d.source").eqNullSafe(F.col("p_source")) & (F.col("size") == F.col("p_size")))
    return shuffled(made.select("d", "shard", "order")).select("d.*")
