"""Quality rules and robust multivariate outliers.

Five counts of each text give base rules and a vector of transformed statistics.
For every language and source a minimum covariance determinant estimate is
fitted to the vectors of all documents that pass the base rules.  From three
starts (medians and quartiles; the shortest interval with half the rows on each
axis; spatial signs about the medians) concentration steps take the mean and
covariance of the nearer half of the group's rows until no determinant falls any
more; the fit of least determinant stays, so up to nearly half of a group may be
junk.  A document is rejected when its squared Mahalanobis distance, with the
estimate scaled for consistency at the normal model, exceeds the limit: the
chi-square quantile that one normal row in ``1 / tail`` passes.

Every step is two aggregates over all rows (an approximate quantile of the
distances by group and start, then sums and products of the nearer rows),
partially done before the shuffle, so a group with a third of all rows is never
gathered.  A group under ``min_rows`` rows is judged by its language, a language under that
by all rows (fitted only where there is such a one), and nothing is rejected when
there are fewer rows in all.

Defined cases: a null or empty text has no words and fails the base rules; null
language or source are groups of their own; a null id is kept as it is; repeated
rows each count; an empty table gives an empty result; only the named columns
are read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workpulse.llm.scratch import stored
from workpulse.llm.texts import SPACES

SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What every fit adds to the standard deviation of each axis (in squares), so
#: that an axis on which most rows agree does not reject every other row.
FLOORS = (0.5, 0.4, 0.3, 0.4, 0.08)
DIMS = len(FLOORS)


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """The counts named in STATS."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()  # bytes split at ASCII white space only
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    threes = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(threes)) < len(threes):
        often = Counter(threes)
        covered = 0  # words up to here are counted
        for i, three in enumerate(threes):
            if often[three] > 1:
                repeated += i + 3 - max(i, covered)
                covered = i + 3
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated


def with_stats(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the columns of STATS."""
    rows = docs.select("doc_id", "lang", "source", "text")
    keys = ["doc_id", "lang", "source"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([text_stats(t.as_py()) for t in batch.column("text")], np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keys] + [
                pa.array(made[:, i].copy()) for i in range(5)], names=keys + list(STATS))

    fields = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    return rows.mapInArrow(run, fields + "".join(f", {s} long" for s in STATS))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def transformed() -> Column:
    """Vector of the statistics: lengths and rates, logarithms of what is skewed."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return F.array(F.log(n), F.col("word_chars") / n, F.log1p(F.col("n_symbols") / n * 20),
                   F.log1p(F.col("n_dup_lines") / n * 50), F.col("n_repeat_words") / n)


def chi2_cdf(x: float, k: int) -> float:
    a, z = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= z / n
        total += term
    return total * math.exp(-z + a * math.log(z) - math.lgamma(a)) if x > 0 else 0.0


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return high


_GROUP = ("level", "g_lang", "g_source")


def _wanted(vectors: DataFrame, min_rows: int) -> DataFrame:
    """(w_lang, w_source, levels): at which levels the vectors of a language and
    source are fitted.  A group of ``min_rows`` rows judges its own; a language is
    fitted only where a group of it is smaller, all rows only where a language is."""
    groups = stored(vectors.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")), "groups")
    langs = groups.groupBy(F.col("lang").alias("l_lang")).agg(
        F.sum("n").alias("l_n"), F.max((F.col("n") < min_rows).cast("int")).alias("small"))
    all_small = not langs.where(f"l_n < {min_rows}").isEmpty()
    met = groups.join(langs, F.col("lang").eqNullSafe(F.col("l_lang")))
    levels = F.array(F.col("n") >= min_rows, (F.col("small") == 1) & (F.col("l_n") >= min_rows), F.lit(all_small))
    return met.select(F.col("lang").alias("w_lang"), F.col("source").alias("w_source"), levels.alias("levels"))


def _grouped(vectors: DataFrame, min_rows: int) -> DataFrame:
    """Each vector once for each of its groups that is fitted: its language and
    source, its language, all."""
    kinds = [vectors.schema[c].dataType.simpleString() for c in ("lang", "source")]
    levels = [F.struct(F.lit(i).alias("level"),
                       (F.col("lang") if i < 2 else F.lit(None).cast(kinds[0])).alias("g_lang"),
                       (F.col("source") if i < 1 else F.lit(None).cast(kinds[1])).alias("g_source"))
              for i in range(3)]
    met = vectors.join(_wanted(vectors, min_rows), F.col("lang").eqNullSafe(F.col("w_lang"))
                       & F.col("source").eqNullSafe(F.col("w_source")))
    fitted = F.filter(F.array(*levels), lambda g: F.element_at("levels", g["level"] + 1))
    return met.withColumn("g", F.explode(fitted)).select("g.*", "x")


def _near(rows: DataFrame, fits: DataFrame) -> DataFrame:
    """``rows`` with d2, the squared distance under each of the group's fits."""
    f = fits.select(*[F.col(c).alias(f"f_{c}") for c in fits.columns])
    on = [F.col(c).eqNullSafe(F.col(f"f_{c}")) for c in _GROUP]
    delta = [F.col("x")[i] - F.col("f_mean")[i] for i in range(DIMS)]
    d2 = sum(delta[i] * delta[j] * F.col("f_inverse")[i * DIMS + j] for i in range(DIMS) for j in range(DIMS))
    return rows.join(f, on).withColumn("d2", d2)


def _fit_rows(scale: float):
    floors = np.diag(np.square(FLOORS))

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            mean, inverse, size = [], [], []
            for n, s, ss in zip(df["n"], df["s"], df["ss"]):
                m = np.asarray(s, float) / n
                cov = (np.asarray(ss, float).reshape(DIMS, DIMS) / n - np.outer(m, m)) * scale + floors
                mean.append(m)
                inverse.append(np.linalg.inv(cov).ravel())
                size.append(np.linalg.slogdet(cov)[1])
            yield df[[*_GROUP, "start", "rows"]].assign(mean=mean, inverse=inverse, logdet=size)
    return fit


#: The quantiles of each axis from which the starts are made.
_GRID = [i / 40 for i in range(41)]


def _box_starts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Starts 0 (median and quartiles) and 1 (shortest half) of groups with quantiles ``q``."""
    half = len(_GRID) // 2
    for df in frames:
        for start in (0, 1):
            mean, inverse = [], []
            for q in df["q"]:
                q = np.array([np.asarray(axis, float) for axis in q])
                at = np.arange(DIMS)
                first = (q[:, half:] - q[:, :half + 1]).argmin(axis=1)
                low, high = (q[:, half // 2], q[:, half + half // 2]) if not start else (
                    q[at, first], q[at, first + half])
                mean.append((low + high) / 2 if start else q[:, half])
                inverse.append(np.diag(np.maximum((high - low) / 1.349, FLOORS) ** -2.0).ravel())
            yield df[[*_GROUP, "rows"]].assign(start=start, mean=mean, inverse=inverse, logdet=float("inf"))


def _sign_starts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Start 2 from the sums of products of the signs of the scaled vectors."""
    for df in frames:
        inverse = []
        for n, ss, old in zip(df["n"], df["ss"], df["inverse"]):
            unit = np.sqrt(np.diag(np.asarray(old, float).reshape(DIMS, DIMS)))
            shape = DIMS * np.asarray(ss, float).reshape(DIMS, DIMS) / n + 0.01 * np.eye(DIMS)
            inverse.append((np.linalg.inv(shape) * np.outer(unit, unit)).ravel())
        yield df[[*_GROUP, "rows"]].assign(start=2, mean=df["mean"], inverse=inverse, logdet=float("inf"))


def fit_mcd(vectors: DataFrame, share: float = 0.5, max_steps: int = 50, min_rows: int = 1) -> DataFrame:
    """(level, g_lang, g_source, rows, mean, inverse) of every fitted group of
    ``vectors`` (lang, source, x).  A start takes steps until its determinant falls
    by less than a thousandth; ``max_steps`` that do not suffice raise."""
    rows = stored(_grouped(vectors, min_rows), "vectors")
    scale = share / chi2_cdf(chi2_quantile(share, DIMS), DIMS + 2)
    cols = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in _GROUP)
    fields = f"{cols}, start int, rows long, mean array<double>, inverse array<double>, logdet double"
    order = [*_GROUP, "start", "rows", "mean", "inverse", "logdet"]

    def made(frame: DataFrame, run) -> DataFrame:
        ordered = lambda frames: (df[order] for df in run(frames))
        return frame.mapInPandas(ordered, fields)

    quantiles = rows.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("rows"), F.array(*[
        F.percentile_approx(F.col("x")[i], _GRID, 1000) for i in range(DIMS)]).alias("q"))
    boxes = stored(made(quantiles, _box_starts), "boxes")
    z = [(F.col("x")[i] - F.col("f_mean")[i]) * F.sqrt(F.col("f_inverse")[i * DIMS + i]) for i in range(DIMS)]
    signs = _near(rows, boxes.where("start = 0")).groupBy(*_GROUP).agg(
        F.first("f_rows").alias("rows"), F.first("f_mean").alias("mean"), F.first("f_inverse").alias("inverse"),
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(F.when(F.col("d2") > 0, a * b / F.col("d2")).otherwise(0.0)) for a in z for b in z])
        .alias("ss"))
    fits = stored(boxes.union(made(signs, _sign_starts)), "start")
    best = fits
    keys = [*_GROUP, "start"]
    for _ in range(max_steps):
        near = _near(rows, fits)
        cut = near.groupBy(*_GROUP, F.col("f_start").alias("start")).agg(
            F.percentile_approx("d2", share, 1000).alias("cut"))
        withcut = stored(fits.join(cut.select(*[F.col(c).alias(f"c_{c}") for c in keys], "cut"),
                                   [F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in keys])
                         .select(*fits.columns, "cut"), "cut")
        x = [F.col("x")[i] for i in range(DIMS)]
        sums = _near(rows, withcut).where("d2 <= f_cut").groupBy(*_GROUP, F.col("f_start").alias("start")).agg(
            F.first("f_rows").alias("rows"), F.count(F.lit(1)).alias("n"),
            F.array(*[F.sum(a) for a in x]).alias("s"),
            F.array(*[F.sum(a * b) for a in x for b in x]).alias("ss"))
        fits = stored(made(sums, _fit_rows(scale)), "fits")
        # The quantile is approximate, so the least determinant of each start is carried.
        now = F.struct("logdet", "mean", "inverse")
        best = stored(fits.select(*[F.col(c).alias(f"n_{c}") for c in keys], now.alias("now")).join(
            best, [F.col(c).eqNullSafe(F.col(f"n_{c}")) for c in keys], "right").withColumn(
            "b", F.coalesce(F.least("now", now), now)).select(
            *keys, "rows", "b.mean", "b.inverse", "b.logdet",
            F.coalesce(F.col("now.logdet") < F.col("logdet") - 1e-3, F.lit(False)).alias("fell")), "best")
        # Only the starts that still fall take another step.
        fell = best.where("fell").select(*[F.col(c).alias(f"k_{c}") for c in keys])
        fits = stored(fits.join(fell, [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in keys], "left_semi"), "moving")
        if fits.isEmpty():
            break
    else:
        raise RuntimeError(f"the concentration did not settle in {max_steps} steps")
    least = F.min(F.struct("logdet", "start", "rows", "mean", "inverse")).alias("b")
    return stored(best.groupBy(*_GROUP).agg(least).select(*_GROUP, "b.rows", "b.mean", "b.inverse"), "mcd")


def judged(docs: DataFrame, tail: float = 1e-7, min_rows: int = 100) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, source, STATS, base_failed, d2, kept."""
    limit = chi2_quantile(1 - tail, DIMS)
    stats = stored(with_stats(docs).withColumn("base_failed", base_failed()), "stats")
    fits = fit_mcd(stats.where("NOT base_failed").select("lang", "source", transformed().alias("x")),
                   min_rows=min_rows)
    fits = fits.where(f"rows >= {min_rows}")
    made = stats.withColumn("x", transformed())
    delta = [F.col("x")[i] - F.col("f.mean")[i] for i in range(DIMS)]
    d2 = sum(delta[i] * delta[j] * F.col("f.inverse")[i * DIMS + j] for i in range(DIMS) for j in range(DIMS))
    for level in range(3):
        name = f"fit{level}"
        some = fits.where(f"level = {level}").select(
            F.col("g_lang").alias(f"l{level}"), F.col("g_source").alias(f"s{level}"),
            F.struct("mean", "inverse").alias(name))
        on = [F.lit(True)] if level == 2 else [F.col("lang").eqNullSafe(F.col(f"l{level}"))]
        if level == 0:
            on.append(F.col("source").eqNullSafe(F.col("s0")))
        if level == 2:
            whole = some.first()  # one row: the fit of all rows
            made = made.withColumn(name, F.struct(
                F.array(*map(F.lit, whole[name]["mean"])).alias("mean"),
                F.array(*map(F.lit, whole[name]["inverse"])).alias("inverse")) if whole else
                F.lit(None).cast("struct<mean:array<double>,inverse:array<double>>"))
        else:
            made = made.join(some, on, "left")
    made = made.withColumn("f", F.coalesce("fit0", "fit1", "fit2")).withColumn("d2", d2)
    return made.withColumn("kept", ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= limit)).select(
        "doc_id", "lang", "source", *STATS, "base_failed", "d2", "kept")
