"""Runs of words that another document holds too, wherever they begin and end.

A text is cut into content-defined units: a unit begins at a word pair whose hash
is the least of the ``reach`` pairs before and after it, so equal runs of words are
cut alike whatever stands around them and wherever lines end.  Units held by two
different texts are candidates.  Around them the match is extended word by word,
exactly: every window of ``min_words`` words that contains a candidate unit is
known by hashes of 96 bits, and a window of two texts is a run of both.  Windows that
overlap are one run.  A shared run of ``min_words`` words without one whole unit
inside is missed: one in 10,000 with ``reach`` 4.

Texts of the same words are one text here, so a group of copies is searched once.
Units and windows are counted before they meet again; the others are sifted out by a
bitmap (``sieve``) before the join, and keys that many texts hold go by broadcast of
bounded size (``minhash.looked_up``).

Defined cases: as in ``substring``; a text of fewer than ``min_words`` words has no
run; a run that only one text repeats within itself is none; a null id is a document
by its text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.llm import scratch
from workpulse.llm.minhash import HOT_SHARE, SENT_ROWS, looked_up
from workpulse.llm.scratch import stored
from workpulse.llm.sieve import sieve, sifted
from workpulse.llm.simhash import xxh64_spans

#: Odd factors of two polynomial hashes over word hashes, and their inverses modulo 2^64.
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_INVERSES = tuple(pow(f, -1, 1 << 64) for f in _FACTORS)
BYTES_AT_ONCE = 1 << 20


def word_hashes(words: list[bytes]) -> np.ndarray:
    if not words:
        return np.zeros(0, np.uint64)
    data = b" ".join(words)
    ends = np.r_[np.flatnonzero(np.frombuffer(data, np.uint8) == 32), len(data)]
    return xxh64_spans(data, np.r_[0, ends[:-1] + 1], ends)


_powers: dict[int, np.ndarray] = {}


def powers(factor: int, n: int) -> np.ndarray:
    """The first ``n`` powers of an odd number modulo 2^64."""
    if len(_powers.get(factor, ())) < n:
        with np.errstate(over="ignore"):
            _powers[factor] = np.r_[np.ones(1, np.uint64), np.cumprod(np.full(max(n, 1 << 18), factor, np.uint64))]
    return _powers[factor][:n]


class Sums:
    """Hashes of any runs of words, wherever in ``words`` they stand."""

    def __init__(self, words: np.ndarray, which: int):
        n = len(words)
        mixed = (words ^ (words >> np.uint64(29 + which))) * np.uint64(_FACTORS[1 - which])
        with np.errstate(over="ignore"):
            self.down = powers(_INVERSES[which], n + 1)
            self.upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * powers(_FACTORS[which], n))])

    def runs(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The hashes of the words from ``first`` up to before ``last``."""
        with np.errstate(over="ignore"):
            h = (self.upto[last] - self.upto[first]) * self.down[first]
            return h ^ (h >> np.uint64(31))


def cuts(words: np.ndarray, reach: int, low: np.ndarray | int = 0, high: np.ndarray | None = None) -> np.ndarray:
    """Where units begin, as far as the words around decide it; ``low`` and ``high``
    are for each word where its text begins and ends."""
    if len(words) < 2 * reach + 2:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        pairs = (words[:-1] ^ (words[1:] * np.uint64(_FACTORS[0]))) * np.uint64(_FACTORS[1])
    pairs ^= pairs >> np.uint64(32)
    least = pairs[:len(pairs) - 2 * reach].copy()
    for k in range(1, 2 * reach + 1):
        np.minimum(least, pairs[k:len(pairs) - 2 * reach + k], out=least)
    at = np.flatnonzero(pairs[reach:len(pairs) - reach] == least) + reach
    if high is not None:
        at = at[(at - reach >= low[at]) & (at + reach + 1 < high[at])]
    return at


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[list[bytes]]]]:
    """Rows of a batch and their words, about ``BYTES_AT_ONCE`` of text at a time."""
    texts, rows, words, held = batch.column("text").cast(pa.binary()), [], [], 0
    for i, text in enumerate(texts):
        text = text.as_py() or b""
        rows.append(i)
        words.append(text.lower().split())
        held += len(text)
        if held > BYTES_AT_ONCE:
            yield rows, words
            rows, words, held = [], [], 0
    if rows:
        yield rows, words


def units(docs: DataFrame, min_words: int, reach: int) -> DataFrame:
    """(dkey, n, digest, hashes, starts) of every text of at least ``min_words``
    words: the digest of its words, the hashes of its units and where each begins
    (one start more than units)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, words in _chunks(batch):
                some = [(i, w) for i, w in zip(rows, words) if len(w) >= min_words]
                if not some:
                    continue
                n = np.array([len(w) for _, w in some])
                stop = np.cumsum(n)
                each = word_hashes([x for _, w in some for x in w])
                begin = cuts(each, reach, np.repeat(stop - n, n), np.repeat(stop, n))
                owner = np.searchsorted(stop, begin, side="right")
                count = np.bincount(owner, minlength=len(n))
                # A unit goes from one cut of a text to its next.
                inner = np.flatnonzero(owner[1:] == owner[:-1])
                hashes = Sums(each, 0).runs(begin[inner], begin[inner + 1]).view(np.int64)
                lists = lambda sizes, flat: pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("dkey").take(pa.array([i for i, _ in some], pa.int64())), pa.array(n, pa.int32()),
                     pa.array([hashlib.blake2b(b" ".join(w), digest_size=16).digest() for _, w in some], pa.binary()),
                     lists(np.maximum(count - 1, 0), hashes),
                     lists(count, (begin - (stop - n)[owner]).astype(np.int32))],
                    names=["dkey", "n", "digest", "hashes", "starts"])

    return docs.select(F.xxhash64("doc_id", "text").alias("dkey"), "text").mapInArrow(
        run, "dkey long, n int, digest binary, hashes array<long>, starts array<int>")


def placed(texts: DataFrame, by: Broadcast) -> DataFrame:
    """(id, h, at, stop): the units of the texts (id, hashes, starts) that may be in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (n, flat), (m, starts) = ((np.diff(c.offsets.to_numpy()), c.flatten().to_numpy())
                                      for c in (batch.column("hashes"), batch.column("starts")))
            hits = np.flatnonzero(by.value.holds(flat))
            owner = np.searchsorted(np.cumsum(n), hits, side="right")
            at = (np.cumsum(m) - m)[owner] + hits - (np.cumsum(n) - n)[owner]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(owner, pa.int64())), pa.array(flat[hits]), pa.array(starts[at]),
                 pa.array(starts[np.minimum(at + 1, len(starts) - 1)])], names=["id", "h", "at", "stop"])

    return texts.select("id", "hashes", "starts").mapInArrow(run, "id long, h long, at int, stop int")


def windows(texts: DataFrame, min_words: int) -> DataFrame:
    """(w, b, id, at): two hashes of each window of the texts (id, text, spots) that
    contains one of the ``spots`` (first word, word after the last) whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, spots = batch.column("id").to_numpy(), batch.column("spots")
            for rows, words in _chunks(batch):
                n = np.array([len(w) for w in words])
                base = np.cumsum(n) - n
                part = spots.slice(rows[0], len(rows))
                count = np.diff(part.offsets.to_numpy())
                flat = part.flatten()
                first, stop = (flat.field(k).to_numpy().astype(np.int64) for k in (0, 1))
                owner = np.repeat(np.arange(len(rows)), count)
                low = np.maximum(stop - min_words, 0)
                high = np.minimum(first, n[owner] - min_words)
                ok = low <= high
                marks = np.zeros(int(n.sum()) + 2, np.int64)
                np.add.at(marks, (base[owner] + low)[ok], 1)
                np.add.at(marks, (base[owner] + high + 1)[ok], -1)
                at = np.flatnonzero(np.cumsum(marks) > 0)
                if not len(at):
                    continue
                each = word_hashes([x for w in words for x in w])
                w, b = (Sums(each, k).runs(at, at + min_words) for k in (0, 1))
                mine = np.searchsorted(base, at, side="right") - 1
                # texts without words share their place with the next one, which is meant
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w.view(np.int64)), pa.array((b >> np.uint64(32)).astype(np.uint32).view(np.int32)), pa.array(ids[rows[0]:rows[-1] + 1][mine]),
                     pa.array((at - base[mine]).astype(np.int32))], names=["w", "b", "id", "at"])

    return texts.select("id", "text", "spots").mapInArrow(run, "w long, b int, id long, at int")


def _joined_runs(found: DataFrame, min_words: int) -> DataFrame:
    """(id, runs, n_later) from (id, ats: window places and whether another text has
    the window first)."""
    kind = "array<struct<first:int,last:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ats = batch.column("ats")
            if not len(ats):
                continue
            flat, owner = ats.flatten(), np.repeat(np.arange(len(ats)), np.diff(ats.offsets.to_numpy()))
            at = flat.field("at").to_numpy().astype(np.int64)
            order = np.lexsort((at, owner))
            at, owner = at[order], owner[order]
            fresh = np.r_[True, (owner[1:] != owner[:-1]) | (at[1:] > at[:-1] + min_words)]
            first = np.flatnonzero(fresh)
            last = np.r_[first[1:] - 1, len(at) - 1]
            count = np.bincount(owner[first], minlength=len(ats))
            runs = pa.StructArray.from_arrays([pa.array(at[first].astype(np.int32)),
                                               pa.array((at[last] + min_words - 1).astype(np.int32))], ["first", "last"])
            # A window covers its words up to where the next later one of its text begins.
            later = np.flatnonzero(flat.field("later").to_numpy(zero_copy_only=False)[order])
            upto, mine = at[later], owner[later]
            words = np.full(len(later), min_words)
            words[:-1] = np.where(mine[1:] == mine[:-1], np.minimum(upto[1:] - upto[:-1], min_words), min_words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(count)], pa.int32()), runs),
                 pa.array(np.bincount(mine, words, len(ats)).astype(np.int64))], names=["id", "runs", "n_later"])

    return found.mapInArrow(run, f"id long, runs {kind}, n_later long")


def repeated_runs(docs: DataFrame, min_words: int = 50, reach: int = 4) -> DataFrame:
    """(r_dkey, runs, n_run_words, n_later_words) of every document with a run of
    ``min_words`` words or more that another document holds: the runs by first and
    last word, the words in them, and those that another text holds first."""
    spark = docs.sparkSession
    cut = stored(units(docs, min_words, reach), "units")
    every = stored(cut.select(F.col("dkey").alias("r_dkey"), "digest").distinct(), "texts_of")
    texts = stored(cut.groupBy("digest").agg(
        F.min("dkey").alias("low"), F.max("dkey").alias("high"), F.max("n").alias("n"), F.first("hashes").alias("hashes"),
        F.first("starts").alias("starts")).withColumn("id", F.monotonically_increasing_id()), "texts")
    scratch.drop(spark, cut)
    held = stored(texts.select("id", F.explode("hashes").alias("h")).groupBy("h").agg(F.min("id").alias("x"), F.max("id").alias("y"), F.count(F.lit(1)).alias("c"))
                  .where("x <> y").select("h", "c"), "held")
    total = texts.agg(F.sum(F.size("hashes"))).first()[0] or 0
    often = F.col("c") * HOT_SHARE * 64 > total  # at most 64 * HOT_SHARE keys
    some = stored(placed(texts, sieve(held, "h")), "places")
    met = looked_up(some, held, "h", often).groupBy("id").agg(F.collect_list(F.struct("at", "stop")).alias("spots"))
    met = stored(met.join(texts.select(F.col("id").alias("t_id"), "low"), F.col("id") == F.col("t_id")).select(
        "id", "low", "spots"), "spots")
    for done in (held, some):
        scratch.drop(spark, done)
    one = docs.select(F.xxhash64("doc_id", "text").alias("dkey"), "text")
    if (met.agg(F.sum(F.size("spots"))).first()[0] or 0) <= 4 * SENT_ROWS:
        met = F.broadcast(met)
    else:
        one = sifted(one, "dkey", sieve(met, "low"))  # texts without spots need not travel
    one = one.join(met, F.col("dkey") == F.col("low"))
    # A document that is there twice gives its windows twice; the aggregates below take them once.
    found = stored(windows(one, min_words), "windows")
    # The second hash does not travel as a key: where one value of the first has two
    # of the second, it is no match.
    twice = stored(found.groupBy("w").agg(
        F.min("id").alias("x"), F.max("id").alias("y"), F.min("b").alias("b1"), F.max("b").alias("b2"),
        F.count(F.lit(1)).alias("c")).where("x <> y AND b1 = b2").select("w", "x", "c"), "shared")
    often = F.col("c") * HOT_SHARE * 64 > found.count()
    places = looked_up(sifted(found.select("w", "id", "at"), "w", sieve(twice, "w")), twice, "w", often).groupBy("id").agg(F.collect_set(
        F.struct("at", (F.col("id") != F.col("x")).alias("later"))).alias("ats"))
    runs = stored(_joined_runs(places, min_words), "runs")
    for done in (found, twice):
        scratch.drop(spark, done)
    whole = F.array(F.struct(F.lit(0).alias("first"), (F.col("n") - 1).alias("last")))
    copied = F.col("low") != F.col("high")  # the whole text is in several documents
    made = stored(texts.select(F.col("digest").alias("t_digest"), "id", "low", "high", "n").join(
        runs.withColumnRenamed("id", "r_id"), F.col("id") == F.col("r_id"), "left").where(
        copied | F.col("runs").isNotNull()).select(
        "t_digest", "low", F.when(copied, whole).otherwise(F.col("runs")).alias("runs"), copied.alias("copied"), "n",
        F.coalesce("n_later", F.lit(0)).alias("n_later")), "found")
    words = F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["last"] - r["first"] + 1)
    return every.join(made, F.col("digest") == F.col("t_digest")).select(
        "r_dkey", "runs", words.alias("n_run_words"),
        F.when(F.col("copied") & (F.col("r_dkey") != F.col("low")), F.col("n")).otherwise(F.col("n_later"))
        .cast("long").alias("n_later_words"))
