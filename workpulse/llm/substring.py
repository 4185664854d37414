"""Passages that repeat across documents: paragraph MinHash banding.

``passages`` puts together two kinds of paragraphs: lines, which near copies of
lines are found by (this module), and content-defined units of words, which passages
that lie anywhere in longer lines are found by, extended word by word (``runs``).

A paragraph is a line of a text.  Equal paragraphs (words compared without case)
are one class.  Classes of enough words get a MinHash signature of their sets of
five-word shingles; the bands are tuned so that two classes at the similarity
limit share one with a probability of ``recall``.  Classes that collide in a band
meet in groups of bounded size, where exact Jaccard similarity of the shingle sets
decides; pairs already connected are not compared again and each group returns a
spanning forest, never its pairs.  Components of classes are clusters; in each,
the first occurrence by document and position stays and the others are removed.
A document's passages are its runs of paragraphs that other documents hold too,
from ``min_words`` words on.

A paragraph of fewer than 8 words has under 4 shingles, where only equal sets
reach a similarity of 0.8, so such classes need no bands.

Defined cases: a null or empty text has no paragraphs; a paragraph without words
is skipped and does not break a run; fewer words than a shingle make one shingle;
rows equal in id and text count as one document, and rows without an id by their
text; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.llm.components import connected_components
from workpulse.llm.runs import repeated_runs
from workpulse.llm import scratch
from workpulse.llm.scratch import stored
from workpulse.llm.sieve import sieve
from workpulse.llm.simhash import xxh64_spans

SHINGLE = 5
BANDED_WORDS = 8
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def tuned_bands(limit: float, rows: int, recall: float) -> int:
    """Least number of bands of ``rows`` rows that catch similarity ``limit`` with ``recall``."""
    bands = 1
    while 1 - (1 - limit ** rows) ** bands < recall:
        bands += 1
    return bands


def shingle_set(line: bytes) -> np.ndarray:
    """Sorted distinct hashes of the line's five-word shingles."""
    words = line.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    data = b" ".join(words)
    ends = np.r_[np.flatnonzero(np.frombuffer(data, np.uint8) == 32), len(data)]
    each = xxh64_spans(data, np.r_[0, ends[:-1] + 1], ends)
    return np.unique(_rolled(each, min(SHINGLE, len(words))))


def _rolled(each: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` word hashes."""
    n = len(each) - width + 1
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            h = (h ^ each[k:k + n]) * _PRIME
            h ^= h >> np.uint64(29)
    return h


def signatures(sets: list[np.ndarray], bands: int, rows: int) -> np.ndarray:
    """Band keys (one long for each band) of non-empty shingle sets."""
    flat = np.concatenate(sets)
    first = np.cumsum([0] + [len(s) for s in sets[:-1]])
    seeds = np.random.default_rng(5).integers(1, 1 << 63, bands * rows, dtype=np.uint64) | np.uint64(1)
    keys = np.zeros((len(sets), bands), np.uint64)
    flat = flat ^ (flat >> np.uint64(31))
    mixed, high = np.empty_like(flat), np.empty_like(flat)
    with np.errstate(over="ignore"):
        for i, seed in enumerate(seeds):
            np.multiply(flat, seed, out=mixed)
            np.right_shift(mixed, np.uint64(32), out=high)
            np.bitwise_xor(mixed, high, out=mixed)
            low = np.minimum.reduceat(mixed, first)
            b = i // rows
            keys[:, b] = (keys[:, b] ^ low) * _PRIME
            keys[:, b] ^= keys[:, b] >> np.uint64(32)
    return keys.view(np.int64)


def paragraphs(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(doc_id, dkey, pos, words, phash, keys): a row per paragraph with words;
    ``keys`` (band keys) only on the first of its class in a batch."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                which, pos, words, phash, sets, owner, seen = [], [], [], [], [], [], set()
                for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                    for p, line in enumerate((text or b"").lower().split(b"\n")):
                        parts = line.split()
                        if not parts:
                            continue
                        joined = b" ".join(parts)
                        h = xxhash.xxh64_intdigest(joined)
                        if len(parts) >= BANDED_WORDS and h not in seen:
                            seen.add(h)
                            owner.append(len(which))
                            sets.append(joined)
                        which.append(i)
                        pos.append(p)
                        words.append(len(parts))
                        phash.append(h)
                keys, some = np.zeros(0, np.int64), np.zeros(len(which), bool)
                if sets:
                    data = b" ".join(sets)  # all words at once; runs do not cross paragraphs
                    ends = np.r_[np.flatnonzero(np.frombuffer(data, np.uint8) == 32), len(data)]
                    each = xxh64_spans(data, np.r_[0, ends[:-1] + 1], ends)
                    n = np.array([words[o] for o in owner])
                    first = np.cumsum(n) - n
                    rolled = _rolled(each, SHINGLE)
                    inside = [rolled[a:a + k - SHINGLE + 1] for a, k in zip(first, n)]
                    keys = signatures(inside, bands, rows).ravel()
                    some[owner] = True
                offsets = np.r_[0, np.cumsum(some * bands)]
                take = pa.array(which, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(take), batch.column("dkey").take(take),
                     pa.array(pos, pa.int32()), pa.array(words, pa.int32()),
                     pa.array(np.array(phash, np.uint64).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=np.r_[~some, False]), pa.array(keys))],
                    names=["doc_id", "dkey", "pos", "words", "phash", "keys"])

    source = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("dkey"), "text")
    return source.mapInArrow(
        run, f"doc_id {kind}, dkey long, pos int, words int, phash long, keys array<bigint>")


def _class_sets(docs: DataFrame, by: Broadcast) -> DataFrame:
    """(phash, line): the words of every banded paragraph that may be in the bitmap, once a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {}
            for text in batch.column("text").cast(pa.binary()):
                for line in (text.as_py() or b"").lower().split(b"\n"):
                    parts = line.split()
                    if len(parts) >= BANDED_WORDS:
                        joined = b" ".join(parts)
                        found[xxhash.xxh64_intdigest(joined)] = joined
            phash, lines = np.array(list(found), np.uint64).view(np.int64), list(found.values())
            hits = np.flatnonzero(by.value.holds(phash))
            yield pa.RecordBatch.from_arrays(
                [pa.array(phash[hits]), pa.array([lines[i].decode() for i in hits], pa.string())], names=["phash", "line"])

    return docs.select("text").mapInArrow(run, "phash long, line string")


def _band_keys(banded: DataFrame, by: Broadcast) -> DataFrame:
    """(phash, key): the band keys of the classes (phash, keys) that may be in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("keys")
            flat, ends = keys.flatten().to_numpy(), np.cumsum(np.diff(keys.offsets.to_numpy()))
            hits = np.flatnonzero(by.value.holds(flat))
            owner = np.searchsorted(ends, hits, side="right")
            yield pa.RecordBatch.from_arrays(
                [batch.column("phash").take(pa.array(owner, pa.int64())), pa.array(flat[hits])], names=["phash", "key"])

    return banded.select("phash", "keys").mapInArrow(run, "phash long, key long")


def _sets_of_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(phash, shingles): the shingle set of each class, in bytes."""
    for batch in batches:
        made = [shingle_set(line.encode()).tobytes() for line in batch.column("line").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("phash"), pa.array(made, pa.binary())],
                                         names=["phash", "shingles"])


def forest(ids: list[int], sets: list[np.ndarray], split: int, limit: float) -> list[tuple[int, int]]:
    """A spanning forest of the links of similarity ``limit`` or more: among all
    if ``split`` is 0, else between the first ``split`` sets and the others."""
    boss = list(range(len(ids)))

    def root(i: int) -> int:
        while boss[i] != i:
            boss[i] = boss[boss[i]]
            i = boss[i]
        return i

    links = []
    for i in range(len(ids)):
        for j in range(i) if not split else range(split) if i >= split else ():
            a, b = root(i), root(j)
            n, m = len(sets[i]), len(sets[j])
            if a == b or min(n, m) < limit * max(n, m):
                continue
            where = sets[i].searchsorted(sets[j])
            where[where == n] = 0
            both = int((sets[i][where] == sets[j]).sum())
            if both >= limit * (n + m - both):
                boss[a] = b
                links.append((ids[i], ids[j]))
    return links


def near_links(banded: DataFrame, docs: DataFrame, limit: float = 0.8, block: int = 256) -> DataFrame:
    """Links (u, v) between classes: ``banded`` (phash, keys) distinct classes
    with their band keys, ``docs`` (text) the texts with the classes' words.  Bands
    have factors of their own, so a key is one band's; were it two's, the sets decide."""
    banded = stored(banded.select("phash", "keys"), "banded")
    sizes = stored(banded.select(F.explode("keys").alias("s_key")).groupBy("s_key").agg(
        F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "s_key", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "sizes")
    met = stored(_band_keys(banded, sieve(sizes, "s_key")).join(sizes, F.col("key") == F.col("s_key"))
                 .select("key", "blocks", "phash"), "met")
    wanted = stored(met.select("phash").distinct(), "wanted")
    lines = _class_sets(docs, sieve(wanted, "phash"))
    sets = lines.join(wanted, "phash", "left_semi").groupBy("phash").agg(F.min("line").alias("line"))
    sets = stored(sets.mapInArrow(_sets_of_lines, "phash long, shingles binary"), "sets")
    own = F.pmod(F.xxhash64("phash"), F.col("blocks")).cast("int")
    dealt = (met.withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", F.greatest("own", "other").alias("a"), F.least("own", "other").alias("b"),
                     (F.col("own") < F.col("other")).alias("later"), "phash")
             .join(sets, "phash"))
    group = ["key", "a", "b"]
    parts = max(1, int(banded.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = dealt.repartition(parts, *group).sortWithinPartitions(*group, "later", "phash")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, sets_, split, out = None, [], [], 0, []

        def packed():
            pairs = np.array(out, np.int64).reshape(-1, 2)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())],
                                              names=["u", "v"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in (*group, "later", "phash", "shingles")]
            for *name, later, phash, shingles in zip(*cols):
                if name != now:
                    out += forest(ids, sets_, split, limit)
                    now, ids, sets_, split = name, [], [], 0
                if later and not split:
                    split = len(ids)
                ids.append(phash)
                sets_.append(np.frombuffer(shingles, np.uint64))
            if len(out) > 10_000:
                yield packed()
        out += forest(ids, sets_, split, limit)
        yield packed()

    return ordered.mapInArrow(search, "u long, v long")


def repeated_paragraphs(docs: DataFrame, limit: float = 0.8, rows: int = 3, recall: float = 0.999) -> DataFrame:
    """Every paragraph with words: doc_id, dkey, pos, words, cluster, repeated
    (another document holds one of its cluster), first_doc_id, removed (it is not
    the cluster's first occurrence)."""
    bands = tuned_bands(limit, rows, recall)
    spark, start = docs.sparkSession, scratch.mark()
    made = stored(paragraphs(docs, bands, rows), "paragraphs")
    banded = made.where("keys IS NOT NULL").groupBy("phash").agg(F.first("keys").alias("keys"))
    links = near_links(banded, docs, limit)
    parts = stored(connected_components(links).select(F.col("node").alias("c_node"), "component"), "parts")
    every = stored(made.drop("keys"), "places")
    scratch.release(spark, since=start, keep=2)  # bands, sets and rounds are as large as the texts
    place = F.struct("doc_id", "dkey", "pos")
    # One row per class first: a hot class has one row, however many paragraphs it has.
    classes = every.groupBy("phash").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    classes = classes.join(parts, F.col("phash") == F.col("c_node"), "left").select(
        F.col("phash").alias("c_phash"), F.coalesce("component", "phash").alias("cluster"), "low", "high")
    classes = stored(classes, "classes")
    clusters = classes.groupBy(F.col("cluster").alias("k_cluster")).agg(
        F.min("low").alias("low"), F.max("high").alias("high")).where(
        ~(F.col("low.doc_id").eqNullSafe(F.col("high.doc_id")) & (F.col("low.dkey") == F.col("high.dkey"))))
    shared = stored(classes.select("c_phash", "cluster").join(
        clusters, F.col("cluster") == F.col("k_cluster")).select("c_phash", "cluster", "low"), "shared")
    made = every.join(shared, F.col("phash") == F.col("c_phash"), "left")
    return made.select("doc_id", "dkey", "pos", "words", "cluster", F.col("cluster").isNotNull().alias("repeated"),
                       F.col("low.doc_id").alias("first_doc_id"),
                       (F.col("cluster").isNotNull() & ~place.eqNullSafe(F.col("low"))).alias("removed"))


def passages(docs: DataFrame, min_words: int = 50, reach: int = 4, **options) -> DataFrame:
    """One row for each document with a passage that another document holds too:
    what ``repeated_passages`` finds of whole paragraphs, near copies included, and
    what ``runs.repeated_runs`` finds of exact words wherever they stand."""
    near = repeated_passages(docs, min_words, **options)
    exact = repeated_runs(docs, min_words, reach)
    met = near.join(exact, F.col("dkey") == F.col("r_dkey"), "full")
    ids = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("i_dkey")).distinct()
    empty = F.array().cast("array<struct<first:int,last:int>>")
    zero = F.lit(0).cast("long")
    return met.drop("doc_id").withColumn("m_dkey", F.coalesce("dkey", "r_dkey")).join(
        ids, F.col("m_dkey") == F.col("i_dkey")).select(
        "doc_id", F.coalesce("passages", F.array().cast(near.schema["passages"].dataType)).alias("passages"),
        F.coalesce("n_words", zero).alias("n_words"), F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("first_doc_ids", F.array().cast(near.schema["first_doc_ids"].dataType)).alias("first_doc_ids"),
        F.coalesce("runs", empty).alias("runs"), F.coalesce("n_run_words", zero).alias("n_run_words"),
        F.coalesce("n_later_words", zero).alias("n_later_words"))


def repeated_passages(docs: DataFrame, min_words: int = 50, **options) -> DataFrame:
    """One row for each document with a passage that another document holds too:
    doc_id, passages (array of first and last paragraph and words), n_words in
    them, first_doc_ids (documents with the first occurrences), n_removed
    (paragraphs of the passages that are not first occurrences)."""
    every = repeated_paragraphs(docs, **options)
    with_some = every.where("words > 0").groupBy("doc_id", "dkey").agg(
        F.max("repeated").alias("some"), F.sort_array(F.collect_set(F.struct(
            "pos", "words", "repeated", "removed", "first_doc_id"))).alias("ps")).where("some")
    kind = docs.schema["doc_id"].dataType.simpleString()
    empty = F.array().cast(f"array<struct<first:int,last:int,words:int,removed:int,docs:array<{kind}>>>")
    fresh = F.struct(F.lit(-1).alias("first"), F.lit(-1).alias("last"), F.lit(0).alias("words"),
                     F.lit(0).alias("removed"), F.array().cast(f"array<{kind}>").alias("docs"))

    def closed(acc):
        return F.when(acc["run"]["words"] >= min_words,
                      F.concat(acc["out"], F.array(acc["run"]))).otherwise(acc["out"])

    def step(acc, p):
        run = acc["run"]
        longer = F.struct(
            F.when(run["words"] > 0, run["first"]).otherwise(p["pos"]).alias("first"), p["pos"].alias("last"),
            (run["words"] + p["words"]).alias("words"), (run["removed"] + p["removed"].cast("int")).alias("removed"),
            F.array_union(run["docs"], F.array(p["first_doc_id"])).alias("docs"))
        return F.struct(F.when(p["repeated"], longer).otherwise(fresh).alias("run"),
                        F.when(p["repeated"], acc["out"]).otherwise(closed(acc)).alias("out"))

    runs = F.aggregate("ps", F.struct(fresh.alias("run"), empty.alias("out")), step, closed)
    made = with_some.select("doc_id", "dkey", runs.alias("runs")).where(F.size("runs") > 0)
    total = lambda name: F.aggregate("runs", F.lit(0), lambda a, r: a + r[name]).cast("long")
    return made.select(
        "doc_id", "dkey", F.transform("runs", lambda r: F.struct(r["first"].alias("first"), r["last"].alias("last"),
                                                         r["words"].alias("words"))).alias("passages"),
        total("words").alias("n_words"), total("removed").alias("n_removed"),
        F.array_distinct(F.flatten(F.transform("runs", lambda r: r["docs"]))).alias("first_doc_ids"))
