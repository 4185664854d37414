"""SimHash near-duplicates with BK-trees.

A document's fingerprint is the bitwise majority of its shingles' XXH64 hashes.
Equal fingerprints are one node.  Fingerprints within ``radius`` bits agree in at
least ``blocks - radius`` of ``blocks`` bit blocks, so every fingerprint is put
under one key for each such choice of blocks, and only keys with two or more
fingerprints are searched.  A key's members are cut into shards of bounded size;
each shard's members become a BK-tree (children keyed by their integer Hamming
distance to the parent), the members of the key are sent to every shard tree,
and a search follows only the edges that the triangle inequality leaves open.
Each tree returns a spanning forest of its links, never the pairs of a group;
components come from star contractions on fingerprints.

The number of blocks follows from the number of distinct fingerprints (finer keys
for more of them) and never changes the result.

Defined cases: a text without words (or null) has fingerprint zero and is linked
like any other; fewer words than a shingle make one shingle of them all; a null
id takes no part in the smallest id of a component (all null: null); repeated
rows give a row each; an empty table gives no rows; only the named columns are
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.llm.components import connected_components
from workpulse.llm.scratch import stored

#: Fixed values of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(x) for x in (
    11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579,
    2870177450012600261))
UNSIGNED = (1 << 64) - 1
BYTES_AT_ONCE = 4 << 20


def _rot(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64_spans(data: bytes, start: np.ndarray, end: np.ndarray, seed: int = 42) -> np.ndarray:
    """XXH64 of ``data[start:end]`` for every span: the lanes of all spans under
    32 bytes at once, longer spans one by one."""
    size = end - start
    padded = np.frombuffer(data + b"\0" * 8, np.uint8)
    wide = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(padded) - 7,), (1,))
    out = np.uint64(seed) + P5 + size.astype(np.uint64)
    at = start.copy()
    short = size < 32
    with np.errstate(over="ignore"):
        for lane in range(3):
            on = np.flatnonzero(short & (size >= 8 * (lane + 1)))
            h = out[on] ^ (_rot(wide[at[on]] * P2, 31) * P1)
            out[on] = _rot(h, 27) * P1 + P4
            at[on] += 8
        on = np.flatnonzero(short & (size & 4 > 0))
        h = out[on] ^ ((wide[at[on]] & np.uint64(0xFFFFFFFF)) * P1)
        out[on] = _rot(h, 23) * P2 + P3
        at[on] += 4
        for tail in range(3):
            on = np.flatnonzero(short & (size & 3 > tail))
            h = out[on] ^ (padded[at[on]].astype(np.uint64) * P5)
            out[on] = _rot(h, 11) * P1
            at[on] += 1
        out ^= out >> np.uint64(33)
        out *= P2
        out ^= out >> np.uint64(29)
        out *= P3
        out ^= out >> np.uint64(32)
    for i in np.flatnonzero(~short):
        out[i] = xxhash.xxh64_intdigest(data[start[i]:end[i]], seed)
    return out


def _bit_counts(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set in each run of ``hashes``."""
    ends = np.r_[first[1:], len(hashes)]
    pieces = [np.arange(a, b, 255) for a, b in zip(first, ends)]  # a byte counts to 255
    cuts = np.concatenate(pieces)
    owner = np.repeat(np.arange(len(first)), [len(p) for p in pieces])
    counts = np.empty((len(first), 64), np.int64)
    ones = np.uint64(0x0101010101010101)
    doc_first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    for b in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(b)) & ones, cuts)
        counts[:, b::8] = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), doc_first)
    return counts


def fingerprints_of(texts: list[str | None], words_in: int = 3, seed: int = 42) -> np.ndarray:
    """64-bit fingerprints (unsigned) of ``texts``."""
    out = np.zeros(len(texts), np.uint64)
    words = [(t or "").encode().lower().split() for t in texts]
    # words() of bytes splits at ASCII white space only
    i = 0
    while i < len(words):
        j, held = i, 0
        while j < len(words) and (held == 0 or held < BYTES_AT_ONCE):
            held += len(texts[j] or "") + 1
            j += 1
        full = [k for k in range(i, j) if words[k]]
        if full:
            data = b" ".join(b" ".join(words[k]) for k in full)
            n = np.array([len(words[k]) for k in full])
            stops = np.r_[np.flatnonzero(np.frombuffer(data, np.uint8) == 32), len(data)]
            starts = np.r_[0, stops[:-1] + 1]
            width = np.minimum(n, words_in)
            shingles = n - width + 1
            first = np.cumsum(shingles) - shingles
            base = np.cumsum(n) - n
            doc = np.repeat(np.arange(len(full)), shingles)
            word = np.arange(shingles.sum()) - first[doc] + base[doc]
            hashes = xxh64_spans(data, starts[word], stops[word + width[doc] - 1], seed)
            counts = _bit_counts(hashes, first)
            bits = (2 * counts > shingles[:, None]).astype(np.uint64)
            out[full] = (bits << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        i = j
    return out


def fingerprints(docs: DataFrame, words_in: int = 3, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, ``carried`` columns, fp): ``fp`` is the fingerprint as a signed long."""
    names = ["doc_id", *carried]
    fields = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                fp = fingerprints_of(part.column("text").to_pylist(), words_in)
                yield pa.RecordBatch.from_arrays(
                    [*map(part.column, names), pa.array(fp.view(np.int64))], names=[*names, "fp"])

    return docs.select(*names, "text").mapInArrow(rows, f"{fields}, fp long")


class BKTree:
    """Integers under Hamming distance."""

    def __init__(self):
        self.value, self.children = [], []

    def add(self, x: int) -> None:
        if not self.value:
            self.value.append(x)
            self.children.append({})
            return
        node = 0
        while True:
            d = (x ^ self.value[node]).bit_count()
            child = self.children[node].get(d)
            if child is None:
                self.children[node][d] = len(self.value)
                self.value.append(x)
                self.children.append({})
                return
            node = child

    def within(self, x: int, radius: int) -> list[int]:
        """Values at most ``radius`` from ``x``."""
        found, stack = [], [0] if self.value else []
        value, children = self.value, self.children
        while stack:
            node = stack.pop()
            d = (x ^ value[node]).bit_count()
            if d <= radius:
                found.append(value[node])
            kids = children[node]
            if len(kids) <= 2 * radius + 1:
                stack += [c for e, c in kids.items() if d - radius <= e <= d + radius]
            else:
                stack += [kids[e] for e in range(d - radius, d + radius + 1) if e in kids]
        return found


def tree_links(members: list[int], seekers: list[int], radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links of one group: among ``members``, as their
    tree grows, or between ``seekers`` and a full tree of ``members``."""
    boss: dict[int, int] = {}

    def root(x: int) -> int:
        while boss.setdefault(x, x) != x:
            boss[x] = boss[boss[x]]
            x = boss[x]
        return x

    links, tree = [], BKTree()

    def link(x: int) -> None:
        for y in tree.within(x, radius):
            a, b = root(x), root(y)
            if a != b:
                boss[a] = b
                links.append((x, y))

    for x in members:
        if not seekers:
            link(x)
        tree.add(x)
    for x in seekers:
        link(x)
    return links


def block_masks(blocks: int, radius: int) -> list[int]:
    """For each choice of ``blocks - radius`` of the 64 bits' blocks, their mask."""
    cut = [64 * i // blocks for i in range(blocks + 1)]
    part = [((1 << b) - (1 << a)) for a, b in zip(cut, cut[1:])]
    return [sum(part[i] for i in some) for some in combinations(range(blocks), blocks - radius)]


def near_links(prints: DataFrame, radius: int = 3, shard_size: int = 1024,
               blocks: int | None = None) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints (column fp) within ``radius`` bits."""
    if blocks is None:
        bits = math.log2(max(2, prints.count() / 16))  # about 16 chance members to a key
        blocks = next(b for b in range(radius + 1, 17) if 64 * (b - radius) // b >= bits or b == 16)
    masks = [m - (1 << 64) if m >> 63 else m for m in block_masks(blocks, radius)]
    keyed = prints.select("fp", F.posexplode(F.array(*[F.lit(m) for m in masks])).alias("t", "mask"))
    keyed = keyed.select("t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    sizes = keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
        F.col("t").alias("s_t"), F.col("key").alias("s_key"),
        F.ceil(F.col("n") / shard_size).cast("int").alias("shards"))
    own = F.pmod(F.xxhash64("fp"), F.col("shards")).cast("int")
    # Block o of a key meets the tree of every later block, and its own: a group
    # is (tree of block j, seekers of block i <= j), at most two blocks in size.
    dealt = (keyed.join(sizes, (F.col("t") == F.col("s_t")) & (F.col("key") == F.col("s_key")))
             .withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
             .select("t", "key", F.greatest("own", "other").alias("tree"),
                     F.least("own", "other").alias("block"),
                     (F.col("own") < F.col("other")).alias("seeks"), "fp"))
    parts = max(1, int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    group = ["t", "key", "tree", "block"]
    ordered = dealt.repartition(parts, *group).sortWithinPartitions(*group, "seeks", "fp")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, members, seekers, out = None, [], [], []

        def packed():
            pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())],
                                              names=["u", "v"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in (*group, "seeks", "fp")]
            for *name, seeks, fp in zip(*cols):
                if name != now:
                    out += tree_links(members, seekers, radius)
                    now, members, seekers = name, [], []
                (seekers if seeks else members).append(fp & UNSIGNED)
            if len(out) > 10_000:
                yield packed()
        out += tree_links(members, seekers, radius)
        yield packed()

    return ordered.mapInArrow(search, "u long, v long")


def _labels(prints: DataFrame, radius: int) -> DataFrame:
    """(l_fp, component, component_id) of every fingerprint in ``prints`` (doc_id, fp)."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    nodes = stored(nodes, "nodes")
    parts = connected_components(near_links(nodes.select("fp"), radius))
    named = nodes.join(parts, F.col("fp") == F.col("node"), "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component"))
    low = named.groupBy("component").agg(F.min("low").alias("component_id")).withColumnRenamed(
        "component", "c")
    return stored(named.join(low, F.col("component") == F.col("c")).select(
        F.col("fp").alias("l_fp"), "component", "component_id"), "labels")


def near_duplicates(docs: DataFrame, words_in: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    prints = stored(fingerprints(docs, words_in), "fingerprints")
    return prints.join(_labels(prints, radius), F.col("fp") == F.col("l_fp")).select(
        "doc_id", "fp", "component_id")


def one_per_component(docs: DataFrame, words_in: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with exactly one row of each component: the one of least id
    (nulls last), then fingerprint, then hash of all its columns."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # Hashes skip nulls, so where they are is hashed as well.
    row = [F.xxhash64(F.lit(seed), *columns, *[c.isNull() for c in columns]) for seed in (1, 2)]
    keyed = docs.select(F.struct(*columns).alias("d"), "doc_id", "text", F.struct(
        row[0].alias("a"), row[1].alias("b")).alias("row"))
    prints = stored(fingerprints(keyed, words_in, carried=("row",)), "fingerprints")
    found = prints.groupBy("doc_id", "fp", "row").agg(F.count(F.lit(1)).alias("copies"))
    first = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "fp", "row", "copies")
    keep = found.join(_labels(prints, radius), F.col("fp") == F.col("l_fp")).groupBy("component").agg(
        F.min(first).alias("k"))
    keep = stored(keep.select(F.col("component").alias("k_component"), F.col("k.row").alias("k_row"),
                              F.col("k.doc_id").alias("k_id"), F.col("k.copies").alias("copies")), "kept")
    kept = keyed.join(keep, (F.col("row.a") == F.col("k_row.a")) & (F.col("row.b") == F.col("k_row.b"))
                      & F.col("doc_id").eqNullSafe(F.col("k_id")))
    if keep.where("copies > 1").limit(1).count():
        least = kept.where("copies > 1").groupBy("k_component").agg(F.min("d").alias("d"))
        return kept.where("copies = 1").select("d.*").union(least.select("d.*"))
    return kept.select("d.*")


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The named documents of ``one_per_component``: a component of rows without
    an id has none."""
    return one_per_component(docs, **options).where("doc_id IS NOT NULL")
