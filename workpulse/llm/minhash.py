"""MinHash near-duplicates by an inverted join of signature coordinates.

A document's set is its distinct word shingles (64-bit hashes; two shingles of
one pair of documents meet by chance with a probability below 1e-12).  Equal sets
are one class, known by a 128-bit digest; everything below works on classes.

A class is posted under its (coordinate, value) pairs, and two classes are
compared exactly when they agree in at least ``matches`` of the ``coords``
coordinates.  With 64 coordinates and 36 matches a pair of similarity 0.8 is
missed with a probability of about 1e-6.  The merge of the posting lists is cut
short in two ways that lose no such pair:

* a value that one class alone holds can't collide: it is dropped, and so are
  classes left with fewer than ``matches`` values;
* of the m values that remain, in ascending order of their lists' lengths, two
  classes with enough matches share one of the first m - matches + 1 of each.
  Only this prefix is posted: the longest lists (the boilerplate of a corpus) are
  skipped, and their collisions are counted on the signatures.

A pair is counted only in the list of its first common prefix coordinate.  Lists
are dealt out in blocks of bounded size.  Classes with a match in their block
meet once more with their full sets, and exact Jaccard similarity decides; pairs
that are already connected are not compared, and a block returns a spanning
forest, never its pairs.  A list of several blocks then has a second round:
blocks of one component need not meet, all others do, so that a large group of
copies costs its few outsiders and not the square of its size.

Defined cases: a text without words (or null) has an empty set, is linked with
nothing and is its own component; fewer words than a shingle make one shingle; a
null id takes no part in the smallest id of a component (all null: null); rows of
one id with different texts are documents of their own; repeated rows give a row
each; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workpulse.llm.components import connected_components
from workpulse.llm.scratch import stored
from workpulse.llm.simhash import xxh64_spans

COORDS = 64
MATCHES = 36
BYTES_AT_ONCE = 1 << 20
#: A block of a posting list: so many classes, and shingles in all, on average.
BLOCK_ROWS, BLOCK_SHINGLES = 512, 1 << 20
#: Most classes whose place in the documents is broadcast (about 50 bytes each).
SENT_ROWS = 1 << 20
#: A key with over 1/4096 of all rows is joined by broadcast: at most 4096 keys
#: for each time a row is posted.
HOT_SHARE = 4096
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(11).integers(1, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[str | None], words_in: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = [(t or "").encode().lower().split() for t in texts]  # ASCII white space and case only
    full = [w for w in words if w]
    empty = np.zeros(0, np.uint64)
    if not full:
        return [empty] * len(texts)
    data = b" ".join(b" ".join(w) for w in full)
    ends = np.r_[np.flatnonzero(np.frombuffer(data, np.uint8) == 32), len(data)]
    each = xxh64_spans(data, np.r_[0, ends[:-1] + 1], ends)
    sets, at = [], 0
    for w in words:
        if not w:
            sets.append(empty)
            continue
        own, width = each[at:at + len(w)], min(words_in, len(w))
        at += len(w)
        n = len(w) - width + 1
        h = np.full(n, width, np.uint64)
        for k in range(width):
            h = (h ^ own[k:k + n]) * _PRIME
            h ^= h >> np.uint64(29)
        sets.append(np.unique(h))
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``COORDS`` minima (32 bits) for each non-empty set."""
    flat = np.concatenate(sets)
    first = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), COORDS), np.uint32)
    for i, seed in enumerate(_SEEDS):
        out[:, i] = np.minimum.reduceat(((flat * seed) >> np.uint64(32)).astype(np.uint32), first)
    return out


def _chunks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of batches with about ``BYTES_AT_ONCE`` of text each, and that text."""
    for batch in batches:
        texts = batch.column(column).to_pylist()
        at = 0
        while at < len(texts):
            end, held = at, 0
            while end < len(texts) and (end == at or held + len(texts[end] or "") < BYTES_AT_ONCE):
                held += len(texts[end] or "")
                end += 1
            yield batch.slice(at, end - at), texts[at:end]
            at = end


def digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def prints(docs: DataFrame, words_in: int) -> DataFrame:
    """(doc_id, text_hash, n, cls, sig) of every row; cls and sig are null for an empty set."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for part, texts in _chunks(batches, "text"):
            sets = shingle_sets(texts, words_in)
            full = [s for s in sets if len(s)]
            sig = signatures(full).view(np.int32).ravel() if full else np.zeros(0, np.int32)
            has = np.array([len(s) > 0 for s in sets])
            offsets = np.r_[0, np.cumsum(has * COORDS)].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(sig), mask=pa.array(~has))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([digest(s) for s in sets], pa.binary()), lists],
                names=["doc_id", "text_hash", "n", "cls", "sig"])

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, f"doc_id {kind}, text_hash long, n long, cls binary, sig array<int>")


def looked_up(rows: DataFrame, facts: DataFrame, key: str, often: Column, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``facts`` (one row per ``key``).  The keys that are
    ``often`` met, a number bounded by the caller, go by broadcast, so that no task
    gets all rows of a hot key; the others by shuffle.  Rows without a key stay
    apart: they go (inner) or stay (left) without a join."""
    facts = facts.withColumnRenamed(key, "_key")
    met = rows.join(F.broadcast(facts.where(often)), F.col(key) == F.col("_key"), "left")
    rare = met.where(F.col("_key").isNull() & F.col(key).isNotNull()).select(*rows.columns).join(
        facts.where(~often), F.col(key) == F.col("_key"), how)
    out = met.where("_key IS NOT NULL").union(rare)
    return (out.union(met.where(F.col(key).isNull())) if how == "left" else out).drop("_key")


def postings(classes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """(token, id, n, mask, toks): each class under its prefix.  A token has the
    coordinate in its upper half and the value in its lower; ``mask`` has the prefix's
    coordinates as bits, ``toks`` are all tokens that another class holds too."""
    tokens = classes.select("id", F.posexplode("sig").alias("j", "v")).select(
        "id", F.shiftleft(F.col("j").cast("long"), 32).bitwiseOR(
            F.col("v").cast("long").bitwiseAND(F.lit(0xFFFFFFFF))).alias("token"))
    held = stored(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("held")).where("held > 1"), "held")
    many = classes.count() / HOT_SHARE
    shared = looked_up(tokens, held, "token", F.col("held") > many).groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("held", "token"))).alias("t")).where(F.size("t") >= matches)
    sized = shared.join(classes.select(F.col("id").alias("c_id"), "n"), F.col("id") == F.col("c_id"))
    prefix = sized.select("id", "n", F.col("t.token").alias("toks")).withColumn(
        "prefix", F.slice("toks", F.lit(1), F.size("toks") - (matches - 1)))
    bits = F.aggregate("prefix", F.lit(0).cast("long"), lambda m, x: m.bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(x, 32).cast("int"))))
    return prefix.select(F.explode("prefix").alias("token"), "id", "n", bits.alias("mask"), "toks")


GROUP = ["token", "g1", "g2"]
MEMBER = ["side", "comp", "id", "n", "mask", "toks"]
MEMBERS = ("token long, g1 string, g2 string, side boolean, comp long, id long, n long, mask long, "
           "toks array<long>")


def matched_pairs(coord: int, rows: dict, limit: int, matches: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (i, j) of a group that it owns and whose counts reach ``matches``,
    most matches first.  Members of one side of a group of two blocks do not meet."""
    m = len(rows["id"])
    who = np.repeat(np.arange(m), [len(x) for x in rows["toks"]])
    toks = np.concatenate(rows["toks"])
    value = np.zeros((m, COORDS), np.uint32)
    there = np.zeros((m, COORDS), bool)
    value[who, toks >> 32] = toks.astype(np.uint32)
    there[who, toks >> 32] = True
    mask = np.array(rows["mask"], np.int64).view(np.uint64)
    first = mask[:, None] >> np.arange(COORDS, dtype=np.uint64) & np.uint64(1) > 0
    n, side = np.array(rows["n"]), np.array(rows["side"])
    comp, two = np.array(rows["comp"]), side.any()
    found = []
    for a in range(0, m, 64):
        i = np.arange(a, min(a + 64, m))
        ok = (i[:, None] < np.arange(m)) & (comp[i, None] != comp)
        if two:
            ok &= side[i, None] != side
        ok &= (100 * np.minimum(n[i, None], n) >= limit * np.maximum(n[i, None], n))
        x, y = np.nonzero(ok)
        if not len(x):
            continue
        for at in range(0, len(x), 8192):
            p, q = x[at:at + 8192] + a, y[at:at + 8192]
            same = (value[p] == value[q]) & there[p] & there[q]
            count = same.sum(axis=1)
            own = (same & first[p] & first[q])
            keep = (count >= matches) & own[:, coord] & (own.argmax(axis=1) == coord)
            found.append((p[keep], q[keep], count[keep]))
    if not found:
        none = np.zeros(0, int)
        return none, none, none
    p, q, count = map(np.concatenate, zip(*found))
    order = np.argsort(-count, kind="stable")
    return p[order], q[order], count[order]


def in_groups(work: Callable[[tuple, dict], pa.RecordBatch | None], columns: list[str]):
    """A mapInArrow function that gives ``work`` each group (rows of one ``GROUP``,
    which follow each other) as lists by column."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, {}
        for batch in batches:
            cols = {c: (list(_arrays(batch.column(c))) if c == "toks" else batch.column(c).to_pylist())
                    for c in columns}
            keys = list(zip(*(batch.column(c).to_pylist() for c in GROUP)))
            at = 0
            while at < len(keys):
                end = at + 1
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                if keys[at] != now:
                    if now and len(rows["id"]) > 1 and (out := work(now, rows)) is not None:
                        yield out
                    now, rows = keys[at], {c: [] for c in columns}
                for c in columns:
                    rows[c] += cols[c][at:end]
                at = end
        if now and len(rows["id"]) > 1 and (out := work(now, rows)) is not None:
            yield out
    return run


def _arrays(lists: pa.ListArray) -> Iterator[np.ndarray]:
    flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    return (flat[a:b] for a, b in zip(offsets, offsets[1:]))


def _by_group(rows: DataFrame) -> DataFrame:
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(parts, *GROUP).sortWithinPartitions(*GROUP)


def candidates(dealt: DataFrame, limit: int, matches: int) -> DataFrame:
    """The members of each group that have a match in it."""
    names = [*GROUP, *MEMBER]

    def work(group: tuple, rows: dict) -> pa.RecordBatch | None:
        p, q, _ = matched_pairs(group[0] >> 32, rows, limit, matches)
        if not len(p):
            return None
        keep = np.unique(np.r_[p, q])
        cols = [[x] * len(keep) for x in group] + [[rows[c][i] for i in keep] for c in MEMBER]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.bool_(), *[pa.int64()] * 4, pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return _by_group(dealt.select(*names)).mapInArrow(in_groups(work, MEMBER), MEMBERS)


def verified(chosen: DataFrame, sets: DataFrame, limit: int, matches: int) -> DataFrame:
    """Links (u, v) that connect what exact similarity connects in each group."""
    columns = [*MEMBER, "shingles"]

    def work(group: tuple, rows: dict) -> pa.RecordBatch | None:
        p, q, _ = matched_pairs(group[0] >> 32, rows, limit, matches)
        full = [np.frombuffer(s, np.uint64) for s in rows["shingles"]]
        boss: dict = {}

        def root(x):
            while boss.setdefault(x, x) != x:
                boss[x] = boss[boss[x]]
                x = boss[x]
            return x

        links = []
        for i, j in zip(p.tolist(), q.tolist()):
            x, y = root(rows["comp"][i]), root(rows["comp"][j])
            if x == y:
                continue
            a, b = full[i], full[j]
            where = np.searchsorted(a, b)
            where[where == len(a)] = 0
            both = int((a[where] == b).sum())
            if 100 * both >= limit * (len(a) + len(b) - both):
                boss[x] = y
                links.append((rows["id"][i], rows["id"][j]))
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)],
                                          names=["u", "v"]) if links else None

    named = chosen.join(sets, F.col("id") == F.col("s_id")).select(*GROUP, *columns)
    return _by_group(named).mapInArrow(in_groups(work, columns), "u long, v long")


def full_sets(docs: DataFrame, needed: DataFrame, words_in: int) -> DataFrame:
    """(s_id, shingles) of the classes in ``needed`` (id, cls, rep), from the text of
    one document of each.  Up to ``SENT_ROWS`` of them go to the documents, so that
    no text is shuffled that nobody needs; more are joined as Spark sees fit."""
    held = needed.select("id", "cls", F.col("rep.doc_id").alias("r_id"), F.col("rep.text_hash").alias("r_hash"))
    if held.count() <= SENT_ROWS:
        held = F.broadcast(held)
    one = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").join(
        held, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_hash") == F.col("r_hash"))).groupBy("id").agg(
        F.first("cls").alias("cls"), F.first("text").alias("text"))

    def run(batches):
        for part, texts in _chunks(batches, "text"):
            sets = shingle_sets(texts, words_in)
            keep = [i for i, c in enumerate(part.column("cls").to_pylist()) if digest(sets[i]) == c]
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(keep, pa.int64())),
                 pa.array([sets[i].tobytes() for i in keep], pa.binary())], names=["s_id", "shingles"])

    return one.mapInArrow(run, "s_id long, shingles binary")


def _blocks(rows: str, shingles: str) -> Column:
    return F.ceil(F.greatest(F.col(rows) / BLOCK_ROWS, F.col(shingles) / BLOCK_SHINGLES)).cast("int")


def _piece(of: str, blocks: str) -> Column:
    """A block by the hash of ``of`` and the token: another deal in every list, so
    that what one list's blocks keep apart meets in the next."""
    return F.pmod(F.xxhash64(of, "token"), F.col(blocks)).cast("string")


def second_deal(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Members of lists of several blocks dealt anew by ``parts`` (node, component):
    a component that fills a block has blocks of its own, the others share some;
    any two blocks meet unless they hold the same single component."""
    rows = rows.join(parts, F.col("id") == F.col("node"), "left").withColumn("comp", F.coalesce("component", "id"))
    in_comp = rows.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c_rows"), F.sum("n").alias("c_shingles"))
    in_comp = in_comp.withColumn("c_blocks", _blocks("c_rows", "c_shingles"))
    pooled = in_comp.where("c_blocks = 1").groupBy(F.col("token").alias("p_token")).agg(
        F.sum("c_rows").alias("p_rows"), F.sum("c_shingles").alias("p_shingles"))
    plan = in_comp.join(pooled.select("p_token", _blocks("p_rows", "p_shingles").alias("p_blocks")),
                        F.col("token") == F.col("p_token"), "left").withColumn("pooled", _piece("comp", "p_blocks"))
    plan = stored(plan.select(F.col("token").alias("t"), F.col("comp").alias("c"), "c_blocks", "pooled"), "plan")
    spread = plan.where("c_blocks > 1").select(
        "t", F.col("c").alias("pure"), F.explode(F.sequence(F.lit(0), F.col("c_blocks") - 1)).alias("i")).select(
        "t", "pure", F.concat_ws(":", "pure", "i").alias("b"))
    shared = plan.where("c_blocks = 1").select("t", F.col("pooled").alias("b")).distinct().select(
        "t", F.lit(None).cast("long").alias("pure"), "b")
    blocks = stored(spread.union(shared), "blocks")
    other = blocks.select(F.col("t").alias("o_t"), F.col("pure").alias("o_pure"), F.col("b").alias("o_b"))
    meet = blocks.join(other, (F.col("t") == F.col("o_t")) & (F.col("b") <= F.col("o_b"))).where(
        "pure IS NULL OR o_pure IS NULL OR pure <> o_pure").select("t", "b", "o_b")
    one = meet.select(F.col("t").alias("m_t"), F.col("b").alias("m_b"), F.col("b").alias("g1"), F.col("o_b").alias("g2"),
                      F.lit(False).alias("side"))
    two = meet.where("b <> o_b").select(F.col("t").alias("m_t"), F.col("o_b").alias("m_b"), F.col("b").alias("g1"),
                                        F.col("o_b").alias("g2"), F.lit(True).alias("side"))
    own = F.when(F.col("c_blocks") > 1, F.concat_ws(":", "comp", _piece("id", "c_blocks"))).otherwise(F.col("pooled"))
    placed = rows.join(plan, (F.col("token") == F.col("t")) & (F.col("comp") == F.col("c"))).withColumn("own", own)
    return placed.join(one.union(two), (F.col("token") == F.col("m_t")) & (F.col("own") == F.col("m_b")))


def near_components(docs: DataFrame, classes: DataFrame, words_in: int = 4, limit: int = 80,
               matches: int = MATCHES) -> DataFrame:
    """(node, component) of all classes (id, cls, n, sig, rep) that have a link:
    those of similarity of at least ``limit`` percent."""
    posted = stored(postings(classes, matches), "postings")
    lists = posted.groupBy("token").agg(F.count(F.lit(1)).alias("l_rows"), F.sum("n").alias("l_shingles")).where(
        "l_rows > 1").withColumn("l_blocks", _blocks("l_rows", "l_shingles"))
    lists = stored(lists, "lists")
    met = looked_up(posted, lists, "token", F.col("l_rows") > posted.count() / HOT_SHARE)
    block = _piece("id", "l_blocks")
    first = met.withColumns({"g1": block, "g2": block, "side": F.lit(False), "comp": F.col("id")})

    def links_of(dealt: DataFrame, name: str) -> DataFrame:
        chosen = stored(candidates(dealt, limit, matches), f"{name}_candidates")
        needed = chosen.select(F.col("id").alias("need")).distinct().join(classes, F.col("need") == F.col("id"))
        sets = full_sets(docs, stored(needed.select("id", "cls", "rep"), f"{name}_needed"), words_in)
        return stored(verified(chosen, sets, limit, matches), name)

    parts = connected_components(links_of(first, "links"))
    if lists.where("l_blocks > 1").isEmpty():
        return parts
    parts = stored(parts, "parts")
    again = looked_up(posted, lists.where("l_blocks > 1"), "token", F.col("l_rows") > posted.count() / HOT_SHARE)
    later = links_of(second_deal(again.select(*posted.columns), parts), "later")
    if later.isEmpty():
        return parts
    return connected_components(later.union(parts.select(F.col("node").alias("u"), F.col("component").alias("v"))))


def near_duplicates(docs: DataFrame, words_in: int = 4, limit: int = 80, matches: int = MATCHES) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``."""
    docs = docs.select("doc_id", "text")
    found = stored(prints(docs, words_in), "prints")
    rep = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
    classes = stored(found.where("n > 0").groupBy("cls").agg(
        F.max("n").alias("n"), F.first("sig").alias("sig"), F.min(rep).alias("rep"), F.min("doc_id").alias("low"),
        F.count(F.lit(1)).alias("copies")).withColumn("id", F.monotonically_increasing_id()), "classes")
    parts = near_components(docs, classes, words_in, limit, matches)
    named = classes.join(parts, F.col("id") == F.col("node"), "left").where(
        "copies > 1 OR node IS NOT NULL").select("cls", "low", "copies", F.coalesce("component", "id").alias("comp"))
    lowest = named.groupBy(F.col("comp").alias("c")).agg(F.min("low").alias("component_id"))
    labels = stored(named.join(lowest, F.col("comp") == F.col("c")).select(
        F.col("cls").alias("l_cls"), "copies", "component_id"), "labels")
    rows = found.select("doc_id", "n", F.col("cls").alias("l_cls"))
    many = F.col("copies") > found.count() / HOT_SHARE
    single = F.col("copies").isNull()
    return looked_up(rows, labels, "l_cls", many, "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(single, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
