"""Alignment of two tokenizers' tokens by byte offsets, on Arrow tables.

A chunk of documents is one Arrow table for each tokenizer: its lists of token
ids are flattened beside their parent indices, and a cumulative sum of the
tokens' byte lengths, taken anew for each document, gives where each token ends.
A hash join of the two tables on (document, end) tells the ends apart that both
or one of them have.  Between two neighbouring ends lies exactly one token of
each side, so the joined rows in order are all overlapping token pairs (links),
and the rows with both sides present close a group.  ``Table.group_by`` counts a
document's links by id pair, and then, for many documents, in how many of them a
pair is linked; Spark merges these partial counts.

Corpus-wide counts come back to the documents in two ways: pairs with more than
1/``HOT`` of all (document, pair) rows, at most ``HOT`` of them, as a broadcast
table looked up within the task; the rest, none of them hot, by a shuffle join.

Defined cases: a null or empty text, or one whose tokens do not give back exactly
a space and the text, has no tokens: zeros, and the empty string; repeated rows
are documents of their own, each counted; a null id is kept; an empty table gives
no rows; only the named columns are read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.llm.scratch import stored

BYTES_AT_ONCE = 1 << 19
#: Distinct parts of texts whose ids a worker keeps, and up to which length.
PARTS_KEPT, LONG_PART = 1 << 19, 1 << 16
#: Most pairs that are broadcast, with their counts.
HOT = 1 << 19
ROWS_AT_ONCE = 1 << 21


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: bytes
    that print stand for themselves, the others follow from U+0100 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has its core
        from tokenizers import Tokenizer
        self.made = Tokenizer.from_file(path)
        self.made.encode_special_tokens = True
        byte = byte_alphabet()
        vocab = json.load(open(path, encoding="utf-8"))["model"]["vocab"]
        tokens = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            tokens[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.tokens = pa.array(tokens, pa.binary())

    def ids(self, spaced: list[str]) -> list[list[int]]:
        """The ids of texts that begin with a space."""
        return [x.ids for x in self.made.encode_batch_fast(spaced, add_special_tokens=False)]


class Pieces:
    """A sentencepiece model, which puts the space by itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.made = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.made.id_to_piece(i) for i in range(self.made.get_piece_size())]
        self.tokens = pa.array([bytes([int(p[3:5], 16)]) if self.made.is_byte(i) else
                                p.replace("▁", " ").encode() for i, p in enumerate(pieces)], pa.binary())

    def ids(self, spaced: list[str]) -> list[list[int]]:
        return self.made.encode([p[1:] for p in spaced], num_threads=1)


@lru_cache(maxsize=4)
def tokenizer(path: str) -> ByteLevel | Pieces:
    return Pieces(path) if path.endswith(".model") else ByteLevel(path)


class Encoder:
    """Encodes texts with several tokenizers by parts that cannot share a token,
    each distinct part once.

    A text with a space before it is cut before every single space that a word
    character follows and neither a space nor U+2581 precedes.  Byte-level
    pre-tokenizing always begins a piece at such a space, and no piece of the
    sentencepiece model goes on over one (tests compare with whole texts)."""

    cut = re.compile(r"(?<=[^ ▁])(?= \w)").split

    def __init__(self, *tokenizers: ByteLevel | Pieces):
        self.tokenizers = tokenizers
        self.size = [pc.binary_length(t.tokens).to_numpy() for t in tokenizers]
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.table = [pa.array([], pa.list_(pa.int32())) for _ in self.tokenizers]

    def learn(self, parts: list[str]) -> None:
        """Add parts to the tables.  They are encoded as one text, which has the same
        cuts; where its tokens do not end at them, one by one."""
        joined = "".join(parts)
        stops = np.cumsum([len(p.encode()) for p in parts])
        safe = joined.isascii() or "▁" not in joined
        safe = safe and all(p[-1] != " " and p[:1] == " " and (p[1:2].isalnum() or p[1:2] == "_") for p in parts)
        for k, (made, size) in enumerate(zip(self.tokenizers, self.size)):
            ids = np.array(made.ids([joined])[0], np.int32) if safe else np.zeros(0, np.int32)
            end = np.cumsum(size[ids])
            at = np.searchsorted(end, stops)
            if len(end) and end[-1] == stops[-1] and (end[at] == stops).all():
                offsets = np.r_[0, at + 1]
            else:
                lists = made.ids(parts)
                offsets = np.cumsum([0, *map(len, lists)])
                ids = np.fromiter(chain.from_iterable(lists), np.int32, offsets[-1])
            new = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
            self.table[k] = pa.concat_arrays([self.table[k], new])
        self.known.update(zip(parts, range(len(self.known), len(self.known) + len(parts))))

    def encode(self, texts: list[str]) -> list[pa.ListArray]:
        """The ids of a space and each text, by tokenizer."""
        cut = [self.cut(f" {t}") for t in texts]
        every = set().union(*cut)
        fresh = every - self.known.keys()
        if len(self.known) + len(fresh) > PARTS_KEPT:
            self.clear()
            fresh = every
        # Parts that end with a space are the last of their texts.
        odd = [p for p in fresh if p[-1] == " " or not p[1:2].isalnum()]
        for some in (list(fresh.difference(odd)), odd):
            if some:
                self.learn(some)
        rows = pa.array(np.fromiter(chain.from_iterable(map(self.known.__getitem__, c) for c in cut), np.int32))
        stops = pa.array(np.cumsum([0, *map(len, cut)]), pa.int32())
        out = []
        for table in self.table:
            parts = pc.take(table, rows)
            out.append(pa.ListArray.from_arrays(pc.take(parts.offsets, stops), pc.list_flatten(parts)))
        if any(len(p) > LONG_PART for p in fresh):
            self.clear()
        return out


@lru_cache(maxsize=4)
def encoder(*paths: str) -> Encoder:
    return Encoder(*map(tokenizer, paths))


def ends(ids: pa.ListArray, tokens: pa.BinaryArray) -> pa.Table:
    """(doc, id, end): every token of the lists and the byte its text ends at."""
    flat, doc = pc.list_flatten(ids), pc.list_parent_indices(ids)
    size = pc.cast(pc.binary_length(pc.take(tokens, flat)), pa.int64())
    running = pc.cumulative_sum(size)
    # The sum up to a document's first token is taken off again.
    first = pc.take(pa.concat_arrays([pa.array([0], pa.int64()), running]), ids.offsets.slice(0, len(ids)))
    return pa.table({"doc": doc, "id": flat, "end": pc.subtract(running, pc.take(first, doc))})


def spelled(ids: pa.ListArray, tokens: pa.BinaryArray) -> pa.BinaryArray:
    """The joined token bytes of each list."""
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, pc.take(tokens, pc.list_flatten(ids))), b"")


def _lists(parents: pa.Array, values: pa.Array, n: int) -> pa.ListArray:
    """Lists of ``values`` by their ascending ``parents`` in 0..n-1."""
    return pa.ListArray.from_arrays(_offsets(parents, n), values)


def _offsets(parents: pa.Array, n: int) -> pa.Array:
    sized = pa.table({"p": parents}).group_by("p").aggregate([([], "count_all")])
    at = pc.index_in(pa.array(np.arange(n), parents.type), value_set=sized["p"].combine_chunks())
    sizes = pc.fill_null(pc.take(sized["count_all"].combine_chunks(), at), 0)
    return pc.cast(pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(sizes)]), pa.int32())


def _one(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def aligned_texts(both: Encoder, texts: list[str | None]) -> pa.Table:
    """For each text: n_a, n_b, n_groups, n_links, groups_sha256, and its id pairs
    (a * |B| + b) with how often each is linked."""
    a, b = both.tokenizers
    some = [i for i, t in enumerate(texts) if t]
    ids_a, ids_b = both.encode([texts[i] for i in some])
    true = pa.array([b" " + texts[i].encode() for i in some], pa.binary())
    good = pc.and_(pc.equal(spelled(ids_a, a.tokens), true), pc.equal(spelled(ids_b, b.tokens), true))
    ids_a, ids_b = ids_a.filter(good), ids_b.filter(good)
    rows = [i for i, ok in zip(some, good.to_pylist()) if ok]
    m = len(rows)
    left, right = ends(ids_a, a.tokens), ends(ids_b, b.tokens)
    left = left.append_column("at", pa.array(np.arange(len(left), dtype=np.int32)))
    right = right.append_column("bt", pa.array(np.arange(len(right), dtype=np.int32))).rename_columns(
        {"id": "id_b"})
    met = left.join(right, ["doc", "end"], join_type="full outer", use_threads=False)
    met = met.sort_by([("doc", "ascending"), ("end", "ascending")])
    doc = _one(met["doc"])
    pair = pc.add(pc.multiply(pc.cast(pc.fill_null_backward(_one(met["id"])), pa.int64()), len(b.tokens)),
                  pc.cast(pc.fill_null_backward(_one(met["id_b"])), pa.int64()))
    shared = met.filter(pc.and_(pc.is_valid(met["id"]), pc.is_valid(met["id_b"])))

    def joined(ids: pa.ListArray, at: pa.Array) -> pa.Array:
        stops = pa.concat_arrays([pa.array([0], pa.int32()), pc.add(at, pa.scalar(1, pa.int32()))])
        return pc.binary_join(pa.ListArray.from_arrays(stops, pc.cast(pc.list_flatten(ids), pa.string())), ",")

    groups = pc.binary_join_element_wise(joined(ids_a, _one(shared["at"])), joined(ids_b, _one(shared["bt"])), "|")
    by_doc = _lists(_one(shared["doc"]), groups, m)
    links = pa.table({"doc": doc, "pair": pair}).group_by(["doc", "pair"]).aggregate([([], "count_all")]).sort_by(
        [("doc", "ascending"), ("pair", "ascending")])
    pairs = _offsets(_one(links["doc"]), m)
    found = pa.table({
        "n_a": pc.cast(pc.list_value_length(ids_a), pa.int64()), "n_b": pc.cast(pc.list_value_length(ids_b), pa.int64()),
        "n_groups": pc.cast(pc.list_value_length(by_doc), pa.int64()),
        "n_links": pc.cast(pc.list_value_length(_lists(doc, pair, m)), pa.int64()),
        "groups_sha256": pa.array([hashlib.sha256(g.as_py().encode()).hexdigest() for g in pc.binary_join(by_doc, ";")],
                                  pa.string()),
        "pairs": pa.ListArray.from_arrays(pairs, _one(links["pair"])),
        "times": pa.ListArray.from_arrays(pairs, pc.cast(_one(links["count_all"]), pa.int32()))})
    at = pc.index_in(pa.array(range(len(texts))), value_set=pa.array(rows, pa.int64()))
    return found.take(at)


def alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(row, doc_id) and the columns of ``aligned_texts`` for every row of
    ``docs``; ``row`` is a number of its own for each."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = encoder(path_a, path_b)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts, at = batch.column("text").to_pylist(), 0
            while at < len(texts):
                end, held = at, 0
                while end < len(texts) and (end == at or held + len(texts[end] or "") < BYTES_AT_ONCE):
                    held += len(texts[end] or "")
                    end += 1
                made = aligned_texts(both, texts[at:end])
                made = made.add_column(0, "doc_id", batch.column("doc_id").slice(at, end - at)).add_column(
                    0, "row", pa.array(np.arange(row, row + end - at, dtype=np.int64)))
                yield from made.combine_chunks().to_batches()
                row, at = row + end - at, end

    return docs.select("doc_id", "text").mapInArrow(
        run, f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<long>, times array<int>")


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """(pair, docs, best): in how many documents each id pair is linked, and
    whether that is the most for its A id."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []

        def counted() -> list[pa.RecordBatch]:
            made = pa.table({"pair": pa.chunked_array(held, pa.int64())}).group_by("pair").aggregate([([], "count_all")])
            held.clear()
            return made.rename_columns(["pair", "docs"]).combine_chunks().to_batches()

        for batch in batches:
            held.append(pc.list_flatten(batch.column("pairs")))
            if sum(map(len, held)) > ROWS_AT_ONCE:
                yield from counted()
        yield from counted()

    counts = aligned.select("pairs").mapInArrow(partial, "pair long, docs long").groupBy("pair").agg(
        F.sum("docs").alias("docs"))
    counts = stored(counts, "pair_docs")
    a = F.expr(f"pair div {size_b}")
    most = counts.groupBy(a.alias("a")).agg(F.max("docs").alias("most"))  # at most |A| rows
    return stored(counts.join(most, a == F.col("a")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")),
                  "pair_counts")


def aligned(docs: DataFrame, path_a: str, path_b: str, hot: int = HOT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)
    of every row of ``docs``."""
    rows = stored(alignments(docs, path_a, path_b), "aligned")
    counts = pair_counts(rows, len(tokenizer(path_b).tokens))
    total = counts.agg(F.sum("docs")).first()[0] or 0
    often = F.col("docs") * hot > F.lit(total).cast("decimal(38,0)")
    # At most `hot` pairs: each has over 1/hot of all rows.
    known = docs.sparkSession.sparkContext.broadcast(counts.where(often).select("pair", "docs", "best").toArrow())
    kept = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    kind = docs.schema["doc_id"].dataType.simpleString()

    def looked_up(batch: pa.RecordBatch):
        """Parent, pair and times of every pair of the batch, and where it is in the broadcast table."""
        pairs = batch.column("pairs")
        flat = pc.list_flatten(pairs)
        return (pc.list_parent_indices(pairs), flat, pc.cast(pc.list_flatten(batch.column("times")), pa.int64()),
                pc.index_in(flat, value_set=_one(known.value["pair"])))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parent, _, times, at = looked_up(batch)
            best = pc.cast(pc.fill_null(pc.take(_one(known.value["best"]), at), False), pa.int64())
            much = pc.fill_null(pc.take(_one(known.value["docs"]), at), 0)
            sums = pa.table({"p": parent, "n_best": pc.multiply(times, best), "count_sum": pc.multiply(times, much)}
                            ).group_by("p").aggregate([("n_best", "sum"), ("count_sum", "sum")])
            of = pc.index_in(pa.array(np.arange(batch.num_rows), parent.type), value_set=_one(sums["p"]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("row", "doc_id", *kept)]
                + [pc.fill_null(pc.take(_one(sums[c]), of), 0) for c in ("n_best_sum", "count_sum_sum")],
                names=["row", "doc_id", *kept, "n_best", "count_sum"])

    def left_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parent, flat, times, at = looked_up(batch)
            rest = pc.is_null(at)
            yield pa.RecordBatch.from_arrays(
                [pc.take(batch.column("row"), parent.filter(rest)), flat.filter(rest), times.filter(rest)],
                names=["r_row", "r_pair", "times"])

    fields = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    near = rows.mapInArrow(summed, f"row long, doc_id {kind}, {fields}, n_best long, count_sum long")
    rest = rows.select("row", "pairs", "times").mapInArrow(left_over, "r_row long, r_pair long, times long")
    rest = rest.join(counts.where(~often), F.col("r_pair") == F.col("pair")).groupBy("r_row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("r_best"),
        F.sum(F.col("times") * F.col("docs")).alias("r_sum"))
    zero = F.lit(0).cast("long")
    return near.join(rest, F.col("row") == F.col("r_row"), "left").select(
        "doc_id", *[F.coalesce(c, zero).alias(c) for c in kept[:4]],
        (F.col("n_best") + F.coalesce("r_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("r_sum", zero)).alias("count_sum"),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
