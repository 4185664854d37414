"""Byte-level BPE, encoding and decoding, on whole texts.

A text is cut into pieces by the tokenizer's pattern.  The distinct pieces of a
batch of texts that the task has not met yet go, by length, into padded numpy
matrices of token ids; every round, every row merges its leftmost pair of least
rank at once (pairs are looked up in a hash table held in arrays), and rows that
are done leave the matrix.  Texts are then put together from their pieces'
ids by array gathers, and so are decoded bytes and id strings.

The piece cache of a task is bounded by ``cache_pieces``; a piece over
``MATRIX_BYTES`` bytes is merged by a heap of its pairs instead, so that one
piece as long as a text still takes n log n steps.

Defined cases: a null or empty text has no ids and decodes to no bytes; rows are
independent, so ties, repeated rows and null ids need no rule; an empty table
gives an empty result; columns of the input are carried in one struct, so they
cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The code points of Unicode's White_Space.
SPACE = {*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
         0x3000}
MATRIX_BYTES = 1024
CELLS = 1 << 20
CHARS_AT_ONCE = 1 << 20
NONE = np.int64(1 << 40)


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a file of lines ``base64(token) rank``."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache
def _members(name: str, top: int) -> str:
    """Ranges of a character class below code point ``top``, as text inside ``[...]``:
    ``L`` and ``N`` by general category, or the white space of SPACE.  Code points
    that Python's tables do not know yet are asked of ``regex``'s newer ones."""
    newer = regex.compile(rf"\p{{{name}}}") if name != "s" else None

    def belongs(c: int) -> bool:
        if name == "s":
            return c in SPACE
        kind = unicodedata.category(chr(c))
        return kind[0] == name or kind == "Cn" and c < 0x30000 and newer.match(chr(c)) is not None

    codes = np.array([c for c in chain(range(min(top, 0xD800)), range(0xE000, top)) if belongs(c)])
    cuts = np.flatnonzero(np.diff(codes) != 1)
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in
                   zip(codes[np.r_[0, cuts + 1]], codes[np.r_[cuts, len(codes) - 1]]))


def compiled(pattern: str, top: int = 0x110000) -> re.Pattern:
    """``pattern`` with its Unicode classes written out as far as texts of code
    points below ``top`` need them: ``re`` matches such sets as bitmaps."""
    classes = {r"\p{L}": "L", r"\p{N}": "N", r"\s": "s"}
    parts = re.split(r"(\[[^\]]*\])", pattern)
    for i, part in enumerate(parts):
        for name, what in classes.items():
            ranges = _members(what, top)
            part = part.replace(name, ranges if i % 2 else f"[{ranges}]")
        parts[i] = part.replace(r"\S", f"[^{_members('s', top)}]")
    return re.compile("".join(parts))


class _Rows:
    """Rows of bytes of different length under each other: row k is data[start[k]:start[k] + size[k]]."""

    def __init__(self, rows: list[bytes]):
        self.size = np.array([len(r) for r in rows], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(rows), np.uint8)


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs data[start:start + size] after one another."""
    shift = start - (np.cumsum(size) - size)
    return data[np.repeat(shift, size) + np.arange(size.sum())]


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str, cache_pieces: int = 600_000):
        self.ranks, self.cache_pieces = ranks, cache_pieces
        self.narrow, self.wide, self.full = (compiled(pattern, top).findall
                                             for top in (0x100, 0x10000, 0x110000))
        words = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            words[rank] = token
        self.bytes_of = _Rows(words)
        self.text_of = _Rows([b"%d," % i for i in range(len(words))])
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = [(ranks[t[:i]] << 20 | ranks[t[i:]], rank) for t, rank in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self._index(np.array(pairs, np.int64).reshape(-1, 2))
        self._forget()

    # pair lookup

    def _index(self, pairs: np.ndarray) -> None:
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.merged = np.full(1 << self.bits, NONE, np.int64)
        slot, todo = self._slot(pairs[:, 0]), np.arange(len(pairs))
        while len(todo):
            at = slot[todo]
            free = todo[self.keys[at] < 0]
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.merged[slot[won]] = pairs[won, 0], pairs[won, 1]
            todo = np.setdiff1d(todo, won)
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id that each pair merges to, NONE where it does not (or an id is negative)."""
        keys = np.where((left < 0) | (right < 0), np.int64(-2), left << 20 | right).ravel()
        out = np.full(len(keys), NONE, np.int64)
        todo = np.flatnonzero(keys >= 0)
        slot = self._slot(keys[todo])
        while len(todo):
            held = self.keys[slot]
            hit = held == keys[todo]
            out[todo[hit]] = self.merged[slot[hit]]
            more = ~hit & (held >= 0)
            todo, slot = todo[more], (slot[more] + 1) & ((1 << self.bits) - 1)
        return out.reshape(left.shape)

    # merging

    def merge_matrix(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge every row of ``ids`` (padded with -1) to the end: (ids, sizes)."""
        n, width = ids.shape
        done, sizes = np.full((n, width), -1, np.int64), np.zeros(n, np.int64)
        rows = np.arange(n)
        rank = np.full((n, width), NONE)
        rank[:, :-1] = self.rank_of(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), at]
            over = best >= NONE
            if over.any():
                done[rows[over], :ids.shape[1]] = ids[over]
                stay = ~over
                rows, ids, rank, at, best = rows[stay], ids[stay], rank[stay], at[stay], best[stay]
                if not len(rows):
                    break
            k = np.arange(len(rows))
            source = np.arange(ids.shape[1] - 1)[None, :]
            source = source + (source > at[:, None])
            ids[k, at] = best
            ids = np.take_along_axis(ids, source, 1)
            rank = np.take_along_axis(rank, source, 1)
            right = np.minimum(at + 1, ids.shape[1] - 1)
            after = np.where(at + 1 < ids.shape[1], ids[k, right], -1)
            rank[k, at] = self.rank_of(best, after)
            left = np.maximum(at - 1, 0)
            before = np.where(at > 0, self.rank_of(ids[k, left], best), rank[k, left])
            rank[k, left] = np.where(at > 0, before, rank[k, left])
        sizes[:] = (done >= 0).sum(axis=1)
        return done, sizes

    def merge_long(self, piece: bytes) -> list[int]:
        """The same merges for one long piece, with a heap of (rank, place)."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        token = [piece[i:i + 1] for i in range(len(piece))]
        heap = [(r, i) for i in range(len(ids) - 1)
                if (r := self.ranks.get(token[i] + token[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if ids[i] is not None else len(ids)
            if j >= len(ids) or self.ranks.get(token[i] + token[j]) != rank:
                continue
            token[i], ids[i], ids[j], after[i] = token[i] + token[j], rank, None, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(ids) and (r := self.ranks.get(token[a] + token[b])) is not None:
                    heapq.heappush(heap, (r, a))
        return [x for x in ids if x is not None]

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids after one another, number of ids of each piece)."""
        found: list = [None] * len(pieces)
        by_size: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                found[i] = (rank,)
            elif len(piece) > MATRIX_BYTES:
                found[i] = self.merge_long(piece)
            else:
                by_size.setdefault(len(piece) if len(piece) <= 24 else -(-len(piece) // 32) * 32, []).append(i)
        for width, places in by_size.items():
            step = max(1, CELLS // width)
            for at in range(0, len(places), step):
                some = places[at:at + step]
                raw = np.zeros((len(some), width), np.uint8)
                sizes = np.array([len(pieces[i]) for i in some])
                flat = np.frombuffer(b"".join(pieces[i] for i in some), np.uint8)
                real = np.arange(width)[None, :] < sizes[:, None]
                raw[real] = flat
                ids, n = self.merge_matrix(np.where(real, self.single[raw], -1))
                for i, row, k in zip(some, ids.tolist(), n.tolist()):
                    found[i] = row[:k]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum())), sizes

    # texts

    def _forget(self) -> None:
        self.code: dict[str, int] = {}
        self.flat = np.zeros(0, np.int64)
        self.start = self.size = np.zeros(0, np.int64)

    def _learn(self, pieces: list[str]) -> None:
        fresh = [p for p in set(pieces) if p not in self.code]
        if len(self.code) + len(fresh) > self.cache_pieces and self.code:
            self._forget()
            fresh = list(set(pieces))
        if fresh:
            ids, sizes = self.encode_pieces([p.encode() for p in fresh])
            self.code.update(zip(fresh, range(len(self.code), len(self.code) + len(fresh))))
            self.start = np.r_[self.start, np.cumsum(sizes) - sizes + len(self.flat)]
            self.size, self.flat = np.r_[self.size, sizes], np.r_[self.flat, ids]

    def split(self, text: str) -> list[str]:
        """The pattern's matches in ``text``."""
        try:
            text.encode("latin-1")
            return self.narrow(text)
        except UnicodeEncodeError:
            return (self.wide if len(text.encode("utf-16-le")) == 2 * len(text) else self.full)(text)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts after one another, number of ids of each text)."""
        ids, sizes, i = [np.zeros(0, np.int64)], [], 0
        while i < len(texts):
            held, some = 0, []
            while i < len(texts) and held < CHARS_AT_ONCE:
                some.append(self.split(texts[i] or ""))
                held += len(texts[i] or "")
                i += 1
            pieces = list(chain.from_iterable(some))
            self._learn(pieces)
            codes = np.fromiter(map(self.code.__getitem__, pieces), np.int64, len(pieces))
            each = self.size[codes]
            ids.append(gather(self.flat, self.start[codes], each))
            ends = np.r_[0, np.cumsum(each)][np.cumsum([len(p) for p in some])]
            sizes.append(np.diff(np.r_[0, ends]))
        return np.concatenate(ids), np.concatenate(sizes) if sizes else np.zeros(0, np.int64)

    def _joined(self, rows: _Rows, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        each = rows.size[ids]
        data = gather(rows.data, rows.start[ids], each).tobytes()
        ends = np.r_[0, np.cumsum(each)][np.cumsum(sizes)].tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The bytes of each run of ``ids``."""
        return self._joined(self.bytes_of, ids, sizes)

    def id_strings(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The decimal ids of each run, joined by commas."""
        return [s[:-1] for s in self._joined(self.text_of, ids, sizes)]


_codecs: dict = {}


def _codec(file: str, pattern: str, cache_pieces: int) -> Codec:
    """The task process's codec for a rank file that Spark has shipped."""
    key = (file, pattern, cache_pieces)
    if key not in _codecs:
        _codecs[key] = Codec(load_ranks(SparkFiles.get(file)), pattern, cache_pieces)
    return _codecs[key]


def _ship(df: DataFrame, path: str) -> str:
    df.sparkSession.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encoded(docs: DataFrame, ranks_path: str, pattern: str, cache_pieces: int = 600_000) -> DataFrame:
    """Columns of ``docs`` as struct ``d`` without its text, and ``ids`` (array<int>)."""
    return _run(docs, ranks_path, pattern, cache_pieces, ("ids",))


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, cache_pieces: int = 600_000) -> DataFrame:
    """As ``encoded``, and ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of
    the ids and of the bytes that decoding the ids gives."""
    return _run(docs, ranks_path, pattern, cache_pieces, ("ids", "digests"))


def digests(docs: DataFrame, ranks_path: str, pattern: str, cache_pieces: int = 600_000) -> DataFrame:
    """``round_trip`` without the ids themselves."""
    return _run(docs, ranks_path, pattern, cache_pieces, ("digests",))


def _run(docs: DataFrame, path: str, pattern: str, cache_pieces: int, what: tuple[str, ...]) -> DataFrame:
    file = _ship(docs, path)
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("d"), "text")
    fields = f"d {rows.schema['d'].dataType.simpleString()}"
    fields += ", ids array<int>" if "ids" in what else ""
    fields += ", n_tokens long, ids_sha256 string, decoded_sha256 string" if "digests" in what else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(file, pattern, cache_pieces)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, sizes = codec.encode(part.column("text").to_pylist())
                made = {"d": part.column("d")}
                if "ids" in what:
                    ends = np.r_[0, np.cumsum(sizes)].astype(np.int32)
                    made["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32)))
                if "digests" in what:
                    sha = lambda rows: pa.array([hashlib.sha256(r).hexdigest() for r in rows])
                    made["n_tokens"] = pa.array(sizes)
                    made["ids_sha256"] = sha(codec.id_strings(ids, sizes))
                    made["decoded_sha256"] = sha(codec.decode(ids, sizes))
                yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))

    return rows.mapInArrow(run, fields)


def decoded(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``df`` with its column ``ids`` replaced by ``decoded`` (binary)."""
    file = _ship(df, ranks_path)
    rest = [c for c in df.columns if c != "ids"]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("d"), "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(file, pattern, 600_000)
        for batch in batches:
            ids = batch.column("ids")
            sizes = np.array([len(x) if x is not None else 0 for x in ids.to_pylist()], np.int64)
            flat = ids.flatten().to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("d"), pa.array(codec.decode(flat, sizes), pa.binary())], names=["d", "decoded"])

    made = rows.mapInArrow(run, f"d {rows.schema['d'].dataType.simpleString()}, decoded binary")
    return made.select("d.*", "decoded")
