"""Lines that many documents share.

Every line becomes a row of two 64-bit key hashes, document and position.  The
rows are range-partitioned by all of these and sorted, so a partition streams
the runs of equal hashes in order of document and position; a run that many
documents share spreads over as many partitions as its rows fill.  A run is
decided where it reaches the document count; only the undecided ends of a
partition (fewer documents than the count on each side) and one marker row per
decided end are put together afterwards.  The result is a compressed keep bitmap
per document, not text.

Defined cases: a null or empty text is one empty line; rows are documents, so rows
equal in id and text count each, and all get one bitmap; a null id is an id like any
other; an empty table gives no bitmaps; only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from workpulse.llm.scratch import stored
from workpulse.llm.texts import SPACES

_STRIP = SPACES.encode()


def _key_rows(min_chars: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dkeys = batch.column("dkey").to_pylist()
            which, keys, at, dkey = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                lines = (text.as_py() or "").encode().lower().split(b"\n")
                for pos, line in enumerate(lines):
                    line = line.strip(_STRIP)
                    if line and (min_chars <= 1 or len(line.decode()) >= min_chars):
                        which.append(i)
                        dkey.append(dkeys[i])
                        at.append(pos << 32 | len(lines))
                        keys.append(xxhash.xxh3_128_digest(line))
            pair = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair[:, 0].copy()), pa.array(pair[:, 1].copy()),
                 batch.column("doc_id").take(pa.array(which, pa.int64())),
                 pa.array(dkey, pa.int64()), pa.array(at, pa.int64())],
                names=["h1", "h2", "doc_id", "dkey", "at"])
    return rows


class _Runs:
    """Streams the sorted rows of one partition; see ``_stream``."""

    def __init__(self, min_docs: int, keep_first: bool):
        self.min_docs, self.keep_first = min_docs, keep_first
        self.held = None          # rows of the last, still undecided run
        self.decided = None       # key of the last run once it is decided
        self.first_row = None     # its first row, until it is known whether the run ends here
        self.at_start = True      # the last run is the partition's first one

    def feed(self, table: pa.Table) -> list[tuple[pa.Table, int]]:
        """(rows, kind): 0 drop, 1 undecided at an end, 2 first row of a run decided at an end."""
        out = []
        if self.held is not None:
            table, self.held = pa.concat_tables([self.held, table]).combine_chunks(), None
        if not table.num_rows:
            return out
        h1, h2, dkey, at = (table.column(c).to_numpy() for c in ("h1", "h2", "dkey", "at"))
        start = np.flatnonzero(np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        end = np.r_[start[1:], len(h1)]
        other = np.r_[True, dkey[1:] != dkey[:-1]]
        other[start] = True
        # A document counts where its first line of the run is, as often as it has rows.
        fresh = at == at[np.flatnonzero(other)][np.cumsum(other) - 1]
        docs = np.add.reduceat(fresh.astype(np.int64), start)
        drop = np.zeros(len(h1), bool)
        lead = 0
        if self.decided is not None:
            if (h1[0], h2[0]) == self.decided:
                drop[:end[0]] = True
                if self.keep_first:
                    first = [self.first_row.column(c)[0].as_py() for c in ("dkey", "at")]
                    drop[:end[0]] &= (dkey[:end[0]] != first[0]) | (at[:end[0]] != first[1])
                lead = 1
            if lead == 0 or len(start) > 1:
                out += self._close()
        for r in np.flatnonzero(docs >= self.min_docs):
            if r < lead:
                continue
            drop[start[r]:end[r]] = True
            if self.keep_first:  # the first line stays in every row of its document
                run = slice(start[r], end[r])
                drop[run] &= (dkey[run] != dkey[start[r]]) | (at[run] != at[start[r]])
            elif r == len(start) - 1 or (self.at_start and r == 0):
                drop[start[r]] = False
        last = len(start) - 1
        if lead == 0 and self.at_start and last > 0:
            kind = 2 if docs[0] >= self.min_docs else 1
            out.append((table.slice(0, 1 if kind == 2 else int(end[0])), kind))
        if last > 0:
            self.at_start = False
        if last >= lead:
            if docs[last] >= self.min_docs:
                self.decided, self.first_row = (h1[-1], h2[-1]), table.slice(int(start[last]), 1)
            else:
                self.held = table.slice(int(start[last]))
        out.append((table.filter(pa.array(drop)), 0))
        return out

    def _close(self) -> list[tuple[pa.Table, int]]:
        """The decided run has ended before the partition's end."""
        row, self.decided, self.first_row = self.first_row, None, None
        if self.at_start:
            self.at_start = False
            return [(row, 2)]
        return [] if self.keep_first else [(row, 0)]

    def finish(self) -> list[tuple[pa.Table, int]]:
        if self.decided is not None:
            return [(self.first_row, 2)]
        return [] if self.held is None else [(self.held, 1)]


def _stream(min_docs: int, keep_first: bool):
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs(min_docs, keep_first)

        def made(parts):
            for rows, kind in parts:
                rows = rows.append_column("kind", pa.array(np.full(rows.num_rows, kind, np.int32)))
                yield from rows.combine_chunks().to_batches()

        for batch in batches:
            yield from made(runs.feed(pa.Table.from_batches([batch])))
        yield from made(runs.finish())
    return stream


def dropped_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
                  keep_first: bool = False) -> DataFrame:
    """(doc_id, dkey, at) of every line whose key at least ``min_docs``
    documents hold; with ``keep_first`` the first occurrence by document and
    position stays.  ``at`` is position * 2**32 + the document's line count."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("dkey"), "text")
    lines = source.mapInArrow(_key_rows(min_chars), f"h1 long, h2 long, doc_id {kind}, dkey long, at long")
    order = ["h1", "h2", "doc_id", "dkey", "at"]
    lines = stored(lines, "lines")  # so that finding the range bounds reads no text
    parts = max(1, int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = lines.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    marks = stored(ranged.mapInArrow(_stream(min_docs, keep_first),
                                     f"h1 long, h2 long, doc_id {kind}, dkey long, at long, kind int"),
                   "marks")
    ends = marks.where("kind > 0")
    place = F.struct("doc_id", "dkey", "at")
    per_doc = ends.groupBy("h1", "h2", "doc_id", "dkey", "at").agg(
        F.max("kind").alias("kind"), F.count(F.lit(1)).alias("rows")).groupBy("h1", "h2", "doc_id", "dkey").agg(
        F.max("kind").alias("kind"), F.min(F.struct("at", "rows")).alias("x")).select(
        "h1", "h2", "doc_id", "dkey", "kind", "x.*")
    keys = (per_doc.groupBy("h1", "h2").agg(F.sum("rows").alias("n"), F.max("kind").alias("most"),
                                           F.min(place).alias("first"))
            .where((F.col("most") == 2) | (F.col("n") >= min_docs)).drop("n", "most"))
    more = ends.join(keys, ["h1", "h2"])
    if keep_first:
        more = more.where(~place.eqNullSafe(F.col("first")))
    cols = ["doc_id", "dkey", "at"]
    return marks.where("kind = 0").select(*cols).union(more.select(*cols))


def pack_bitmap(n_lines: int, dropped) -> bytes:
    keep = np.ones(n_lines, np.uint8)
    keep[np.asarray(dropped, np.int64)] = 0
    return zlib.compress(np.packbits(keep).tobytes(), 6)


def unpack_bitmap(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines)


def keep_bitmaps(docs: DataFrame, min_docs: int = 10, min_chars: int = 1,
                 keep_first: bool = False) -> DataFrame:
    """(doc_id, dkey, n_lines, n_dropped, keep) for every document that loses
    a line; ``keep`` is the zlib-compressed bitmap of the lines that stay."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    at = dropped_lines(docs, min_docs, min_chars, keep_first)
    per_doc = at.groupBy("doc_id", "dkey").agg(F.collect_set("at").alias("at"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [np.asarray(x.values.to_numpy()) for x in batch.column("at")]
            n_lines = [int(x[0] & 0xFFFFFFFF) for x in marks]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("dkey"), pa.array(n_lines, pa.int64()),
                 pa.array([len(x) for x in marks], pa.int64()),
                 pa.array([pack_bitmap(n, x >> 32) for n, x in zip(n_lines, marks)], pa.binary())],
                names=["doc_id", "dkey", "n_lines", "n_dropped", "keep"])

    return per_doc.mapInArrow(pack, f"doc_id {kind}, dkey long, n_lines long, n_dropped long, keep binary")


@F.pandas_udf(StringType())
def _kept_text(text: pd.Series, keep: pd.Series) -> pd.Series:
    def kept(t, bitmap):
        if t is None or bitmap is None:
            return None
        lines = t.split("\n")
        return "\n".join(x for x, stays in zip(lines, unpack_bitmap(bitmap, len(lines))) if stays)
    return pd.Series([kept(t, b) for t, b in zip(text, keep)], dtype=object)


def with_kept_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Columns of ``docs`` as a struct ``d``, its ``kept`` text, ``n_lines`` and
    ``n_dropped``.  A text without dropped lines stays as it is."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"),
                       F.xxhash64("doc_id", "text").alias("dkey"))
    marks = bitmaps.select(F.col("doc_id").alias("m_doc_id"), F.col("dkey").alias("m_dkey"),
                           F.col("n_dropped").alias("m_dropped"), "keep")
    # The bitmaps are the hashed side: the texts need not be sorted.
    both = rows.join(marks.hint("shuffle_hash"), F.col("d.doc_id").eqNullSafe(F.col("m_doc_id"))
                     & (F.col("dkey") == F.col("m_dkey")), "left")
    text = F.coalesce("d.text", F.lit(""))
    changed = _kept_text(F.when(F.col("keep").isNotNull(), text), "keep")
    return both.select(
        "d", F.when(F.col("keep").isNull(), F.col("d.text")).otherwise(changed).alias("kept"),
        (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce("m_dropped", F.lit(0)).cast("long").alias("n_dropped"))


def dedup_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the shared lines taken out of their texts."""
    made = with_kept_lines(docs, keep_bitmaps(docs, **options))
    new = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_dropped") == 0, F.col("d.n_chars")).otherwise(
            F.length("kept").cast(docs.schema["n_chars"].dataType))
    return made.select(*[new.get(c, F.col(f"d.`{c}`")).alias(c) for c in docs.columns])
