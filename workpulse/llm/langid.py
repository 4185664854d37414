"""Language identification by compression.

Each language has a raw-content zstandard dictionary, filled with pieces from all
over the texts of a bounded sample of labelled documents.  A text is compressed,
whole, in pieces of ``PIECE`` bytes with every dictionary; the language whose
dictionary makes it smallest is the answer.  Case is ignored.  The score weighs
each language by 2 to the power of minus the margins it is behind (a margin is
``min_margin`` of the smallest size), so a tie of two scores 0.5.  A text whose best
language leads by less than one margin is rejected, save texts under ``min_bytes``,
too short to tell languages apart by so much.

Bounds: ``sample_docs`` documents a language, of each ``SAMPLE_PIECES`` pieces of
``SAMPLE_CHARS`` characters at equal distances from its first to its last character
(all of a shorter one), make a dictionary of at most ``dictionary_bytes``; more than
``MAX_LANGUAGES`` labels raise an error.  Predictions read nothing but the text.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so
is every text when nothing could be learned; a tie goes to the label learned from
more rows, then to the first in code-point order; null labels, null ids and null texts are not learned from;
repeated rows count once in the sample; columns of the input are carried in one
struct.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PIECE = 1 << 15
SAMPLE_CHARS, SAMPLE_PIECES = 128, 16
MAX_LANGUAGES = 500
UNKNOWN = "und"


def sample_pieces(text: str) -> Column:
    """Array of pieces at equal distances over the whole of a text, or all of it."""
    size, last = F.length(text), SAMPLE_PIECES - 1
    at = F.sequence(F.lit(0), F.least(F.lit(last), F.ceil(size / SAMPLE_CHARS).cast("int") - 1))
    step = F.when(size <= SAMPLE_CHARS * SAMPLE_PIECES, F.lit(float(SAMPLE_CHARS))).otherwise(
        (size - SAMPLE_CHARS) / last)
    return F.transform(at, lambda i: F.substring(text, F.floor(i * step).cast("int") + 1, F.lit(SAMPLE_CHARS)))


def dictionaries(docs: DataFrame, learn: Column, sample_docs: int = 200,
                 dictionary_bytes: int = 96 << 10) -> dict[str, bytes]:
    """Dictionary of each label, the most frequent label first, from rows for
    which ``learn`` holds."""
    rows = docs.select(F.col("doc_id"), F.col("lang"), F.col("text"), learn.alias("learn")).where(
        "learn AND lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL")
    counts = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return {}
    # A hash of the id draws about four times the sample, of which the least hashes stay.
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(1.0, 4 * sample_docs / r["count"]))])
    h = F.xxhash64(F.lit("language sample"), "doc_id")
    drawn = rows.where(F.pmod(h, F.lit(1 << 40)) < share[F.col("lang")] * float(1 << 40)).where(
        F.col("text").rlike(r"\p{L}"))
    drawn = drawn.select("lang", h.alias("h"), sample_pieces("text").alias("pieces")).distinct()
    order = W.partitionBy("lang").orderBy("h", "pieces")
    sample = drawn.withColumn("n", F.row_number().over(order)).where(f"n <= {sample_docs}")
    texts: dict[str, list[list[bytes]]] = {}
    for r in sorted(sample.collect(), key=lambda r: (r["lang"], r["n"])):
        texts.setdefault(r["lang"], []).append([p.lower().encode() for p in r["pieces"]])
    often = {r["lang"]: r["count"] for r in counts}
    return {lang: _fill(texts[lang], dictionary_bytes) for lang in sorted(texts, key=lambda x: (-often[x], x))}


def _fill(texts: list[list[bytes]], size: int) -> bytes:
    """An equal part of each text, in pieces from all over it; shorter texts leave
    their rest to the others."""
    left, parts = size, []
    for i, pieces in enumerate(sorted(texts, key=lambda ps: sum(map(len, ps)))):
        room = left // (len(texts) - i)
        if sum(map(len, pieces)) + len(pieces) > room:
            some = max(1, room // (1 + max(map(len, pieces))))
            pieces = [pieces[k * len(pieces) // some] for k in range(some)]
        parts.append(b"\n".join(pieces)[:room])
        left -= len(parts[-1])
    return b"\n".join(parts)


class Classifier:
    def __init__(self, learned: dict[str, bytes], level: int = 9):
        self.langs = list(learned)
        self.compressors = []
        for lang in self.langs:
            raw = zstandard.ZstdCompressionDict(learned[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(level=level)
            self.compressors.append(zstandard.ZstdCompressor(
                level=level, dict_data=raw, write_checksum=False, write_content_size=False,
                write_dict_id=False))

    def sizes(self, text: str) -> np.ndarray:
        data = text.lower().encode()
        pieces = [data[i:i + PIECE] for i in range(0, len(data), PIECE)]
        return np.array([sum(len(c.compress(p)) for p in pieces) for c in self.compressors], float)

    def predict(self, text: str | None, min_margin: float) -> tuple[str, float, bool]:
        """Language, score, and whether it leads by less than the margin."""
        if not self.langs or text is None or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        sizes = self.sizes(text)
        best = int(sizes.argmin())
        behind = (sizes - sizes[best]) / (min_margin * sizes[best])
        narrow = len(sizes) > 1 and np.sort(behind)[1] < 1
        return self.langs[best], float(1 / np.exp2(-behind).sum()), bool(narrow)


def predicted(docs: DataFrame, learned: dict[str, bytes], min_margin: float = 0.0125,
              min_bytes: int = 64) -> DataFrame:
    """Columns of ``docs`` as struct ``d``, lang_pred, score, and rejected (no
    language, or a lead under ``min_margin`` of the size in a text of ``min_bytes``
    or more)."""
    bc = docs.sparkSession.sparkContext.broadcast(learned)  # at most MAX_LANGUAGES dictionaries
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(bc.value)
        for batch in batches:
            made = [model.predict(t.as_py(), min_margin) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("d"), pa.array([m[0] for m in made], pa.string()),
                 pa.array([m[1] for m in made], pa.float64()), pa.array([m[2] for m in made], pa.bool_()),
                 pc.binary_length(batch.column("text"))],
                names=["d", "lang_pred", "score", "narrow", "bytes"])

    fields = f"d {rows.schema['d'].dataType.simpleString()}, lang_pred string, score double, narrow boolean, bytes int"
    return rows.mapInArrow(run, fields).withColumn(
        "rejected", (F.col("lang_pred") == UNKNOWN) | (F.col("narrow") & (F.col("bytes") >= min_bytes))).drop(
        "narrow", "bytes")
