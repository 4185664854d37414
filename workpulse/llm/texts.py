"""Word and field conventions that the operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word, and the white space between words (ASCII only).
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_count(text: str | Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_class(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n
