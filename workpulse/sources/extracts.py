"""Delimited extracts whose malformed lines are kept.

Every non-blank line of the files becomes one row.  A line that does not fit the
declared columns has NULL in all of them, its raw text in ``_corrupt_record`` and
why in ``_corrupt_reason``, so good + corrupt = lines, and no value is shifted,
cut off or padded.  The lines are parsed by ``from_csv`` with a corrupt-record
column: a plan over the text source, split by bytes like any text file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workpulse.sources.io import EXTRACT_OPTIONS, read_extract

CORRUPT, REASON, SOURCE = "_corrupt_record", "_corrupt_reason", "_source_file"


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(line, _source_file) of every non-blank line."""
    return spark.read.text(list(paths) if not isinstance(paths, str) else paths).where(
        "trim(value) <> ''").select(F.col("value").alias("line"), F.col("_metadata.file_path").alias(SOURCE))


def parse_lines(lines: DataFrame, columns: Sequence[str], sep: str = "|", null_token: str = "[NULL]") -> DataFrame:
    """``lines`` (line, ...) with the declared ``columns``, all strings, and
    ``_corrupt_record`` and ``_corrupt_reason``:

    * ``broken_quote``: a quote that is never closed;
    * ``wrong_field_count``: more or fewer fields than columns;
    * ``other_header``: the column names in another order, a file of another layout.

    Lines that repeat the header are not rows and are left out."""
    names = list(columns)
    options = {k: v for k, v in EXTRACT_OPTIONS.items() if k in ("quote", "escape", "mode")}
    options |= {"sep": sep, "nullValue": null_token, "columnNameOfCorruptRecord": CORRUPT}
    ddl = ", ".join([f"`{c}` string" for c in names] + [f"{CORRUPT} string"])
    row = lines.withColumn("_row", F.from_csv("line", ddl, options))
    quote = options["quote"]
    quotes = F.length("line") - F.length(F.replace("line", F.lit(quote), F.lit("")))
    values = F.array(*[F.col(f"_row.`{c}`") for c in names])
    header = F.array(*map(F.lit, names))
    reason = (F.when(quotes % 2 == 1, "broken_quote")
              .when(F.col(f"_row.{CORRUPT}").isNotNull(), "wrong_field_count")
              .when(F.array_sort(values) == F.array_sort(header), "other_header"))
    kept = row.where(~F.coalesce(values == header, F.lit(False))).withColumn(REASON, reason)
    good = F.col(REASON).isNull()
    return kept.select(*[F.when(good, F.col(f"_row.`{c}`")).alias(c) for c in names],
                       F.when(~good, F.col("line")).alias(CORRUPT), REASON,
                       *[c for c in lines.columns if c != "line"])


def read_checked_extract(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str] | None = None,
                         sep: str = "|", null_token: str = "[NULL]") -> DataFrame:
    """The rows of delimited extract(s), malformed lines included; ``columns``
    default to the header of the first file."""
    names = columns or read_extract(spark, paths, sep, null_token).columns
    return parse_lines(read_lines(spark, paths), names, sep, null_token)


def line_reasons() -> dict:
    """The quarantine reasons of malformed lines, to come before those of rows."""
    return {r: F.coalesce(F.col(REASON) == r, F.lit(False))
            for r in ("broken_quote", "wrong_field_count", "other_header")}
