"""A corpus pipeline of five stages over ``documents``.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns of documents.  ``run`` writes each
stage's result as Parquet to the shared folder, reads it for the next and deletes
what the stage has left there.

Defined cases: a null text has no language and goes in the first stage, as does an
empty one or one without a letter; a null id, language or source stays (a null
source is a source of its own); equal rows are documents each until near dedup
leaves one of them; very long texts pass whole; an empty table gives no rows; extra
columns are carried through all stages but the last, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workpulse.llm import bpe, langid, line_dedup, mixing, scratch, simhash, texts
from workpulse.llm.scratch import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; rejected ones go.  Learns from the same
    rows as the registered query does."""
    learned = langid.dictionaries(docs, texts.crc_class("doc_id", 4) != 2)
    return langid.predicted(docs, learned).where("NOT rejected").select("d.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents hold leave all texts."""
    return line_dedup.dedup_documents(docs, min_docs=10, min_chars=1)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, with or without an id."""
    return simhash.one_per_component(docs, words_in=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, by shard in random order; a document appears,
    whole, as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text and the digests of their round trip."""
    made = bpe.round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return made.select("d.doc_id", "d.lang", "d.source", "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]

#: Compression, SimHash and BPE have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, start = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch.mark()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        scratch.release(spark, since=start, keep=1)
    return docs.select(*[F.col(c) for c in docs.columns])
