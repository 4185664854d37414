"""The registered queries of this folder: each applies one operator, with
production parameters, to its whole table and derives the contract's columns
from the operator's result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workpulse.llm import (alignment, bpe, filter_audit, knn, langid, lbl, line_dedup, minhash, mixing, oracles, outliers,
                           secrets, simhash, substring, texts)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_mixing", oracles.MIXING)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(*mixing.mix(table(spark, sf_dir, "documents")))


@query("op2_line_dedup", oracles.LINE_DEDUP)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    made = line_dedup.with_kept_lines(docs, line_dedup.keep_bitmaps(docs, min_docs=10, min_chars=1))
    return made.select("d.doc_id", "n_lines", "n_dropped",
                       F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


@query("op3_simhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = simhash.near_duplicates(table(spark, sf_dir, "documents"), words_in=3, radius=3)
    return made.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                       "component_id")


@query("op4_byte_bpe")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = bpe.digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return made.select("d.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = texts.crc_class("doc_id", 4) == 2
    learned = langid.dictionaries(docs, ~held_out)
    made = langid.predicted(docs.select("doc_id", "text"), learned)
    return made.select("d.doc_id", F.col("d.doc_id").alias("i"), "lang_pred", "score", "rejected").select(
        "doc_id", F.coalesce(texts.crc_class("i", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


@query("op8_outliers")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = outliers.judged(table(spark, sf_dir, "documents"))
    return made.select("doc_id", *outliers.STATS, "base_failed", "kept", "d2")


@query("op5_top_k", oracles.TOP_K)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, top=5)


@query("op10_secrets")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = secrets.secrets(table(spark, sf_dir, "documents"))
    # A second parameter of a lambda, with a default or not, would be the element's place in the array.
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    n = [of_kind(k).alias(f"n_{secrets.KINDS[k]}") for k in range(3)]
    return made.select(
        "doc_id", *n, F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets.span_text(F.sort_array(F.concat("base", "added"))).alias("spans"),
        F.size("added").cast("long").alias("n_markov"))


@query("op9_log_bilinear")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = texts.crc_class("doc_id", 7) == 2
    made = lbl.scored(docs, texts.crc_class("doc_id", 7) != 2)
    return made.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                       "train_tokens", "base_score", "score")


@query("op6_substring")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = substring.passages(table(spark, sf_dir, "documents"), min_words=50, limit=0.8)
    spans = F.transform("passages", lambda p: F.concat_ws(":", p["first"], p["last"], p["words"]))
    runs = F.transform("runs", lambda r: F.concat_ws(":", r["first"], r["last"]))
    return made.select("doc_id", F.size("passages").cast("long").alias("n_passages"), "n_words", "n_removed",
                       F.array_join(spans, ",").alias("passages"), "first_doc_ids",
                       F.array_join(runs, ",").alias("runs"), "n_run_words", "n_later_words")


@query("op13_filter_audit", oracles.FILTER_AUDIT)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_minhash", oracles.NEAR_DUPLICATES)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = minhash.near_duplicates(table(spark, sf_dir, "documents"), words_in=4, limit=80)
    return made.select("doc_id", "n_shingles", "component_id",
                       F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query("op12_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                             public_tokenizers.path("piece_bpe_32k.model"))
