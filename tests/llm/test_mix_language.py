"""Shards of the mix in random order, language margins on junk, dictionaries from all of a text."""

import random
import string
from collections import Counter

import numpy as np
import zstandard
from pyspark.sql import functions as F

from workpulse.llm import langid, mixing

SCHEMA = "doc_id long, text string, lang string, source string, size long, shard int, order int, d int"


def test_shards_hold_all_of_the_mix_in_their_order(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(1, 40)) + f" n{i}", "en", rng.choice("aab") if i % 9 else None, 1, 2, 3, 4)
            for i in range(400)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    _, targets, placements = mixing.mix(docs, block_words=None, shard_words=2000)
    placed = mixing.shuffled(placements, pieces=4)
    parts = placed.select(F.spark_partition_id().alias("p"), "shard", "piece", "order", "doc_id", "epoch").collect()
    assert Counter((r.doc_id, r.epoch) for r in parts) == Counter(
        (r.doc_id, r.epoch) for r in placements.collect())
    assert len({r.shard for r in parts}) > 2
    by_part = {}
    for r in parts:
        by_part.setdefault((r.shard, r.piece), set()).add(r.p)
    assert all(len(p) == 1 for p in by_part.values())               # a run lies in one task
    for shard in {r.shard for r in parts}:
        run = [r for r in sorted(parts, key=lambda r: r.order) if r.shard == shard]
        ids = [r.doc_id for r in run]
        assert ids != sorted(ids) and [r.piece for r in run] == sorted(r.piece for r in run)
        share = sum(i % 2 for i in ids) / len(ids)                  # a random sample of the mix
        assert 0.2 < share < 0.8
    mixed = mixing.mixed_documents(docs, shard_words=2000).collect()
    again = mixing.mixed_documents(docs.repartition(2), shard_words=2000).collect()
    assert Counter(r.doc_id for r in mixed) == Counter(r.doc_id for r in again)
    assert set(r.text for r in mixed) <= {r[1] for r in rows}


def languages():
    rng = random.Random(8)
    stems = {"en": ["the", "thing", "with", "other", "ation", "wh"], "de": ["und", "der", "ung", "schön", "keit", "ge"],
             "es": ["ción", "que", "los", "ñado", "ente", "ar"]}
    word = lambda lang: "".join(rng.choice(stems[lang]) for _ in range(rng.randint(1, 3)))
    return stems, lambda lang, n: " ".join(word(lang) for _ in range(n))


def test_junk_is_rejected_and_languages_are_not(spark):
    stems, text = languages()
    rng = random.Random(5)
    rows = [(i, text(lang, rng.randint(20, 400)), lang, "a", 1, 1, 1, 1) for i, lang in enumerate(list(stems) * 80)]
    docs = spark.createDataFrame(rows, SCHEMA)
    learned = langid.dictionaries(docs, F.col("doc_id") % 4 != 2)
    junk = []
    for letters in (string.ascii_lowercase, string.ascii_letters + string.digits + "+/"):
        for n in (1000, 3000, 30_000):
            junk += ["".join(rng.choice(letters) for _ in range(n)) for _ in range(20)]
    bad = spark.createDataFrame([(1000 + i, t, None, "x", 1, 1, 1, 1) for i, t in enumerate(junk)], SCHEMA)
    made = langid.predicted(docs.where("doc_id % 4 = 2").union(bad), learned).select(
        "d.doc_id", "d.lang", "lang_pred", "score", "rejected").collect()
    junk_rows = [r for r in made if r.doc_id >= 1000]
    assert sum(r.rejected for r in junk_rows) >= 0.95 * len(junk_rows)
    real = [r for r in made if r.doc_id < 1000]
    assert all(not r.rejected and r.lang_pred == r.lang and 0.5 < r.score <= 1 for r in real)


def test_score_from_sizes_by_hand(spark):
    stems, text = languages()
    docs = spark.createDataFrame([(i, text(lang, 60), lang, "a", 1, 1, 1, 1) for i, lang in enumerate(list(stems) * 12)],
                                 SCHEMA)
    learned = langid.dictionaries(docs, F.lit(True))
    probe = [text("en", 30), text("es", 9), "thwhother der", "x" * 70_000, "Ünd"]
    made = {r.text: r for r in langid.predicted(spark.createDataFrame([(t,) for t in probe], "text string"), learned)
            .select("d.text", "lang_pred", "score", "rejected").collect()}
    for t in probe:
        sizes = {}
        for lang, raw in learned.items():
            c = zstandard.ZstdCompressor(level=9, dict_data=zstandard.ZstdCompressionDict(
                raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_checksum=False, write_content_size=False,
                write_dict_id=False)
            data = t.lower().encode()
            sizes[lang] = sum(len(c.compress(data[i:i + 32768])) for i in range(0, len(data), 32768))
        low = min(sizes.values())
        behind = sorted((s - low) / (0.0125 * low) for s in sizes.values())
        assert sizes[made[t].lang_pred] == low
        assert abs(made[t].score - 1 / sum(2.0 ** -b for b in behind)) < 1e-9
        assert made[t].rejected == (behind[1] < 1 and len(t.encode()) >= 64)


def test_dictionaries_hold_all_of_a_text(spark):
    text = "".join(f"{i:05d}," for i in range(20_000))
    docs = spark.createDataFrame([(1, text, "aa", "s", 1, 1, 1, 1), (2, "short one", "aa", "s", 1, 1, 1, 1)], SCHEMA)
    got = docs.select(langid.sample_pieces("text").alias("p")).collect()
    assert [len(r.p) for r in got] == [16, 1] and "".join(got[1].p) == "short one"
    assert got[0].p[0] == text[:128] and got[0].p[-1] == text[-128:]
    places = [text.index(p) for p in got[0].p]
    assert np.ptp(np.diff(places)) <= 1
    learned = langid.dictionaries(docs.withColumn("text", F.concat(F.lit("a"), "text")), F.lit(True))
    assert b"19999" in learned["aa"] and b"00001" in learned["aa"] and b"short one" in learned["aa"]
