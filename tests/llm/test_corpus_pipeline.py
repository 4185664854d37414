"""The corpus pipeline, stage by stage against brute force, on nulls, empty and long
texts, equal rows, ties, clashing columns, and an empty table."""

import base64
import hashlib
import random
from collections import Counter

import corpus_pipeline
import pytest
import tiktoken

import public_tokenizers
from tests_llm_helpers import brute_lines, fingerprint
from workpulse.llm import langid, scratch, texts

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, d string, rejected boolean, "
          "kept int, order long, shard int, component long, n_lines long")
EXTRA = (9, "d", True, 5, 6, 7, 8, 9)


def rows():
    rng = random.Random(30)
    stems = {"en": ["the", "thing", "with", "other", "ation"], "de": ["und", "der", "ung", "schön", "keit"]}
    word = lambda lang: "".join(rng.choice(stems[lang]) for _ in range(rng.randint(1, 3)))
    out = []
    for i in range(60):
        lang = "en" if i % 2 else "de"
        lines = [" ".join(word(lang) for _ in range(rng.randint(8, 40))) for _ in range(rng.randint(1, 4))]
        if i % 3:
            lines.insert(rng.randrange(len(lines) + 1), "  A line THAT many documents hold\t")
        out.append((i, "\n".join(lines), lang if i % 7 else None, rng.choice(["a", "a", "b", None])))
    same = " ".join(word("en") for _ in range(50))
    out += [(100 + i, same, "en", "a") for i in range(5)] + [(105, same.upper(), "en", "b"), (None, same, "en", "a")] * 2
    out += [(200, None, "en", "a"), (201, "", "en", "a"), (202, "123 ...", "en", "a"), (None, None, None, None),
            (203, " ".join(word("de") for _ in range(20_000)), "de", "c"), (None, "und der ung schön keit " * 9, "de", "c")]
    return [(*r, None if r[1] is None else len(r[1]), *EXTRA) for r in out]


ROWS = rows()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def test_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    key = lambda r: (r["doc_id"], r["text"])

    learned = langid.dictionaries(docs, texts.crc_class("doc_id", 4) != 2)
    model = langid.Classifier(learned)
    want = Counter()
    for r in ROWS:
        lang, _, narrow = model.predict(r[1], 0.0125)
        if lang != "und" and not (narrow and len((r[1] or "").encode()) >= 64):
            want[r[:2]] += 1
    first = scratch.stored(stages["language_id"](spark, docs, folder), "one")
    assert first.columns == docs.columns and Counter(map(key, first.collect())) == want
    assert want[None, "und der ung schön keit " * 9] == 1 and want[203, ROWS[-2][1]] == 1

    held = [tuple(r) for r in first.collect()]
    second = scratch.stored(stages["line_dedup"](spark, first, folder), "two")
    got = second.collect()
    assert second.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, t) for i, _, _, t in brute_lines(held, 10))
    assert all(r.n_chars == len(r.text) for r in got)

    third = scratch.stored(stages["simhash_near_dedup"](spark, second, folder), "three")
    prints = [fingerprint(r.text) for r in got]
    boss = list(range(len(got)))

    def root(x):
        while boss[x] != x:
            x = boss[x]
        return x
    for i in range(len(got)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                boss[root(i)] = root(j)
    groups = {}
    for i, r in enumerate(got):
        groups.setdefault(root(i), []).append(key(r))
    left = Counter(map(key, third.collect()))
    assert third.columns == docs.columns and sum(left.values()) == len(groups)
    for members in groups.values():
        assert sum(left[m] for m in set(members)) == 1               # one of each group, whichever has an id
        named = [m for m in members if m[0] is not None]
        assert not named or any(left[m] for m in named)

    fourth = scratch.stored(stages["mixing"](spark, third, folder), "four")
    taken = Counter(map(key, fourth.collect()))
    assert fourth.columns == docs.columns and set(taken) <= set(left)
    assert all(n <= 2 * left[k] for k, n in taken.items())

    last = stages["byte_bpe"](spark, fourth, folder).collect()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for (i, t), n in taken.items():
        want[i, tuple(plain.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()] += n
    assert Counter((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in last) == want


def test_run_writes_each_stage_and_leaves_one_table(spark, folder):
    before = scratch.mark()
    made = corpus_pipeline.run(spark, folder)
    assert made.count() > 40 and scratch.mark() == before + 1
    assert made.where("n_tokens <> size(ids)").count() == 0
    scratch.release(spark, since=before)


def test_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
