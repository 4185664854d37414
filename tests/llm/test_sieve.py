"""Bitmaps that rows are sifted by: nothing that is in them is lost."""

import random

import numpy as np
import pytest

from workpulse.llm import runs, sieve, substring


@pytest.mark.parametrize("most", [15, 16, 27])
def test_keys_stay_and_most_others_go(spark, most, monkeypatch):
    monkeypatch.setattr(sieve, "LEAST", 15)
    rng = np.random.default_rng(3)
    keys = rng.integers(-1 << 63, (1 << 63) - 1, 500).tolist() + [0, -1, (1 << 63) - 1, -1 << 63]
    others = rng.integers(-1 << 63, (1 << 63) - 1, 5000).tolist()
    frame = spark.createDataFrame([(k,) for k in keys * 2 + [None]], "k long")
    rows = spark.createDataFrame([(k, str(k)) for k in keys + others], "h long, name string").repartition(3)
    stay = sieve.sifted(rows, "h", sieve.sieve(frame, "k", most)).collect()
    assert {r.h for r in stay} >= set(keys) and len(stay) < len(keys) + 400
    assert all(r.name == str(r.h) for r in stay)
    assert sieve.sifted(rows, "h", sieve.sieve(frame.where("k > 0 AND k < 0"), "k", most)).count() == 0


def test_only_met_classes_get_sets(spark, tmp_path, monkeypatch):
    """Of 200 lines only the two near copies are read again and made into sets."""
    rng = random.Random(6)
    line = lambda: [f"w{rng.randrange(10 ** 6)}" for _ in range(60)]
    lines = [line() for _ in range(200)] + [line()]
    near = lines[-1][:30] + ["other"] + lines[-1][31:]
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(lines + [near])], "doc_id long, text string")
    sent = []
    whole = substring._class_sets
    monkeypatch.setattr(substring, "_class_sets", lambda *a: sent.append(whole(*a)) or sent[-1])
    made = substring.repeated_paragraphs(docs).where("repeated").collect()
    assert sorted(r.doc_id for r in made) == [200, 201] and [r.removed for r in sorted(made)] == [False, True]
    assert sent[0].count() <= 4


def test_texts_without_spots_do_not_travel(spark, monkeypatch):
    """Above the bound of the broadcast, the texts with spots only reach the join."""
    monkeypatch.setattr(runs, "SENT_ROWS", 0)
    went = []
    whole = runs.sifted
    monkeypatch.setattr(runs, "sifted", lambda rows, key, by: went.append((key, whole(rows, key, by))) or went[-1][1])
    rng = random.Random(8)
    words = lambda n: " ".join(f"v{rng.randrange(10 ** 6)}" for _ in range(n))
    same = words(70)
    rows = [(i, words(90)) for i in range(100)] + [(200, words(20) + "\n" + same), (201, same + " " + words(20))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    made = {r.doc_id: (r.runs, r.n_later_words) for r in substring.passages(docs).collect()}
    assert {k: [tuple(x) for x in v[0]] for k, v in made.items()} == {200: [(20, 89)], 201: [(0, 69)]}
    assert sorted(v[1] for v in made.values()) == [0, 70]
    assert [n.count() for key, n in went if key == "dkey"] == [2]


def test_joined_runs_by_hand(spark):
    rng = random.Random(12)
    rows = [(i, [(at, rng.random() < 0.5) for at in rng.sample(range(300), rng.randrange(1, 25))]) for i in range(80)]
    made = runs._joined_runs(spark.createDataFrame(rows, "id long, ats array<struct<at:int,later:boolean>>"), 10)
    got = {r.id: ([tuple(x) for x in r.runs], r.n_later) for r in made.collect()}
    for i, ats in rows:
        spans = []
        for at, _ in sorted(ats):
            if spans and at <= last + 10:  # noqa: F821
                spans[-1] = (spans[-1][0], at + 9)
            else:
                spans.append((at, at + 9))
            last = at  # noqa: F841
        assert got[i] == (spans, len({at + k for at, later in ats if later for k in range(10)}))
