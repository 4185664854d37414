"""Shared runs of words against all pairs of 50-word windows, and passages inside lines."""

import random
from collections import defaultdict

import numpy as np
import pytest

from workpulse.llm import runs, substring

SCHEMA = "doc_id long, text string, dkey long, n int, id int, runs string, low int, w int"
EXTRA = (1, 2, 3, "r", 4, 5)


def corpus():
    rng = random.Random(21)
    vocab = [f"w{i}" for i in range(400)] + ["Über", "THE", "漢字"]
    words = lambda n: [rng.choice(vocab) for _ in range(n)]

    def text(ws):
        out = []
        for w in ws:  # line ends and spaces fall anywhere
            out += [w, rng.choice([" "] * 12 + ["\n", "  ", "\t", " \n"])]
        return "".join(out)

    shared = [words(n) for n in (49, 50, 51, 60, 120, 300)]
    rows = [(None, None), (1, ""), (2, " \n"), (3, "short text")]
    for k, passage in enumerate(shared):
        for copy in range(2 + k % 3):
            rows.append((10 + 10 * k + copy, text(words(rng.randint(0, 90)) + passage + words(rng.randint(0, 90)))))
    whole = words(80)
    rows += [(100, text(whole)), (101, text([w.upper() for w in whole])), (102, text(whole + ["end"]))]
    rows += [(110, text(words(60) * 3)), (111, text(words(200))), (111, text(words(210)))]       # alone
    rows += [(120, text(shared[3][:49] + words(40))), (None, text(words(30) + shared[4][10:70]))]
    twice = (130, text(words(20) + shared[5][100:200]))
    return rows + [twice, twice, (131, " ".join(words(30_000)))]


ROWS = corpus()


def brute(rows, m=50):
    """Words of each different row that lie in a window another different row holds."""
    rows = list(dict.fromkeys(rows))
    where = defaultdict(set)
    split = [(t or "").encode().lower().split() for _, t in rows]
    for i, w in enumerate(split):
        for s in range(len(w) - m + 1):
            where[tuple(w[s:s + m])].add(i)
    out = []
    for i, w in enumerate(split):
        hit = np.zeros(len(w), bool)
        for s in range(len(w) - m + 1):
            if len(where[tuple(w[s:s + m])]) > 1:
                hit[s:s + m] = True
        if hit.any():
            edge = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(int)))
            out.append((rows[i][0], [(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2])]))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *EXTRA) for r in ROWS], SCHEMA).repartition(3).cache()


def test_runs_equal_all_windows(docs):
    made = substring.passages(docs).where("size(runs) > 0").collect()
    got = sorted(((r.doc_id, [(x["first"], x["last"]) for x in r.runs]) for r in made), key=repr)
    assert got == brute(ROWS)
    assert {i for i, _ in got} >= {20, 21, 22, 30, 100, 101, 102, 130, None} and not {10, 11, 110, 111, 120} & {i for i, _ in got}
    by = {r.doc_id: r for r in made}
    assert by[20].n_run_words == 50 and by[130].n_run_words == 100
    later = [by[i].n_later_words for i in (20, 21, 22) if i in by]
    assert sorted(later)[0] == 0 and sum(x == 50 for x in later) == len(later) - 1  # one holds it first


def test_hot_and_cold_keys_give_the_same(docs, monkeypatch):
    want = sorted(map(repr, substring.repeated_passages(docs).collect()))
    monkeypatch.setattr(runs, "HOT_SHARE", 1e-9)
    monkeypatch.setattr(runs, "SENT_ROWS", 0)
    made = substring.passages(docs).where("size(runs) > 0").collect()
    assert sorted(((r.doc_id, [(x["first"], x["last"]) for x in r.runs]) for r in made), key=repr) == brute(ROWS)
    assert len(want) == substring.repeated_passages(docs).count()


def test_empty_table_and_text_ids(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert substring.passages(empty).count() == 0
    named = spark.createDataFrame([("a", ROWS[6][1]), ("b", ROWS[7][1]), ("c", "x")], "doc_id string, text string")
    assert {r.doc_id for r in substring.passages(named).collect()} == {"a", "b"}


def test_units_of_equal_runs_are_equal():
    rng = np.random.default_rng(2)
    missed = 0
    for _ in range(2000):
        run = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
        found = []
        for _ in range(2):
            around = [rng.integers(0, 1 << 63, int(rng.integers(0, 40)), dtype=np.uint64) for _ in range(2)]
            text = np.r_[around[0], run, around[1]]
            at = runs.cuts(text, 4)
            hashes = runs.Sums(text, 0).runs(at[:-1], at[1:]) if len(at) > 1 else []
            found.append({int(h) for h, x, y in zip(hashes, at, at[1:])
                          if x >= len(around[0]) and y <= len(around[0]) + 50})
        missed += not found[0] & found[1]
    assert missed <= 4
