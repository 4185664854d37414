"""Filter audit, MinHash near-duplicates and tokenizer alignment against brute
force, with nulls, empty and long texts, ties, repeated rows, empty tables and
extra columns whose names clash with the operators' own."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

import public_tokenizers
from workpulse.llm import alignment, filter_audit, minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = ("doc_id long, text string, source string, n long, mask long, cls binary, token long, sig array<int>, "
        "part string, digest string, rank int, pairs string, row long, copies int")
EXTRA = (1, 2, b"x", 3, [4], "p", "d", 5, "q", 6, 7)


def rows_of(pairs):
    return [(i, t, s, *EXTRA) for i, t, s in pairs]


def make_pairs():
    rng = random.Random(8)
    vocab = ["alpha", "Beta", "gamma", "über", "delta", "x", "of", "the", "and", "漢字", "row", "line"] + [
        f"w{k}" for k in range(300)]
    out = [(1, None, "a"), (2, "", None), (3, " \t\n", ""), (None, "no id here at all", "b"), (4, None, "b"),
           (None, "no id here at all", "b"), (5, "same text " * 30, "b"), (5, "same text " * 30, "b"),
           (6, "same text " * 30, "a"), (7, "one", "a"), (8, "ONE", "c"), (9, "two words", "c"),
           (10, "SHOUTING " * 60 + "#", "c"), (11, "w " * 20_000, "a"), (12, "<|endoftext|> <s> ▁", "a"),
           (13, "<|endoftext|> <s> <0x41> ﬁ  dbl é́", "a"), (7, "an id with two texts", "a")]
    base = [rng.choice(vocab) for _ in range(240)]
    for i in range(20, 60):  # copies of one text, some near, some not near enough
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 14])):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        out.append((i, " ".join(words), rng.choice(["a", "b", None])))
    for i in range(60, 90):
        out.append((i, "\n".join(" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 60))) for _ in range(3)),
                    rng.choice(["a", "c"])))
    return out


PAIRS = make_pairs()
LABELS = [(5, 1, 0), (6, 0, 1), (6, None, None), (20, 1, 1), (21, 1, 0), (None, 1, 1), (7, 1, 0), (999, 1, 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows_of(PAIRS), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


# ---- filter audit

def test_intervals_give_every_removal():
    for n in (1, 3, 5):
        step = {}
        for mask, s, low, high in filter_audit.removal_intervals(n):
            for rank in range(low, high):
                assert (mask, rank) not in step
                step[mask, rank] = s
        for rank, order in enumerate(permutations(range(n))):
            for mask in range(1, 1 << n):
                assert step.pop((mask, rank)) == 1 + next(k for k, f in enumerate(order) if mask >> f & 1)
        assert not step


def audit_by_hand(pairs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _ in pairs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    parts = defaultdict(list)
    for i, t, s in pairs:
        t = t or ""
        w = WORD.findall(t)
        f = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w),
             "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t)),
             "E": i is not None and i > first[t]}
        parts[s or ""].append(({k for k, v in f.items() if v}, i in good, i in toxic))
    out = set()
    for part, rows in parts.items():
        lines, shapley = [], Counter()
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                shapley[f] += len(gone)
                lines.append((f, ("".join(order), step, len(left), len(gone), sum(f in r[0] for r in rows) - len(gone),
                                  sum(r[0] == {f} for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone))))
        out |= {(part, *line, shapley[f]) for f, line in lines}
    return out


def test_audit_equals_running_every_order(spark, docs):
    labels = spark.createDataFrame([(*r, 1) for r in LABELS], "doc_id long, quality int, toxic int, mask int")
    made = filter_audit.audit(docs, labels)
    assert made.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                            "good_lost", "toxic_lost", "shapley"]
    rows = [tuple(r) for r in made.collect()]
    assert len(rows) == len(set(rows)) == 600 * 4
    assert set(rows) == audit_by_hand(PAIRS, LABELS)


def test_audit_without_rows_or_labels(spark, docs, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty, none).count() == 0
    assert {tuple(r) for r in filter_audit.audit(docs, none).collect()} == audit_by_hand(PAIRS, [])


# ---- MinHash

def near_by_hand(pairs, words_in=4, limit=80):
    sets = []
    for _, t, _ in pairs:
        w = WORD.findall(lower(t))
        k = min(words_in, len(w))
        sets.append({" ".join(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    boss = list(range(len(pairs)))

    def root(x):
        while boss[x] != x:
            x = boss[x]
        return x
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= limit * len(a | b):
                boss[root(i)] = root(j)
    low = {}
    for i, (doc, _, _) in enumerate(pairs):
        if doc is not None:
            low[root(i)] = min(doc, low.get(root(i), doc))
    return sorted(((doc, len(sets[i]), low.get(root(i))) for i, (doc, _, _) in enumerate(pairs)), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def test_minhash_equals_all_pairs(docs):
    assert found(minhash.near_duplicates(docs)) == near_by_hand(PAIRS)


def test_minhash_in_many_blocks(docs, monkeypatch):
    """Blocks of four classes: lists have a second round, with the same links."""
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 4)
    assert found(minhash.near_duplicates(docs)) == near_by_hand(PAIRS)


def test_minhash_hot_and_cold_keys(docs, monkeypatch):
    """No key by broadcast: the shuffle joins alone give the same."""
    monkeypatch.setattr(minhash, "HOT_SHARE", 1e-9)
    assert found(minhash.near_duplicates(docs)) == near_by_hand(PAIRS)


def test_minhash_empty_table(empty):
    assert minhash.near_duplicates(empty).count() == 0


def test_minhash_finds_pairs_at_the_limit():
    """Pairs of similarity 0.8 to 0.82 reach the matches; unlike sets don't."""
    rng = np.random.default_rng(3)
    hit, n = 0, 400
    for _ in range(n):
        both = rng.integers(0, 1 << 63, 160, dtype=np.uint64)
        own = rng.integers(0, 1 << 63, (2, 20), dtype=np.uint64)
        a, b = minhash.signatures([np.unique(np.r_[both, own[0]]), np.unique(np.r_[both, own[1]])])
        hit += (a == b).sum() >= minhash.MATCHES
    assert hit == n


# ---- alignment

def align_by_hand(pairs, a, b):
    """Per text: links by pair, and the contract's columns that need no counts."""
    ta, tb = a.tokens.to_pylist(), b.tokens.to_pylist()
    out = []
    for _, text, _ in pairs:
        true = b" " + (text or "").encode()
        ia = a.made.encode(" " + text, add_special_tokens=False).ids if text else []
        ib = b.made.encode(text) if text else []
        if not text or b"".join(ta[i] for i in ia) != true or b"".join(tb[i] for i in ib) != true:
            out.append((0, 0, 0, Counter(), ""))
            continue
        spans = []
        for ids, tokens in ((ia, ta), (ib, tb)):
            at, one = 0, []
            for i in ids:
                one.append((at, at + len(tokens[i]), i))
                at += len(tokens[i])
            spans.append(one)
        links, k = Counter(), 0
        for s, e, i in spans[0]:
            while spans[1][k][1] <= s:
                k += 1
            j = k
            while j < len(spans[1]) and spans[1][j][0] < e:
                links[i, spans[1][j][2]] += 1
                j += 1
        both = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, low = [], 0
        for high in both:
            groups.append("|".join(",".join(str(i) for _, e, i in side if low < e <= high) for side in spans))
            low = high
        out.append((len(ia), len(ib), len(both), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    docs = Counter(p for x in out for p in x[3])
    most = Counter()
    for (i, _), n in docs.items():
        most[i] = max(most[i], n)
    return sorted(((doc, *x[:3], sum(x[3].values()), sum(n for p, n in x[3].items() if docs[p] == most[p[0]]),
                    sum(n * docs[p] for p, n in x[3].items()), x[4]) for (doc, _, _), x in zip(pairs, out)), key=repr)


PATHS = [public_tokenizers.path(p) for p in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.mark.parametrize("hot", [alignment.HOT, 40, 0])
def test_alignment_equals_spans_by_hand(docs, hot):
    """All counts by broadcast, some, none."""
    small = [p for p in PAIRS if p[0] != 11]
    made = alignment.aligned(docs.where("doc_id IS NULL OR doc_id <> 11"), *PATHS, hot=hot)
    assert made.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = align_by_hand(small, *map(alignment.tokenizer, PATHS))
    assert sorted((tuple(r) for r in made.collect()), key=repr) == want
    assert sum(x[1] > 0 for x in want) > 60 and sum(x[1] == 0 for x in want) >= 4


def test_alignment_long_text_and_empty_table(docs, empty):
    assert alignment.aligned(empty, *PATHS).count() == 0
    row = alignment.aligned(docs.where("doc_id = 11"), *PATHS).first()
    assert row["n_groups"] > 19_000 and row["n_links"] >= row["n_groups"]


def test_special_tokens_are_text():
    a = alignment.tokenizer(PATHS[0])
    ids = alignment.Encoder(a).encode(["<|endoftext|> é\n"])[0]
    assert 50256 not in ids.to_pylist()[0]
    assert alignment.spelled(ids, a.tokens).to_pylist() == [" <|endoftext|> é\n".encode()]


def test_parts_encode_like_whole_texts():
    """Cutting texts into parts changes no id: whole documents, and random strings of
    spaces, other white space, marks, digits, letters of several scripts and signs."""
    rng = random.Random(12)
    signs = [" ", " ", " ", "  ", "\n", "\t", "\r", "\u00a0", "\u2003", "\u3000", "\u200b", "\u0085", "\x1c", "a", "the", "X",
             "é", "e\u0301", "\u0301", "ß", "漢", "字", "ا", "ी", "1", "42", "_", "-", "'s", "'", ".", "<0x41>", "▁", "ﬁ", "①",
             "🙂", "👩\u200d💻", "\ufeff", "\0", "<|endoftext|>", "<s>"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 30))) for _ in range(4000)]
    texts += [t for _, t, _ in PAIRS if t]
    a, b = map(alignment.tokenizer, PATHS)
    both = alignment.Encoder(a, b)
    for kept in (1 << 19, 500):  # parts known from before, and a table that overflows
        alignment.PARTS_KEPT = kept
        for at in range(0, len(texts), 700):
            some = texts[at:at + 700]
            got_a, got_b = (x.to_pylist() for x in both.encode(some))
            for text, x, y in zip(some, got_a, got_b):
                assert x == a.made.encode(" " + text, add_special_tokens=False).ids, repr(text)
                assert y == b.made.encode(text), repr(text)
    alignment.PARTS_KEPT = 1 << 19
