"""Brute-force versions that several tests compare with."""

import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def brute_lines(rows, min_docs):
    """(doc_id, lines, dropped lines, kept text) of rows (doc_id, text, ...)."""
    strip = " \t\n\x0b\x0c\r"
    seen = Counter()
    for r in rows:  # rows are documents, equal ones too
        seen.update({lower(x.strip(strip)) for x in (r[1] or "").split("\n")} - {""})
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if seen[lower(x.strip(strip))] < min_docs]
        out.append((r[0], len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def fingerprint(text):
    """The SimHash of a text, one shingle after the other."""
    w = WORD.findall(lower(text))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if w else 0
