"""Secret scans: fixed patterns, and character Markov models of random strings.

Three patterns give base spans.  Long tokens that no base span touches are judged
by two first-order character models, of random strings and of ordinary
identifiers, by their log-likelihood ratio.  The models are trained on labelled
samples from the whole table: the values inside base spans are random strings,
the long tokens outside of which at most a quarter are digits are ordinary
identifiers (the others may be secrets that no base pattern knows).  Those that the
first model holds for random strings are then left out, and it is trained anew.

All of it is DataFrame functions: match places come from running sums of the
lengths of matches and of the pieces between them, training is one grouped count of
character pairs (an alphabet of 42 symbols bounds the model), scoring is a lookup in
the model's array.  Texts are read once; what is found is stored without them.

Defined cases: a null text is an empty one; a text without matches has no spans;
rows are judged on their own, so ties, repeated rows and null ids need no rule;
without any labelled sample of either kind nothing is added; only the two named
columns are read.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workpulse.llm.scratch import stored

#: The kinds of spans in their order, and the base patterns.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
#: A token of the models, from where its run of characters begins; ``secrets`` says from which length.
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
MIN_TOKEN = 16
#: Symbols of the models: letters without case, digits, the other token characters; 0 is the start.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SYMBOLS = len(ALPHABET) + 1

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, also where a lambda asks for it
    again and again."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _blocks(items: Column) -> Column:
    """The bound array ``items`` in runs of the square root of its size."""
    def cut(width: Column) -> Column:
        last = F.greatest(F.ceil(F.size(items) / width).cast("int") - 1, F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(items, k * width + 1, width))

    return let(F.ceil(F.sqrt(F.greatest(F.size(items), F.lit(1)))).cast("int"), cut)


def running(items: Column) -> Column:
    """The sums of an array of ints up to each of its items.  SQL's array functions
    add an element by copying the array, so the sums are made in blocks of the
    square root of its size, each from zero, and moved to where the block begins."""
    empty = F.array().cast("array<int>")

    def sums(block: Column) -> Column:
        first = F.struct(F.lit(0).alias("at"), empty.alias("out"))
        return F.aggregate(block, first, lambda acc, x: F.struct(
            (acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x)).alias("out")),
            lambda acc: acc["out"])

    def moved(made: Column) -> Column:
        totals = sums(F.transform(made, lambda b: F.coalesce(F.element_at(b, -1), F.lit(0))))
        return F.flatten(F.transform(F.arrays_zip(made.alias("sums"), totals.alias("upto")), lambda z: F.transform(
            z["sums"], lambda s: s + z["upto"] - F.element_at(z["sums"], -1))))

    return let(items, lambda it: F.when(F.size(it) > 0, let(F.transform(_blocks(it), sums), moved)).otherwise(empty))


def _spans(text: Column, pattern: str, kind: int, when: Column, valued: int | None = None) -> Column:
    """Array of (start, kind, end, value) of all matches in ``text`` for which ``when`` holds;
    ``valued`` is the group whose text is the value.  The text is scanned for the
    matches and for the pieces between them."""
    empty = F.array().cast("array<string>")

    def placed(hits: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
        sizes = F.transform(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")),
                            lambda m: F.length(m["gap"]) + F.length(m["hit"]))
        return F.transform(F.arrays_zip(running(sizes).alias("end"), hits.alias("hit")), lambda m: F.struct(
            (m["end"] - F.length(m["hit"])).alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"),
            (m["hit"] if valued is None else F.regexp_extract(m["hit"], pattern, valued)).alias("value")))

    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    return F.when(when, let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(none)


def found_spans(docs: DataFrame, min_token: int = MIN_TOKEN) -> DataFrame:
    """doc_id, base (spans with values) and tokens (long tokens that no base span touches)."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    text, token = F.col("text"), TOKEN % min_token
    assign = F.filter(_spans(text, ASSIGN, 0, text.rlike(ASSIGN), 2), lambda s: F.length(s["value"]) >= 12)
    access = F.filter(_spans(text, ACCESS, 1, text.contains("AKIA")), lambda s: F.length(s["value"]) >= 18)
    hexes = _spans(text, HEX, 2, text.rlike(HEX))
    tokens = _spans(text, token, 3, text.rlike(token))

    def apart(base: Column) -> Column:
        # Base spans in blocks with their bounds: a token looks into those it touches only.
        blocks = F.transform(_blocks(base), lambda s: F.struct(
            F.element_at(s, 1)["start"].alias("low"), F.array_max(F.transform(s, lambda b: b["end"])).alias("high"),
            s.alias("spans")))
        free = let(blocks, lambda ks: F.filter(tokens, lambda t: ~F.exists(ks, lambda k: (k["low"] < t["end"]) & (
            t["start"] < k["high"]) & F.exists(k["spans"], lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))))
        return F.struct(base.alias("base"), F.when(F.size(base) == 0, tokens).otherwise(free).alias("tokens"))

    made = rows.select("doc_id", let(F.sort_array(F.concat(assign, access, hexes)), apart).alias("f"))
    return made.select("doc_id", "f.base", "f.tokens")


def _symbols(token: Column) -> Column:
    """The token's characters as places in the alphabet, after a 0 for the start."""
    chars = F.split(F.translate(token, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ALPHABET[:26]), "")
    return F.concat(F.array(F.lit(0)), F.transform(
        F.filter(chars, lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c)))


def train(found: DataFrame, smoothing: float = 0.5, backoff: float = 5.0, earlier: list[float] | None = None,
          doubtful: float = 0.0) -> list[float] | None:
    """The log ratio of both models' transition probabilities, at place
    previous * SYMBOLS + next; None where either kind has no sample.  With an
    ``earlier`` model, tokens whose ratio it puts above ``doubtful`` are no samples of
    ordinary identifiers."""
    value = F.regexp_replace(F.col("s.value"), "[^A-Za-z0-9+/_=-]", "")
    samples = found.select(F.explode(F.concat("base", "tokens")).alias("s")).select(
        (F.col("s.kind") < 3).cast("int").alias("random"), value.alias("token"))
    digits = F.length("token") - F.length(F.translate("token", "0123456789", ""))
    samples = samples.where((F.col("random") == 1) | (digits * 4 <= F.length("token")))
    # Equal samples of a task are put together before their characters are counted.
    seen = samples.where("token <> ''").groupBy("random", "token").count()
    if earlier is not None:
        seen = seen.where((F.col("random") == 1) | (likelihood_ratio(F.col("token"), earlier) <= doubtful))
    signs = _symbols(F.col("token"))
    pairs = seen.select("random", "count", F.explode(F.arrays_zip(
        F.slice(signs, 1, F.length("token")).alias("a"),
        F.slice(signs, 2, F.length("token")).alias("b"))).alias("p"))
    counts = pairs.groupBy("random", "p.a", "p.b").agg(F.sum("count").alias("n")).collect()  # <= 2 * 42 * 42 rows
    n = [[0.0] * (SYMBOLS * SYMBOLS) for _ in range(2)]
    for r in counts:
        n[r["random"]][r["a"] * SYMBOLS + r["b"]] = float(r["n"])
    if not all(map(sum, n)):
        return None
    # What follows a symbol backs off to how often each symbol occurs at all.
    often = [[sum(x[b::SYMBOLS]) + smoothing for b in range(SYMBOLS)] for x in n]
    out = []
    for a in range(SYMBOLS):
        logs = []
        for x, o in zip(n, often):
            row, whole = x[a * SYMBOLS:(a + 1) * SYMBOLS], sum(o)
            logs.append([log((row[b] + backoff * o[b] / whole) / (sum(row) + backoff)) for b in range(SYMBOLS)])
        out += [r - i for i, r in zip(*logs)]
    return out


def likelihood_ratio(token: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of random string against ordinary identifier, per character."""
    table = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")  # folded into a constant
    first = F.struct(F.lit(0).alias("a"), F.lit(0.0).alias("sum"))

    def step(acc, b):
        return F.struct(b.alias("a"), (acc["sum"] + F.element_at(table, acc["a"] * SYMBOLS + b + 1)).alias("sum"))

    signs = _symbols(token)
    return F.aggregate(F.slice(signs, 2, F.length(token)), first, step, lambda acc: acc["sum"]) / F.length(token)


def secrets(docs: DataFrame, min_ratio: float = 0.5, min_token: int = MIN_TOKEN) -> DataFrame:
    """doc_id, base and added: arrays of (start, kind, end) sorted by start and
    kind.  A token of at least ``min_token`` characters is added where its
    log-likelihood ratio is at least ``min_ratio`` per character."""
    found = stored(found_spans(docs, min_token), "spans")
    model = train(found)
    if model is not None:  # the secrets among the ordinary samples go, and the model is trained anew
        model = train(found, earlier=model) or model
    added = F.array().cast(_SPAN)
    if model is not None:
        added = F.filter("tokens", lambda t: likelihood_ratio(t["value"], model) >= min_ratio)
    bare = lambda spans: F.sort_array(F.transform(
        spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return found.select("doc_id", bare(F.col("base")).alias("base"),
                        (bare(added) if model is not None else added).alias("added"))


def span_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
