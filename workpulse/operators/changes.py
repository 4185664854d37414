"""Keyed reads and batch change application (insert / partial update / delete).

``merge_changes`` applies a change set to a snapshot: the new snapshot plus the
rejected changes with a reason; every change is one or the other.  No join carries a hint: Spark broadcasts a small change set by the sizes
it measures and keeps a shuffle join for a large one.
A partial update only replaces the fields listed in ``set_fields``, so
"set to NULL" and "not set" stay distinct.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_PAGE = 1000


def lookup_many(df: DataFrame, key: str, keys: DataFrame, keys_col: str | None = None) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in the ``keys`` frame (left semi join)."""
    k = keys.select(F.col(keys_col or key).alias("_lookup_key")).distinct()
    return df.join(k, df[key] == k["_lookup_key"], "left_semi")


def lookup_page(df: DataFrame, order: Sequence[str], offset: int = 0, limit: int = 100,
                filters: Sequence[Column] = (), max_page: int = MAX_PAGE) -> DataFrame:
    """Filtered, totally ordered page.  The filters are plain predicates, so they
    reach the scan.  A limit over ``max_page`` raises ``ValueError``."""
    if int(limit) > max_page:
        raise ValueError(f"limit {limit} is over the page maximum of {max_page}")
    out = df
    for f in filters:
        out = out.filter(f)
    out = out.orderBy(*order)
    if offset:
        out = out.offset(int(offset))
    return out.limit(int(limit))


def recent(df: DataFrame, order_col: str, n: int, tie_break: Sequence[str] = ()) -> DataFrame:
    """Last ``n`` rows by ``order_col`` (per-partition top-n, then merged),
    returned in ascending order."""
    desc = [F.col(order_col).desc()] + [F.col(t).desc() for t in tie_break]
    return df.orderBy(*desc).limit(n).orderBy(order_col, *tie_break)


def date_window_filters(date_col: str, start=None, end=None) -> list[Column]:
    out = []
    if start is not None:
        out.append(F.col(date_col) >= F.lit(str(start)).cast("date"))
    if end is not None:
        out.append(F.col(date_col) <= F.lit(str(end)).cast("date"))
    return out


def merge_changes(base: DataFrame, changes: DataFrame, key: str, op_col: str = "op",
                  set_col: str = "set_fields") -> DataFrame:
    """``base`` merged with ``changes`` (``key``, ``op`` in I/U/D, ``set_fields`` array,
    new values under the base column names) as one frame with ``merge_side``: the
    rows of the new snapshot (``row``) and the rejected changes with
    ``reject_reason`` (``reject``).

    The changes are folded to one row a key before they are shuffled (a hot key is
    a count by then) and meet the base in one full outer join, so the base is read
    and shuffled once.  Changes of a key that is changed several times, or of no
    key, are rejected one by one and never meet the base.

    Rejections: ``null_key``, ``duplicate_change`` (several changes for one key in
    a batch), ``unknown_op`` (a null one included), ``unknown_field`` (an update
    naming a field that the base does not have), ``no_field`` (an update naming
    none), ``key_exists`` (insert of an existing key), ``key_not_found`` (update or
    delete of a missing key)."""
    cols = [c for c in base.columns if c != key]
    asked = F.struct(F.col(op_col).alias("op"), F.col(set_col).alias("fields"), *[F.col(c) for c in cols])
    folded = changes.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_ck")).agg(
        F.count(F.lit(1)).alias("_n"), F.first(asked).alias("_c"))
    held = base.withColumn("_held", F.lit(True))
    met = held.join(folded, F.col(key) == F.col("_ck"), "full")
    single, held_there = F.col("_n") == 1, F.col("_held").isNotNull()
    op, fields = F.col("_c.op"), F.coalesce("_c.fields", F.array().cast("array<string>"))
    known = F.array(*[F.lit(c) for c in cols]) if cols else F.array().cast("array<string>")
    reason = (F.when(~F.coalesce(op.isin("I", "U", "D"), F.lit(False)), "unknown_op")
              .when((op == "U") & (F.size(F.array_except(fields, known)) > 0), "unknown_field")
              .when((op == "U") & (F.size(fields) == 0), "no_field")
              .when((op == "I") & held_there, "key_exists")
              .when((op != "I") & ~held_there, "key_not_found"))
    met = met.withColumn("reject_reason", F.when(F.coalesce(single, F.lit(False)), reason))
    good = F.coalesce(single, F.lit(False)) & F.col("reject_reason").isNull()
    nothing = F.lit(None)

    def side(name: str, frame: DataFrame, k, values, ops, sets, why) -> DataFrame:
        types = dict(base.dtypes) | {op_col: "string", set_col: "array<string>"}
        return frame.select(
            F.lit(name).alias("merge_side"), k.alias(key), *[v.cast(types[c]).alias(c) for c, v in zip(cols, values)],
            ops.cast("string").alias(op_col), sets.cast("array<string>").alias(set_col), why.alias("reject_reason"))

    kept = met.where((held_there & ~(good & (op == "D"))) | (good & (op == "I")))
    new = [F.when(good & ((op == "I") | F.array_contains(fields, c)), F.col(f"_c.`{c}`")).otherwise(F.col(c))
           for c in cols]
    rows = side("row", kept, F.coalesce(key, "_ck"), new, nothing, nothing, nothing.cast("string"))
    refused = side("reject", met.where("reject_reason IS NOT NULL"), F.col("_ck"),
                   [F.col(f"_c.`{c}`") for c in cols], op, F.col("_c.fields"), F.col("reject_reason"))
    often = folded.where("_n > 1").select(F.col("_ck").alias("_rk"))
    apart = changes.join(often, F.col(key) == F.col("_rk"), "left").where(
        F.col(key).isNull() | F.col("_rk").isNotNull())
    one_by_one = side("reject", apart, F.col(key), [F.col(c) for c in cols], F.col(op_col), F.col(set_col),
                      F.when(F.col(key).isNull(), "null_key").otherwise("duplicate_change"))
    return rows.union(refused).union(one_by_one)


def apply_changes(base: DataFrame, changes: DataFrame, key: str, op_col: str = "op",
                  set_col: str = "set_fields") -> tuple[DataFrame, DataFrame]:
    """The two sides of ``merge_changes``: (snapshot, rejects), lazily.  For both at
    once write the merged frame partitioned by ``merge_side`` and read it back."""
    merged = merge_changes(base, changes, key, op_col, set_col)
    snapshot = merged.where("merge_side = 'row'").select(*base.columns)
    rejects = merged.where("merge_side = 'reject'").select(*changes.columns, "reject_reason")
    return snapshot, rejects


def lookup_after(df: DataFrame, order: Sequence[str], after: Sequence, limit: int = 100,
                 filters: Sequence[Column] = (), max_page: int = MAX_PAGE) -> DataFrame:
    """The page that follows the row with the values ``after`` in the total order of
    the columns ``order``: a filter that the scan can skip files and row groups by,
    where an offset would sort and count all earlier rows again."""
    if int(limit) > max_page:
        raise ValueError(f"limit {limit} is over the page maximum of {max_page}")
    out, beyond, equal = df, F.lit(False), F.lit(True)
    for f in filters:
        out = out.filter(f)
    for name, value in zip(order, after, strict=True):
        at = F.lit(value).cast(df.schema[name].dataType)
        beyond = beyond | (equal & (F.col(name) > at))
        equal = equal & (F.col(name) == at)
    first = F.lit(after[0]).cast(df.schema[order[0]].dataType)
    return out.where(F.col(order[0]) >= first).where(beyond).orderBy(*order).limit(int(limit))
