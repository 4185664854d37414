"""Data-quality engine.

A ``Check`` declares aggregate metrics over a frame (SQL aggregate text or
Columns) and SQL templates over those metrics for the pass rule, the actual
value text and the message (``{name}`` stands for metric ``name``).
``dq_report`` groups checks by the frame they read and compiles each group
into **one** aggregate: a table with twenty row-level checks is scanned once,
not twenty times.  All uniqueness checks of a table are one pass by grouping sets;
reference and reconciliation checks read a derived frame (joined key sets, one-row
counts) and form their own group.  The report is a lazy DataFrame with the 11-field record schema;
``dq_gate`` reduces it to one verdict row and ``enforce_gate`` raises on FAIL.

Schema and availability checks inspect metadata only (``df.schema``,
``spark.catalog``) and evaluate over a one-row frame.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Frames = Mapping[str, DataFrame]
REPORT_FIELDS = ("check_id", "check_name", "layer", "table_name", "check_type", "severity",
                 "actual_value", "expected_value", "status", "message", "checked_at")


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def txt(name: str) -> str:
    """Template piece: a metric as text (NULL shown as 'null')."""
    return f"coalesce(cast({{{name}}} as string), 'null')"


def concat(*parts: str) -> str:
    """SQL concat of template pieces; plain strings become literals unless they
    already are SQL (start with ``coalesce(`` / ``cast(``)."""
    return "concat(" + ", ".join(p if p.startswith(("coalesce(", "cast(")) else q(p)
                                  for p in parts) + ")"


def cnt(pred_sql: str) -> str:
    return f"count(CASE WHEN {pred_sql} THEN 1 END)"


@dataclass
class Check:
    check_id: str
    check_name: str
    table_name: str
    check_type: str
    severity: str
    metrics: dict[str, str | Column]
    passed: str          # SQL boolean template
    actual: str          # SQL string template
    expected: str        # plain text
    message: str         # SQL string template
    fail_status: str = "FAIL"
    layer: str = "silver"
    frame_key: str | None = None          # defaults to table_name
    frame: Callable[[Frames], DataFrame] | None = field(default=None, repr=False)
    unique: tuple[str, ...] | None = None  # the keys, of a uniqueness check


def _status_default(severity: str) -> str:
    return "FAIL" if severity == "CRITICAL" else "WARNING"


def _ident(col: str) -> str:
    return f"`{col}`"


# --------------------------------------------------------------------------- builders

def check_complete(cid, table, col, severity="CRITICAL", fail_status=None, layer="silver",
                   name=None) -> Check:
    """Null or blank values in ``col``."""
    c = _ident(col)
    return Check(cid, name or f"{col} completeness (null + blank)", table, "completeness", severity,
                 {"nulls": cnt(f"{c} IS NULL"), "blanks": cnt(f"trim(cast({c} as string)) = ''")},
                 "{nulls} + {blanks} = 0",
                 concat("nulls=", txt("nulls"), ", blanks=", txt("blanks")), "nulls=0, blanks=0",
                 concat(txt("nulls"), " null and ", txt("blanks"), f" blank values in {col}."),
                 fail_status or _status_default(severity), layer)


def check_unique(cid, table, keys: Sequence[str], severity="CRITICAL", fail_status="FAIL",
                 layer="silver", require_non_null=False, nulls_fail=False, name=None) -> Check:
    """Keys appearing more than once.  All uniqueness checks of a table are one
    grouped pass (``_unique_frame``).  With ``nulls_fail`` rows whose key has a null
    part fail the check too; with ``require_non_null`` they are left out."""
    keys = tuple(keys)
    any_null = " OR ".join(f"{_ident(k)} IS NULL" for k in keys)
    # _set is bound to the number of the check's grouping set when the report is compiled
    mine = "_gid = {_set}" + (f" AND NOT ({any_null})" if require_non_null else "")
    rule = "{dup_groups} = 0" + (" AND {null_rows} = 0" if nulls_fail else "")
    return Check(cid, name or f"{', '.join(keys)} uniqueness", table, "uniqueness", severity,
                 {"dup_groups": cnt(f"{mine} AND _n > 1"),
                  "extra_rows": f"coalesce(sum(CASE WHEN {mine} AND _n > 1 THEN _n - 1 END), 0)",
                  "null_rows": f"coalesce(sum(CASE WHEN {mine} AND ({any_null}) THEN _n END), 0)"},
                 rule, concat("duplicate_groups=", txt("dup_groups"), ", null_keys=", txt("null_rows")),
                 "duplicate_groups=0" + (", null_keys=0" if nulls_fail else ""),
                 concat(txt("dup_groups"), " duplicate key groups (", txt("extra_rows"),
                        f" extra rows) on {', '.join(keys)}; ", txt("null_rows"),
                        " rows with a null key."),
                 fail_status, layer, frame_key=f"{table}|unique", unique=keys)


def _unique_frame(df: DataFrame, sets: Sequence[tuple[str, ...]]) -> tuple[DataFrame, dict[tuple[str, ...], int]]:
    """Rows per key of every key list of ``sets`` in one shuffle, by grouping sets,
    and the grouping id of each list."""
    sets = list(dict.fromkeys(sets))
    cols = list(dict.fromkeys(k for keys in sets for k in keys))
    ids = {keys: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in keys) for keys in sets}
    if len(sets) == 1:
        return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"), F.lit(0).alias("_gid")), ids
    made = df.groupingSets([[F.col(c) for c in keys] for keys in sets], *[F.col(c) for c in cols])
    return made.agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_gid")), ids


def check_predicate(cid, table, name, violations: Mapping[str, str], severity="CRITICAL",
                    fail_status=None, check_type="validity", layer="silver") -> Check:
    """Each named SQL predicate marks violating rows; PASS when all counts are 0."""
    names = list(violations)
    total = " + ".join(f"{{{k}}}" for k in names)
    pieces = []
    for i, k in enumerate(names):
        pieces += ([", "] if i else []) + [f"{k}=", txt(k)]
    return Check(cid, name, table, check_type, severity,
                 {k: cnt(v) for k, v in violations.items()},
                 f"{total} = 0", concat(*pieces), ", ".join(f"{k}=0" for k in names),
                 concat(f"cast({total} as string)", " violating rows."),
                 fail_status or _status_default(severity), layer)


def check_range(cid, table, col, low=None, high=None, severity="CRITICAL", fail_status=None,
                layer="silver", name=None) -> Check:
    """Values outside [low, high]; nulls and zeros are only reported."""
    c = _ident(col)
    bad = " OR ".join(([f"{c} < {low}"] if low is not None else []) +
                      ([f"{c} > {high}"] if high is not None else [])) or "FALSE"
    bounds = f"[{'-inf' if low is None else low}, {'inf' if high is None else high}]"
    return Check(cid, name or f"{col} range {bounds}", table, "validity", severity,
                 {"out_of_range": cnt(bad), "nulls": cnt(f"{c} IS NULL"), "zeros": cnt(f"{c} = 0")},
                 "{out_of_range} = 0",
                 concat("out_of_range=", txt("out_of_range"), ", nulls=", txt("nulls"),
                        ", zeros=", txt("zeros")),
                 "out_of_range=0",
                 concat(txt("out_of_range"), f" values of {col} outside {bounds}."),
                 fail_status or _status_default(severity), layer)


def check_flag_rule(cid, table, flag, variance, threshold=5, guard: str = "TRUE",
                    severity="CRITICAL", fail_status="FAIL", layer="silver") -> Check:
    """Flag must equal ``variance > threshold`` on guarded rows (both directions)."""
    f, v = _ident(flag), f"coalesce({_ident(variance)} > {threshold}, FALSE)"
    return Check(cid, f"{flag} matches {variance} > {threshold}", table, "business_rule", severity,
                 {"flag_without_variance": cnt(f"({guard}) AND {f} AND NOT {v}"),
                  "variance_without_flag": cnt(f"({guard}) AND NOT {f} AND {v}")},
                 "{flag_without_variance} + {variance_without_flag} = 0",
                 concat("flag_without_variance=", txt("flag_without_variance"),
                        ", variance_without_flag=", txt("variance_without_flag")),
                 "flag_without_variance=0, variance_without_flag=0",
                 concat("cast({flag_without_variance} + {variance_without_flag} as string)",
                        " rows disagree with the rule."), fail_status, layer)


def check_count_equals(cid, table, name, flagged: str, recomputed: str, severity="WARNING",
                       fail_status="FAIL", layer="silver") -> Check:
    """Count of a stored flag equals the count of its recomputation."""
    return Check(cid, name, table, "business_rule", severity,
                 {"flagged": cnt(flagged), "recomputed": cnt(recomputed)},
                 "{flagged} = {recomputed}",
                 concat("flagged=", txt("flagged"), ", recomputed=", txt("recomputed")),
                 "flagged=recomputed",
                 concat(txt("flagged"), " flagged vs ", txt("recomputed"), " recomputed."),
                 fail_status, layer)


def check_reference(cid, fact, fk, master, pk, severity="WARNING", fail_status="WARNING",
                    layer="silver") -> Check:
    """Distinct fact keys missing from the master (distinct key sets joined)."""
    def frame(frames: Frames) -> DataFrame:
        keys = frames[fact].select(F.col(fk).alias("_k")).filter(F.col("_k").isNotNull()).distinct()
        ref = frames[master].select(F.col(pk).alias("_r")).distinct().withColumn("_hit", F.lit(True))
        return keys.join(ref, keys["_k"] == ref["_r"], "left")

    return Check(cid, f"{fact}.{fk} -> {master}.{pk}", fact, "referential_integrity", severity,
                 {"distinct_keys": "count(1)", "unmatched": cnt("_hit IS NULL")},
                 "{unmatched} = 0",
                 concat("unmatched=", txt("unmatched"), " of ", txt("distinct_keys")),
                 "unmatched=0",
                 concat(txt("unmatched"), f" distinct {fk} values (",
                        "cast(round({unmatched} * 100.0 / NULLIF({distinct_keys}, 0), 2) as string)",
                        "%) have no master row."),
                 fail_status, layer, frame_key=f"{fact}|ref|{fk}|{master}|{pk}", frame=frame)


def check_reconcile(cid, name, source, target, removed: Sequence = (), max_gap=None,
                    severity="WARNING", fail_status="WARNING", layer="silver") -> Check:
    """source rows = target rows + removed rows (+ an unexplained gap).
    Each side is a frame name (its row count) or ``(label, frame, SQL value)``
    (the sum of that value).  PASS when the gap is >= 0 (and <= ``max_gap``).
    All sides are summed in ONE aggregate over a tagged union (no joins)."""
    def norm(x):
        return (x, x, None) if isinstance(x, str) else x
    sides = [norm(x) for x in (source, target, *removed)]
    labels = [s[0] for s in sides]

    def frame(frames: Frames) -> DataFrame:
        from workpulse.operators.combine import tagged_union
        return tagged_union({
            label: frames[fname].select(
                (F.lit(1) if value is None else F.expr(value)).cast("long").alias("_v"))
            for label, fname, value in sides})

    return _balance(cid, name, labels, {lab: f"coalesce(sum(CASE WHEN _src = {q(lab)} THEN _v END), 0)"
                                        for lab in labels},
                    max_gap, severity, fail_status, layer, f"reconcile|{'|'.join(labels)}", frame)


def check_reconcile_counted(cid, name, source: str, target: str, removed: Sequence[str] = (), max_gap=None,
                            severity="WARNING", fail_status="WARNING", layer="silver",
                            counts="layer_counts") -> Check:
    """``check_reconcile`` over what the writes counted: each side is a ``metric``
    of the frame ``counts`` (metric, value), and no table is read."""
    labels = [source, target, *removed]
    names = {lab: re.sub(r"\W", "_", lab) for lab in labels}
    return _balance(cid, name, list(names.values()),
                    {n: f"coalesce(sum(CASE WHEN metric = {q(lab)} THEN value END), 0)" for lab, n in names.items()},
                    max_gap, severity, fail_status, layer, counts, lambda frames: frames[counts])


def _balance(cid, name, labels, metrics, max_gap, severity, fail_status, layer, frame_key, frame) -> Check:
    src, tgt, rem = labels[0], labels[1], labels[2:]
    gap = "({" + src + "} - {" + tgt + "}" + "".join(f" - {{{r}}}" for r in rem) + ")"
    rule = f"{gap} >= 0" + (f" AND {gap} <= {max_gap}" if max_gap is not None else "")
    pieces = [f"{src}=", txt(src), f", {tgt}=", txt(tgt)]
    for r in rem:
        pieces += [f", {r}=", txt(r)]
    pieces += [", unexplained_gap=", f"cast({gap} as string)"]
    return Check(cid, name, tgt, "reconciliation", severity, metrics, rule, concat(*pieces),
                 "unexplained_gap>=0" if max_gap is None else f"0<=unexplained_gap<={max_gap}",
                 concat("unexplained gap of ", f"cast({gap} as string)", " rows."),
                 fail_status, layer, frame_key=frame_key, frame=frame)


def check_counted(cid, name, metric: str, low=1, severity="CRITICAL", fail_status=None, layer="silver",
                  counts="layer_counts") -> Check:
    """A count that a write made is at least ``low`` (None: only reported)."""
    return Check(cid, name, metric, "volume", severity if low is not None else "INFO",
                 {"n": f"coalesce(sum(CASE WHEN metric = {q(metric)} THEN value END), 0)"},
                 "TRUE" if low is None else f"{{n}} >= {low}", txt("n"),
                 "informational" if low is None else f">={low}", concat(txt("n"), f" {metric}."),
                 "PASS" if low is None else fail_status or _status_default(severity), layer,
                 frame_key=counts, frame=lambda frames: frames[counts])


def check_grain(cid, table, name, keys: Sequence[str] = (), not_null: Sequence[str] = (),
                not_negative: Sequence[str] = (), layer="gold", severity="CRITICAL", fail_status="FAIL") -> Check:
    """A table has rows, one per key, none with a null in ``not_null`` or a value
    below zero in ``not_negative``: one grouped pass."""
    def frame(frames: Frames) -> DataFrame:
        df = frames[table]
        null, low = F.lit(False), F.lit(False)
        for c in not_null:
            null = null | F.col(c).isNull()
        for c in not_negative:
            low = low | F.coalesce(F.col(c) < 0, F.lit(False))
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count(F.when(null, 1)).alias("_null"),
                                     F.count(F.when(low, 1)).alias("_low"))

    metrics = {"rows": "coalesce(sum(_n), 0)", "nulls": "coalesce(sum(_null), 0)",
               "negative": "coalesce(sum(_low), 0)", "duplicates": cnt("_n > 1") if keys else "max(0)"}
    shown = ", ".join(["rows>0", "nulls=0", "negative=0", "duplicates=0"])
    return Check(cid, name, table, "completeness+validity+uniqueness", severity, metrics,
                 "{rows} > 0 AND {nulls} + {negative} + {duplicates} = 0",
                 concat("rows=", txt("rows"), ", nulls=", txt("nulls"), ", negative=", txt("negative"),
                        ", duplicates=", txt("duplicates")), shown,
                 concat(txt("rows"), " rows, ", txt("nulls"), " with nulls, ", txt("negative"), " negative, ",
                        txt("duplicates"), " keys repeated."),
                 fail_status, layer, frame_key=f"{table}|grain|{','.join(keys)}", frame=frame)


def check_non_empty(cid, table, layer="gold") -> Check:
    return Check(cid, f"{table} has rows", table, "volume", "CRITICAL", {"rows": "count(1)"},
                 "{rows} > 0", txt("rows"), ">0", concat(txt("rows"), " rows."), "FAIL", layer)


def check_info(cid, table, name, predicate_sql: str, layer="silver") -> Check:
    """Informational count of rows matching a predicate (always PASS)."""
    return Check(cid, name, table, "informational", "INFO", {"rows": cnt(predicate_sql)},
                 "TRUE", txt("rows"), "informational", concat(txt("rows"), f" rows: {name}."),
                 "PASS", layer)


def check_counts(cid_prefix, tables: Sequence[str], layer="silver") -> list[Check]:
    """Informational row counts (always PASS)."""
    return [Check(f"{cid_prefix}_{t}", f"{t} row count", t, "volume", "INFO", {"rows": "count(1)"},
                  "TRUE", txt("rows"), "informational", concat(txt("rows"), " rows."), "PASS", layer)
            for t in tables]


def _meta_check(cid, name, table, check_type, severity, ok: bool, actual: str, expected: str,
                message: str, fail_status="FAIL", layer="silver") -> Check:
    return Check(cid, name, table, check_type, severity, {"ok": "max(TRUE)" if ok else "max(FALSE)"},
                 "{ok}", q(actual), expected, q(message), fail_status, layer,
                 frame_key="__meta__", frame=lambda frames: frames["__meta__"])


def check_columns(cid, table, df: DataFrame, required: Sequence[str], layer="silver") -> Check:
    missing = [c for c in required if c not in df.columns]
    return _meta_check(cid, f"{table} required columns", table, "schema", "CRITICAL",
                       not missing, f"missing={missing}", "missing=[]",
                       f"{len(missing)} required columns missing.", layer=layer)


def check_types(cid_prefix, table, df: DataFrame, expected: Mapping[str, str], layer="silver"
                ) -> list[Check]:
    """One check per column: the type's simpleString contains the expected text."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = []
    for col, want in expected.items():
        got = types.get(col, "missing")
        out.append(_meta_check(f"{cid_prefix}_{col}", f"{table}.{col} type", table, "schema",
                               "CRITICAL", want in got, got, want,
                               f"{col} is {got}, expected {want}.", layer=layer))
    return out


def check_available(cid_prefix, spark: SparkSession, names: Sequence[str],
                    critical: Sequence[str] = (), exists: Callable[[str], bool] | None = None) -> list[Check]:
    """Existence of each table (in the catalog, or by ``exists``); a missing
    critical table fails, others warn."""
    out = []
    for n in names:
        ok = (exists or spark.catalog.tableExists)(n)
        crit = n in critical
        out.append(_meta_check(f"{cid_prefix}_{n.replace('.', '_')}", f"{n} available", n,
                               "availability", "CRITICAL" if crit else "WARNING", ok,
                               "exists" if ok else "missing", "exists",
                               f"table {n} {'exists' if ok else 'is missing'}.",
                               "FAIL" if crit else "WARNING", layer="catalog"))
    return out


# --------------------------------------------------------------------------- engine

_PLACEHOLDER = re.compile(r"\{([A-Za-z_][A-Za-z0-9_]*)\}")


def _bind(template: str, names: Mapping[str, str]) -> str:
    return _PLACEHOLDER.sub(lambda m: names[m.group(1)], template)


def dq_report(spark: SparkSession, frames: Frames, checks: Sequence[Check],
              checked_at: dt.datetime | None = None) -> DataFrame:
    """Compile the checks: one aggregate per distinct frame, then union."""
    if not checks:
        schema = ", ".join(f"{n} string" for n in REPORT_FIELDS[:-1]) + ", checked_at timestamp"
        return spark.createDataFrame([], schema)
    frames = dict(frames)
    frames.setdefault("__meta__", spark.range(1))
    ts = "current_timestamp()" if checked_at is None else \
        f"cast({q(checked_at.isoformat(sep=' '))} as timestamp)"
    groups: dict[str, list[tuple[int, Check]]] = {}
    for i, chk in enumerate(checks):
        groups.setdefault(chk.frame_key or chk.table_name, []).append((i, chk))
    parts = []
    for members in groups.values():
        first, sets = members[0][1], {}
        if first.unique is not None:
            base, sets = _unique_frame(frames[first.table_name], [chk.unique for _, chk in members])
        else:
            base = first.frame(frames) if first.frame is not None else frames[first.table_name]
        aggs, records = [], []
        for i, chk in members:
            names = {k: f"m{i}_{k}" for k in chk.metrics}
            for k, m in chk.metrics.items():
                if chk.unique is not None:
                    m = m.replace("{_set}", str(sets[chk.unique]))
                aggs.append((F.expr(m) if isinstance(m, str) else m).alias(names[k]))
            status = (f"CASE WHEN coalesce({_bind(chk.passed, names)}, FALSE) THEN 'PASS' "
                      f"ELSE {q(chk.fail_status)} END")
            fields = [q(chk.check_id), q(chk.check_name), q(chk.layer), q(chk.table_name),
                      q(chk.check_type), q(chk.severity),
                      f"cast({_bind(chk.actual, names)} as string)", q(chk.expected), status,
                      f"cast({_bind(chk.message, names)} as string)", ts]
            records.append("named_struct(" + ", ".join(
                f"{q(n)}, {v}" for n, v in zip(REPORT_FIELDS, fields)) + ")")
        parts.append(base.agg(*aggs).select(
            F.explode(F.expr("array(" + ", ".join(records) + ")")).alias("r")).select("r.*"))
    # every part has the same 11 record fields in the same order: a positional
    # union avoids re-resolving columns for each of the many parts
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def dq_summary(report: DataFrame) -> DataFrame:
    """Checks per status and severity."""
    return report.groupBy("status", "severity").agg(F.count(F.lit(1)).alias("checks"))


def dq_gate(report: DataFrame) -> DataFrame:
    """One row: FAIL if any check failed, PASS_WITH_WARNINGS if any warned, else PASS."""
    s = F.col("status")
    g = report.agg(F.count(F.lit(1)).alias("total_checks"),
                   F.count(F.when(s == "PASS", 1)).alias("passed"),
                   F.count(F.when(s == "WARNING", 1)).alias("warnings"),
                   F.count(F.when(s == "FAIL", 1)).alias("failed"))
    return g.withColumn("gate_status", F.when(F.col("failed") > 0, "FAIL")
                        .when(F.col("warnings") > 0, "PASS_WITH_WARNINGS").otherwise("PASS"))


def require(report: DataFrame) -> None:
    """Raise unless every check of ``report`` passed (one small action)."""
    failed = [r["check_id"] for r in report.filter(F.col("status") != "PASS")
              .select("check_id").collect()]
    if failed:
        raise RuntimeError(f"data-quality gate FAIL: {sorted(failed)}")


def enforce_gate(report: DataFrame, strict: bool = True) -> str:
    """Evaluate the gate (one small action); raise when ``strict`` and it is FAIL."""
    row = dq_gate(report).first()
    if strict and row["gate_status"] == "FAIL":
        failed = [r["check_id"] for r in report.filter(F.col("status") == "FAIL")
                  .select("check_id").collect()]
        raise RuntimeError(f"data-quality gate FAIL: {failed}")
    return row["gate_status"]
