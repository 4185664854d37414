"""Silver-layer queries: quarantine, dedup, keys, pay codes, references and
profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from workpulse.functions import expr as X
from workpulse.operators import clean, codes, keys, profile, quarantine, refs
from workpulse.plans import bindings as B
from workpulse.plans.oracles import PCT, TIMESHEET_ID
from workpulse.plans.registry import register

KEY = list(keys.TIMESHEET_KEY)
KEY_SQL = ", ".join(KEY)
EXTRACT_COLS = ["client_employee_id", "department_id", "department_name", "pay_code",
                "hours_worked", "punch_apply_date", "punch_in_datetime", "punch_out_datetime",
                "scheduled_start_datetime", "scheduled_end_datetime", "_source_file",
                "_ingested_at", "_batch_id"]
REST = [c for c in EXTRACT_COLS if c not in KEY and c not in ("_source_file", "_ingested_at")]
ORDER_SQL = ", ".join(f"{c} ASC NULLS FIRST" for c in ["_source_file", "_ingested_at", *REST])

# ----------------------------------------------------------------------------- dedup and keys


@register("dedup_extracts", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, count(*) OVER (PARTITION BY {KEY_SQL}) AS source_duplicate_count,
    row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY {ORDER_SQL}) AS rn
  FROM b_extract) WHERE rn = 1""", doubles=("hours_worked",))
def dedup_extracts(spark, sf):
    """WN1/JN3: one row per natural key (null parts collapse), copies counted."""
    return keys.deduplicate(B.extract(spark, sf))


@register("dedup_extracts_keep_null_keys", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, count(*) OVER (PARTITION BY {KEY_SQL}) AS source_duplicate_count,
    row_number() OVER (PARTITION BY {KEY_SQL} ORDER BY {ORDER_SQL}) AS rn
  FROM b_extract WHERE {' AND '.join(f'{k} IS NOT NULL' for k in KEY)}) WHERE rn = 1
UNION ALL
SELECT *, 1 AS source_duplicate_count FROM b_extract
WHERE {' OR '.join(f'{k} IS NULL' for k in KEY)}""", doubles=("hours_worked",))
def dedup_extracts_keep_null_keys(spark, sf):
    """Dedup with ``null_key_policy='keep'``: rows with a null key part pass."""
    return keys.deduplicate(B.extract(spark, sf), null_key_policy="keep")


LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINE_REST = ", ".join(f"{c} ASC NULLS FIRST" for c in LINE_COLS[2:3] + LINE_COLS[1:2] + LINE_COLS[4:])


@register("dedup_lineitem", f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS source_duplicate_count,
    row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_REST}) AS rn
  FROM lineitem) WHERE rn = 1""")
def dedup_lineitem(spark, sf):
    """Dedup of a driver table on (l_orderkey, l_linenumber); winner by the other columns."""
    li = B.table(spark, sf, "lineitem")
    return keys.deduplicate(li, keys=["l_orderkey", "l_linenumber"], order=["l_suppkey", "l_partkey"])


@register("duplicate_stats", f"""
SELECT count(*) AS duplicate_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_in_duplicate_groups,
  CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS extra_copies
FROM (SELECT count(*) AS n FROM b_extract GROUP BY {KEY_SQL} HAVING count(*) > 1)""")
def duplicate_stats(spark, sf):
    """AG8: duplicate groups, rows in them, extra copies."""
    return keys.duplicate_stats(B.extract(spark, sf), KEY)


@register("duplicate_conflicts", f"""
SELECT {KEY_SQL}, count(DISTINCT pay_code) AS pay_code_variants,
  count(DISTINCT hours_worked) AS hours_worked_variants
FROM b_extract WHERE {' AND '.join(f'{k} IS NOT NULL' for k in KEY)}
GROUP BY {KEY_SQL} HAVING count(DISTINCT pay_code) > 1 OR count(DISTINCT hours_worked) > 1""")
def duplicate_conflicts(spark, sf):
    """AG9: same natural key, different payload."""
    return keys.duplicate_conflicts(B.extract(spark, sf), KEY, ["pay_code", "hours_worked"])


@register("surrogate_key", f"SELECT {KEY_SQL}, {TIMESHEET_ID} AS timesheet_id FROM b_punch")
def surrogate_key(spark, sf):
    """PRJ25: sha256 of the natural key's JSON text."""
    return keys.with_surrogate_key(B.punch(spark, sf)).select(*KEY, "timesheet_id")


# ----------------------------------------------------------------------------- quarantine

RAW_COLS = ["client_employee_id", "department_id", "department_name", "pay_code", "hours_worked",
            "punch_apply_date", "punch_in_datetime", "punch_out_datetime",
            "scheduled_start_datetime", "scheduled_end_datetime", "_source_file"]
KW = " OR ".join(f"contains(lower(client_employee_id), '{k}')" for k in clean.INVALID_ID_KEYWORDS)
REASON_SQL = f"""
CASE WHEN client_employee_id IS NULL OR trim(client_employee_id) = '' OR contains(client_employee_id, ' ')
       OR {KW} THEN 'invalid_employee_id'
     WHEN NULLIF(trim(pay_code), '') IS NULL THEN 'missing_pay_code'
     WHEN hours_worked IS NOT NULL AND TRY_CAST(hours_worked AS DECIMAL(10,2)) IS NULL THEN 'malformed_hours_worked'
     WHEN hours_worked IS NULL THEN 'missing_hours_worked'
     WHEN TRY_CAST(punch_apply_date AS DATE) IS NULL THEN 'invalid_punch_apply_date'
END"""


def _reasons():
    return {
        "invalid_employee_id": X.invalid_identifier("client_employee_id", clean.INVALID_ID_KEYWORDS),
        "missing_pay_code": X.blank_to_null("pay_code").isNull(),
        "malformed_hours_worked": X.malformed_numeric("hours_worked"),
        "missing_hours_worked": F.col("hours_worked").isNull(),
        "invalid_punch_apply_date": F.try_to_date("punch_apply_date", "yyyy-MM-dd").isNull(),
    }


def _split(spark, sf):
    raw = B.raw_extract(spark, sf)
    return quarantine.split_quarantine(raw, _reasons(),
                                       checked_at=F.lit(B.INGEST_A).cast("timestamp"))


@register("quarantine_good", f"""
SELECT client_employee_id, department_id, department_name, trim(pay_code) AS pay_code,
  CAST(hours_worked AS DECIMAL(10,2)) AS hours_worked, CAST(punch_apply_date AS DATE) AS punch_apply_date,
  TRY_CAST(punch_in_datetime AS TIMESTAMP) AS punch_in_datetime,
  TRY_CAST(punch_out_datetime AS TIMESTAMP) AS punch_out_datetime,
  TRY_CAST(scheduled_start_datetime AS TIMESTAMP) AS scheduled_start_datetime,
  TRY_CAST(scheduled_end_datetime AS TIMESTAMP) AS scheduled_end_datetime, _source_file,
  _ingested_at, _batch_id
FROM b_raw WHERE ({REASON_SQL}) IS NULL""", doubles=("hours_worked",))
def quarantine_good(spark, sf):
    """FLT3/FLT4/PRJ6/PRJ9: clean rows, typed (tolerant casts)."""
    good, _ = _split(spark, sf)
    good = clean.blank_to_null(good, ["pay_code"])
    good = clean.cast_dates(good, ["punch_apply_date"])
    good = clean.cast_timestamps(good, ["punch_in_datetime", "punch_out_datetime",
                                        "scheduled_start_datetime", "scheduled_end_datetime"])
    return clean.cast_columns(good, {"hours_worked": "decimal(10,2)"}, strict=False)


@register("quarantine_bad", f"""
SELECT *, {REASON_SQL} AS dq_reason, TIMESTAMP '2024-02-01 00:00:00' AS dq_checked_at
FROM b_raw WHERE ({REASON_SQL}) IS NOT NULL""")
def quarantine_bad(spark, sf):
    """FLT4/FLT5: quarantined rows with the first failing reason."""
    return _split(spark, sf)[1]


@register("malformed_numeric", """
SELECT count(*) FILTER (WHERE hours_worked IS NOT NULL AND TRY_CAST(hours_worked AS DECIMAL(10,2)) IS NULL)
  AS malformed_hours_worked,
  count(*) FILTER (WHERE TRY_CAST(hours_worked AS DECIMAL(10,2)) < 0) AS negative_hours_worked
FROM b_raw""")
def malformed_numeric(spark, sf):
    """FLT1/PRJ9: unparseable numeric text."""
    raw = B.raw_extract(spark, sf)
    return raw.agg(
        F.count(F.when(X.malformed_numeric("hours_worked"), 1)).alias("malformed_hours_worked"),
        F.count(F.when(F.col("hours_worked").try_cast("decimal(10,2)") < 0, 1)
                ).alias("negative_hours_worked"))


@register("invalid_identifier", f"""
SELECT client_employee_id, count(*) AS row_count FROM b_raw
WHERE client_employee_id IS NULL OR trim(client_employee_id) = '' OR contains(client_employee_id, ' ') OR {KW}
GROUP BY client_employee_id""")
def invalid_identifier(spark, sf):
    """FLT2: invalid employee identifiers and their row counts."""
    raw = B.raw_extract(spark, sf)
    bad = raw.filter(X.invalid_identifier("client_employee_id", clean.INVALID_ID_KEYWORDS))
    return bad.groupBy("client_employee_id").agg(F.count(F.lit(1)).alias("row_count"))


@register("identifier_formats", """
SELECT count(*) FILTER (WHERE regexp_matches(client_employee_id, '^[0-9]+$')) AS numeric_ids,
  count(*) FILTER (WHERE NOT regexp_matches(client_employee_id, '^[0-9]+$')) AS non_numeric_ids,
  count(*) FILTER (WHERE contains(pay_code, '|')) AS packed_pay_codes,
  count(*) FILTER (WHERE pay_code LIKE '%|%' AND NOT regexp_matches(client_employee_id, '^[0-9]+$'))
    AS packed_with_bad_id
FROM b_raw""")
def identifier_formats(spark, sf):
    """FLT6: numeric-id regex, contains '|', LIKE '%|%'."""
    raw = B.raw_extract(spark, sf)
    num = X.numeric_identifier("client_employee_id")
    return raw.agg(F.count(F.when(num, 1)).alias("numeric_ids"),
                   F.count(F.when(~num, 1)).alias("non_numeric_ids"),
                   F.count(F.when(F.col("pay_code").contains("|"), 1)).alias("packed_pay_codes"),
                   F.count(F.when(F.col("pay_code").like("%|%") & ~num, 1)).alias("packed_with_bad_id"))


@register("normalise_numeric_text", """
SELECT hours_worked_text, count(*) AS row_count FROM (
  SELECT CAST(TRY_CAST(hours_worked AS DECIMAL(10,2)) AS VARCHAR) AS hours_worked_text FROM b_raw)
GROUP BY 1""")
def normalise_numeric_text(spark, sf):
    """PRJ9 bronze rule: numeric text kept as text, unparseable -> NULL."""
    raw = clean.normalise_numeric_text(B.raw_extract(spark, sf), ["hours_worked"])
    return raw.groupBy(F.col("hours_worked").alias("hours_worked_text")).agg(
        F.count(F.lit(1)).alias("row_count"))


# ----------------------------------------------------------------------------- pay codes

@register("packed_count", """
SELECT client_employee_id, punch_apply_date, punch_in_datetime, punch_out_datetime, pay_code,
  pay_code_count, has_multiple_pay_codes FROM t_silver""")
def packed_count(spark, sf):
    """PRJ24: codes per punch and a multi-code flag."""
    return codes.with_packed_count(B.punch(spark, sf)).select(
        *KEY, "pay_code", "pay_code_count", "has_multiple_pay_codes")


BRIDGE_SQL = """
SELECT timesheet_id, client_employee_id, CAST(r.i - 1 AS INTEGER) AS pay_code_position,
  trim(string_split(pay_code, '|')[r.i]) AS pay_code
FROM t_silver, range(1, len(string_split(pay_code, '|')) + 1) AS r(i)"""


def _bridge(spark, sf):
    t = keys.with_surrogate_key(B.punch(spark, sf))
    return codes.explode_codes(t)


@register("code_bridge", BRIDGE_SQL)
def code_bridge(spark, sf):
    """GLD11: punch x atomic pay code bridge."""
    return _bridge(spark, sf)


@register("code_dimension", f"""
SELECT pay_code, sha256(pay_code) AS pay_code_id,
  regexp_matches(pay_code, '{codes.OVERTIME_PATTERN}') AS is_overtime_pay_code,
  regexp_matches(pay_code, '{codes.LEAVE_PATTERN}') AS is_leave_pay_code
FROM (SELECT DISTINCT pay_code FROM ({BRIDGE_SQL}))""")
def code_dimension(spark, sf):
    """GLD12/PRJ26: distinct codes, sha256 id, overtime/leave flags."""
    return codes.code_dimension(_bridge(spark, sf))


@register("code_flags", """
SELECT client_employee_id, punch_apply_date, punch_in_datetime, punch_out_datetime, pay_code,
  has_overtime_pay_code, has_leave_pay_code FROM t_silver""")
def code_flags(spark, sf):
    """AG10/JN5: per-punch flags evaluated on the split codes (no shuffle)."""
    return codes.with_code_flags(B.punch(spark, sf)).select(
        *KEY, "pay_code", "has_overtime_pay_code", "has_leave_pay_code")


@register("code_flags_rollup", f"""
SELECT b.timesheet_id,
  bool_or(regexp_matches(b.pay_code, '{codes.OVERTIME_PATTERN}')) AS has_overtime_pay_code,
  bool_or(regexp_matches(b.pay_code, '{codes.LEAVE_PATTERN}')) AS has_leave_pay_code
FROM ({BRIDGE_SQL}) b GROUP BY b.timesheet_id""")
def code_flags_rollup(spark, sf):
    """JN4/AG10: star-model roll-up (bridge x dimension, bool_or per punch)."""
    bridge = _bridge(spark, sf)
    return codes.rollup_code_flags(bridge, codes.code_dimension(bridge))


# ----------------------------------------------------------------------------- references

@register("reference_flag", """
SELECT client_employee_id, punch_apply_date, punch_in_datetime, punch_out_datetime,
  employee_master_match FROM t_silver""")
def reference_flag(spark, sf):
    """JN6: total existence flag of the punch's employee in the master."""
    return refs.with_reference_flag(B.punch(spark, sf), "client_employee_id",
                                    B.master_ids(spark, sf), "client_employee_id",
                                    "employee_master_match").select(*KEY, "employee_master_match")


@register("orphans", """
SELECT DISTINCT client_employee_id FROM b_punch
WHERE client_employee_id IS NOT NULL
  AND client_employee_id NOT IN (SELECT client_employee_id FROM e_ids)""")
def orphans(spark, sf):
    """JN2/JN7: distinct punch employee ids missing from the master."""
    return refs.orphans(B.punch(spark, sf), "client_employee_id", B.master_ids(spark, sf),
                        "client_employee_id")


@register("orphan_rate", f"""
SELECT distinct_keys, unmatched_keys, {PCT("unmatched_keys", "distinct_keys")} AS unmatched_pct FROM (
  SELECT count(*) AS distinct_keys,
    count(*) FILTER (WHERE client_employee_id NOT IN (SELECT client_employee_id FROM e_ids)) AS unmatched_keys
  FROM (SELECT DISTINCT client_employee_id FROM b_punch WHERE client_employee_id IS NOT NULL))""")
def orphan_rate(spark, sf):
    """DQ007 shape: distinct fact keys, unmatched, percentage."""
    return refs.orphan_rate(B.punch(spark, sf), "client_employee_id", B.master_ids(spark, sf),
                            "client_employee_id")


@register("bridge_orphans", f"""
SELECT count(*) AS punches_without_bridge_rows FROM t_silver
WHERE timesheet_id NOT IN (SELECT timesheet_id FROM ({BRIDGE_SQL}))""")
def bridge_orphans(spark, sf):
    """JN7: bridge completeness (punches without any bridge row)."""
    t = keys.with_surrogate_key(B.punch(spark, sf))
    bridge = codes.explode_codes(t).select("timesheet_id").distinct()
    return t.join(bridge, "timesheet_id", "left_anti").agg(
        F.count(F.lit(1)).alias("punches_without_bridge_rows"))


# ----------------------------------------------------------------------------- profiling

@register("profile_sources", f"""
SELECT _source_file, count(*) AS row_count, min(punch_apply_date) AS min_date,
  max(punch_apply_date) AS max_date, count(DISTINCT client_employee_id) AS distinct_ids,
  min(_ingested_at) AS first_ingested_at, max(_ingested_at) AS last_ingested_at
FROM b_extract GROUP BY _source_file""")
def profile_sources(spark, sf):
    """AG1: per source file profile."""
    return profile.profile_sources(B.extract(spark, sf))


@register("reconcile_sources", """
SELECT count(*) AS source_count, CAST(sum(n) AS BIGINT) AS sum_of_sources,
  (SELECT count(*) FROM b_extract) AS table_rows,
  (SELECT count(*) FROM b_extract) - CAST(sum(n) AS BIGINT) AS difference
FROM (SELECT _source_file, count(*) AS n FROM b_extract GROUP BY 1)""")
def reconcile_sources(spark, sf):
    """AG2: sum of per-source counts equals the table count."""
    return profile.reconcile_sources(B.extract(spark, sf))


@register("profile_nulls", f"""
SELECT count(*) AS row_count,
  {', '.join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in EXTRACT_COLS)}
FROM b_extract""")
def profile_nulls(spark, sf):
    """AG3: null count per column in one pass."""
    return profile.profile_nulls(B.extract(spark, sf))


@register("profile_ranges", """
SELECT min(punch_apply_date) AS min_punch_apply_date, max(punch_apply_date) AS max_punch_apply_date,
  min(punch_in_datetime) AS min_punch_in_datetime, max(punch_in_datetime) AS max_punch_in_datetime,
  min(punch_out_datetime) AS min_punch_out_datetime, max(punch_out_datetime) AS max_punch_out_datetime,
  min(scheduled_start_datetime) AS min_scheduled_start_datetime,
  max(scheduled_start_datetime) AS max_scheduled_start_datetime,
  min(scheduled_end_datetime) AS min_scheduled_end_datetime,
  max(scheduled_end_datetime) AS max_scheduled_end_datetime,
  min(_ingested_at) AS min__ingested_at, max(_ingested_at) AS max__ingested_at
FROM b_extract""")
def profile_ranges(spark, sf):
    """AG4: min/max of every date and timestamp column."""
    return profile.profile_ranges(B.extract(spark, sf))


@register("profile_keys", """
SELECT count(*) AS total_rows, count(client_employee_id) AS populated,
  count(DISTINCT client_employee_id) AS distinct_keys,
  count(client_employee_id) - count(DISTINCT client_employee_id) AS duplicate_rows
FROM b_extract""")
def profile_keys(spark, sf):
    """AG5: populated vs distinct keys."""
    return profile.profile_keys(B.extract(spark, sf), "client_employee_id")


@register("value_distribution", """
SELECT pay_code, count(*) AS row_count FROM b_extract GROUP BY pay_code""")
def value_distribution(spark, sf):
    """AG6: value distribution of a column."""
    return profile.value_distribution(B.extract(spark, sf), "pay_code")


@register("reconcile_totals", """
SELECT CAST(count(*) AS BIGINT) AS aggregated_total, count(*) AS source_total, TRUE AS matches
FROM t_silver""")
def reconcile_totals(spark, sf):
    """AG18: per-employee counts add up to the source rows."""
    from workpulse.operators import hours
    ts = B.timesheet(spark, sf)
    return profile.reconcile_totals(hours.attendance_metrics(ts), "total_work_days", ts)
