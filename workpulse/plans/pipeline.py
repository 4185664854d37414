"""Layer steps chained as plain functions (bronze -> silver -> gold).

Each step is lazy; ``run`` publishes every table once, so no frame is
recomputed for a count before its write.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.functions.expr import decode_flag, full_name, prettify_enum, strip_prefix
from workpulse.operators import clean, refs, workforce

EMPLOYEE_DATE_COLUMNS = ("job_start_date", "dob", "hire_date", "recent_hire_date",
                         "anniversary_date", "term_date")
EMPLOYEE_ID_COLUMNS = ("client_employee_id", "department_id", "manager_employee_id",
                       "organization_id", "job_code")


def employee_reasons(columns) -> dict:
    """Ordered quarantine rules for bronze employee rows: an id must be there and
    each date must be one or be blank.  A date that cannot be read is a reason, not
    a NULL that looks like an employee who never left."""
    dates = [c for c in EMPLOYEE_DATE_COLUMNS if c in columns]
    return {"missing_employee_id": F.coalesce(F.trim("client_employee_id"), F.lit("")) == "",
            **{f"invalid_{c}": F.coalesce(F.trim(c) != "", F.lit(False))
               & F.try_to_date(F.trim(c), clean.DATE_FORMAT).isNull() for c in dates}}


def silver_employee(raw: DataFrame, as_of: dt.date | str, early_days: int = 90) -> DataFrame:
    """Bronze employee (all strings) -> silver employee."""
    e = clean.blank_to_null(raw)
    e = clean.split_code_name(e, "department_name", "department_code")
    e = clean.cast_dates(e, [c for c in EMPLOYEE_DATE_COLUMNS if c in e.columns])
    e = clean.cast_columns(e, {c: "string" for c in EMPLOYEE_ID_COLUMNS})
    if "scheduled_weekly_hour" in e.columns:
        e = clean.cast_columns(e, {"scheduled_weekly_hour": "decimal(10,2)"}, strict=False)
    e = e.withColumns({
        "active_status": decode_flag("active_status"),
        "fte_status": prettify_enum("fte_status"),
        "termination_reason": strip_prefix("termination_reason", clean.TERMINATION_PREFIX),
    })
    e = e.withColumns({
        "employment_status": workforce.employment_status("active_status"),
        "full_name": full_name("first_name", "last_name"),
    })
    if "manager_employee_id" in e.columns:
        e = refs.with_reference_flag(e, "manager_employee_id", e, "client_employee_id",
                                     "manager_exists", null_when_missing=True)
    e = workforce.with_tenure(e, as_of)
    return workforce.with_early_attrition(e, early_days)


# --------------------------------------------------------------------------- timesheet

TIMESHEET_TIMESTAMPS = ("punch_in_datetime", "punch_out_datetime", "scheduled_start_datetime",
                        "scheduled_end_datetime")
TIMESHEET_STRINGS = ("client_employee_id", "department_id", "department_name", "pay_code")


def timesheet_reasons() -> dict:
    """Ordered quarantine rules for bronze timesheet rows (first match wins)."""
    from workpulse.functions import expr as X
    return {
        "invalid_employee_id": X.invalid_identifier("client_employee_id", clean.INVALID_ID_KEYWORDS),
        "missing_pay_code": X.blank_to_null("pay_code").isNull(),
        "malformed_hours_worked": X.malformed_numeric("hours_worked"),
        "missing_hours_worked": F.col("hours_worked").isNull(),
        "invalid_punch_apply_date": F.try_to_date("punch_apply_date", clean.DATE_FORMAT).isNull(),
    }


def type_timesheet(good: DataFrame) -> DataFrame:
    """Trim/blank->NULL the text columns, then tolerant date/timestamp/decimal casts."""
    t = clean.blank_to_null(good, [c for c in TIMESHEET_STRINGS if c in good.columns])
    t = clean.cast_dates(t, ["punch_apply_date"])
    t = clean.cast_timestamps(t, [c for c in TIMESHEET_TIMESTAMPS if c in t.columns])
    return clean.cast_columns(t, {"hours_worked": "decimal(10,2)"}, strict=False)


def apply_timesheet_rules(t: DataFrame, master: DataFrame | None, grace_minutes: float = 5
                          ) -> DataFrame:
    """Durations, adherence, declared-vs-punched, pay-code count/flags,
    surrogate id and (when a master is given) the master match flag."""
    from workpulse.operators import attendance, codes, keys
    t = attendance.with_durations(t)
    t = attendance.with_schedule_adherence(t, grace_minutes=grace_minutes)
    t = attendance.with_hours_variance(t)
    t = codes.with_packed_count(t)
    t = codes.with_code_flags(t)
    t = keys.with_surrogate_key(t, keys.TIMESHEET_KEY, "timesheet_id")
    if master is not None:
        t = refs.with_reference_flag(t, "client_employee_id", master, "client_employee_id",
                                     "employee_master_match", null_when_missing=False)
    return t


def silver_timesheet(raw: DataFrame, master: DataFrame | None, grace_minutes: float = 5,
                     checked_at=None, null_key_policy: str = "collapse"
                     ) -> tuple[DataFrame, DataFrame]:
    """Bronze timesheet -> (silver timesheet, quarantine).

    quarantine split -> typing -> dedup on the natural key (count of copies
    kept) -> attendance rules and flags.  Dedup runs before the rules so they
    evaluate each punch once."""
    from workpulse.operators import keys, quarantine
    good, bad = quarantine.split_quarantine(raw, timesheet_reasons(), checked_at=checked_at)
    typed = type_timesheet(good)
    deduped = keys.deduplicate(typed, null_key_policy=null_key_policy)
    return apply_timesheet_rules(deduped, master, grace_minutes), bad


# --------------------------------------------------------------------------- end to end

class Layers:
    """The tables of a run, each replaced in one step and counted by its own write.

    With ``root`` a table is a versioned folder ``root/layer/name``; without, a
    managed table ``<prefix><layer>.name`` of the catalog."""

    def __init__(self, spark, root: str | None, prefix: str = ""):
        self.spark, self.root, self.prefix = spark, root, prefix
        self.counts: list[tuple[str, int]] = []
        self.paths: dict[str, str] = {}

    def name(self, layer: str, name: str) -> str:
        return f"{self.prefix}{layer}.{name}"

    def put(self, layer: str, name: str, df: DataFrame, partition_by=None, metrics=None) -> DataFrame:
        """Write a table and return it as read back.  A tagged table
        (``quarantine.tag``) is partitioned by its verdict, and the verdicts are counted."""
        from workpulse.operators import quarantine
        from workpulse.sources import io, versions
        metrics, partition_by = dict(metrics or {}), list(partition_by or [])
        if quarantine.VERDICT in df.columns:
            partition_by = [*partition_by, quarantine.VERDICT]
            metrics |= quarantine.verdict_metrics()
        if self.root is None:
            counted, seen = versions.observed(df, metrics)
            io.publish(counted, None, f"{self.prefix}{layer}", name, partition_by=partition_by or None)
            found, path = seen.get, self.name(layer, name)
        else:
            found = versions.publish_version(df, self.root, layer, name, partition_by=partition_by or None,
                                             metrics=metrics)["metrics"]
            path = io.table_path(self.root, layer, name)
        self.paths[f"{layer}.{name}"] = path
        self.counts += [(f"{layer}.{name}.{k}", int(v)) for k, v in found.items()]
        return self.load(layer, name)

    def load(self, layer: str, name: str) -> DataFrame:
        from workpulse.sources import io
        return io.load(self.spark, self.root, layer if self.root else f"{self.prefix}{layer}", name)

    def exists(self, table: str) -> bool:
        from workpulse.sources import versions
        if self.root is None:
            return self.spark.catalog.tableExists(f"{self.prefix}{table}")
        return bool(versions.manifests(self.spark, self.root, *table.split(".")))

    def layer_counts(self) -> DataFrame:
        """(metric, value): what the writes have counted so far."""
        from workpulse.sources import io
        return io.frame_from_records(self.spark, self.counts, "metric string, value long")


def build_silver(layers: Layers, b_emp: DataFrame, b_ts: DataFrame, as_of, grace_minutes: float = 5,
                 null_key_policy: str = "collapse", partition_by: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Silver from tagged bronze tables; returns the frames that gates and checks read."""
    from workpulse.operators import codes, keys, quarantine
    line = [c for c in ("_corrupt_record", "_corrupt_reason") if c in b_emp.columns]
    emp = layers.put("silver", "employee", silver_employee(quarantine.good_side(b_emp).drop(*line), as_of))
    layers.put("silver", "employee_quarantine", quarantine.bad_side(b_emp))
    bad = layers.put("silver", "timesheet_quarantine", quarantine.bad_side(b_ts))
    good = type_timesheet(quarantine.good_side(b_ts).drop(*line))
    ts = layers.put("silver", "timesheet", apply_timesheet_rules(
        keys.deduplicate(good, null_key_policy=null_key_policy), emp.select("client_employee_id"), grace_minutes),
        partition_by=partition_by,
        metrics={"copies_removed": F.col("source_duplicate_count") - 1, "codes": F.col("pay_code_count")})
    bridge = layers.put("silver", "timesheet_pay_code", codes.explode_codes(ts))
    layers.put("silver", "pay_code_dimension", codes.code_dimension(bridge))
    return {"bronze_employee": b_emp, "employee": emp, "bronze_timesheet": b_ts, "bridge": bridge,
            "timesheet_typed": good, "quarantine": bad, "timesheet": ts, "layer_counts": layers.layer_counts()}


def build_gold(layers: Layers, emp: DataFrame, ts: DataFrame) -> dict[str, DataFrame]:
    from workpulse.operators import hours
    headcount = layers.put("gold", "daily_headcount", workforce.daily_headcount(emp))
    gold = {
        "monthly_turnover": workforce.monthly_turnover(emp, headcount),
        "department_tenure": workforce.group_tenure(emp),
        "employee_working_hours": hours.working_hours(ts),
        "attendance_metrics": hours.attendance_metrics(ts),
        "rolling_avg_hours": hours.rolling_hours(ts),
        "early_attrition_overall": workforce.attrition(emp),
        "early_attrition_by_department": workforce.attrition(emp, by=list(workforce.DEPARTMENT_KEYS)),
        "early_attrition_by_cohort": workforce.attrition(emp, by="hire_year"),
    }
    out = {"daily_headcount": headcount} | {n: layers.put("gold", n, df) for n, df in gold.items()}
    daily = layers.put("gold", "employee_attendance_daily", hours.attendance_daily(ts, emp))
    out["employee_attendance_daily"] = daily
    for name, df in (("employee_attendance_summary", hours.attendance_summary(daily)),
                     ("attendance_rolling_trend", hours.attendance_trend(daily))):
        out[name] = layers.put("gold", name, df)
    return out


def run(spark, employee_paths, timesheet_paths, root: str | None, as_of: dt.date,
        punch_as_of: dt.date | None = None, grace_minutes: float = 5, batch_id: str | None = None,
        strict: bool | None = None, timesheet_partition_by: tuple[str, ...] = (),
        null_key_policy: str = "collapse", expected_employees: int | None = None, prefix: str = "",
        employee_columns=None, timesheet_columns=None) -> dict:
    """Extract files -> bronze -> silver -> gold -> data-quality report and gate.

    Every line of the extracts becomes a bronze row with a verdict: malformed lines
    and bad rows are written with their reason beside the good ones, in one pass
    over the files.  Every table is written once, replaced in one step and counted by
    its write, under ``root`` or, with ``root=None``, as managed tables of the
    schemas ``<prefix>bronze``, ``<prefix>silver`` and ``<prefix>gold``; an executor
    lost late in the run recomputes from the last table, never from the extracts.

    A failing hard gate (``plans.gates``) raises before gold is built, unless
    ``strict=False``.  The verdict of the final report raises only with
    ``strict=True``.  Returns the table paths, the ids of failing gates, the verdict
    and the layers."""
    # The times of extracts carry no zone and surrogate ids hash their text: everything
    # is written under one zone, and the caller's is put back.
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        return _run(spark, employee_paths, timesheet_paths, root, as_of, punch_as_of or as_of, grace_minutes, batch_id,
                    strict, timesheet_partition_by, null_key_policy, expected_employees, prefix, employee_columns,
                    timesheet_columns)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def _run(spark, employee_paths, timesheet_paths, root, as_of, punch_as_of, grace_minutes, batch_id, strict,
         timesheet_partition_by, null_key_policy, expected_employees, prefix, employee_columns, timesheet_columns) -> dict:
    from workpulse.operators import dq, quarantine
    from workpulse.plans import contract, dq_suite, gates
    from workpulse.sources import extracts, io
    batch_id = batch_id or io.new_batch_id()
    layers = Layers(spark, root, prefix)

    def bronze(paths, columns):
        return extracts.read_checked_extract(spark, paths, columns).withColumns(
            {"_ingested_at": F.current_timestamp(), "_batch_id": F.lit(batch_id)})

    raw_emp, raw_ts = bronze(employee_paths, employee_columns), bronze(timesheet_paths, timesheet_columns)
    # Without these columns the rules cannot be planned.
    dq.require(dq.dq_report(spark, {}, gates.column_checks(
        {"bronze_employee": raw_emp, "bronze_timesheet": raw_ts})))
    b_emp = layers.put("bronze", "employee", quarantine.tag(
        raw_emp, extracts.line_reasons() | employee_reasons(raw_emp.columns)))
    b_ts = layers.put("bronze", "timesheet", quarantine.tag(
        raw_ts, extracts.line_reasons() | timesheet_reasons()))
    frames = build_silver(layers, b_emp, b_ts, as_of, grace_minutes, null_key_policy, timesheet_partition_by)
    gate_rows = layers.put("silver", "pipeline_gates", dq.dq_report(
        spark, frames, gates.gate_checks(frames, expected_employees)))
    if strict is not False:
        dq.require(gate_rows)
    failing = sorted(r["check_id"] for r in gate_rows.where("status <> 'PASS'")
                     .select("check_id").collect())

    gold = build_gold(layers, frames["employee"], frames["timesheet"])
    frames |= gold | {"working_hours": gold["employee_working_hours"], "layer_counts": layers.layer_counts()}
    if root is not None:  # managed tables are in the catalog already
        io.register_views({k.replace(".", "_"): layers.load(*k.split(".")) for k in layers.paths})
    checks = dq.check_available("DQ_TBL", spark, contract.TABLES, contract.CRITICAL_TABLES, layers.exists)
    checks += [dq.check_counted(f"DQ_CNT_{t.replace('.', '_')}", f"{t} row count", f"{t}.rows", low=None)
               for t in contract.TABLES]
    report = layers.put("gold", "data_quality_report", dq_suite.run_suite(
        spark, frames, as_of, punch_as_of, grace_minutes=grace_minutes, extra=tuple(checks)))
    gate = dq.enforce_gate(report, strict=bool(strict))
    return {"paths": layers.paths, "gate": gate, "gates_failed": failing, "batch_id": batch_id, "layers": layers}
