"""Bind the library to the driver's generic tables.

The driver ships no punch-clock data, so workforce inputs are derived from its
tables with plain Spark expressions (every view grows with the tables):

* ``raw_extract``  -- all-string bronze timesheet extract from ``events`` with
  two overlapping files, in-file duplicates and injected bad rows.
* ``punch``        -- typed punch rows (one per event), the input of the
  attendance rules.
* ``extract``      -- typed overlapping extracts with lineage, for dedup.
* ``employee_raw`` -- all-string bronze employee master from ``customer`` and
  the first ``orders`` date per customer.
* ``employee``     -- silver employee built from ``employee_raw`` by the library.
* ``timesheet``    -- silver timesheet built from ``punch`` by the library.

The same derivations are spelled in DuckDB SQL in ``workpulse.plans.oracles``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import functools

AS_OF = dt.date(2003, 1, 1)
INGEST_A = "2024-02-01 00:00:00"
INGEST_B = "2024-02-02 00:00:00"
BATCH_ID = "20240201_000000"


def _memo(fn):
    """Build each derived view once per (session, folder, args): DataFrames are
    immutable plans, so queries share them like registered views."""
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(spark: SparkSession, sf_dir: str, *args, **kwargs):
        key = (spark.sparkContext.applicationId, spark._jsparkSession.sessionUUID(), sf_dir.rstrip("/"), args,
               tuple(sorted(kwargs.items())))
        if key not in cache:
            cache[key] = fn(spark, sf_dir, *args, **kwargs)
        return cache[key]
    return wrapper


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pay_code(event_type: Column) -> Column:
    return (F.when(event_type == "click", "Hourly")
            .when(event_type == "purchase", "TM-12 OT 50HP|Hourly")
            .when(event_type == "signup", "Vacation TM")
            .when(event_type == "view", "HH-Hourly | Sick Unpaid TM")
            .otherwise("Float pool"))


@_memo
def punch(spark: SparkSession, sf_dir: str, keep_event_id: bool = False) -> DataFrame:
    """Typed punches: one row per event.

    error events lose the punch-out (and every second one the punch-in too);
    view events have no schedule; every 997th shift runs 21 h longer."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    dept = F.when(eid % 10 == 0, (uid + 1) % 25).otherwise(uid % 25).cast("string")
    pin = F.date_trunc("second", "ts")
    hour = F.date_trunc("hour", "ts")
    shift = F.lit(240) + (eid * 7) % 420 + F.when(eid % 997 == 0, 1260).otherwise(0)
    cols = [
        # every 4th user punches under an id outside the master (no master row)
        F.when(uid % 4 == 3, F.concat(F.lit("9"), F.lpad(uid.cast("string"), 6, "0")))
        .otherwise(F.lpad(uid.cast("string"), 6, "0")).alias("client_employee_id"),
        dept.alias("department_id"),
        F.concat(F.lit("DEPT-"), dept).alias("department_name"),
        _pay_code(et).alias("pay_code"),
        (F.col("value") % 30).cast("decimal(10,2)").alias("hours_worked"),
        F.col("ts").cast("date").alias("punch_apply_date"),
        F.when(~((et == "error") & (eid % 2 == 0)), pin).alias("punch_in_datetime"),
        F.when(et != "error", pin + F.make_dt_interval(mins=shift)).alias("punch_out_datetime"),
        F.when(et != "view", hour + F.expr("INTERVAL 30 MINUTES")).alias("scheduled_start_datetime"),
        F.when(et != "view", hour + F.expr("INTERVAL 510 MINUTES")).alias("scheduled_end_datetime"),
    ]
    if keep_event_id:
        cols = [eid] + cols
    return ev.select(*cols)


@_memo
def _extract_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = punch(spark, sf_dir, keep_event_id=True)
    eid = F.col("event_id")
    a = p.withColumns({"_source_file": F.lit("extract_a.csv"),
                       "_ingested_at": F.lit(INGEST_A).cast("timestamp")})
    b = (p.filter(eid % 3 == 0)
         .withColumn("hours_worked",
                     F.when(eid % 9 == 0, F.col("hours_worked") + 1)
                     .otherwise(F.col("hours_worked")).cast("decimal(10,2)"))
         .withColumns({"_source_file": F.lit("extract_b.csv"),
                       "_ingested_at": F.lit(INGEST_B).cast("timestamp")}))
    b2 = (p.filter(eid % 15 == 0)
          .withColumn("hours_worked", (F.col("hours_worked") + 2).cast("decimal(10,2)"))
          .withColumns({"_source_file": F.lit("extract_b.csv"),
                        "_ingested_at": F.lit(INGEST_B).cast("timestamp")}))
    return a.unionByName(b).unionByName(b2).withColumn("_batch_id", F.lit(BATCH_ID))


@_memo
def extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping typed extracts: file a = every punch; file b = every 3rd
    event again (every 9th with different hours), plus every 15th event a
    second time inside file b (hours + 2)."""
    return _extract_e(spark, sf_dir).drop("event_id")


@_memo
def raw_extract_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string bronze rows of the overlapping extracts (lineage kept) with
    injected defects: ids 'Meal ...' (every 97th event), '' (101st), NULL
    (103rd), '...ADJ FOR' (109th); pay code NULL (83rd) or blank (107th);
    hours a timestamp text (89th), NULL (113th), negative (127th)."""
    p = _extract_e(spark, sf_dir)
    eid = F.col("event_id")
    ts_fmt = "yyyy-MM-dd HH:mm:ss.SSS"
    emp = F.col("client_employee_id")
    return p.select(
        eid,
        (F.when(eid % 97 == 0, F.concat(F.lit("Meal "), emp))
         .when(eid % 101 == 0, F.lit(""))
         .when(eid % 103 == 0, F.lit(None).cast("string"))
         .when(eid % 109 == 0, F.concat(emp, F.lit("ADJ FOR")))
         .otherwise(emp)).alias("client_employee_id"),
        F.col("department_id"),
        F.col("department_name"),
        (F.when(eid % 83 == 0, F.lit(None).cast("string"))
         .when(eid % 107 == 0, F.lit("  "))
         .otherwise(F.col("pay_code"))).alias("pay_code"),
        (F.when(eid % 89 == 0, F.date_format("punch_in_datetime", ts_fmt))
         .when(eid % 113 == 0, F.lit(None).cast("string"))
         .when(eid % 127 == 0, F.concat(F.lit("-"), F.col("hours_worked").cast("string")))
         .otherwise(F.col("hours_worked").cast("string"))).alias("hours_worked"),
        F.date_format("punch_apply_date", "yyyy-MM-dd").alias("punch_apply_date"),
        F.date_format("punch_in_datetime", ts_fmt).alias("punch_in_datetime"),
        F.date_format("punch_out_datetime", ts_fmt).alias("punch_out_datetime"),
        F.date_format("scheduled_start_datetime", ts_fmt).alias("scheduled_start_datetime"),
        F.date_format("scheduled_end_datetime", ts_fmt).alias("scheduled_end_datetime"),
        "_source_file", "_ingested_at", "_batch_id",
    )


@_memo
def raw_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_extract_e(spark, sf_dir).drop("event_id")


RAW_COLUMNS = ("client_employee_id", "department_id", "department_name", "pay_code", "hours_worked",
               "punch_apply_date", "punch_in_datetime", "punch_out_datetime", "scheduled_start_datetime",
               "scheduled_end_datetime")


@_memo
def extract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line, origin) of the bronze rows as extract text, with malformed lines:
    every 61st event lacks its last field, every 67th has one too many, every 71st
    opens a quote that never closes."""
    raw, eid = raw_extract_e(spark, sf_dir), F.col("event_id")

    def field(name: str) -> Column:
        text = F.col(name)
        return (F.when(text.isNull(), "[NULL]").when(text == "", '""')
                .when(F.contains(text, F.lit("|")), F.concat(F.lit('"'), text, F.lit('"'))).otherwise(text))

    first, last = [field(c) for c in RAW_COLUMNS[:-1]], field(RAW_COLUMNS[-1])
    line = F.concat_ws("|", *first)
    return raw.select(
        F.when(eid % 61 == 0, line).when(eid % 67 == 0, F.concat_ws("|", line, last, F.lit("surplus")))
        .when(eid % 71 == 0, F.concat_ws("|", F.concat(F.lit('"'), line), last))
        .otherwise(F.concat_ws("|", line, last)).alias("line"), F.col("_source_file").alias("origin"))


@_memo
def employee_raw_odd_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze master with dates nobody can read: every 59th hire date in another
    order, every 61st term date a word, and every 83rd id blank."""
    raw = employee_raw(spark, sf_dir)
    k = F.col("client_employee_id").cast("long")
    return raw.withColumns({
        "hire_date": F.when(k % 59 == 0, F.date_format(F.to_date("hire_date"), "dd/MM/yyyy"))
        .otherwise(F.col("hire_date")),
        "term_date": F.when(k % 61 == 0, "unknown").otherwise(F.col("term_date")),
        "client_employee_id": F.when(k % 83 == 0, " ").otherwise(F.col("client_employee_id"))})


@_memo
def employee_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-string employee master: every customer; hire =
    first order date; every 5th terminated after ``c_custkey % 400`` days, every
    397th (+1) terminated before hire; departments ``<nation>-<segment>``, some
    without a dash or with two."""
    cust = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    first = (table(spark, sf_dir, "orders").groupBy("o_custkey")
             .agg(F.min("o_orderdate").cast("date").alias("hire")))
    k = F.col("c_custkey")
    hire = F.col("hire")
    term = (F.when(k % 397 == 1, F.date_sub(hire, 10))
            .when(k % 5 == 0, F.date_add(hire, (k % 400).cast("int"))))
    nation = F.col("c_nationkey").cast("string")
    seg = F.col("c_mktsegment")
    base = (cust.join(first, cust.c_custkey == first.o_custkey, "left")
            .withColumn("term", term))
    return base.select(
        F.lpad(k.cast("string"), 6, "0").alias("client_employee_id"),
        F.when(k % 11 != 0, F.concat(F.lit("F"), (k % 37).cast("string"))).alias("first_name"),
        F.concat(F.lit("L"), (k % 53).cast("string")).alias("last_name"),
        (F.when(k % 3 == 0, "Nurse").when(k % 3 == 1, "Technician")
         .otherwise("Clerk")).alias("job_title"),
        nation.alias("department_id"),
        (F.when(k % 17 == 0, seg)
         .when(k % 19 == 0, F.concat(nation, F.lit("-"), seg, F.lit("-X")))
         .otherwise(F.concat(nation, F.lit("-"), seg))).alias("department_name"),
        F.date_format(hire, "yyyy-MM-dd").alias("hire_date"),
        F.date_format("term", "yyyy-MM-dd").alias("term_date"),
        (F.when(k % 23 == 0, "X").when(k % 29 == 0, "1")
         .when(F.col("term").isNotNull(), "0").otherwise("1")).alias("active_status"),
        F.when(F.col("term").isNotNull(),
               F.concat(F.lit("Terminate_Employee_"),
                        F.when(k % 3 == 0, "Voluntary").otherwise("Involuntary"))
               ).alias("termination_reason"),
        (F.when(k % 3 == 0, "Full_time").when(k % 3 == 1, "Part_time")
         .otherwise("Variable_time")).alias("fte_status"),
        F.when(k % 7 != 0, F.lpad(((k * 7) % 2003).cast("string"), 6, "0")
               ).alias("manager_employee_id"),
        (F.col("c_acctbal") % 60).cast("decimal(10,2)").cast("string").alias("scheduled_weekly_hour"),
        F.lit(" ").alias("middle_name"),
    )


@_memo
def employee(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF) -> DataFrame:
    """Silver employee master built by the library from ``employee_raw``."""
    from workpulse.plans.pipeline import silver_employee
    return silver_employee(employee_raw(spark, sf_dir), as_of=as_of)


@_memo
def master_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return employee_raw(spark, sf_dir).select("client_employee_id")


@_memo
def timesheet(spark: SparkSession, sf_dir: str, grace_minutes: float = 5) -> DataFrame:
    """Silver-like timesheet: punch -> durations -> adherence -> declared-vs-punched
    -> pay-code flags -> surrogate key -> employee master match."""
    from workpulse.operators import attendance, codes, keys, refs
    t = punch(spark, sf_dir)
    t = attendance.with_durations(t)
    t = attendance.with_schedule_adherence(t, grace_minutes=grace_minutes)
    t = attendance.with_hours_variance(t)
    t = codes.with_packed_count(t)
    t = codes.with_code_flags(t)
    t = keys.with_surrogate_key(t, keys.TIMESHEET_KEY, "timesheet_id")
    return refs.with_reference_flag(t, "client_employee_id", master_ids(spark, sf_dir),
                                    "client_employee_id", "employee_master_match",
                                    null_when_missing=False)
