"""DuckDB SQL oracles for ``__spark_entry__.queries()``.

Independent spelling of the bindings (``workpulse.plans.bindings``) and of the
operator semantics, used only to check the Spark results.  Rounding uses the
same half-up formula as ``workpulse.functions.expr.rnd`` so both engines
produce identical doubles.
"""

from __future__ import annotations


def R(x: str, scale: int = 2) -> str:
    k = f"CAST({10 ** scale} AS DOUBLE)"
    v = f"CAST(({x}) AS DOUBLE)"
    return (f"(CAST(CASE WHEN {v} < 0 THEN -CAST(floor(-{v} * {k} + 0.500000001) AS BIGINT) "
            f"ELSE CAST(floor({v} * {k} + 0.500000001) AS BIGINT) END AS DOUBLE) / {k})")


def PCT(num: str, den: str, scale: int = 2) -> str:
    return R(f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) * 100", scale)


from workpulse.operators.codes import LEAVE_PATTERN as LEAVE  # noqa: E402
from workpulse.operators.codes import OVERTIME_PATTERN as OT  # noqa: E402

_DEPT = "CAST(CASE WHEN event_id % 10 = 0 THEN (user_id + 1) % 25 ELSE user_id % 25 END AS VARCHAR)"
_SHIFT = "CAST(240 + (event_id * 7) % 420 + CASE WHEN event_id % 997 = 0 THEN 1260 ELSE 0 END AS BIGINT)"


def _json_key(cols: list[tuple[str, str]]) -> str:
    parts = []
    for name, kind in cols:
        if kind == "str":
            val = f"'\"{name}\":\"' || {name} || '\"'"
        elif kind == "date":
            val = f"'\"{name}\":\"' || strftime({name}, '%Y-%m-%d') || '\"'"
        else:
            val = f"'\"{name}\":\"' || strftime({name}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z\"'"
        parts.append(f"CASE WHEN {name} IS NOT NULL THEN {val} END")
    return "sha256('{' || concat_ws(',', " + ", ".join(parts) + ") || '}')"


TIMESHEET_ID = _json_key([("client_employee_id", "str"), ("punch_apply_date", "date"),
                          ("punch_in_datetime", "ts"), ("punch_out_datetime", "ts")])

PUNCH_COLS = ("client_employee_id, department_id, department_name, pay_code, hours_worked, "
              "punch_apply_date, punch_in_datetime, punch_out_datetime, "
              "scheduled_start_datetime, scheduled_end_datetime")


def silver_chain(src: str, p: str) -> str:
    """Silver timesheet rules over relation ``src`` as CTEs ``{p}1`` .. ``{p}_silver``."""
    return f"""
{p}1 AS (
  SELECT *,
    CASE WHEN punch_in_datetime IS NOT NULL AND punch_out_datetime IS NOT NULL
      THEN date_diff('second', punch_in_datetime, punch_out_datetime) / 60 END AS actual_duration_minutes,
    scheduled_start_datetime IS NOT NULL AND scheduled_end_datetime IS NOT NULL AS is_schedulable
  FROM {src}
),
{p}2 AS (
  SELECT *, {R("actual_duration_minutes / 60")} AS actual_duration_hours,
    CASE WHEN is_schedulable THEN date_diff('second', scheduled_start_datetime, scheduled_end_datetime) / 60
      END AS scheduled_duration_minutes
  FROM {p}1
),
{p}3 AS (
  SELECT *, {R("scheduled_duration_minutes / 60")} AS scheduled_duration_hours,
    CASE WHEN is_schedulable AND punch_in_datetime IS NOT NULL
      THEN date_diff('second', scheduled_start_datetime, punch_in_datetime) / 60 END AS arrival_variance_minutes,
    CASE WHEN is_schedulable AND punch_out_datetime IS NOT NULL
      THEN date_diff('second', punch_out_datetime, scheduled_end_datetime) / 60 END AS departure_variance_minutes,
    CASE WHEN is_schedulable AND actual_duration_minutes IS NOT NULL
      THEN actual_duration_minutes - scheduled_duration_minutes END AS schedule_variance_minutes,
    actual_duration_hours > 24 AS is_excessive_duration
  FROM {p}2
),
{p}4 AS (
  SELECT *,
    CASE WHEN arrival_variance_minutes > 5 THEN {R("arrival_variance_minutes")} ELSE 0.0 END AS late_arrival_minutes,
    CASE WHEN departure_variance_minutes > 5 THEN {R("departure_variance_minutes")} ELSE 0.0 END AS early_departure_minutes,
    CASE WHEN schedule_variance_minutes > 5 THEN {R("schedule_variance_minutes")} ELSE 0.0 END AS overtime_minutes
  FROM {p}3
),
{p}_silver AS (
  SELECT *,
    late_arrival_minutes > 0 AS is_late_arrival,
    early_departure_minutes > 0 AS is_early_departure,
    {R("overtime_minutes / 60")} AS overtime_hours,
    overtime_minutes > 0 AS is_overtime,
    CASE WHEN hours_worked IS NOT NULL AND actual_duration_hours IS NOT NULL
      THEN {R("CAST(hours_worked AS DOUBLE) - actual_duration_hours")} END AS hours_worked_vs_punch_variance,
    CAST(len(string_split(pay_code, '|')) AS INTEGER) AS pay_code_count,
    len(string_split(pay_code, '|')) > 1 AS has_multiple_pay_codes,
    len(list_filter(string_split(pay_code, '|'), lambda x: regexp_matches(trim(x), '{OT}'))) > 0
      AS has_overtime_pay_code,
    len(list_filter(string_split(pay_code, '|'), lambda x: regexp_matches(trim(x), '{LEAVE}'))) > 0
      AS has_leave_pay_code,
    {TIMESHEET_ID} AS timesheet_id,
    client_employee_id IN (SELECT client_employee_id FROM e_ids) AS employee_master_match
  FROM {p}4
)
"""


CTES = f"""
b_punch_e AS (
  SELECT event_id,
    CASE WHEN user_id % 4 = 3 THEN '9' || lpad(CAST(user_id AS VARCHAR), 6, '0')
      ELSE lpad(CAST(user_id AS VARCHAR), 6, '0') END AS client_employee_id,
    {_DEPT} AS department_id,
    'DEPT-' || {_DEPT} AS department_name,
    CASE event_type WHEN 'click' THEN 'Hourly' WHEN 'purchase' THEN 'TM-12 OT 50HP|Hourly'
      WHEN 'signup' THEN 'Vacation TM' WHEN 'view' THEN 'HH-Hourly | Sick Unpaid TM'
      ELSE 'Float pool' END AS pay_code,
    CAST(value % 30 AS DECIMAL(10,2)) AS hours_worked,
    CAST(ts AS DATE) AS punch_apply_date,
    CASE WHEN NOT (event_type = 'error' AND event_id % 2 = 0) THEN date_trunc('second', ts) END
      AS punch_in_datetime,
    CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) + to_minutes({_SHIFT}) END
      AS punch_out_datetime,
    CASE WHEN event_type <> 'view' THEN date_trunc('hour', ts) + INTERVAL 30 MINUTE END
      AS scheduled_start_datetime,
    CASE WHEN event_type <> 'view' THEN date_trunc('hour', ts) + INTERVAL 510 MINUTE END
      AS scheduled_end_datetime
  FROM events
),
b_punch AS (SELECT {PUNCH_COLS} FROM b_punch_e),
b_extract_e AS (
  SELECT event_id, {PUNCH_COLS}, 'extract_a.csv' AS _source_file,
    TIMESTAMP '2024-02-01 00:00:00' AS _ingested_at, '20240201_000000' AS _batch_id FROM b_punch_e
  UNION ALL
  SELECT event_id, client_employee_id, department_id, department_name, pay_code,
    CAST(CASE WHEN event_id % 9 = 0 THEN hours_worked + 1 ELSE hours_worked END AS DECIMAL(10,2)),
    punch_apply_date, punch_in_datetime, punch_out_datetime, scheduled_start_datetime,
    scheduled_end_datetime, 'extract_b.csv', TIMESTAMP '2024-02-02 00:00:00', '20240201_000000'
  FROM b_punch_e WHERE event_id % 3 = 0
  UNION ALL
  SELECT event_id, client_employee_id, department_id, department_name, pay_code,
    CAST(hours_worked + 2 AS DECIMAL(10,2)),
    punch_apply_date, punch_in_datetime, punch_out_datetime, scheduled_start_datetime,
    scheduled_end_datetime, 'extract_b.csv', TIMESTAMP '2024-02-02 00:00:00', '20240201_000000'
  FROM b_punch_e WHERE event_id % 15 = 0
),
b_extract AS (SELECT * EXCLUDE (event_id) FROM b_extract_e),
b_raw_e AS (
  SELECT event_id,
    CASE WHEN event_id % 97 = 0 THEN 'Meal ' || client_employee_id
      WHEN event_id % 101 = 0 THEN '' WHEN event_id % 103 = 0 THEN NULL
      WHEN event_id % 109 = 0 THEN client_employee_id || 'ADJ FOR'
      ELSE client_employee_id END AS client_employee_id,
    department_id, department_name,
    CASE WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 107 = 0 THEN '  ' ELSE pay_code END
      AS pay_code,
    CASE WHEN event_id % 89 = 0 THEN strftime(punch_in_datetime, '%Y-%m-%d %H:%M:%S.%g')
      WHEN event_id % 113 = 0 THEN NULL
      WHEN event_id % 127 = 0 THEN '-' || CAST(hours_worked AS VARCHAR)
      ELSE CAST(hours_worked AS VARCHAR) END AS hours_worked,
    strftime(punch_apply_date, '%Y-%m-%d') AS punch_apply_date,
    strftime(punch_in_datetime, '%Y-%m-%d %H:%M:%S.%g') AS punch_in_datetime,
    strftime(punch_out_datetime, '%Y-%m-%d %H:%M:%S.%g') AS punch_out_datetime,
    strftime(scheduled_start_datetime, '%Y-%m-%d %H:%M:%S.%g') AS scheduled_start_datetime,
    strftime(scheduled_end_datetime, '%Y-%m-%d %H:%M:%S.%g') AS scheduled_end_datetime,
    _source_file, _ingested_at, _batch_id
  FROM b_extract_e
),
b_raw AS (SELECT * EXCLUDE (event_id) FROM b_raw_e),
e_first AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS hire FROM orders GROUP BY o_custkey),
e_base AS (
  SELECT c.c_custkey AS k, c.c_nationkey, c.c_acctbal, c.c_mktsegment, f.hire,
    CASE WHEN c.c_custkey % 397 = 1 THEN f.hire - 10
      WHEN c.c_custkey % 5 = 0 THEN f.hire + CAST(c.c_custkey % 400 AS INTEGER) END AS term
  FROM customer c LEFT JOIN e_first f ON c.c_custkey = f.o_custkey
),
e_raw AS (
  SELECT lpad(CAST(k AS VARCHAR), 6, '0') AS client_employee_id,
    CASE WHEN k % 11 <> 0 THEN 'F' || CAST(k % 37 AS VARCHAR) END AS first_name,
    'L' || CAST(k % 53 AS VARCHAR) AS last_name,
    CASE WHEN k % 3 = 0 THEN 'Nurse' WHEN k % 3 = 1 THEN 'Technician' ELSE 'Clerk' END AS job_title,
    CAST(c_nationkey AS VARCHAR) AS department_id,
    CASE WHEN k % 17 = 0 THEN c_mktsegment
      WHEN k % 19 = 0 THEN CAST(c_nationkey AS VARCHAR) || '-' || c_mktsegment || '-X'
      ELSE CAST(c_nationkey AS VARCHAR) || '-' || c_mktsegment END AS department_name,
    hire AS hire_date, term AS term_date,
    CASE WHEN k % 23 = 0 THEN 'X' WHEN k % 29 = 0 THEN '1' WHEN term IS NOT NULL THEN '0' ELSE '1' END
      AS active_status,
    CASE WHEN term IS NOT NULL THEN 'Terminate_Employee_' ||
      CASE WHEN k % 3 = 0 THEN 'Voluntary' ELSE 'Involuntary' END END AS termination_reason,
    CASE WHEN k % 3 = 0 THEN 'Full_time' WHEN k % 3 = 1 THEN 'Part_time' ELSE 'Variable_time' END
      AS fte_status,
    CASE WHEN k % 7 <> 0 THEN lpad(CAST((k * 7) % 2003 AS VARCHAR), 6, '0') END AS manager_employee_id,
    CAST(c_acctbal % 60 AS DECIMAL(10,2)) AS scheduled_weekly_hour
  FROM e_base
),
e_ids AS (SELECT DISTINCT client_employee_id FROM e_raw),
e1 AS (
  SELECT client_employee_id, first_name, last_name, job_title, department_id,
    NULLIF(trim(regexp_extract(department_name, '^([^-]+)-', 1)), '') AS department_code,
    CASE WHEN trim(regexp_extract(department_name, '^[^-]+-(.*)$', 1)) <> ''
      THEN trim(regexp_extract(department_name, '^[^-]+-(.*)$', 1)) ELSE department_name END
      AS department_name,
    hire_date, term_date,
    CASE WHEN active_status = '1' THEN TRUE WHEN active_status = '0' THEN FALSE END AS active_status,
    regexp_replace(termination_reason, '^Terminate_Employee_', '') AS termination_reason,
    array_to_string(list_transform(string_split(replace(fte_status, '_', ' '), ' '),
      lambda w: upper(w[1]) || lower(w[2:])), ' ') AS fte_status,
    manager_employee_id, scheduled_weekly_hour,
    concat_ws(' ', first_name, last_name) AS full_name
  FROM e_raw
),
b_employee AS (
  SELECT *,
    CASE WHEN active_status = TRUE THEN 'Active' WHEN active_status = FALSE THEN 'Terminated'
      ELSE 'Unknown' END AS employment_status,
    CASE WHEN manager_employee_id IS NULL THEN NULL
      ELSE manager_employee_id IN (SELECT client_employee_id FROM e_ids) END AS manager_exists,
    coalesce(term_date, DATE '2003-01-01') AS tenure_end_date,
    CAST(date_diff('day', hire_date, coalesce(term_date, DATE '2003-01-01')) AS INTEGER) AS tenure_days,
    {R("date_diff('day', hire_date, coalesce(term_date, DATE '2003-01-01')) / 365.25")} AS tenure_years,
    CASE WHEN term_date IS NOT NULL THEN CAST(date_diff('day', hire_date, term_date) AS INTEGER) END
      AS days_to_termination,
    coalesce(term_date IS NOT NULL AND date_diff('day', hire_date, term_date) BETWEEN 0 AND 90, FALSE)
      AS is_early_attrition
  FROM e1
),
{silver_chain("b_punch", "t")}
"""


def q(body: str) -> str:
    """Prefix the binding CTEs; a body with its own WITH list is merged."""
    body = body.strip()
    if body[:4].upper() == "WITH":
        return "WITH " + CTES.strip() + ",\n" + body[4:].lstrip()
    return "WITH " + CTES.strip() + "\n" + body
