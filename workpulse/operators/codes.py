"""Packed pay codes: count, bridge (punch x atomic code), dimension with
regex classification flags, and per-punch flag roll-up.

``with_code_flags`` evaluates the patterns on the split array of each row
(``exists``), so the roll-up needs no explode, join or shuffle; the bridge and
dimension are still produced as tables for the star model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.functions.expr import any_match

# Fixed values (must equal the source system's classification rules).
# Overtime: a token "OT" preceded by start, '-' or ' ' and followed by ' ' or end.
OVERTIME_PATTERN = r"(?i)(^|[- ])OT( |$)"
# Leave: unanchored, case-insensitive keyword alternation (matches e.g. "Float"
# through "LOA"; kept for parity, see LEAVE_PATTERN_STRICT).
LEAVE_PATTERN = (r"(?i)(PTO|VACATION|SICK|BEREAVEMENT|JURY DUTY|LOA|UNPAID|PERSONAL|HOLIDAY|"
                 r"APPROVED ABSENCE|ADMINISTRATIVE LEAVE|CANCELLED|CANCELED)")
LEAVE_PATTERN_STRICT = LEAVE_PATTERN.replace("LOA", r"\bLOA\b")
SEPARATOR = r"\|"

DEFAULT_FLAGS = {"overtime": OVERTIME_PATTERN, "leave": LEAVE_PATTERN}

# The same two rules stated on the packed text: a code boundary is the start or
# end of the text or a '|' (codes are trimmed of spaces, which the rules already
# accept as separators), and no leave keyword contains '|', so a substring match
# never spans two codes.  Evaluated as one rlike per row (code-generated).
PACKED_FLAGS = {"overtime": r"(?i)(^|[- |])OT( |\||$)", "leave": LEAVE_PATTERN}


def with_packed_count(df: DataFrame, code_col: str = "pay_code",
                      count_col: str = "pay_code_count",
                      multi_col: str = "has_multiple_pay_codes") -> DataFrame:
    """Number of ``|``-separated parts and a ``> 1`` flag."""
    return (df.withColumn(count_col, F.size(F.split(F.col(code_col), SEPARATOR)))
              .withColumn(multi_col, F.col(count_col) > 1))


def explode_codes(df: DataFrame, id_cols: Sequence[str] = ("timesheet_id", "client_employee_id"),
                  code_col: str = "pay_code", position_col: str = "pay_code_position") -> DataFrame:
    """Bridge: one row per (punch, position) with the trimmed atomic code.
    Row-local (``posexplode``), no shuffle."""
    return df.select(*id_cols, F.posexplode(F.split(F.col(code_col), SEPARATOR))
                     .alias(position_col, "_code")).select(
        *id_cols, position_col, F.trim(F.col("_code")).alias(code_col))


def code_dimension(bridge: DataFrame, code_col: str = "pay_code", id_col: str = "pay_code_id",
                   flags: Mapping[str, str] | None = None) -> DataFrame:
    """Distinct atomic codes, sha256 id, and one ``is_<name>_pay_code`` flag per pattern.
    ``distinct`` is a partial+final hash aggregate: hot codes collapse map-side."""
    flags = DEFAULT_FLAGS if flags is None else flags
    dim = bridge.select(code_col).distinct().withColumn(id_col, F.sha2(F.col(code_col), 256))
    return dim.withColumns({f"is_{name}_pay_code": F.col(code_col).rlike(p)
                            for name, p in flags.items()})


def with_code_flags(df: DataFrame, code_col: str = "pay_code",
                    flags: Mapping[str, str] | None = None) -> DataFrame:
    """``has_<name>_pay_code``: some trimmed atomic code of the row matches the
    pattern.  Same result as bridge -> dimension -> bool_or per punch, without
    the two shuffles.  The default rules run on the packed text
    (``PACKED_FLAGS``); caller-supplied per-code patterns are evaluated on the
    split, trimmed codes."""
    if flags is None:
        return df.withColumns({f"has_{name}_pay_code": F.col(code_col).rlike(p)
                               for name, p in PACKED_FLAGS.items()})
    parts = F.transform(F.split(F.col(code_col), SEPARATOR), lambda x: F.trim(x))
    return df.withColumns({f"has_{name}_pay_code": any_match(parts, p)
                           for name, p in flags.items()})


def rollup_code_flags(bridge: DataFrame, dimension: DataFrame, id_col: str = "timesheet_id",
                      code_col: str = "pay_code", flags: Sequence[str] = ("overtime", "leave"),
                      salts: int = 32) -> DataFrame:
    """Star-model roll-up: bridge joined to the dimension, ``bool_or`` per punch.
    The join is salted: the dimension (distinct codes) has ``salts`` copies and a
    bridge row meets the one its punch hashes to, so that a code on most punches
    is spread over as many tasks where the join is a shuffle."""
    spread = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = bridge.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int"))
    joined = salted.join(spread, [code_col, "_salt"], "left")
    return joined.groupBy(id_col).agg(*[
        F.bool_or(F.col(f"is_{n}_pay_code")).alias(f"has_{n}_pay_code") for n in flags])
