"""Bronze -> silver column cleaning.  Every operator is a single ``select`` /
``withColumns`` (one projection, however many columns), so analysis cost and
the generated code stay flat as column lists grow."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from workpulse.functions.expr import blank_to_null as _blank

# Fixed values (must equal the source system's):
# - identifier keywords (case-insensitive substrings) that mark a pay-code or
#   comment fragment shifted into the employee id column;
# - the termination-reason prefix removed from the reason text;
# - the date and timestamp text formats of the extracts.
INVALID_ID_KEYWORDS = ("meal", "missed", "tardy", "late", "note", "voluntary", "punch",
                       "traffic", "mbta", "adj for")
TERMINATION_PREFIX = r"^Terminate_Employee_"
DATE_FORMAT = "yyyy-MM-dd"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def blank_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Trim and turn '' into NULL on ``cols`` (default: every string column not
    starting with ``_``).  Absent names are ignored; see ``missing_columns``."""
    if cols is None:
        cols = [f.name for f in df.schema.fields
                if isinstance(f.dataType, StringType) and not f.name.startswith("_")]
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: _blank(c) for c in present})


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def drop_existing(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def all_null_columns(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """One-row frame ``column -> non-null count`` computed in a single pass;
    columns with 0 are all-null."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count(F.col(c)).alias(c) for c in cols])


def drop_all_null_columns(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Drop the columns that hold no value (one aggregate action decides)."""
    counts = all_null_columns(df, cols).first().asDict()
    return df.drop(*[c for c, n in counts.items() if n == 0])


def split_code_name(df: DataFrame, col: str = "department_name", code: str = "department_code",
                    name: str | None = None) -> DataFrame:
    """``<code>-<name>`` split at the first dash.  No dash: code NULL and name
    unchanged; the name falls back to the original when the rest is blank."""
    name = name or col
    src = F.col(col)
    code_expr = _blank(F.regexp_extract(src, r"^([^-]+)-", 1))
    rest = F.trim(F.regexp_extract(src, r"^[^-]+-(.*)$", 1))
    name_expr = F.when(rest.isNotNull() & (rest != ""), rest).otherwise(src)
    return df.withColumns({code: code_expr, name: name_expr})


def cast_dates(df: DataFrame, cols: Iterable[str], fmt: str = DATE_FORMAT,
               strict: bool = False) -> DataFrame:
    """String -> date.  ``strict`` raises on bad text (ANSI ``to_date``);
    otherwise bad text becomes NULL (``try_to_date``).  Columns that are not
    strings any more are left as they are."""
    fn = F.to_date if strict else F.try_to_date
    types = dict(df.dtypes)
    return df.withColumns({c: fn(F.col(c), fmt) for c in cols if types.get(c) == "string"})


def cast_timestamps(df: DataFrame, cols: Iterable[str], fmt: str = TIMESTAMP_FORMAT,
                    strict: bool = False) -> DataFrame:
    types = dict(df.dtypes)
    if strict:
        return df.withColumns({c: F.to_timestamp(F.col(c), fmt)
                               for c in cols if types.get(c) == "string"})
    return df.withColumns({c: F.try_to_timestamp(F.col(c), F.lit(fmt))
                           for c in cols if types.get(c) == "string"})


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Explicit casts; ``strict=False`` uses ``try_cast`` (bad values -> NULL)."""
    return df.withColumns({c: (F.col(c).cast(t) if strict else F.col(c).try_cast(t))
                           for c, t in types.items() if c in df.columns})


def normalise_numeric_text(df: DataFrame, cols: Sequence[str], to: str = "decimal(10,2)"
                           ) -> DataFrame:
    """Bronze rule: keep numeric text as text but NULL what does not parse."""
    return df.withColumns({c: F.col(c).try_cast(to).cast("string") for c in cols})
