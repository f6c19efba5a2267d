"""Casts: lenient text->int (Q27), typed copy conversion (A5), source projection helpers."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts the source uses for unbounded timestamps, and the numeric type of money.
# Years of the source database's finite timestamps that every driver can represent.
FINITE_YEARS = (-4713, 99999)
INFINITY_TEXTS = ("infinity", "-infinity")
MONEY_TYPE = "decimal(38,2)"
_INT_PART = r"^\s*([+-]?\d+)(\.\d*)?\s*$"


def lenient_int(c) -> Column:
    """Text to int as a non-ANSI cast would do it: '12.5'->12, '-3.9'->-3, ''/'abc'/'1e2'->NULL.

    One regex extracts the integer part of a plain decimal text; only that part is cast, so no
    input ever takes the failing-cast path (which is costly per row)."""
    c = F.col(c) if isinstance(c, str) else c
    whole = F.regexp_extract(c.cast("string"), _INT_PART, 1)
    return F.when(F.length(whole) > 0, whole.try_cast("int")).otherwise(F.lit(None).cast("int"))


def lenient_int_sql(ref: str) -> str:
    """``lenient_int`` as SQL text over the expression ``ref`` (cheaper to build for wide projections)."""
    pat = _INT_PART.replace("\\", "\\\\")
    whole = f"regexp_extract(CAST({ref} AS STRING), '{pat}', 1)"
    return f"CASE WHEN length({whole}) > 0 THEN try_cast({whole} AS INT) END"


def lenient_bool(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string").try_cast("boolean")


def infinity_to_null(c) -> Column:
    """'infinity' / '-infinity' become NULL, as text or as the typed timestamps that a driver returns in their place: the
    first and last microseconds of the range or anything beyond the years of FINITE_YEARS."""
    c = F.col(c) if isinstance(c, str) else c
    s = F.lower(F.trim(c.cast("string")))
    year = F.regexp_extract(s, r"^([+-]?\d+)-\d{2}-\d{2}", 1).try_cast("int")
    beyond = (year < FINITE_YEARS[0]) | (year > FINITE_YEARS[1])
    return F.when(s.isin(*INFINITY_TEXTS) | F.coalesce(beyond, F.lit(False)), F.lit(None)).otherwise(c)


def money_to_decimal(c, text: bool = False) -> Column:
    """Money to numeric(38,2). ``text=True`` for money arriving as text ('$1,234.56', '-1,000.00'):
    currency symbols, spaces and thousands separators are removed before the cast."""
    c = F.col(c) if isinstance(c, str) else c
    if text:
        c = F.regexp_replace(c.cast("string"), r"[^0-9.+-]", "")
    return c.try_cast(MONEY_TYPE)


def conform(df: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Copy conversion onto a target schema (A5): select by name, try_cast each column.

    Doubles truncate toward zero into integer types; booleans are not read as numbers."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    cols = []
    for f in schema.fields:
        src = F.col(f.name)
        numeric_target = isinstance(f.dataType, T.NumericType)
        if numeric_target and isinstance(df.schema[f.name].dataType, T.BooleanType):
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))      # booleans are not numbers
        else:
            cols.append(src.try_cast(f.dataType).alias(f.name))
    return df.select(*cols)
