"""Dimension lookups with a proven broadcast bound."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Dimensions at or under this many rows are broadcast; above it the join stays a shuffle join
# (and AQE may still pick a broadcast from runtime statistics).
DEFAULT_BROADCAST_ROWS = 2_000_000
# ... and this many bytes.
DEFAULT_BROADCAST_BYTES = 64 << 20


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    A plain count is a two-phase aggregate (per-partition counts, then a sum), so checking a large
    dimension is one distributed scan. ``limit(n).count()`` would instead funnel up to n rows from
    every partition into a single task before counting."""
    return df.count() <= max_rows


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row written as text, so that wide columns and long texts count in full."""
    sizes = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(c), F.lit(0)) + 8)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(c.alias("v")))), F.lit(0)))
    fixed = F.lit(16 * (len(df.columns) - len(sizes))).cast("long")
    # one flat expression: a chain of as many sums as columns would be as deep
    return fixed + F.aggregate(F.array(*[s.cast("long") for s in sizes]), F.lit(0).cast("long"), lambda a, x: a + x) if sizes else fixed


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) in one distributed aggregate; see ``row_bytes``."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).first()
    return r["n"], r["bytes"]


def broadcast_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint only behind checked bounds of rows and bytes; otherwise the frame is returned as is."""
    n, size = measured(df)
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df


def lookup(fact: DataFrame, dim: DataFrame, on, how: str = "left", max_rows: int = DEFAULT_BROADCAST_ROWS,
           right_filter=None, distinct_right: bool = False) -> DataFrame:
    """Fact -> dimension lookup. A right-side constant condition is applied to the dimension first
    (C2); ``distinct_right`` deduplicates it so an unused lookup can be pruned (Q17)."""
    if right_filter is not None:
        dim = dim.filter(right_filter)
    if distinct_right:
        dim = dim.distinct()
    return fact.join(broadcast_bounded(dim, max_rows), on, how)
