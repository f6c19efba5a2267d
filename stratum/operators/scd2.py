"""History closing (E2 / C5 / K5): each row of a key is closed by the start of the next one.

Where a later row of the same key exists and starts on or after this one, the row becomes
``Active = 0`` with ``EndDate = next start - 1 day``; otherwise ``Active = 1`` and ``EndDate`` NULL.
Closing is recomputed over the whole key history (idempotent: a rebuild equals the incremental
result, Q23), ties are broken on the row id (Q22) and NULL keys are never chained (Q21)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators.sequence import with_successor, with_successor_window


def close_intervals(df: DataFrame, key: str, order: list[str], start: str = "StartDate",
                    active: str = "Active", end: str = "EndDate", active_only: bool = False,
                    skew_safe: bool = True, partitions: int | None = None) -> DataFrame:
    """Set ``active``/``end`` from the successor's ``start``.

    ``active_only=True`` reproduces the as-written variant: only rows currently active take part in
    the ordering, inactive rows are left as they are."""
    cols = df.columns
    if active_only and active in cols:
        live = df.filter(F.col(active) == 1)
        rest = df.filter(~(F.col(active) == 1) | F.col(active).isNull())
    else:
        live, rest = df, None
    if skew_safe:
        nxt = with_successor(live, key, order, [start], prefix="__next_", partitions=partitions)
    else:
        nxt = with_successor_window(live, key, order, [start], prefix="__next_")
    ns = F.col(f"__next_{start}")
    closes = ns.isNotNull() & (ns >= F.col(start))
    closed = nxt.select(*[c for c in cols if c not in (active, end)],
                        F.when(closes, F.lit(0)).otherwise(F.lit(1)).alias(active),
                        F.when(closes, F.date_sub(ns, 1)).otherwise(F.lit(None).cast("date")).alias(end))
    closed = closed.select(*cols) if set(cols) >= {active, end} else closed
    if rest is not None:
        closed = closed.unionByName(rest.select(*closed.columns))
    return closed
