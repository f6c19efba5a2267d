"""Running totals over a date axis.

Rows are aggregated to (group, period) before any window, so the window input is
periods x groups and a hot group never reaches a window as raw rows. Distinct members are
counted at their first appearance (an aggregate that combines map-side), which equals the
range join "all dates <= d" without producing any pairs."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _axis(date_col, period: str) -> Column:
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    if period == "day":
        return F.to_date(d)
    if period == "month":
        return F.last_day(F.to_date(d))
    raise ValueError(period)


def _carry(counts: DataFrame, groups: list[str], axis: str, value: str, out: str,
           fill_until: Column | None, step: str) -> DataFrame:
    if fill_until is None:
        w = Window.partitionBy(*groups).orderBy(axis).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return counts.select(*groups, axis, F.sum(value).over(w).alias(out))
    # periods without rows still show the carried total
    end = F.last_day(fill_until) if step == "month" else fill_until
    return carry_forward(counts, groups, axis, value, out, end, step=step)


def carry_forward(counts: DataFrame, groups: list[str], axis: str, value, out, end: Column,
                  start: Column | None = None, step: str = "month") -> DataFrame:
    """Running total per group over month ends, carried through months without rows, up to ``end``.

    One pass over the (small) per-period counts: a running sum and the next period with rows, then each
    row expands to the months until that next period. With ``start``, a group's months before its first
    row are emitted with 0 (zero rows from the start of the axis). No grid is joined back."""
    values = [value] if isinstance(value, str) else list(value)
    outs = [out] if isinstance(out, str) else list(out)
    w = Window.partitionBy(*groups).orderBy(axis)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = counts.select(*groups, axis,
                      *[F.sum(v).over(upto).alias(f"__total{i}") for i, v in enumerate(values)],
                      F.lead(axis).over(w).alias("__next"), F.lag(axis).over(w).alias("__prev"),
                      end.alias("__end"), (start if start is not None else F.lit(None).cast("date")).alias("__start"))
    if step == "month":
        prev_of_next, interval, norm = F.last_day(F.add_months("__next", -1)), F.expr("interval 1 month"), F.last_day
    else:
        prev_of_next, interval, norm = F.date_sub("__next", 1), F.expr("interval 1 day"), (lambda x: x)
    stop = F.coalesce(prev_of_next, F.col("__end"))
    begin = F.when(F.col("__prev").isNull() & F.col("__start").isNotNull() & (F.col("__start") < F.col(axis)),
                   F.col("__start")).otherwise(F.col(axis))
    totals = [f"__total{i}" for i in range(len(values))]
    e = c.select(*groups, axis, *totals, F.explode(F.sequence(begin, stop, interval)).alias("__m"))
    m = norm(F.col("__m"))
    return e.select(*groups, m.alias(axis),
                    *[F.when(m < F.col(axis), F.lit(0)).otherwise(F.col(t)).cast("long").alias(o)
                      for t, o in zip(totals, outs)])


def running_count(df: DataFrame, groups: list[str], date_col: str, out: str = "running_count",
                  period: str = "day", axis: str = "period", fill_until: Column | None = None) -> DataFrame:
    counts = df.groupBy(*groups, _axis(date_col, period).alias(axis)).agg(F.count(F.lit(1)).alias("__n"))
    return _carry(counts, groups, axis, "__n", out, fill_until, period)


def running_distinct(df: DataFrame, groups: list[str], date_col: str, member: str, out: str = "running_distinct",
                     period: str = "day", axis: str = "period", fill_until: Column | None = None) -> DataFrame:
    """Cumulative distinct members per group; a NULL member counts as one value (blank counts)."""
    first = df.groupBy(*groups, member).agg(F.min(_axis(date_col, period)).alias(axis))
    counts = first.groupBy(*groups, axis).agg(F.count(F.lit(1)).alias("__n"))
    return _carry(counts, groups, axis, "__n", out, fill_until, period)
