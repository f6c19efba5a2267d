"""Interval coverage at month ends.

A row counts at date d when ``start <= d`` and (``end`` is NULL or ``end >= last_day(d)``). At month ends the row therefore
covers the month ends from last_day(start) up to its last covered month end. Three ways to count the members that cover
each month end, none of which joins ranges:

* ``active_by_union``: exact for any history, work in proportion to the rows. A member's rows are reduced to one per first
  month (a combinable aggregate, so at most one row per month is left of the hottest member), its intervals are united
  by a running maximum, and +1 / -1 at the union's edges are summed per month and carried forward.
* ``active_by_sweep``: the same sweep over the rows themselves, for histories in which one member's intervals never overlap
  (what history closing produces).
* ``distinct_active``: expands every row to the month ends it covers and counts distinct members (rows x covered months).

A NULL member counts as one value."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_covered_month_end(end_col: str, horizon: Column) -> Column:
    e = F.col(end_col)
    # the latest month end m with last_day(m) <= end: end itself when it is a month end, else the previous one
    prev = F.last_day(F.add_months(e, -1))
    return F.when(e.isNull(), horizon).otherwise(F.when(F.last_day(e) == e, e).otherwise(prev))


def covered_month_ends(df: DataFrame, start_col: str, end_col: str, horizon: Column, out: str = "month_end") -> DataFrame:
    first = F.last_day(F.col(start_col))
    last = F.least(last_covered_month_end(end_col, horizon), horizon)
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    return df.select(*df.columns, F.explode(months).alias("__m")).select(*df.columns, F.last_day("__m").alias(out))


def distinct_active(df: DataFrame, groups: list[str], start_col: str, end_col: str, member: str,
                    horizon: Column, out: str = "active", axis: str = "month_end") -> DataFrame:
    """DISTINCTCOUNT(member) of rows covering each month end; a NULL member counts as one value."""
    exp = covered_month_ends(df, start_col, end_col, horizon, axis)
    return exp.groupBy(*groups, axis).agg(
        (F.countDistinct(member) + F.max(F.col(member).isNull().cast("int"))).cast("long").alias(out))


def active_by_sweep(df: DataFrame, groups: list[str], start_col: str, end_col: str, member: str,
                    horizon: Column, out: str = "active", axis: str = "month_end") -> DataFrame:
    from stratum.operators.running import carry_forward
    first = F.last_day(F.col(start_col))
    last = F.least(last_covered_month_end(end_col, horizon), horizon)
    live = df.select(*groups, first.alias("__f"), last.alias("__l"), F.col(member).isNull().alias("__z")) \
             .filter(F.col("__f") <= F.col("__l"))
    n = F.when(F.col("__z"), 0).otherwise(1)
    z = F.when(F.col("__z"), 1).otherwise(0)
    opens = live.select(*groups, F.col("__f").alias(axis), n.alias("__dn"), z.alias("__dz"))
    closes = live.filter(F.col("__l") < horizon).select(
        *groups, F.last_day(F.add_months("__l", 1)).alias(axis), (-n).alias("__dn"), (-z).alias("__dz"))
    deltas = opens.unionByName(closes).groupBy(*groups, axis).agg(F.sum("__dn").alias("__dn"), F.sum("__dz").alias("__dz"))
    carried = carry_forward(deltas, list(groups), axis, ["__dn", "__dz"], ["__n", "__nz"], horizon)
    total = F.col("__n") + F.when(F.col("__nz") > 0, 1).otherwise(0)
    return carried.select(*groups, axis, total.cast("long").alias(out)).filter(F.col(out) > 0)


def active_by_union(df: DataFrame, groups: list[str], start_col: str, end_col: str, member: str,
                    horizon: Column, out: str = "active", axis: str = "month_end") -> DataFrame:
    """Distinct members per month end whose intervals may overlap; see the module's docstring."""
    from stratum.operators.running import carry_forward
    last = F.least(last_covered_month_end(end_col, horizon), horizon)
    rows = df.select(*groups, F.col(member).alias("__member"), F.last_day(F.col(start_col)).alias("__f"), last.alias("__l")).filter(F.col("__f") <= F.col("__l"))
    per_month = rows.groupBy(*groups, "__member", "__f").agg(F.max("__l").alias("__l"))
    w = Window.partitionBy(*groups, "__member").orderBy("__f")
    upto = F.max("__l").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.max("__l").over(w.rowsBetween(Window.unboundedPreceding, -1))
    edges = per_month.select(*groups, "__f", upto.alias("__end"), before.alias("__before"), F.lead("__f").over(w).alias("__next"))
    # a row beyond all earlier ends opens an interval of the union; a row whose successor does so closes one
    opens = edges.filter(F.col("__before").isNull() | (F.col("__f") > F.col("__before"))).select(*groups, F.col("__f").alias(axis), F.lit(1).alias("__d"))
    closes = edges.filter((F.col("__next").isNull() | (F.col("__next") > F.col("__end"))) & (F.col("__end") < horizon)) \
                  .select(*groups, F.last_day(F.add_months("__end", 1)).alias(axis), F.lit(-1).alias("__d"))
    deltas = opens.unionByName(closes).groupBy(*groups, axis).agg(F.sum("__d").alias("__d"))
    return carry_forward(deltas, list(groups), axis, "__d", out, horizon).filter(F.col(out) > 0)
