"""The seven measures (L1-L7) over the occupational-risk star model.

Blank handling follows the report language: a NULL ``Eliminated`` counts as FALSE (B11), a NULL
status as 0 (B10), ``Active`` is compared as an integer (Q12)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.operators.intervals import active_by_sweep, active_by_union
from stratum.operators.running import carry_forward
from stratum.operators.joins import broadcast_bounded
from stratum.plans.star import Measure, Relationship, StarModel

FACT, HIS, CAL, CLASS = "fact_occupational_risk", "fact_occupational_risk_his", "dim_calendar", "language_riskclass"

# The model's relationships (from column -> to column, active flag).
RELATIONSHIPS = (
    Relationship(FACT, "CreationDate", CAL, "DateRef"),
    Relationship(HIS, "StartDate", CAL, "DateRef"),
    Relationship(FACT, "UpdateDate", CAL, "DateRef", active=False),
    Relationship(HIS, "EndDate", CAL, "DateRef", active=False),
    Relationship(FACT, "ClassId", "dim_riskclass", "Id"),
    Relationship(HIS, "UnitId", "dim_unit", "UnitId"),
    Relationship(FACT, "UnitId", "dim_unit", "UnitId"),
    Relationship(HIS, "ClassId", CLASS, "Id"),
    Relationship(HIS, "LinearClassId", CLASS, "Id", active=False),
    Relationship(HIS, "MitigatedClassId", CLASS, "Id", active=False),
    Relationship(HIS, "LinearMitigatedClassId", CLASS, "Id", active=False),
    Relationship(FACT, "ClassId", CLASS, "Id"),
    Relationship(FACT, "LinearClassId", CLASS, "Id", active=False),
    Relationship(FACT, "LinearMitigatedClassId", CLASS, "Id", active=False),
    Relationship(FACT, "MitigatedClassId", CLASS, "Id", active=False),
)


def risk_model(tables: dict[str, DataFrame]) -> StarModel:
    """Bind gold tables to the model; ``dim_riskclass`` is served from ``dim_risk_class`` too (Q10)."""
    t = dict(tables)
    if "dim_riskclass" not in t and "dim_risk_class" in t:
        t["dim_riskclass"] = t["dim_risk_class"]
    return StarModel(t, list(RELATIONSHIPS))


def broadcast_calendar(days: DataFrame) -> DataFrame:
    """Calendar rows are days, one per date: at most 366 per year of the calendar's span (and never more
    than the ~3.65 million dates of years 1-9999), so the calendar has a size bound by construction and
    is broadcast without a counting job."""
    return F.broadcast(days)


def not_eliminated(col: str = "Eliminated") -> Column:
    return ~F.coalesce(F.col(col), F.lit(False))


def status_not(value: int = -1, col: str = "Status") -> Column:
    return F.coalesce(F.col(col), F.lit(0)) != F.lit(value)


def _rows(model: StarModel, role: str | None, by, out, dim_filter=None, fact_filter=None, cal_filter=None,
          zero_fill=True) -> DataFrame:
    ff = not_eliminated()
    if fact_filter is not None:
        ff = ff & fact_filter
    return model.count_rows(FACT, CLASS, list(by), out, role=role, fact_filter=ff, dim_filter=dim_filter,
                            zero_fill=zero_fill, where={CAL: cal_filter} if cal_filter is not None else None)


# The class role of each counting measure.
ROLES = {"active_risks": None, "active_risks_mitigated": "MitigatedClassId", "active_risks_rrn": "LinearClassId",
         "active_risks_rrn_mitigated": "LinearMitigatedClassId"}


def side_by_side(model: StarModel, names, by=("ptBR",), dim_filter=None, cal_filter=None, zero_fill: bool = True) -> DataFrame:
    """Several of the counting measures (L1, L2, L3, L5) as columns of one result, from one scan of the fact."""
    found = [Measure(n, {CLASS: ROLES[n]} if ROLES[n] else {}) for n in names]
    where = {d: c for d, c in ((CLASS, dim_filter), (CAL, cal_filter)) if c is not None}
    return model.summarize(FACT, [(CLASS, a) for a in by], found, where, not_eliminated(), zero_fill)


def active_risks(model, by=("ptBR",), **kw) -> DataFrame:
    """L1: COUNTROWS(fact) where not eliminated, active class role, +0."""
    return _rows(model, None, by, "active_risks", **kw)


def active_risks_mitigated(model, by=("ptBR",), **kw) -> DataFrame:
    """L2: role MitigatedClassId."""
    return _rows(model, "MitigatedClassId", by, "active_risks_mitigated", **kw)


def active_risks_rrn(model, by=("ptBR",), **kw) -> DataFrame:
    """L3: role LinearClassId."""
    return _rows(model, "LinearClassId", by, "active_risks_rrn", **kw)


def active_risks_rrn_mitigated(model, by=("ptBR",), **kw) -> DataFrame:
    """Role LinearMitigatedClassId."""
    return _rows(model, "LinearMitigatedClassId", by, "active_risks_rrn_mitigated", **kw)


def active_risks_rrn_acumulative(model: StarModel, by=("ptBR",)) -> DataFrame:
    """L4: rows up to each month's last calendar date, by class (LinearClassId role) and month, +0.

    Rows are counted per (class key, month) first; the window runs over months x classes only."""
    rel_cal = model.relationship(FACT, CAL)
    rel = model.relationship(FACT, CLASS, "LinearClassId")
    cal_days = model.table(CAL).select(F.col("DateRef").alias("__d"))
    f = model.table(FACT).filter(not_eliminated())
    f = f.join(broadcast_calendar(cal_days), f[rel_cal.from_col] == F.col("__d"), "left_semi")
    per = f.groupBy(F.col(rel.from_col).alias("__fkey"), F.last_day(F.col(rel_cal.from_col)).alias("month_end")) \
           .agg(F.count(F.lit(1)).alias("__n"))
    dim = model.table(CLASS).select(F.col(rel.to_col).alias("__dkey"), *by).distinct()
    keyed = per.join(broadcast_bounded(dim), per["__fkey"] == dim["__dkey"], "left")
    counts = keyed.groupBy(*by, "month_end").agg(F.sum("__n").alias("__n"))
    cal = model.table(CAL)
    first = cal.agg(F.last_day(F.min("DateRef"))).scalar()
    last = cal.agg(F.last_day(F.max("DateRef"))).scalar()
    # +0: every dimension member starts at the first calendar month with a zero row
    zeros = dim.select(*by).distinct().select(*by, first.alias("month_end"), F.lit(0).cast("long").alias("__n"))
    rows = counts.unionByName(zeros).groupBy(*by, "month_end").agg(F.sum("__n").alias("__n"))
    out = carry_forward(rows, list(by), "month_end", "__n", "active_risks_rrn_acumulative", last, start=first)
    return out.select(*by, F.year("month_end").alias("Year"), F.month("month_end").alias("MonthNumber"),
                      "active_risks_rrn_acumulative")


def _his_rows(model: StarModel, point_in_time: bool) -> DataFrame:
    h = model.table(HIS)
    cond = status_not(-1)
    if point_in_time:
        cond = cond & not_eliminated()
    else:
        cond = cond & (F.col("Active") == 1)
    return h.filter(cond)


def historicals(model: StarModel, by=("ptBR",), as_of=None, active_only: bool = True) -> DataFrame:
    """L6 at one date ``as_of`` (default: the calendar's last date), by class (MitigatedClassId role).

    active_only=True is the measure as written (Active = 1 rows); False is the point-in-time count of
    rows whose interval covers ``as_of`` through its month end (Q13, Q14)."""
    asof = F.lit(str(as_of)[:10]).cast("date") if as_of is not None else model.table(CAL).agg(F.max("DateRef")).scalar()
    rel = model.relationship(HIS, CLASS, "MitigatedClassId")
    h = _his_rows(model, not active_only)
    cover = (F.col("StartDate") <= asof) & (F.col("EndDate").isNull() | (F.col("EndDate") >= F.last_day(asof)))
    t = dict(model.tables)
    t[HIS] = h.filter(cover)
    return StarModel(t, model.relationships, model.dim_max_rows).distinct_count(
        HIS, CLASS, list(by), "OccupationalRiskId", "historicals", role=rel.from_col)


def historicals_by_month(model: StarModel, by=("ptBR",), disjoint: bool = False) -> DataFrame:
    """Point-in-time L6 at every calendar month end (interval coverage, C9), by class attribute.

    Exact for any history, also where a member's intervals overlap, and linear in the rows. ``disjoint=True`` is for
    histories whose intervals do not, as ``close_intervals`` leaves them: it needs no aggregate by member."""
    rel = model.relationship(HIS, CLASS, "MitigatedClassId")
    horizon = model.table(CAL).agg(F.last_day(F.max("DateRef"))).scalar()
    h = _his_rows(model, True).select(F.col(rel.from_col).alias("__fkey"), "OccupationalRiskId", "StartDate", "EndDate")
    dim = model.table(CLASS).select(F.col(rel.to_col).alias("__dkey"), *by).distinct()
    keyed = h.join(broadcast_bounded(dim), h["__fkey"] == dim["__dkey"], "left")
    if disjoint:
        out = active_by_sweep(keyed, list(by), "StartDate", "EndDate", "OccupationalRiskId", horizon, "historicals")
    else:
        out = active_by_union(keyed, list(by), "StartDate", "EndDate", "OccupationalRiskId", horizon, "historicals")
    return out.select(*by, F.year("month_end").alias("Year"), F.month("month_end").alias("MonthNumber"), "historicals")


def historicals_acumulative(model: StarModel, by=("ptBR",)) -> DataFrame:
    """Distinct risks with a (non-eliminated, active, status <> -1) row started on or before each
    month's last calendar date, by class and month; months after the first appearance carry the total.

    Each (class attribute, risk) pair is reduced to its first month (a combinable aggregate), then
    counted per month and summed over months: no pairs of rows, no range join."""
    h = model.table(HIS).filter(not_eliminated() & (F.col("Active") == 1) & status_not(-1))
    rel_cal = model.relationship(HIS, CAL)
    rel = model.relationship(HIS, CLASS, "MitigatedClassId")
    cal_days = model.table(CAL).select(F.col("DateRef").alias("__d"))
    h = h.join(broadcast_calendar(cal_days), h[rel_cal.from_col] == F.col("__d"), "left_semi")
    dim = model.table(CLASS).select(F.col(rel.to_col).alias("__dkey"), *by).distinct()
    keyed = h.select(F.col(rel.from_col).alias("__fkey"), "OccupationalRiskId", F.col(rel_cal.from_col).alias("__s"))
    keyed = keyed.join(broadcast_bounded(dim), keyed["__fkey"] == dim["__dkey"], "left")
    first = keyed.groupBy(*by, "OccupationalRiskId").agg(F.last_day(F.min("__s")).alias("month_end"))
    counts = first.groupBy(*by, "month_end").agg(F.count(F.lit(1)).alias("__n"))
    cal_end = model.table(CAL).agg(F.last_day(F.max("DateRef"))).scalar()
    out = carry_forward(counts, list(by), "month_end", "__n", "historicals_acumulative", cal_end)
    return out.select(*by, F.year("month_end").alias("Year"), F.month("month_end").alias("MonthNumber"),
                      "historicals_acumulative")
