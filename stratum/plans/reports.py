"""Report queries (L8-L15): each visual is one DataFrame over the star model.

Sorting follows the visual (measure descending, name as tie-break)."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.plans import measures as M
from stratum.plans.star import StarModel

# The tolerability label the cards and the pie filter on, and the class code shown
# by each single-class card.
UNACCEPTABLE = "Unacceptable"
CLASS_CARDS = {"Acceptable": 12, "Low": 9, "Medium": 13, "High": 14, "Critical": 15}


def _year(year: int | None) -> Column | None:
    return None if year is None else (F.col("Year") == F.lit(year))


def column_chart(model: StarModel, year: int | None = None, name: str = "ptBR") -> DataFrame:
    """RRN mitigated and RRN by class name, blank class dropped, sorted by the first, descending."""
    both = M.side_by_side(model, ("active_risks_rrn_mitigated", "active_risks_rrn"), (name,), cal_filter=_year(year))
    return both.filter(F.col(name).isNotNull()).withColumnRenamed(name, "class_name") \
               .orderBy(F.desc("active_risks_rrn_mitigated"), "class_name")


def pie_unacceptable(model: StarModel, year: int | None = None, name: str = "ptBR") -> DataFrame:
    """RRN mitigated by class name where Tolerability = 'Unacceptable'."""
    out = M.active_risks_rrn_mitigated(model, (name,), dim_filter=F.col("Tolerability") == UNACCEPTABLE,
                                       cal_filter=_year(year))
    return out.select(F.col(name).alias("class_name"), "active_risks_rrn_mitigated") \
              .orderBy(F.desc("active_risks_rrn_mitigated"), "class_name")


def time_chart(model: StarModel, year: int | None = None, name: str = "ptBR") -> DataFrame:
    """Cumulative historical risks by Year, Month and class name, ascending.
    The year slicer only selects which months are shown; accumulation starts at the beginning."""
    out = M.historicals_acumulative(model, (name,))
    if year is not None:
        out = out.filter(F.col("Year") == year)
    return out.select("Year", "MonthNumber", F.col(name).alias("class_name"), "historicals_acumulative") \
              .orderBy("Year", "MonthNumber", "class_name")


def _total(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.coalesce(F.sum(col), F.lit(0)).cast("long").alias(col))


def card_mitigated_total(model: StarModel, year: int | None = None) -> DataFrame:
    """Active Risks Mitigated over everything (one row)."""
    return _total(M.active_risks_mitigated(model, ("Id",), cal_filter=_year(year), zero_fill=False),
                  "active_risks_mitigated")


def cards_by_class(model: StarModel, year: int | None = None) -> DataFrame:
    """One card per class code: RRN mitigated with LinearMitigatedClassId = code (0 when none)."""
    codes = list(CLASS_CARDS.values())
    per = M.active_risks_rrn_mitigated(model, ("Id",), dim_filter=F.col("Id").isin(*codes), cal_filter=_year(year))
    spark = model.table(M.CLASS).sparkSession
    cards = spark.createDataFrame([(k, v) for k, v in CLASS_CARDS.items()], "card string, class_id int")
    j = cards.alias("__c").join(per.alias("__p"), F.col("__c.class_id") == F.col("__p.Id"), "left")
    return j.select("card", "class_id", F.coalesce(F.col("__p.active_risks_rrn_mitigated"), F.lit(0)).cast("long")
                    .alias("active_risks_rrn_mitigated"))


def card_unacceptable(model: StarModel, year: int | None = None) -> DataFrame:
    """RRN mitigated over the unacceptable classes (one row)."""
    per = M.active_risks_rrn_mitigated(model, ("Id",), dim_filter=F.col("Tolerability") == UNACCEPTABLE,
                                       cal_filter=_year(year))
    return _total(per, "active_risks_rrn_mitigated")


def card_expiring(model: StarModel, run_date, year: int | None = None) -> DataFrame:
    """Active risks whose evaluation expires on ``run_date`` (between today and today)."""
    d = run_date.isoformat() if isinstance(run_date, (_dt.date, _dt.datetime)) else str(run_date)
    today = F.lit(d[:10]).cast("date")
    per = M.active_risks(model, ("Id",), fact_filter=F.col("EvaluationExpirationDate").between(today, today),
                         cal_filter=_year(year), zero_fill=False)
    return _total(per, "active_risks")


def slicer_years(model: StarModel) -> DataFrame:
    """The year slicer's values (calendar years)."""
    return model.table(M.CAL).select("Year").distinct().orderBy("Year")
