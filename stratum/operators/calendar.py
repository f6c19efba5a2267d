"""Calendar dimension (K3, H9-H12): one row per day from the first date to 31 December of a year."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.functions.dates import date_lit, format_ntz, semester, year_end


def calendar_columns(d: Column) -> list[Column]:
    return [d.alias("DateRef"),
            F.dayofmonth(d).alias("DayNumber"),
            F.month(d).alias("MonthNumber"),
            F.year(d).alias("Year"),
            F.quarter(d).alias("Quarter"),
            semester(d).alias("Semester"),
            format_ntz(d, "yyyyMMdd").alias("YearMonthDay"),
            F.dayofweek(d).alias("DayOfWeekNumber"),
            F.dayofyear(d).alias("DayOfYear")]


def calendar_from(source: DataFrame, date_col: str, run_date) -> DataFrame:
    """Days from MIN(date_col) to 31 Dec of ``run_date``'s year. A NULL minimum gives no rows.

    The bounds are one aggregated row; the sequence then holds (years x 366) dates at most."""
    bounds = source.agg(F.min(F.col(date_col)).alias("start")) \
                   .select(F.to_date("start").alias("start"), year_end(date_lit(run_date)).alias("end"))
    days = bounds.select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("d"))
    return days.select(*calendar_columns(F.col("d")))
