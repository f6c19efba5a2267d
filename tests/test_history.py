"""Skew-safe successor and interval closing."""
import datetime as dt

from pyspark.sql import functions as F

from stratum.operators.scd2 import close_intervals
from stratum.operators.sequence import with_successor, with_successor_window


def test_successor_matches_window_with_a_hot_key(spark):
    # key 0 holds half of all rows; it must still equal the window answer
    df = spark.range(0, 4000).select(F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 97).alias("k"),
                                     (F.col("id") * 7919 % 4000).alias("o"), F.col("id").alias("v"))
    a = with_successor(df, "k", ["o", "v"], ["v"], partitions=16)
    b = with_successor_window(df, "k", ["o", "v"], ["v"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def hist(spark, rows):
    return spark.createDataFrame(rows, "k int, id int, ts timestamp_ntz, StartDate date, Active int, EndDate date")


def ts(day, h=0):
    return dt.datetime(2024, 1, day, h)


def test_close_intervals(spark):
    rows = [(1, 1, ts(1), dt.date(2024, 1, 1), 1, None),
            (1, 2, ts(5), dt.date(2024, 1, 5), 1, None),
            (1, 3, ts(5, 3), dt.date(2024, 1, 5), 1, None),     # same-day successor
            (2, 4, ts(2), dt.date(2024, 1, 2), 1, None),         # single row
            (None, 5, ts(1), dt.date(2024, 1, 1), 1, None),      # NULL key: never chained
            (None, 6, ts(2), dt.date(2024, 1, 2), 1, None)]
    out = {r["id"]: (r["Active"], r["EndDate"]) for r in
           close_intervals(hist(spark, rows), "k", ["ts", "id"], partitions=4).collect()}
    assert out[1] == (0, dt.date(2024, 1, 4))
    assert out[2] == (0, dt.date(2024, 1, 4))    # empty interval kept as written
    assert out[3] == (1, None)
    assert out[4] == (1, None)
    assert out[5] == (1, None) and out[6] == (1, None)


def test_closing_is_idempotent(spark):
    rows = [(1, i, ts(i), dt.date(2024, 1, i), 1, None) for i in range(1, 6)]
    once = close_intervals(hist(spark, rows), "k", ["ts", "id"])
    twice = close_intervals(once, "k", ["ts", "id"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    closed = sorted((r["StartDate"], r["EndDate"]) for r in once.collect())
    for (s1, e1), (s2, _) in zip(closed, closed[1:]):
        assert e1 < s2                       # intervals of one key never overlap
