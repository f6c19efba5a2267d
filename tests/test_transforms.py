"""Hierarchy (K2), calendar (K3), JSON widening (K25), names, casts, pivot, running totals."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from stratum.functions.casts import lenient_int
from stratum.functions.json import json_fields
from stratum.functions.names import ColumnNameCollision, clean_column_names
from stratum.operators import hierarchy as hier
from stratum.operators import running
from stratum.operators.calendar import calendar_from
from stratum.operators.pivot import language_pivot


def test_levels(spark):
    paths = [(1, None), (2, "A"), (3, "A>B"), (4, " A > B > C "), (5, ">".join(f"L{i}" for i in range(1, 10)))]
    df = spark.createDataFrame(paths, "Id int, path string")
    got = {r["Id"]: r for r in df.select("Id", *hier.level_columns("path", with_depth=True)).collect()}
    assert got[1]["Level1"] is None
    assert got[2]["Level1"] == "A" and got[2]["Level2"] is None
    assert (got[4]["Level1"], got[4]["Level3"]) == ("A", "C")
    assert got[5]["Level8"] == "L8" and got[5]["depth"] == 9          # 9th level is beyond the default 8
    nine = df.select("Id", *hier.level_columns("path", max_levels=9)).filter("Id = 5").first()
    assert nine["Level9"] == "L9"
    grouped = hier.pivot_levels_grouped(hier.explode_levels(df, "Id", "path"), "Id")
    direct = df.filter(F.col("path").isNotNull()).select("Id", *hier.level_columns("path"))
    assert sorted(map(tuple, grouped.collect())) == sorted(map(tuple, direct.collect()))


def test_calendar(spark):
    src = spark.createDataFrame([(dt.datetime(2024, 2, 27, 13),), (dt.datetime(2024, 3, 2),)], "DataCriacao timestamp_ntz")
    cal = calendar_from(src, "DataCriacao", "2024-05-01").collect()
    days = [r["DateRef"] for r in cal]
    assert days[0] == dt.date(2024, 2, 27) and days[-1] == dt.date(2024, 12, 31)
    assert all((b - a).days == 1 for a, b in zip(days, days[1:]))     # no gaps
    feb29 = next(r for r in cal if r["DateRef"] == dt.date(2024, 2, 29))
    assert feb29["DayOfWeekNumber"] == 5 and feb29["Semester"] == 1 and feb29["YearMonthDay"] == "20240229"
    empty = spark.createDataFrame([(None,)], "DataCriacao timestamp_ntz")
    assert calendar_from(empty, "DataCriacao", "2024-05-01").count() == 0


def test_lenient_int_and_json(spark):
    texts = ["12.5", "-3.9", "", "abc", "1e2", " 12 ", "+7", "99999999999", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "s string").select(lenient_int("s")).collect()]
    assert got == [12, -3, None, None, None, 12, 7, None, None]
    docs = ['{"a": 7, "b": "12", "c": 12.5, "d": true}', '{"a": null}', '{broken', None, '{"a": "x"}']
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    out = df.select(*json_fields("doc", {"a": "int", "b": "int", "c": "int", "d": "boolean", "missing": "int"})).collect()
    assert tuple(out[0]) == (7, 12, 12, True, None)
    assert all(v is None for r in out[1:] for v in r)


def test_clean_names(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `c/d` int")
    assert clean_column_names(df).columns == ["a_b", "c_d"]
    with pytest.raises(ColumnNameCollision):
        clean_column_names(spark.createDataFrame([(1, 2)], "`a b` int, `a/b` int"))


def test_language_pivot(spark):
    rows = [(13, 1, "Médio"), (13, 2, "Medium"), (13, 3, "Medio"), (9, 1, "Baixo"), (7, 1, "x")]
    out = {r["Id"]: r for r in language_pivot(spark.createDataFrame(rows, "Id int, IdiomaId int, Descricao string")).collect()}
    assert set(out) == {9, 13}
    assert (out[13]["enUS"], out[13]["Tolerability"]) == ("Medium", "Unacceptable")
    assert out[9]["enUS"] is None and out[9]["Tolerability"] == "Acceptable"


def test_running_distinct_equals_range_join(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    fast = {(r["event_type"], r["period"]): r["running_distinct"] for r in
            running.running_distinct(ev, ["event_type"], "ts", "user_id").collect()}
    e = ev.select("event_type", "user_id", F.to_date("ts").alias("d"))
    days = e.select("event_type", F.col("d").alias("period")).distinct()
    naive = days.join(e, (days.event_type == e.event_type) & (e.d <= days.period)) \
                .groupBy(days.event_type, "period").agg(F.countDistinct("user_id").alias("n"))
    for r in naive.collect():
        key = (r["event_type"], r["period"])
        if key in fast:
            assert fast[key] == r["n"]


def test_running_fill_carries_empty_periods(spark):
    import datetime as dt
    rows = [("a", dt.date(2024, 1, 3)), ("a", dt.date(2024, 1, 3)), ("a", dt.date(2024, 1, 6)), ("b", dt.date(2024, 1, 5))]
    df = spark.createDataFrame(rows, "g string, d date")
    out = running.running_count(df, ["g"], "d", fill_until=F.lit("2024-01-07").cast("date"))
    got = {(r["g"], r["period"].day): r["running_count"] for r in out.collect()}
    assert got == {("a", 3): 2, ("a", 4): 2, ("a", 5): 2, ("a", 6): 3, ("a", 7): 3, ("b", 5): 1, ("b", 6): 1, ("b", 7): 1}
    monthly = running.running_count(df, ["g"], "d", period="month", fill_until=F.lit("2024-03-15").cast("date"))
    got = {(r["g"], r["period"].month): r["running_count"] for r in monthly.collect()}
    assert got == {("a", 1): 3, ("a", 2): 3, ("a", 3): 3, ("b", 1): 1, ("b", 2): 1, ("b", 3): 1}


def test_json_select_matches_column_path(spark):
    from stratum.functions.json import json_select
    docs = ['{"a": 7, "b": "12", "c": 12.5, "d": true}', '{"a": "-3.9", "b": "1e2", "c": " 4 ", "d": "x"}',
            '{"a": null}', '{broken', None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id int, doc string")
    fields = {"a": "int", "b": "int", "c": "int", "d": "boolean"}
    wide = {r["id"]: tuple(r)[1:] for r in json_select(df, "doc", fields, keep=["id"]).collect()}
    narrow = {r["id"]: tuple(r)[1:] for r in df.select("id", *json_fields("doc", fields)).collect()}
    assert wide == narrow
    assert wide[0] == (7, 12, 12, True) and wide[1] == (-3, None, 4, None)


def test_money_and_infinity(spark):
    from stratum.functions.casts import infinity_to_null, money_to_decimal
    df = spark.createDataFrame([("$1,234.56", "infinity"), ("-1,000.00", "2024-01-02 03:04:05"), (None, "-infinity")],
                               "m string, ts string")
    out = df.select(money_to_decimal("m", text=True).alias("m"),
                    infinity_to_null("ts").try_cast("timestamp_ntz").alias("ts")).collect()
    assert [str(r["m"]) for r in out] == ["1234.56", "-1000.00", "None"]
    assert out[0]["ts"] is None and out[2]["ts"] is None and out[1]["ts"].day == 2


def test_load_clock():
    import datetime as dt
    from stratum.functions.audit import load_clock
    now = dt.datetime(2024, 3, 1, 2, 30, 15, 999, tzinfo=dt.timezone.utc)
    assert load_clock(now=now) == "2024-02-29 23:30:15"


def test_conform_copy_conversion(spark):
    from stratum.functions.casts import conform
    df = spark.createDataFrame([(12.9, True, "7", -3.5)], "a double, b boolean, c string, d double")
    r = conform(df, "a int, b int, c bigint, d int").first()
    assert (r["a"], r["b"], r["c"], r["d"]) == (12, None, 7, -3)
