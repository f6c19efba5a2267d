"""Managed tables (A11), digests in place of rows (B17, D6), a narrow successor (E2), reports in order."""
import datetime as dt
import os
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from stratum.operators.distinct import distinct_rows
from stratum.operators.sequence import with_successor, with_successor_window
from stratum.proxies.registry import load_all
from stratum.session import scratch_path
from stratum.sources import tables as tb
from tests.conftest import SMOKE
from tools.check_oracle import TABLES, norm

QUERIES, ORACLE = load_all()
T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def new_target(**kw):
    return tb.Target(f"managed_{uuid.uuid4().hex[:8]}.t", "managed", **kw)


def folder(spark, t):
    return tb.location(spark, t.name).removeprefix("file:")


@pytest.mark.parametrize("kw", [{}, {"partition_columns": ["g"]}, {"buckets": 3, "bucket_keys": ["k"]}])
def test_managed_table_is_the_catalogs_own(spark, kw):
    t = new_target(**kw)
    df = spark.range(20).select(F.col("id").alias("k"), (F.col("id") % 4).alias("g"), F.lit("a").alias("v"))
    tb.load(spark, df, t, "merge", keys="k", run_ts=T1)
    changed = df.filter("k < 5").withColumn("v", F.lit("b")).unionByName(spark.range(20, 23).selectExpr("id AS k", "id % 4 AS g", "'n' AS v"))
    tb.load(spark, changed, t, "merge", keys="k", run_ts=T2)
    got = {r["k"]: (r["v"], r["insert_date"], r["update_date"]) for r in spark.table(t.name).collect()}
    assert len(got) == 23 and {k for k, v in got.items() if v[0] == "b"} == set(range(5))
    assert got[0][1] == T1 and got[10][1] == T1 and got[21][1] == T2
    assert tb.metadata(spark, t.name)["type"] == "MANAGED"
    place = folder(spark, t)
    assert os.path.isdir(place) and place.rstrip("/").endswith("/t")
    spark.sql(f"DROP TABLE {t.name}")
    assert not os.path.exists(place)
    tb.create_table(spark, df, t)                       # the name and its folder are free again
    assert spark.table(t.name).count() == 20


def test_managed_overwrite_and_append(spark):
    t = new_target()
    tb.create_table(spark, spark.range(5).selectExpr("id AS k", "'a' AS v"), t)
    tb.overwrite(spark, spark.table(t.name).selectExpr("k + 10 AS k"), t)          # reads what it replaces
    assert sorted(r[0] for r in spark.table(t.name).collect()) == [10, 11, 12, 13, 14]
    assert spark.table(t.name).columns == ["k"]
    tb.append(spark, spark.range(2).selectExpr("id AS k", "'x' AS w"), t)
    assert sorted((r["k"], r["w"]) for r in spark.table(t.name).filter("k < 10").collect()) == [(0, "x"), (1, "x")]
    assert spark.table(t.name).count() == 7 and tb.metadata(spark, t.name)["type"] == "MANAGED"


def test_managed_partition_that_empties(spark):
    t = new_target(partition_columns=["g"])
    tb.load(spark, spark.createDataFrame([(1, "a"), (2, "b")], "k int, g string"), t, "merge", keys="k", run_ts=T1)
    tb.load(spark, spark.createDataFrame([(1, "b")], "k int, g string"), t, "merge", keys="k", run_ts=T2)
    assert sorted((r["k"], r["g"]) for r in spark.table(t.name).collect()) == [(1, "b"), (2, "b")]
    assert tb.metadata(spark, t.name)["type"] == "MANAGED"


def test_failed_managed_overwrite_leaves_the_table(spark):
    t = new_target()
    tb.create_table(spark, spark.range(3).toDF("k"), t)
    with pytest.raises(Exception):
        tb.overwrite(spark, spark.range(3).select(F.raise_error(F.lit("stop")).cast("int").alias("k")), t)
    assert spark.table(t.name).count() == 3


def stored(spark, df):
    path = scratch_path(spark, "test_rows")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def test_distinct_rows_equals_distinct(spark):
    rows = [(1, "a", 0.0), (1, "a", -0.0), (1, "a", None), (1, "a", None), (None, None, None), (None, None, None),
            (2, "b", float("nan")), (2, "b", float("nan")), (3, "c", 1.0)]
    df = stored(spark, spark.createDataFrame(rows, "k int, `v w` string, x double"))
    hot = stored(spark, spark.range(6000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id % 1500 END AS k", "repeat('x', 50) AS v"))
    for some in (df, hot, df.filter("k > 99")):
        for limit in (0, 2_000_000):      # rows grouped directly, and by digests
            assert same(distinct_rows(some, limit), some.distinct())


def test_distinct_rows_exchanges_digests(spark):
    """Whole rows cross an exchange only after they were matched with a repeated digest."""
    df = stored(spark, spark.range(1000).selectExpr("id AS k", "repeat('x', 50) AS v"))
    out = distinct_rows(df)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [__digest" in text and "LeftAnti" in text
    assert "SortMergeJoin" not in text and text.count("Exchange hashpartitioning") == 1      # of the repeated rows alone
    assert out.count() == 1000


def test_successor_with_repeats_nulls_and_empty(spark):
    rows = [(1, 1, "a"), (1, 1, "a"), (1, 2, None), (None, 1, "n"), (None, 2, "m"), (2, None, "x"), (2, 5, "y")]
    df = spark.createDataFrame(rows, "k int, o int, v string").withColumn("void", F.lit(None).cast("string"))
    for chain in (False, True):
        for some in (df, df.limit(0)):
            a = with_successor(some, "k", ["o"], ["v"], partitions=3, chain_nulls=chain)
            assert same(a, with_successor_window(some, "k", ["o"], ["v"], chain_nulls=chain))


def test_successor_exchanges_narrow_rows(spark):
    df = spark.range(500).selectExpr("id % 7 AS k", "id AS o", "repeat('w', 100) AS wide")
    jvm = with_successor(df, "k", ["o"], ["o"])._jdf.queryExecution()
    plan = jvm.optimizedPlan().toString()
    right = plan[plan.index("Join LeftOuter"):].split("\n", 2)[2]
    assert "wide" in plan and "Join Inner" in right
    narrow = right[right.index("Join Inner"):]
    assert "wide" not in narrow                          # only number, key, order and carried values meet on positions


ORDERED = {"f1_sort_by_measure_desc": "n_customers DESC, n_name", "f2_sort_multi_asc": "Year, MonthNumber",
           "l8_column_chart": "active_risks_rrn_mitigated DESC, class_name", "l9_pie_unacceptable": "active_risks_rrn_mitigated DESC, class_name",
           "l10_time_chart": "Year, MonthNumber, class_name"}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_sorted_reports_come_in_order(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    keys = ", ".join(k + " NULLS LAST" if "DESC" in k else k + " NULLS FIRST" for k in ORDERED[name].split(", "))
    df = QUERIES[name](spark, SMOKE)
    cols = ", ".join(f'"{c}"' for c in df.columns)
    want = con.execute(f"SELECT {cols} FROM ({ORACLE[name]}) ORDER BY {keys}").fetchall()
    assert [tuple(map(norm, r)) for r in df.collect()] == [tuple(map(norm, r)) for r in want]
