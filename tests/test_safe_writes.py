"""Writes that must not lose rows: concurrent merges, odd column names, NULL keys, first loads, failed and mistyped writes."""
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from stratum.operators.joins import broadcast_bounded
from stratum.operators.merge import KeyViolation, SchemaMismatch, merge_frames
from stratum.operators.hierarchy import level_columns
from stratum.plans.summarize import summarize
from stratum.sources import tables as tb

TS = "2024-01-01 00:00:00"


def _name(stem):
    import uuid
    return f"safe_{uuid.uuid4().hex[:8]}.{stem}"


def test_concurrent_partitioned_merges_keep_all_rows(spark):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    targets = [tb.Target(_name(f"t{i}"), partition_columns=["p"]) for i in range(4)]
    rows = spark.range(100).select("id", (F.col("id") % 5).cast("int").alias("p"), F.lit("a").alias("v"))

    def go(t):
        tb.load(spark, rows, t, "merge", keys="id", run_ts=TS)
        part = rows.where("p = 2").withColumn("v", F.lit("b"))
        tb.load(spark, part, t, "merge", keys="id", run_ts=TS)
        out = spark.table(t.name)
        return out.count(), out.where("v = 'b'").count()
    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(go, targets)) == [(100, 20)] * 4
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_column_named_location(spark):
    t = tb.Target(_name("loc"))
    df = spark.createDataFrame([(1, "x")], "id int, Location string")
    tb.load(spark, df, t, "append", run_ts=TS)
    assert tb.load(spark, df, t, "append", run_ts=TS).count() == 2


def test_null_key_row_of_the_target_is_kept(spark):
    t = spark.createDataFrame([(None, "keepme"), (1, "a")], "id int, v string")
    s = spark.createDataFrame([(1, "b"), (2, "c")], "id int, v string")
    a = merge_frames(t.withColumns({"insert_date": F.lit(None).cast("timestamp_ntz"), "update_date": F.lit(None).cast("timestamp_ntz"), "hash_row": F.lit("")}),
                     s, "id", TS)
    assert {(r["id"], r["v"]) for r in a.collect()} == {(None, "keepme"), (1, "b"), (2, "c")}


def test_first_merge_load_checks_keys(spark):
    dup = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "id int, v string, at int")
    with pytest.raises(KeyViolation):
        tb.load(spark, dup, tb.Target(_name("k")), "merge", keys="id", run_ts=TS)
    out = tb.load(spark, dup, tb.Target(_name("k")), "merge", keys="id", run_ts=TS, on_duplicate="latest", order_by="at")
    assert [r["v"] for r in out.collect()] == ["b"]


def test_failed_bucketed_overwrite_leaves_the_old_table(spark):
    t = tb.Target(_name("b"), buckets=2, bucket_keys=["id"])
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    tb.create_table(spark, df, t)
    with pytest.raises(Exception):
        tb.overwrite(spark, df.withColumn("v", F.raise_error(F.lit("no")).cast("string")), t)
    assert [r["v"] for r in spark.table(t.name).collect()] == ["a"]


def test_append_of_another_type_raises_and_narrower_numbers_widen(spark):
    t = tb.Target(_name("q"))
    tb.append(spark, spark.createDataFrame([(1, 5)], "id int, q bigint"), t)
    with pytest.raises(SchemaMismatch):
        tb.append(spark, spark.createDataFrame([(1, "x")], "id int, q string"), t)
    out = tb.append(spark, spark.createDataFrame([(2, 6)], "id int, q int"), t)
    assert sorted(r["q"] for r in out.collect()) == [5, 6]


def test_partitioned_merge_prunes_the_target(spark):
    t = tb.Target(_name("p"), partition_columns=["p"])
    tb.create_table(spark, spark.range(10).select("id", (F.col("id") % 5).cast("int").alias("p")), t)
    f = tb._partition_filter(["p"], spark.createDataFrame([(2,), (None,)], "p int").collect())
    plan = spark.table(t.name).filter(f)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_deep_paths_keep_every_level(spark):
    deep = " > ".join("abcdefghijk")
    row = spark.createDataFrame([(deep,)], "path string").select(*level_columns("path", with_all=True)).first()
    assert row["Level8"] == "h" and row["Levels"] == deep


def test_summaries_are_not_rounded_and_names_do_not_clash(spark):
    df = spark.createDataFrame([("x", 0.001, 1.0), ("x", 0.002, 1.0)], "g string, a_x double, b_x double")
    out = summarize(df, ["g"], {"a_x": "sum", "b_x": "sum"}).first()
    assert abs(out["sum_a_x"] - 0.003) < 1e-12 and out["sum_b_x"] == 2.0


def test_broadcast_is_bounded_in_bytes(spark):
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("t"))

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(broadcast_bounded(wide)) and not hinted(broadcast_bounded(wide, max_bytes=5000))
