"""Merge (A15), change feed (A20), load modes (A22) on hand-written fixtures and properties."""
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from stratum.functions.audit import with_audit_columns
from stratum.operators.merge import KeyViolation, SchemaMismatch, change_feed, merge_frames, merge_plan
from stratum.sources import tables as tb

SCHEMA = "id int, name string, score int"
T1, T2, T3 = "2024-01-01 10:00:00", "2024-02-01 10:00:00", "2024-03-01 10:00:00"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_actions(spark):
    tgt = with_audit_columns(spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3), (4, None, 4)], SCHEMA), T1)
    src = spark.createDataFrame([(1, "a", 1), (2, "b", 20), (5, "e", 5), (4, "", 4)], SCHEMA)
    plan = merge_plan(tgt, src, "id", T2)
    actions = dict((r["id"], r["_action"]) for r in plan.collect())
    # NULL and '' hash alike in compat mode (Q5), so id 4 is a no-op
    assert actions == {1: "noop", 2: "update", 3: "keep", 4: "noop", 5: "insert"}
    strict = dict((r["id"], r["_action"]) for r in merge_plan(
        with_audit_columns(tgt, T1, mode="strict"), src, "id", T2, hash_mode="strict").collect())
    assert strict[4] == "update"
    out = {r["id"]: r for r in merge_frames(tgt, src, "id", T2).collect()}
    assert out[2]["score"] == 20 and str(out[2]["insert_date"]) == T1 and str(out[2]["update_date"]) == T2
    assert out[3]["name"] == "c" and str(out[3]["update_date"]) == T1
    # the update also carries the new hash (Q1)
    assert out[2]["hash_row"] != tgt.filter("id = 2").first()["hash_row"]


def test_revert_is_applied(spark):
    base = spark.createDataFrame([(1, "a", 1)], SCHEMA)
    t = with_audit_columns(base, T1)
    t = merge_frames(t, spark.createDataFrame([(1, "a", 2)], SCHEMA), "id", T2)
    t = merge_frames(t, base, "id", T3)
    r = t.first()
    assert r["score"] == 1 and str(r["update_date"]) == T3


def test_key_checks(spark):
    tgt = with_audit_columns(spark.createDataFrame([(1, "a", 1)], SCHEMA), T1)
    with pytest.raises(KeyViolation):
        merge_frames(tgt, spark.createDataFrame([(None, "x", 1)], SCHEMA), "id", T2).collect()
    with pytest.raises(KeyViolation):
        merge_frames(tgt, spark.createDataFrame([(2, "x", 1), (2, "y", 2)], SCHEMA), "id", T2).collect()
    latest = merge_frames(tgt, spark.createDataFrame([(2, "x", 1), (2, "y", 2)], SCHEMA), "id", T2,
                          on_duplicate="latest", order_by="score")
    assert {r["name"] for r in latest.filter("id = 2").collect()} == {"y"}
    with pytest.raises(SchemaMismatch):
        merge_frames(tgt, spark.createDataFrame([(1, "a")], "id int, name string"), "id", T2)


def test_merge_without_hash_compares_columns(spark):
    tgt = with_audit_columns(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA), T1, add_hash=False)
    src = spark.createDataFrame([(1, "a", 1), (2, "b", 3)], SCHEMA)
    acts = {r["id"]: r["_action"] for r in merge_plan(tgt, src, "id", T2, add_hash=False).collect()}
    assert acts == {1: "noop", 2: "update"}


def test_change_feed(spark):
    tgt = with_audit_columns(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA), T1)
    src = spark.createDataFrame([(2, "b", 3), (3, "c", 3)], SCHEMA)
    cf = change_feed(tgt, src, "id", T2)
    got = sorted((r["id"], r["_change_type"], r["score"]) for r in cf.collect())
    assert got == [(2, "update_postimage", 3), (2, "update_preimage", 2), (3, "insert", 3)]


row = st.tuples(st.integers(0, 8), st.sampled_from(["a", "b", None]), st.integers(0, 3))


def dedup(rs):
    return list({r[0]: r for r in rs}.values())


@settings(max_examples=15, deadline=None)
@given(st.lists(row, max_size=8), st.lists(row, max_size=8))
def test_merge_properties(spark, t_rows, s_rows):
    t_rows, s_rows = dedup(t_rows), dedup(s_rows)
    tgt = with_audit_columns(spark.createDataFrame(t_rows, SCHEMA), T1)
    src = spark.createDataFrame(s_rows, SCHEMA)
    once = merge_frames(tgt, src, "id", T2)
    twice = merge_frames(once, src, "id", T3)
    data = lambda df: sorted(tuple(r) for r in df.drop("insert_date", "update_date").collect())
    assert data(once) == data(twice)                          # idempotent
    assert rows(twice) == rows(once)                          # second run changes nothing, not even dates
    keys = {r[0] for r in s_rows} | {r[0] for r in t_rows}
    assert {r["id"] for r in once.collect()} == keys          # union of keys, nothing deleted
    empty = with_audit_columns(spark.createDataFrame([], SCHEMA), T1)
    assert data(merge_frames(empty, src, "id", T2)) == data(with_audit_columns(src, T2))


def test_load_modes(spark):
    t = tb.Target("test_loads.people", "external")
    df = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA)
    out = tb.load(spark, df, t, "merge", keys="id", run_ts=T1)
    assert out.count() == 2 and "hash_row" in out.columns
    out = tb.load(spark, spark.createDataFrame([(2, "b", 5), (3, "c", 3)], SCHEMA), t, "merge", keys="id", run_ts=T2)
    assert rows(out.select("id", "score")) == [(1, 1), (2, 5), (3, 3)]
    out = tb.load(spark, spark.createDataFrame([(9, "z", 9)], SCHEMA), t, "append", run_ts=T3)
    assert out.count() == 4
    out = tb.load(spark, spark.createDataFrame([(7, "q")], "id int, name string"), t, "overwrite", run_ts=T3)
    assert out.columns[:2] == ["id", "name"] and out.count() == 1
    with pytest.raises(tb.UnknownLoadMode):
        tb.load(spark, df, t, "upsert", run_ts=T3)


@settings(max_examples=10, deadline=None)
@given(st.lists(row, max_size=8), st.lists(row, max_size=8))
def test_merge_is_source_plus_target_only_rows(spark, t_rows, s_rows):
    """A full reload merged into a target equals the source rows plus the target rows it does not mention."""
    t_rows, s_rows = dedup(t_rows), dedup(s_rows)
    tgt = with_audit_columns(spark.createDataFrame(t_rows, SCHEMA), T1)
    src = spark.createDataFrame(s_rows, SCHEMA)
    merged = sorted(tuple(r) for r in merge_frames(tgt, src, "id", T2).select("id", "name", "score").collect())
    src_keys = {r[0] for r in s_rows}
    expected = sorted([tuple(r) for r in s_rows] + [tuple(r) for r in t_rows if r[0] not in src_keys])
    assert merged == expected


def test_partitioned_merge_rewrites_only_touched_partitions(spark):
    import glob
    schema = "id int, name string, score int, part string"
    t = tb.Target("test_pmerge.people", "external", partition_columns="part")
    base = spark.createDataFrame([(1, "a", 1, "x"), (2, "b", 2, "x"), (3, "c", 3, "y"), (4, "d", 4, "z")], schema)
    tb.load(spark, base, t, "merge", keys="id", run_ts=T1)
    loc = tb.location(spark, t.name).replace("file:", "")
    before = {p: sorted(glob.glob(f"{loc}/part={p}/*.parquet")) for p in "xyz"}
    # id 2 changes, id 3 moves from y to x (y keeps id 6), id 5 is new in x; partition z is not touched
    tb.load(spark, spark.createDataFrame([(6, "f", 6, "y")], schema), t, "merge", keys="id", run_ts=T1)
    loc = tb.location(spark, t.name).replace("file:", "")
    before = {p: sorted(glob.glob(f"{loc}/part={p}/*.parquet")) for p in "xyz"}
    src = spark.createDataFrame([(2, "b", 20, "x"), (3, "c", 3, "x"), (5, "e", 5, "x")], schema)
    out = tb.load(spark, src, t, "merge", keys="id", run_ts=T2)
    got = sorted((r["id"], r["score"], r["part"]) for r in out.collect())
    assert got == [(1, 1, "x"), (2, 20, "x"), (3, 3, "x"), (4, 4, "z"), (5, 5, "x"), (6, 6, "y")]
    assert tb.location(spark, t.name).replace("file:", "") == loc                 # rewritten in place
    assert sorted(glob.glob(f"{loc}/part=z/*.parquet")) == before["z"]          # untouched files kept
    assert sorted(glob.glob(f"{loc}/part=x/*.parquet")) != before["x"]
    dates = {r["id"]: (str(r["insert_date"]), str(r["update_date"])) for r in out.collect()}
    assert dates[1] == (T1, T1) and dates[2] == (T1, T2) and dates[5] == (T2, T2)
    # moving the last key out of a partition empties it: the exact full-snapshot path takes over
    out = tb.load(spark, spark.createDataFrame([(6, "f", 6, "x")], schema), t, "merge", keys="id", run_ts=T3)
    assert sorted((r["id"], r["part"]) for r in out.collect()) == [(1, "x"), (2, "x"), (3, "x"), (4, "z"), (5, "x"), (6, "x")]


def test_bucketed_target_merge_shuffles_only_the_source(spark):
    from stratum.operators.merge import merge_plan
    t = tb.Target("test_bucketed.orders", "external", buckets=8, bucket_keys=["o_orderkey"])
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_orderstatus")
    tb.load(spark, orders.filter("o_orderstatus <> 'P'"), t, "merge", keys="o_orderkey", run_ts=T1)
    src = orders.filter("o_orderstatus <> 'O'")
    plan = merge_plan(spark.table(t.name), src, "o_orderkey", T2, validate=False)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1            # the source only; the target is read in place
    out = tb.load(spark, src, t, "merge", keys="o_orderkey", run_ts=T2)
    assert out.count() == orders.count()
    assert "Bucket" in " ".join(r[0] + str(r[1]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {t.name}").collect())


def test_bucketed_append(spark):
    t = tb.Target("test_bucketed_append.people", "external", buckets=4, bucket_keys=["id"])
    tb.load(spark, spark.createDataFrame([(1, "a", 1), (2, "b", 2)], SCHEMA), t, "merge", keys="id", run_ts=T1)
    out = tb.load(spark, spark.createDataFrame([(3, "c", 3)], SCHEMA), t, "append", run_ts=T2)
    assert sorted(r["id"] for r in out.collect()) == [1, 2, 3]
    wide = spark.createDataFrame([(4, "d", 4, True)], SCHEMA + ", flag boolean")
    out = tb.load(spark, wide, t, "append", run_ts=T3)
    assert sorted((r["id"], r["flag"]) for r in out.collect()) == [(1, None), (2, None), (3, None), (4, True)]
    desc = " ".join(str(r[0]) + str(r[1]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {t.name}").collect())
    assert "Bucket" in desc
