"""The two-phase upsert: equal to the join of whole rows, no exchange of the target, one evaluation of the source, and a
change feed that outlives the call."""
import uuid

import pytest
from pyspark.sql import functions as F

from stratum.operators import upsert
from stratum.operators.merge import KeyViolation, SchemaMismatch, merge_frames
from stratum.sources import tables as tb

T1, T2, T3, T4 = (f"2024-0{i}-01 10:00:00" for i in range(1, 5))


def name(stem):
    return f"ups_{uuid.uuid4().hex[:8]}.{stem}"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def people(spark, ids, tag):
    return spark.createDataFrame([(i, f"n{i}", tag if i % 3 else "same", i % 4) for i in ids], "id int, name string, tag string, part int")


@pytest.mark.parametrize("large", [False, True])
@pytest.mark.parametrize("shape", [{}, {"partition_columns": ["part"]}, {"buckets": 3, "bucket_keys": ["id"]}])
@pytest.mark.parametrize("add_hash", [True, False])
def test_equals_the_join_of_whole_rows(spark, monkeypatch, large, shape, add_hash):
    if large:   # as if nothing were small enough for a broadcast
        monkeypatch.setattr(upsert.Staged, "small", lambda self: False)
        monkeypatch.setattr(upsert, "broadcast_bounded", lambda df: df)
    t = tb.Target(name("people"), **shape)
    tb.load(spark, people(spark, range(40), "a").repartition(3), t, "merge", keys="id", run_ts=T1, add_hash=add_hash)
    before = spark.createDataFrame(spark.table(t.name).collect(), spark.table(t.name).schema)
    src = people(spark, range(30, 60), "b")
    expected = merge_frames(before, src, "id", T2, add_hash=add_hash)
    out, changes = tb.merge(spark, src, t, "id", T2, add_hash=add_hash, with_changes=True)
    cols = expected.columns
    assert sorted(map(tuple, out.select(*cols).collect())) == sorted(map(tuple, expected.collect()))
    kinds = {k: sorted(r["id"] for r in changes.collect() if r["_change_type"] == k) for k in ("insert", "update_preimage", "update_postimage")}
    updated = [i for i in range(30, 40) if i % 3]
    assert kinds == {"insert": list(range(40, 60)), "update_preimage": updated, "update_postimage": updated}


def test_repeated_and_null_keys_of_the_target(spark):
    t = tb.Target(name("dups"))
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "x"), (2, "c")], "id int, v string")
    tb.load(spark, rows, t, "append", run_ts=T1)
    out = tb.load(spark, spark.createDataFrame([(1, "b"), (3, "d")], "id int, v string"), t, "merge", keys="id", run_ts=T2)
    assert sorted(((r["id"], r["v"], str(r["update_date"])) for r in out.collect()), key=str) \
        == sorted([(1, "b", T2), (1, "b", T1), (None, "x", T1), (2, "c", T1), (3, "d", T2)], key=str)


def test_small_source_moves_no_target_row(spark):
    t = tb.Target(name("big"))
    tb.load(spark, spark.range(20_000).selectExpr("id", "repeat('x', 50) AS wide", "id % 7 AS v"), t, "merge", keys="id", run_ts=T1)
    up = tb.start_merge(spark, spark.createDataFrame([(5, "y", 1), (30_000, "z", 2)], "id long, wide string, v long"), t, "id", T2)
    text = plan_of(up.kept())
    assert "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text and "FullOuter" not in plan_of(up.snapshot())
    assert up.snapshot().count() == 20_001


def joins_of_rows(text):
    """Sort-merge joins of a plan, and exchanges that carry the wide column."""
    return text.count("SortMergeJoin"), sum("Exchange hashpartitioning" in line for line in text.split("\n"))


def test_large_source_of_few_keys_is_not_dealt_out(spark, monkeypatch):
    """A source too wide for a broadcast, with keys that are not: new rows come from one join, without an exchange."""
    monkeypatch.setattr(upsert.Staged, "small", lambda self: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = tb.Target(name("wide"))
        tb.load(spark, spark.range(200).selectExpr("id", "repeat('x', 50) AS wide", "id % 7 AS v"), t, "merge", keys="id", run_ts=T1)
        up = tb.start_merge(spark, spark.range(150, 300).selectExpr("id", "repeat('x', 50) AS wide", "id % 3 AS v"), t, "id", T2)
        for part in (up.snapshot(), up.changes()):
            assert joins_of_rows(plan_of(part)) == (0, 0)
        assert up.snapshot().count() == 300 and up.changes().filter("_change_type = 'insert'").count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_many_places_travel_as_bits(spark, monkeypatch):
    """Places too many for a broadcast are 64 to a number; kept rows and rows as they were are still told by them."""
    monkeypatch.setattr(upsert, "broadcast_bounded", lambda df: df if "__r" in df.columns else F.broadcast(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = tb.Target(name("bits"))
        tb.load(spark, spark.range(0, 1000, 1, 3).selectExpr("id", "id % 7 AS v"), t, "merge", keys="id", run_ts=T1)
        up = tb.start_merge(spark, spark.range(0, 1000, 2).selectExpr("id", "id % 3 AS v"), t, "id", T2)
        gone = {i for i in range(0, 1000, 2) if i % 7 != i % 3}
        assert "SortMergeJoin" not in plan_of(up.kept()) and "SortMergeJoin" not in plan_of(up.before())
        assert sorted(r["id"] for r in up.before().collect()) == sorted(gone)
        assert sorted(r["id"] for r in up.kept().collect()) == sorted(set(range(1000)) - gone)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_source_meets_narrow_columns(spark, monkeypatch):
    """The exchanged side of the target holds keys, hash, dates and places; the wide column is read for kept rows alone."""
    monkeypatch.setattr(upsert.Staged, "small", lambda self: False)
    t = tb.Target(name("narrow"))
    tb.load(spark, spark.range(100).selectExpr("id", "repeat('x', 50) AS wide"), t, "merge", keys="id", run_ts=T1)
    seen = {}
    put = lambda df, what: seen.setdefault(what, df)
    src = upsert.Staged(spark.table(t.name), 100, 10_000)
    upsert.match(spark.table(t.name), src, ["id"], T2, put)
    text = plan_of(seen["matched"])
    scans = [line for line in text.split("\n") if "FileScan" in line]
    assert len(scans) == 2 and all("wide" not in s for s in scans)


def test_source_runs_once(spark):
    """Checks and all parts of the merge read what was written: a source of random numbers stays one source."""
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b
    t = tb.Target(name("once"))
    for ts in (T1, T2):
        src = spark.range(50).selectExpr("id", "rand() AS v").mapInArrow(count, "id long, v double")
        tb.load(spark, src, t, "merge", keys="id", run_ts=ts)
    assert runs.value == 100


def test_bad_keys_leave_the_table_alone(spark):
    t = tb.Target(name("keys"))
    good = spark.createDataFrame([(1, "a")], "id int, v string")
    for rows in ([(None, "x")], [(2, "x"), (2, "y")]):
        bad = spark.createDataFrame(rows, "id int, v string")
        with pytest.raises(KeyViolation):
            tb.load(spark, bad, t, "merge", keys="id", run_ts=T1)
        assert not tb.table_exists(spark, t.name)
    tb.load(spark, good, t, "merge", keys="id", run_ts=T1)
    for rows in ([(None, "x")], [(2, "x"), (2, "y")]):
        with pytest.raises(KeyViolation):
            tb.load(spark, spark.createDataFrame(rows, "id int, v string"), t, "merge", keys="id", run_ts=T2)
    assert [r["v"] for r in spark.table(t.name).collect()] == ["a"]


def test_change_feed_of_every_load(spark):
    t = tb.Target(name("fed"), change_feed=True)
    schema = "id int, v string"
    tb.load(spark, spark.createDataFrame([(1, "a"), (2, "b")], schema), t, "merge", keys="id", run_ts=T1)
    tb.load(spark, spark.createDataFrame([(2, "c"), (3, "d")], schema), t, "merge", keys="id", run_ts=T2)
    tb.load(spark, spark.createDataFrame([(4, "e", 1)], schema + ", w int"), t, "append", run_ts=T3)
    tb.load(spark, spark.createDataFrame([(9, "z")], schema), t, "overwrite", run_ts=T4)
    got = sorted((r["_load"], r["id"], r["v"], r["_change_type"]) for r in tb.read_changes(spark, t).collect())
    assert got == sorted([(T1, 1, "a", "insert"), (T1, 2, "b", "insert"), (T2, 2, "b", "update_preimage"), (T2, 2, "c", "update_postimage"),
                          (T2, 3, "d", "insert"), (T3, 4, "e", "insert"), (T4, 1, "a", "delete"), (T4, 2, "c", "delete"),
                          (T4, 3, "d", "delete"), (T4, 4, "e", "delete"), (T4, 9, "z", "insert")])
    some = tb.read_changes(spark, t, since=T2, until=T3)
    assert {r["_load"] for r in some.collect()} == {T2, T3}
    assert "PartitionFilters: [isnotnull(_load" in plan_of(some)


def test_appends_lose_no_digit(spark):
    for have, want, fine in (("bigint", "double", False), ("int", "float", False), ("int", "double", True), ("float", "double", True),
                             ("smallint", "float", True), ("int", "decimal(12,2)", True), ("bigint", "decimal(12,2)", False), ("double", "float", False)):
        t = tb.Target(name("n"))
        tb.append(spark, spark.range(1).select(F.col("id").cast(want).alias("q")), t)
        more = spark.range(1).select(F.col("id").cast(have).alias("q"))
        if fine:
            assert tb.append(spark, more, t).count() == 2
        else:
            with pytest.raises(SchemaMismatch):
                tb.append(spark, more, t)


def test_partitioned_writes_make_few_files(spark):
    t = tb.Target(name("files"), partition_columns=["p"])
    df = spark.range(8000).repartition(8).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 10 END AS p")
    out = tb.create_table(spark, df, t)
    assert len(out.inputFiles()) <= 20 and out.count() == 8000   # not one per task and partition
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(tb._clustered(df, ["p"]))


def test_swap_has_a_way_back(spark):
    t = tb.Target(name("swap"))
    tb.create_table(spark, spark.range(3).toDF("id"), t)
    with pytest.raises(Exception):
        tb._swap(spark, t.name + "__new_missing", t)
    assert spark.table(t.name).count() == 3


def staged_folders(spark, t):
    import glob
    import os
    return sorted(os.path.basename(p).rsplit("-", 1)[0] for p in glob.glob(tb._root(spark, t).removeprefix("file://").removeprefix("file:") + "/staging-*"))


def test_rows_that_change_nothing_are_staged_by_their_keys(spark):
    """Of a source row without a change only the key is written; rows that meet several target rows or none stay whole."""
    t = tb.Target(name("lean"))
    tb.load(spark, spark.createDataFrame([(1, "a"), (1, "b"), (None, "x"), (2, "c"), (3, "d")], "id int, v string"), t, "append", run_ts=T1)
    src = spark.createDataFrame([(1, "b"), (2, "c"), (3, "e"), (4, None)], "id int, v string")
    up = tb.start_merge(spark, src, t, "id", T2)
    staged = sorted(((r["id"], r["v"], r["hash_row"] is None) for r in up.source.frame.collect()), key=str)
    assert staged == sorted([(1, "b", False), (1, None, True), (2, None, True), (3, "e", False), (4, None, False)], key=str)
    assert (up.source.rows, up.source.small()) == (4, True)
    assert sorted(((r["id"], r["v"], r["_change_type"]) for r in up.changes().collect()), key=str) == sorted(
        [(1, "a", "update_preimage"), (1, "b", "update_postimage"), (3, "d", "update_preimage"), (3, "e", "update_postimage"), (4, None, "insert")], key=str)
    assert sorted((r["id"], r["_action"]) for r in up.actions().filter("id IS NOT NULL").collect()) == [(1, "noop"), (1, "update"), (2, "noop"), (3, "update"), (4, "insert")]
    with pytest.raises(KeyViolation):
        tb.start_merge(spark, src.unionByName(src.limit(1)), t, "id", T2)


@pytest.mark.parametrize("bounded", [True, False])
@pytest.mark.parametrize("kind", ["external", "managed"])
def test_staged_files_leave_as_the_new_rows_are_written(spark, monkeypatch, kind, bounded):
    """New rows of a large source come in portions; a portion's files are gone before the next one, and all by the end."""
    monkeypatch.setattr(upsert.Staged, "small", lambda self: False)
    if not bounded:
        monkeypatch.setattr(upsert, "broadcast_bounded", lambda df: df)
    t = tb.Target(name("portions"), kind)
    first, second = people(spark, range(60), "a"), people(spark, range(40, 100), "b").repartition(10, "id")
    tb.load(spark, first.repartition(3), t, "merge", keys="id", run_ts=T1)
    before = spark.createDataFrame(spark.table(t.name).collect(), spark.table(t.name).schema)
    expected, gone, discard = merge_frames(before, second, "id", T2), [], tb._discard

    def watched(spark, paths):
        discard(spark, paths)
        gone.append(len(paths))
    monkeypatch.setattr(tb, "_discard", watched)
    out = tb.load(spark, second, t, "merge", keys="id", run_ts=T2)
    assert sorted(map(tuple, out.select(*expected.columns).collect())) == sorted(map(tuple, expected.collect()))
    assert len(gone) > 3 and not staged_folders(spark, t)


def test_row_groups_of_wide_rows_stay_small(spark):
    """A reader's batch ends with its row group, so texts that fill one bound what a task holds."""
    import pyarrow.parquet as pq
    t = tb.Target(name("groups"))
    wide = spark.range(0, 4000, 1, 1).selectExpr("id", "concat_ws('', transform(sequence(1, 200), x -> sha2(concat(id, ' ', x), 512))) AS text")
    out = tb.load(spark, wide, t, "merge", keys="id", run_ts=T1)
    groups = [m.row_group(i).total_byte_size for f in out.inputFiles() for m in [pq.ParquetFile(f.removeprefix("file://")).metadata] for i in range(m.num_row_groups)]
    assert sum(groups) > 100_000_000 and max(groups) < 80_000_000
