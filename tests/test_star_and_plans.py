"""Star-model semantics (blank member, +0, roles) and physical-plan checks."""
from pyspark.sql import functions as F

from stratum.plans.star import Relationship, StarModel
from stratum.proxies.registry import load_all
from tests.conftest import SMOKE

QUERIES, _ = load_all()


def model(spark):
    fact = spark.createDataFrame([(1, 10, 20, None), (2, 10, 99, False), (3, 99, 20, True), (4, None, 20, False)],
                                 "id int, cls int, alt int, gone boolean")
    dim = spark.createDataFrame([(10, "ten", "x"), (20, "twenty", "y"), (30, "thirty", "y")], "Id int, name string, grp string")
    rels = [Relationship("f", "cls", "d", "Id"), Relationship("f", "alt", "d", "Id", active=False)]
    return StarModel({"f": fact, "d": dim}, rels)


def test_blank_member_and_zero_rows(spark):
    m = model(spark)
    got = {r["name"]: r["n"] for r in m.count_rows("f", "d", ["name"], "n").collect()}
    assert got == {"ten": 2, "twenty": 0, "thirty": 0, None: 2}          # unmatched 99 and NULL -> blank
    no_zero = {r["name"]: r["n"] for r in m.count_rows("f", "d", ["name"], "n", zero_fill=False).collect()}
    assert no_zero == {"ten": 2, None: 2}
    role = {r["name"]: r["n"] for r in m.count_rows("f", "d", ["name"], "n", role="alt").collect()}
    assert role == {"ten": 0, "twenty": 3, "thirty": 0, None: 1}
    filtered = {r["name"]: r["n"] for r in m.count_rows("f", "d", ["name"], "n", dim_filter=F.col("grp") == "y").collect()}
    assert filtered == {"twenty": 0, "thirty": 0}                         # a dimension filter drops the blank member


def test_distinct_count_blank_counts_once(spark):
    m = model(spark)
    got = {r["grp"]: r["n"] for r in m.distinct_count("f", "d", ["grp"], "gone", "n", role="alt").collect()}
    assert got == {"y": 3, None: 1}       # None, False, True under y


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString() + df._jdf.queryExecution().optimizedPlan().toString()


def test_no_cartesian_products(spark):
    for name in ["l4_active_risks_rrn_acumulative", "l7_historicals_acumulative", "c9_interval_join", "l8_column_chart",
                 "a15_merge_upsert", "e2_scd2_close", "k2_dim_unit"]:
        text = plan_text(QUERIES[name](spark, SMOKE))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_dimensions_are_broadcast_and_filters_pushed(spark):
    text = plan_text(QUERIES["c2_left_join_conditioned"](spark, SMOKE))
    assert "BroadcastHashJoin" in text
    scan = QUERIES["a2_scan_incremental_lookback"](spark, SMOKE)
    s = scan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in s
    pruned = QUERIES["b1_project_rename"](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in pruned                                   # column pruning reaches the scan


def test_jdbc_select_list(spark):
    from stratum.sources import jdbc
    assert jdbc.select_item("amount", "money") == '"amount"::NUMERIC(38,2) AS "amount"'
    assert "infinity" in jdbc.select_item("ts", "timestamp with time zone")
    cat = spark.createDataFrame([("public", "t", "b", "money", 2), ("public", "t", "a", "text", 1)],
                                "table_schema string, table_name string, column_name string, data_type string, ordinal_position int")
    sl = jdbc.select_lists(cat).first()["select_list"]
    assert sl == '"a", "b"::NUMERIC(38,2) AS "b"'
    import datetime as dt
    q = jdbc.source_query("public", "t", sl, "updated_at", dt.datetime(2024, 1, 10), -7)
    assert q.endswith("WHERE \"updated_at\" > '2024-01-03 00:00:00'")


def test_history_close_has_no_window_per_key(spark):
    for name in ["e2_scd2_close", "c5_merge_self_update"]:
        text = QUERIES[name](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
        assert "windowspecdefinition(user_id" not in text, name      # no key sits whole in one window task


def test_json_arrays_spread_identical_rows(spark):
    import glob
    from pyspark.sql import functions as F
    from stratum.session import scratch_path
    from stratum.sources import files
    same = spark.range(0, 3000).select(F.lit(7).alias("k"), F.lit("x").alias("v"))      # one group of copies
    path = scratch_path(spark, "json_copies")
    files.write_json_arrays(same, path, rows_per_file=500)
    parts = glob.glob(f"{path}/__file=*/*.txt")
    assert len(parts) >= 4
    assert files.read_json_arrays(spark, path, same.schema).count() == 3000
