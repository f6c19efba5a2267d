"""Scans, sources and sinks (A2-A22) exercised on the test tables."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from stratum.functions.casts import conform
from stratum.functions.dates import look_back
from stratum.operators.partitioning import spread
from stratum.operators.joins import lookup
from stratum.proxies import testdata as td
from stratum.proxies.registry import ORACLE, query
from stratum.session import scratch_path
from stratum.sources import files, jdbc
from stratum.sources import tables as tb

T = td.table


def fresh(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex[:8]}"


@query("a2_scan_incremental_lookback",
       "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '2001-08-01 00:00:00' - INTERVAL 365 DAY")
def a2(spark, d):
    return T(spark, d, "orders").filter(look_back("o_orderdate", "2001-08-01 00:00:00", -365))


@query("a3_source_projection", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(38,2)) AS o_totalprice,
       o_orderdate, o_orderpriority FROM orders""")
def a3(spark, d):
    o = T(spark, d, "orders")
    return jdbc.project_source(o, {"o_totalprice": "money", "o_orderdate": "timestamp without time zone"})


@query("a4_bronze_sink", "SELECT * FROM part")
def a4(spark, d):
    path = scratch_path(spark, "bronze", "part")
    files.write_bronze(T(spark, d, "part"), path, spread_scan=True)
    return files.read_parquet(spark, path)


@query("a5_copy_type_conversion", """
SELECT l_orderkey, l_linenumber, CAST(trunc(l_quantity) AS INTEGER) AS l_quantity,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate
FROM lineitem""")
def a5(spark, d):
    return conform(T(spark, d, "lineitem"),
                   "l_orderkey bigint, l_linenumber int, l_quantity int, l_extendedprice decimal(18,2), "
                   "l_returnflag string, l_shipdate date")


@query("a6_scan_parquet", "SELECT * FROM lineitem")
def a6(spark, d):
    return files.read_parquet(spark, f"{d}/lineitem.parquet")


@query("a7_scan_json_multiline", "SELECT * FROM conversations")
def a7(spark, d):
    conv = T(spark, d, "conversations")
    path = scratch_path(spark, "json", "conversations")
    files.write_json_arrays(conv, path, rows_per_file=20_000, bucket_cols=["conv_id", "turn"])
    return files.read_json_arrays(spark, path, conv.schema)


@query("a8_scan_table", "SELECT * FROM part")
def a8(spark, d):
    schema = fresh("silver_a8")
    tb.create_table(spark, T(spark, d, "part"), tb.Target(f"{schema}.part", "managed"))
    two_part = spark.table(f"{schema}.part")
    prev = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(schema)
    try:
        one_part = spark.table("part")
        cols = one_part.columns
        assert cols == two_part.columns
    finally:
        spark.catalog.setCurrentDatabase(prev)
    return two_part


CONFIG_SQL = """
SELECT CASE WHEN s_acctbal > 0 THEN '1' ELSE '0' END AS enable_etl, 'public' AS source_schema_name,
       s_name AS source_table_name, CASE WHEN s_nationkey < 10 THEN 'incremental' ELSE 'full' END AS load_type,
       'updated_at' AS watermark_column, '-7' AS delta_days, CAST(s_suppkey AS VARCHAR) AS merge_columns,
       CASE WHEN s_nationkey > 20 THEN 'S' ELSE 'N' END AS carga_full,
       CASE WHEN s_acctbal > 5000 THEN 'merge' ELSE 'append' END AS write_table_model
FROM supplier"""


def config_frame(spark, d):
    s = T(spark, d, "supplier")
    return s.select(
        F.when(F.col("s_acctbal") > 0, "1").otherwise("0").alias("enable_etl"), F.lit("public").alias("source_schema_name"),
        F.col("s_name").alias("source_table_name"),
        F.when(F.col("s_nationkey") < 10, "incremental").otherwise("full").alias("load_type"),
        F.lit("updated_at").alias("watermark_column"), F.lit("-7").alias("delta_days"),
        F.col("s_suppkey").cast("string").alias("merge_columns"),
        F.when(F.col("s_nationkey") > 20, "S").otherwise("N").alias("carga_full"),
        F.when(F.col("s_acctbal") > 5000, "merge").otherwise("append").alias("write_table_model"))


def written_config(spark, d):
    path = scratch_path(spark, "config", "source_to_bronze")
    config_frame(spark, d).write.option("header", True).csv(path)
    return files.read_config(spark, path)


@query("a9_scan_config", CONFIG_SQL)
def a9(spark, d):
    return written_config(spark, d)


@query("a10_filter_enabled", f"SELECT * FROM ({CONFIG_SQL}) WHERE enable_etl = '1'")
def a10(spark, d):
    return files.enabled_rows(written_config(spark, d))


@query("h19_mode_switch", f"""
SELECT source_table_name, CASE WHEN carga_full = 'S' THEN 'overwrite' ELSE write_table_model END AS mode
FROM ({CONFIG_SQL})""")
def h19(spark, d):
    c = written_config(spark, d)
    return c.select("source_table_name", files.write_mode_column(c).alias("mode"))


@query("a11_create_table_managed", "SELECT * FROM supplier")
def a11(spark, d):
    return tb.create_table(spark, T(spark, d, "supplier"), tb.Target(f"{fresh('silver_a11')}.supplier", "managed"))


@query("a12_create_table_external", "SELECT * FROM supplier")
def a12(spark, d):
    t = tb.Target(f"{fresh('silver_a12')}.supplier", "external", root=scratch_path(spark, "external", "supplier"))
    return tb.create_table(spark, T(spark, d, "supplier"), t)


@query("a13_write_overwrite", "SELECT p_partkey, p_brand, p_size FROM part")
def a13(spark, d):
    p = T(spark, d, "part")
    t = tb.Target(f"{fresh('silver_a13')}.part", "external")
    tb.create_table(spark, p.select("p_partkey", "p_name"), t)
    return tb.overwrite(spark, spark.table(t.name).join(p, "p_partkey").select("p_partkey", "p_brand", "p_size"), t)


@query("a14_write_append", """
SELECT *, CASE WHEN c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE') THEN c_acctbal > 5000 END AS c_flag FROM customer""")
def a14(spark, d):
    c = T(spark, d, "customer")
    first = c.filter(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"))
    second = c.filter(~F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE")).withColumn("c_flag", F.col("c_acctbal") > 5000)
    t = tb.Target(f"{fresh('silver_a14')}.customer", "external")
    tb.create_table(spark, first, t)
    return tb.append(spark, second, t)


# -- merge (A15, A20, A22) ----------------------------------------------------------------------
ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate"
MERGE_CTE = f"""WITH t AS (SELECT {ORDERS_COLS} FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01 00:00:00'),
s AS (SELECT o_orderkey, o_custkey, o_orderstatus,
             CASE WHEN o_orderstatus = 'F' THEN '9-CHANGED' ELSE o_orderpriority END AS o_orderpriority,
             CAST(o_orderdate AS DATE) AS o_orderdate
      FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00'),
th AS (SELECT *, md5(concat_ws('|', coalesce(CAST(o_orderkey AS VARCHAR), ''), coalesce(CAST(o_custkey AS VARCHAR), ''),
         coalesce(o_orderstatus, ''), coalesce(o_orderpriority, ''), coalesce(CAST(o_orderdate AS VARCHAR), ''))) AS h FROM t),
sh AS (SELECT *, md5(concat_ws('|', coalesce(CAST(o_orderkey AS VARCHAR), ''), coalesce(CAST(o_custkey AS VARCHAR), ''),
         coalesce(o_orderstatus, ''), coalesce(o_orderpriority, ''), coalesce(CAST(o_orderdate AS VARCHAR), ''))) AS h FROM s),
j AS (SELECT th.o_orderkey AS tk, th.o_custkey AS tc, th.o_orderstatus AS ts_, th.o_orderpriority AS tp, th.o_orderdate AS td, th.h AS thash,
             sh.o_orderkey AS sk, sh.o_custkey AS sc, sh.o_orderstatus AS ss, sh.o_orderpriority AS sp, sh.o_orderdate AS sd, sh.h AS shash,
             CASE WHEN th.o_orderkey IS NULL THEN 'insert' WHEN sh.o_orderkey IS NULL THEN 'keep'
                  WHEN th.h IS DISTINCT FROM sh.h THEN 'update' ELSE 'noop' END AS action
      FROM th FULL OUTER JOIN sh ON th.o_orderkey = sh.o_orderkey)
"""
TS1, TS2 = f"TIMESTAMP '{td.RUN_TS_1}'", f"TIMESTAMP '{td.RUN_TS_2}'"


def merge_inputs(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                                     F.to_date("o_orderdate").alias("o_orderdate"))
    tgt = o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("date"))
    src = o.filter(F.col("o_orderdate") >= F.lit("1997-01-01").cast("date")).withColumn(
        "o_orderpriority", F.when(F.col("o_orderstatus") == "F", F.lit("9-CHANGED")).otherwise(F.col("o_orderpriority")))
    return tgt, src


@query("a15_merge_upsert", MERGE_CTE + f"""
SELECT CASE WHEN action IN ('insert', 'update') THEN sk ELSE tk END AS o_orderkey,
       CASE WHEN action IN ('insert', 'update') THEN sc ELSE tc END AS o_custkey,
       CASE WHEN action IN ('insert', 'update') THEN ss ELSE ts_ END AS o_orderstatus,
       CASE WHEN action IN ('insert', 'update') THEN sp ELSE tp END AS o_orderpriority,
       CASE WHEN action IN ('insert', 'update') THEN sd ELSE td END AS o_orderdate,
       CASE WHEN tk IS NOT NULL THEN {TS1} ELSE {TS2} END AS insert_date,
       CASE WHEN action IN ('insert', 'update') THEN {TS2} ELSE {TS1} END AS update_date,
       CASE WHEN action IN ('insert', 'update') THEN shash ELSE thash END AS hash_row
FROM j""")
def a15(spark, d):
    tgt, src = merge_inputs(spark, d)
    t = tb.Target(f"{fresh('silver_a15')}.orders", "external")
    tb.load(spark, tgt, t, "merge", keys="o_orderkey", run_ts=td.RUN_TS_1)
    return tb.load(spark, src, t, "merge", keys="o_orderkey", run_ts=td.RUN_TS_2)


def a15_partitioned(spark, d):
    """The same upsert into a table partitioned by order status: only touched partitions are rewritten."""
    tgt, src = merge_inputs(spark, d)
    t = tb.Target(f"{fresh('silver_a15p')}.orders", "external", partition_columns="o_orderstatus")
    tb.load(spark, tgt, t, "merge", keys="o_orderkey", run_ts=td.RUN_TS_1)
    return tb.load(spark, src, t, "merge", keys="o_orderkey", run_ts=td.RUN_TS_2)


@query("a20_change_feed", MERGE_CTE + f"""
SELECT sk AS o_orderkey, sc AS o_custkey, ss AS o_orderstatus, sp AS o_orderpriority, sd AS o_orderdate,
       {TS2} AS insert_date, {TS2} AS update_date, shash AS hash_row, 'insert' AS _change_type FROM j WHERE action = 'insert'
UNION ALL
SELECT tk, tc, ts_, tp, td, {TS1}, {TS1}, thash, 'update_preimage' FROM j WHERE action = 'update'
UNION ALL
SELECT sk, sc, ss, sp, sd, {TS1}, {TS2}, shash, 'update_postimage' FROM j WHERE action = 'update'""")
def a20(spark, d):
    tgt, src = merge_inputs(spark, d)
    t = tb.Target(f"{fresh('silver_a20')}.orders", "external")
    tb.load(spark, tgt, t, "merge", keys="o_orderkey", run_ts=td.RUN_TS_1)
    _, changes = tb.merge(spark, src, t, "o_orderkey", td.RUN_TS_2, with_changes=True)
    return changes


TS3 = "TIMESTAMP '2024-03-10 06:00:00'"
HASH3 = """md5(concat_ws('|', coalesce(CAST(o_orderkey AS VARCHAR), ''), coalesce(CAST(o_custkey AS VARCHAR), ''),
         coalesce(o_orderstatus, ''), coalesce(o_orderpriority, ''), coalesce(CAST(o_orderdate AS VARCHAR), '')))"""


@query("a20_change_feed_loads", MERGE_CTE + f""",
late AS (SELECT {ORDERS_COLS} FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' AND o_orderstatus = 'O'),
two AS (
SELECT sk AS o_orderkey, sc AS o_custkey, ss AS o_orderstatus, sp AS o_orderpriority, sd AS o_orderdate,
       {TS2} AS insert_date, {TS2} AS update_date, shash AS hash_row, 'insert' AS _change_type FROM j WHERE action = 'insert'
UNION ALL
SELECT tk, tc, ts_, tp, td, {TS1}, {TS1}, thash, 'update_preimage' FROM j WHERE action = 'update'
UNION ALL
SELECT sk, sc, ss, sp, sd, {TS1}, {TS2}, shash, 'update_postimage' FROM j WHERE action = 'update'),
three AS (
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate, CASE WHEN o_orderdate < DATE '1999-01-01' THEN {TS1} ELSE {TS2} END AS insert_date,
       CASE WHEN o_orderdate < DATE '1999-01-01' THEN {TS1} ELSE {TS2} END AS update_date, {HASH3} AS hash_row, 'update_preimage' AS _change_type FROM late
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate, CASE WHEN o_orderdate < DATE '1999-01-01' THEN {TS1} ELSE {TS2} END,
       {TS3}, {HASH3}, 'update_postimage' FROM (SELECT * REPLACE ('0-LATE' AS o_orderpriority) FROM late))
SELECT *, strftime({TS2}, '%Y-%m-%d %H:%M:%S') AS _load FROM two
UNION ALL SELECT *, strftime({TS3}, '%Y-%m-%d %H:%M:%S') FROM three""")
def a20_loads(spark, d):
    """Three loads into a table that keeps its change feed; the feed of the second and third is read back."""
    tgt, src = merge_inputs(spark, d)
    late = src.filter(F.col("o_orderdate") >= F.lit("1998-01-01").cast("date")) \
              .withColumn("o_orderpriority", F.when(F.col("o_orderstatus") == "O", "0-LATE").otherwise(F.col("o_orderpriority")))
    t = tb.Target(f"{fresh('silver_a20l')}.orders", "external", change_feed=True)
    for df, ts in ((tgt, td.RUN_TS_1), (src, td.RUN_TS_2), (late, "2024-03-10 06:00:00")):
        tb.load(spark, df, t, "merge", keys="o_orderkey", run_ts=ts)
    return tb.read_changes(spark, t, since=td.RUN_TS_2)


@query("c4_merge_join", """
WITH agg AS (SELECT l_orderkey, l_linenumber, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty,
                    max(l_shipdate) AS last_ship FROM lineitem GROUP BY l_orderkey, l_linenumber),
t AS (SELECT l_orderkey, l_linenumber, n, qty FROM agg WHERE last_ship < TIMESTAMP '1998-01-01 00:00:00'),
s AS (SELECT l_orderkey, l_linenumber, n, qty + 1 AS qty FROM agg WHERE last_ship >= TIMESTAMP '1997-01-01 00:00:00')
SELECT coalesce(s.l_orderkey, t.l_orderkey) AS l_orderkey, coalesce(s.l_linenumber, t.l_linenumber) AS l_linenumber,
       CASE WHEN t.l_orderkey IS NULL THEN 'insert' WHEN s.l_orderkey IS NULL THEN 'keep'
            WHEN t.qty IS DISTINCT FROM s.qty OR t.n IS DISTINCT FROM s.n THEN 'update' ELSE 'noop' END AS _action
FROM t FULL OUTER JOIN s ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber""")
def c4(spark, d):
    li = T(spark, d, "lineitem")
    agg = li.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"),
                                                       F.sum("l_quantity").cast("long").alias("qty"),
                                                       F.max("l_shipdate").alias("last_ship"))
    tgt = agg.filter(F.col("last_ship") < F.lit("1998-01-01").cast("timestamp_ntz")).select("l_orderkey", "l_linenumber", "n", "qty")
    src = agg.filter(F.col("last_ship") >= F.lit("1997-01-01").cast("timestamp_ntz")).select(
        "l_orderkey", "l_linenumber", "n", (F.col("qty") + 1).alias("qty"))
    t, keys = tb.Target(f"{fresh('silver_c4')}.lines", "external"), "l_orderkey, l_linenumber"
    tb.load(spark, tgt, t, "merge", keys=keys, run_ts=td.RUN_TS_1, add_hash=False)
    return tb.start_merge(spark, src, t, keys, td.RUN_TS_2, add_hash=False).actions()


@query("a16_write_partitioned", "SELECT * FROM lineitem")
def a16(spark, d):
    t = tb.Target(f"{fresh('bronze_a16')}.lineitem", "external", partition_columns="l_returnflag")
    return tb.create_table(spark, spread(T(spark, d, "lineitem")), t)


@query("a17_table_exists", """
SELECT 'present' AS probe, true AS found, (SELECT CAST(count(*) AS BIGINT) FROM region) AS n_rows
UNION ALL SELECT 'absent', false, CAST(NULL AS BIGINT)
UNION ALL SELECT 'present_path', true, CAST(NULL AS BIGINT)
UNION ALL SELECT 'absent_path', false, CAST(NULL AS BIGINT)""")
def a17(spark, d):
    schema = fresh("silver_a17")
    t = tb.Target(f"{schema}.region", "external")
    out = tb.create_table(spark, T(spark, d, "region"), t)
    loc = tb.location(spark, t.name)
    probes = [("present", tb.table_exists(spark, t.name)), ("absent", tb.table_exists(spark, f"{schema}.absent")),
              ("present_path", tb.path_exists(spark, loc)), ("absent_path", tb.path_exists(spark, loc + "_missing"))]
    flags = spark.createDataFrame(probes, "probe string, found boolean")
    counted = out.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("present").alias("probe"), "n_rows")
    return flags.join(counted, "probe", "left").select("probe", "found", "n_rows")


@query("a18_replace_table", """
SELECT n.n_nationkey, n.n_name, n.n_regionkey, concat_ws(' > ', r.r_name, n.n_name) AS path
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def a18(spark, d):
    n, r = T(spark, d, "nation"), T(spark, d, "region")
    derived = lookup(n, r, n["n_regionkey"] == r["r_regionkey"], "left").select(
        "n_nationkey", "n_name", "n_regionkey", F.concat_ws(" > ", "r_name", "n_name").alias("path"))
    return tb.replace_table(spark, derived, tb.Target(f"{fresh('silver_a18')}.nation_path", "external"))


@query("a19_register_temp_view", "SELECT r_regionkey, upper(r_name) AS r_name_upper FROM region")
def a19(spark, d):
    view = tb.register_view(T(spark, d, "region"), "region")
    return spark.sql(f"SELECT r_regionkey, upper(r_name) AS r_name_upper FROM {view}")


@query("a22_automated_load", f"""
WITH t AS (SELECT * FROM supplier WHERE s_acctbal < 5000),
s AS (SELECT s_suppkey, CASE WHEN s_acctbal > 8000 THEN upper(s_name) ELSE s_name END AS s_name, s_nationkey FROM supplier)
SELECT s.s_suppkey, s.s_name, s.s_nationkey,
       CASE WHEN t.s_suppkey IS NOT NULL THEN {TS1} ELSE {TS2} END AS insert_date,
       CASE WHEN t.s_suppkey IS NULL OR t.s_name IS DISTINCT FROM s.s_name OR t.s_nationkey IS DISTINCT FROM s.s_nationkey
            THEN {TS2} ELSE {TS1} END AS update_date
FROM s LEFT JOIN t ON s.s_suppkey = t.s_suppkey""")
def a22(spark, d):
    s = T(spark, d, "supplier")
    first = s.filter(F.col("s_acctbal") < 5000).select("s_suppkey", "s_name", "s_nationkey")
    second = s.select("s_suppkey", F.when(F.col("s_acctbal") > 8000, F.upper("s_name")).otherwise(F.col("s_name")).alias("s_name"),
                      "s_nationkey")
    t = tb.Target(f"{fresh('silver_a22')}.supplier", "external")
    tb.load(spark, first, t, "merge", keys="s_suppkey", run_ts=td.RUN_TS_1)
    out = tb.load(spark, second, t, "merge", keys="s_suppkey", run_ts=td.RUN_TS_2)
    return out.drop("hash_row")


query("a15_merge_upsert_partitioned", ORACLE["a15_merge_upsert"])(a15_partitioned)


def a15_bucketed(spark, d):
    """The same upsert into a table bucketed by its key: the merge join reads the target in place and
    shuffles only the source into the target's buckets."""
    tgt, src = merge_inputs(spark, d)
    t = tb.Target(f"{fresh('silver_a15b')}.orders", "external", buckets=16, bucket_keys=["o_orderkey"])
    tb.load(spark, tgt, t, "merge", keys="o_orderkey", run_ts=td.RUN_TS_1)
    return tb.load(spark, src, t, "merge", keys="o_orderkey", run_ts=td.RUN_TS_2)


query("a15_merge_upsert_bucketed", ORACLE["a15_merge_upsert"])(a15_bucketed)
