"""Config-driven silver load and the streaming upsert."""
import os
import tempfile

from pyspark.sql import functions as F

from stratum.plans import layers
from stratum.session import scratch_path
from stratum.sources import tables as tb
from stratum.streaming.upsert import upsert_stream
from tests.conftest import SMOKE

T1, T2 = "2024-01-01 10:00:00", "2024-02-01 10:00:00"


def test_run_silver(spark):
    bronze = scratch_path(spark, "bronze_root")
    part = spark.read.parquet(f"{SMOKE}/part.parquet")
    part.unionAll(part).toDF(*[c.replace("_", " ") for c in part.columns]).write.parquet(f"{bronze}/cad/part")
    spark.read.parquet(f"{SMOKE}/supplier.parquet").write.parquet(f"{bronze}/cad/supplier")
    cfg = spark.createDataFrame([
        ("1", "cad", "part", "p_partkey", "part", "N/A", "merge", "1", "external", "N"),
        ("1", "cad", "supplier", "s_suppkey", "supplier", "s_nationkey", "overwrite", "0", "managed", "N"),
        ("0", "cad", "missing", "id", "missing", "N/A", "merge", "0", "external", "N"),
    ], "enable_etl string, source_directory string, source_file string, merge_columns string, table_name string, "
       "partition_columns string, write_table_model string, apply_distinct string, table_type string, carga_full string")
    res = layers.run_silver(spark, cfg, bronze, "test_silver_run", T1)
    assert [r.status for r in res] == ["succeeded", "succeeded"]
    assert spark.table("test_silver_run.part").count() == part.count()
    assert spark.table("test_silver_run.supplier").filter(F.col("s_nationkey") == 3).count() == \
        spark.read.parquet(f"{SMOKE}/supplier.parquet").filter("s_nationkey = 3").count()
    assert layers.summary(spark, res).first()["run_status"] == "SUCCESS"


def test_upsert_stream(spark):
    src = scratch_path(spark, "landing")
    orders = spark.read.parquet(f"{SMOKE}/orders.parquet").select("o_orderkey", "o_orderstatus")
    orders.filter("o_orderstatus = 'F'").write.parquet(f"{src}/batch=1")
    target = tb.Target("test_stream.orders", "external")
    q = upsert_stream(spark, src + "/*", orders.schema, target, "o_orderkey", T1,
                      checkpoint=tempfile.mkdtemp(prefix="stream-ckpt-"))
    q.awaitTermination(120)
    assert spark.table(target.name).count() == orders.filter("o_orderstatus = 'F'").count()


def test_run_gold_levels(spark):
    order = []
    nation = spark.read.parquet(f"{SMOKE}/nation.parquet")

    def dim():
        order.append("dim")
        return nation.select("n_nationkey", "n_name"), "n_nationkey"

    def fact():
        order.append("fact")
        return spark.read.parquet(f"{SMOKE}/customer.parquet").select("c_custkey", "c_nationkey"), "c_custkey"

    def empty():
        order.append("empty")
        return nation.filter("n_nationkey < 0"), "n_nationkey"

    cfg = spark.createDataFrame([("1", "fact_c", "2", "merge"), ("1", "dim_n", "1", "merge"), ("1", "dim_e", "1", "merge"),
                                 ("0", "off", "1", "merge")],
                                "enable_etl string, notebook_name string, notebook_level string, write_table_model string")
    res = layers.run_gold(spark, cfg, {"fact_c": fact, "dim_n": dim, "dim_e": empty}, "test_gold_run", T1, parallel=2)
    assert order.index("fact") > max(order.index("dim"), order.index("empty"))     # level 2 after level 1
    assert all(r.status == "succeeded" for r in res)
    assert spark.table("test_gold_run.dim_n").count() == 25
    assert not spark.catalog.tableExists("test_gold_run.dim_e")                     # empty source: skipped


def test_ingest_with_stubbed_source(spark, monkeypatch):
    """K28 orchestration without a database: the JDBC read is replaced by a stub that records the query."""
    import datetime as dt
    from stratum.sources import jdbc
    seen = {}

    def fake_read(spark_, url, query, properties=None, **kw):
        seen[query.split(" FROM ")[1].split(" ")[0]] = query
        return spark.read.parquet(f"{SMOKE}/nation.parquet")

    monkeypatch.setattr(jdbc, "read_jdbc", fake_read)
    catalogue = spark.createDataFrame([
        ("public", "nation", "n_nationkey", "integer", 1), ("public", "nation", "updated", "timestamp with time zone", 3),
        ("public", "nation", "n_name", "text", 2), ("public", "orders", "o_totalprice", "money", 1)],
        "table_schema string, table_name string, column_name string, data_type string, ordinal_position int")
    cfg = spark.createDataFrame([
        ("1", "public", "nation", "incremental", "updated", "-7", "cad", "nation"),
        ("1", "public", "orders", "full", "", "0", "cad", "orders"),
        ("0", "public", "skipped", "full", "", "0", "cad", "skipped")],
        "enable_etl string, source_schema_name string, source_table_name string, load_type string, "
        "watermark_column string, delta_days string, directory_target string, file_target string")
    root = scratch_path(spark, "bronze_ingest")
    res = layers.ingest(spark, cfg, "jdbc:none", catalogue, root, dt.datetime(2024, 1, 10))
    assert [r.status for r in res] == ["succeeded", "succeeded"]
    assert seen['"public"."nation"'].startswith('SELECT "n_nationkey", "n_name", CASE WHEN "updated"::text IN')
    assert seen['"public"."nation"'].endswith("WHERE \"updated\" > '2024-01-03 00:00:00'")
    assert seen['"public"."orders"'] == 'SELECT "o_totalprice"::NUMERIC(38,2) AS "o_totalprice" FROM "public"."orders"'
    assert spark.read.parquet(f"{root}/cad/nation").count() == 25


def test_pass_through_tables_have_their_columns(spark):
    import pytest
    from pyspark.sql import functions as F
    from stratum.operators.merge import SchemaMismatch
    from stratum.plans import contract, gold
    sizes = [len(contract.COLUMNS[p.gold]) + 3 for p in gold.PASS_THROUGH]   # with the control columns
    assert sizes == [8, 19, 18, 67, 12, 7, 14, 7, 107, 59, 12, 30, 19, 16, 30, 8]
    spec = gold.PASS_THROUGH_BY_GOLD["fact_action"]
    row = spark.range(2).select(*[F.lit(None).cast(contract.column_type(c)).alias(c.upper()) for c in spec.columns if c != "Id"],
                                F.col("id").alias("Id"), F.lit("x").alias("unknown"), F.lit("h").alias("hash_row"))
    out = gold.pass_through(row, spec)
    assert out.columns == spec.columns and dict(out.dtypes)["DtInicio"] == "timestamp_ntz" and dict(out.dtypes)["ValorPrevisto"] == "double"
    with pytest.raises(SchemaMismatch, match="Andamento"):
        gold.pass_through(row.drop("ANDAMENTO"), spec)
