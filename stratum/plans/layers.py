"""Config-driven runs of the three layers (K24, K28 and the gold levels).

The config tables are small lists of source tables (one row per table), so their rows are read on
the driver to submit one Spark job per table; a small thread pool only submits jobs, Spark runs them.
No data passes through the driver."""
from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.names import lower_name
from stratum.plans import silver
from stratum.sources import files, jdbc
from stratum.sources import tables as tb

# Gold levels in their order, dimensions before facts.
GOLD_LEVELS = ("1", "2")
# Tables processed at once per layer, and the config's "no partitions" marker.
PARALLEL_TABLES = 10
NO_PARTITIONS = "N/A"


@dataclass
class TableResult:
    table: str
    status: str
    detail: str = ""


def _run_all(tasks: list[tuple[str, Callable[[], object]]], parallel: int) -> list[TableResult]:
    def one(item):
        name, fn = item
        try:
            fn()
            return TableResult(name, "succeeded")
        except Exception as e:  # noqa: BLE001 - reported per table, like the orchestrator's per-activity status
            return TableResult(name, "failed", f"{type(e).__name__}: {e}")
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        return list(pool.map(one, tasks))


def ingest(spark: SparkSession, config: DataFrame, url: str, catalogue: DataFrame, bronze_root: str,
           run_ts: _dt.datetime, properties: dict | None = None, parallel: int = PARALLEL_TABLES) -> list[TableResult]:
    """For every enabled source table, generate the select list from the source catalogue, read
    (full, or incremental with the look-back), and write one bronze Parquet directory per table."""
    lists = {(r["table_schema"], r["table_name"]): r["select_list"] for r in jdbc.select_lists(catalogue).collect()}
    tasks = []
    for row in files.enabled_rows(config).collect():
        schema, table = row["source_schema_name"], row["source_table_name"]
        incremental = row["load_type"] == "incremental"
        q = jdbc.source_query(schema, table, lists[(schema, table)],
                              row["watermark_column"] if incremental else None, run_ts if incremental else None,
                              int(row["delta_days"]) if incremental else None)
        dest = f"{bronze_root}/{row['directory_target'] or table}/{row['file_target'] or table}"
        tasks.append((table, lambda q=q, dest=dest: files.write_bronze(jdbc.read_jdbc(spark, url, q, properties), dest)))
    return _run_all(tasks, parallel)


def load_silver_table(spark: SparkSession, row, bronze_root: str, silver_schema: str, run_ts) -> DataFrame:
    """Bronze Parquet -> optional distinct -> clean names -> automated_load with the configured mode."""
    path = f"{bronze_root}/{lower_name(row['source_directory'])}/{row['source_file']}"
    df = silver.bronze_to_silver(files.read_parquet(spark, path), apply_distinct=row["apply_distinct"] == "1")
    mode = "overwrite" if (row.asDict().get("carga_full") == "S") else row["write_table_model"]
    target = tb.Target(f"{silver_schema}.{lower_name(row['table_name'])}", row["table_type"],
                       partition_columns=row["partition_columns"] or NO_PARTITIONS)
    return tb.load(spark, df, target, mode, keys=row["merge_columns"], run_ts=run_ts)


def run_silver(spark: SparkSession, config: DataFrame, bronze_root: str, silver_schema: str, run_ts,
               parallel: int = PARALLEL_TABLES) -> list[TableResult]:
    rows = files.enabled_rows(config).collect()
    tasks = [(r["table_name"], lambda r=r: load_silver_table(spark, r, bronze_root, silver_schema, run_ts)) for r in rows]
    return _run_all(tasks, parallel)


def run_gold(spark: SparkSession, config: DataFrame, builders: dict[str, Callable[[], tuple[DataFrame, str]]],
             gold_schema: str, run_ts, parallel: int = PARALLEL_TABLES) -> list[TableResult]:
    """Gold levels: every level-1 builder (dimensions) before any level-2 builder (facts).
    ``builders[name]()`` returns (frame, merge keys); an empty frame is skipped (non-empty guard)."""
    enabled = files.enabled_rows(config).collect()
    results: list[TableResult] = []
    unknown = [r for r in enabled if r["notebook_level"] not in GOLD_LEVELS]
    results.extend(TableResult(r["notebook_name"], "failed", f"unknown gold level {r['notebook_level']!r}") for r in unknown)
    for level in GOLD_LEVELS:
        if any(r.status != "succeeded" for r in results if r.table not in {u["notebook_name"] for u in unknown}):
            # facts depend on all dimensions
            results.extend(TableResult(r["notebook_name"], "skipped", "an earlier level failed") for r in enabled if r["notebook_level"] == level)
            continue
        tasks = []
        for r in (x for x in enabled if x["notebook_level"] == level):
            name = r["notebook_name"]

            def build(name=name, mode=r["write_table_model"]):
                df, keys = builders[name]()
                if df.isEmpty():
                    return None
                return tb.load(spark, df, tb.Target(f"{gold_schema}.{name}", "external"), mode, keys=keys, run_ts=run_ts)
            tasks.append((name, build))
        results.extend(_run_all(tasks, parallel))
    return results


def summary(spark: SparkSession, results: list[TableResult]) -> DataFrame:
    """SUCCESS when every table succeeded, else PARTIAL_FAILURE, with the per-table list."""
    df = spark.createDataFrame([(r.table, r.status, r.detail) for r in results] or [("", "succeeded", "")],
                               "table string, status string, detail string")
    failed = any(r.status != "succeeded" for r in results)
    return df.withColumn("run_status", F.lit("PARTIAL_FAILURE" if failed else "SUCCESS"))
