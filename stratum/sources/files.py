"""File sources."""
from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratum.operators.partitioning import spread


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_bronze(df: DataFrame, path: str, mode: str = "overwrite", spread_scan: bool = False) -> None:
    """Bronze sink: snappy Parquet, the whole table replaced (a directory of files, one per task).
    ``spread_scan`` spreads a few-partition source scan over the cluster first."""
    (spread(df) if spread_scan else df).write.mode(mode).option("compression", "snappy").parquet(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A file holding one JSON array (or object) per file; give the schema at scale (no inference pass).
    Each file is parsed by one task, so write many bounded files rather than one large one."""
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def write_json_arrays(df: DataFrame, path: str, rows_per_file: int = 50_000, bucket_cols: list[str] | None = None) -> None:
    """Write ``df`` as JSON array documents, one per file, each holding at most about ``rows_per_file``
    rows (the file count grows with the data, so no single task holds an unbounded group)."""
    n = df.count()
    files = max(1, math.ceil(n / rows_per_file))
    cols = bucket_cols or df.columns
    # the row position joins the hash, so many identical rows still spread over all files
    salt = F.monotonically_increasing_id()
    bucketed = df.withColumn("__file", F.pmod(F.xxhash64(*[F.col(c) for c in cols], salt), F.lit(files)))
    docs = bucketed.groupBy("__file").agg(
        F.to_json(F.collect_list(F.struct(*[F.col(c) for c in df.columns]))).alias("value"))
    docs.write.mode("errorifexists").partitionBy("__file").text(path)


def read_json_arrays(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    df = read_json_array(spark, path, schema)
    names = schema.names if isinstance(schema, T.StructType) else [f.name for f in T._parse_datatype_string(schema).fields]
    return df.select(*names)


def read_config(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Config sheet: first row is the header, every value is text."""
    if fmt == "csv":
        return spark.read.option("header", True).option("inferSchema", False).csv(path)
    if fmt == "json":
        return spark.read.json(path)
    return spark.read.format(fmt).load(path)


def enabled_rows(config: DataFrame, flag: str = "enable_etl") -> DataFrame:
    return config.filter(F.col(flag) == F.lit("1"))


def write_mode_column(config: DataFrame, full_flag: str = "carga_full", mode_col: str = "write_table_model") -> F.Column:
    """'overwrite' when the full-load flag is 'S', else the configured mode."""
    return F.when(F.col(full_flag) == F.lit("S"), F.lit("overwrite")).otherwise(F.col(mode_col))
