"""Relational sources (A1, A2, A3, D7 helper, K28).

The select list is generated from the source's column catalogue: unbounded timestamps become NULL,
money becomes numeric(38,2), every other column is read as is, in ordinal order of the configured
schema (Q24). Reads are partitioned on a numeric column when bounds are given."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.functions.casts import INFINITY_TEXTS, MONEY_TYPE, infinity_to_null, money_to_decimal

# Source type names that need a converted read.
TIMESTAMP_TYPES = ("timestamp without time zone", "timestamp with time zone")
MONEY_TYPES = ("money",)


def select_item(column: str, data_type: str) -> str:
    """One entry of the generated source SELECT list (source SQL dialect)."""
    q = '"' + column.replace('"', '""') + '"'
    if data_type in TIMESTAMP_TYPES:
        texts = ", ".join(f"'{t}'" for t in INFINITY_TEXTS)
        return f"CASE WHEN {q}::text IN ({texts}) THEN NULL ELSE {q} END AS {q}"
    if data_type in MONEY_TYPES:
        return f"{q}::NUMERIC(38,2) AS {q}"
    return q


def select_item_column(column: Column, data_type: Column) -> Column:
    """The same rule as a Spark expression over a catalogue DataFrame."""
    q = F.concat(F.lit('"'), F.replace(column, F.lit('"'), F.lit('""')), F.lit('"'))
    texts = ", ".join(f"'{t}'" for t in INFINITY_TEXTS)
    ts = F.concat(F.lit("CASE WHEN "), q, F.lit(f"::text IN ({texts}) THEN NULL ELSE "), q, F.lit(" END AS "), q)
    money = F.concat(q, F.lit("::NUMERIC(38,2) AS "), q)
    return (F.when(data_type.isin(*TIMESTAMP_TYPES), ts)
             .when(data_type.isin(*MONEY_TYPES), money).otherwise(q))


def select_lists(catalogue: DataFrame, schema_col: str = "table_schema", table_col: str = "table_name",
                 column_col: str = "column_name", type_col: str = "data_type",
                 ordinal_col: str = "ordinal_position") -> DataFrame:
    """Per table, the comma-joined select list in ordinal order (one aggregate per table)."""
    items = catalogue.select(schema_col, table_col, F.col(ordinal_col).alias("__o"),
                             select_item_column(F.col(column_col), F.col(type_col)).alias("__item"))
    return items.groupBy(schema_col, table_col).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("__o", "__item"))), lambda s: s["__item"]),
                     ", ").alias("select_list"))


def source_query(schema: str, table: str, select_list: str, watermark_column: str | None = None,
                 run_ts: _dt.datetime | None = None, delta_days: int | None = None) -> str:
    """Full read, or an incremental look-back ``WHERE watermark > run_ts + delta_days``."""
    sql = f'SELECT {select_list} FROM "{schema}"."{table}"'
    if watermark_column and run_ts is not None and delta_days is not None:
        since = run_ts + _dt.timedelta(days=int(delta_days))
        sql += f" WHERE \"{watermark_column}\" > '{since:%Y-%m-%d %H:%M:%S}'"
    return sql


def read_jdbc(spark: SparkSession, url: str, query: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int | None = None, fetch_size: int = 10_000) -> DataFrame:
    """A JDBC read of a generated query; parallel when a numeric partition column and bounds are given."""
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("dbtable", f"({query}) src").option("partitionColumn", partition_column)
              .option("lowerBound", lower).option("upperBound", upper).option("numPartitions", num_partitions))
    else:
        r = r.option("query", query)
    return r.load()


def project_source(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """The generated projection applied to an already-loaded frame (file or table sources):
    timestamps outside the representable range -> NULL, money -> decimal(38,2)."""
    cols = []
    for c in df.columns:
        t = types.get(c, "")
        if t in TIMESTAMP_TYPES:
            cols.append(infinity_to_null(c).alias(c))
        elif t in MONEY_TYPES:
            cols.append(money_to_decimal(c).alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)
