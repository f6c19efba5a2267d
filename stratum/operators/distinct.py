"""Whole-row de-duplication that exchanges digests in place of rows."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.operators.joins import DEFAULT_BROADCAST_ROWS
from stratum.session import scratch_path

_DIGEST = "__digest"


def _digested(df: DataFrame) -> DataFrame:
    return df.withColumn(_DIGEST, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))


def distinct_rows(df: DataFrame, max_digests: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """The distinct rows of a scan. Only 64-bit digests of the rows are dealt out and counted; rows whose digest occurs
    once are distinct and stay where they are, and whole rows are compared only where digests agree, so a collision
    costs a comparison and no row.

    With more than ``max_digests`` repeated digests most of the table repeats, and whole rows are grouped directly (rows
    are combined before that shuffle). ``df`` is read three times, so it must give the same rows each time, as files do;
    stage anything else first. NULLs equal each other, as in ``distinct``."""
    if not df.columns:
        return df.distinct()
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "digests")
    repeated = _digested(df).groupBy(_DIGEST).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(_DIGEST)
    repeated.write.parquet(path)
    repeated = spark.read.schema(repeated.schema).parquet(path)
    if repeated.count() > max_digests:
        return df.distinct()
    repeated = F.broadcast(repeated)      # at most max_digests longs
    rows = _digested(df)
    once = rows.join(repeated, _DIGEST, "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])
    again = rows.join(repeated, _DIGEST, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])
    return once.unionByName(again.distinct())
