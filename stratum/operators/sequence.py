"""Successor lookup in key order without putting a whole key into one task (E2 building block).

``LEAD(x) OVER (PARTITION BY k ORDER BY o)`` buffers each key in one task; a key holding a third
of all rows would then be a third of the job on one core. Instead the frame is written once with a
number per row, and only its narrow columns (number, key, order, carried values) are
range-partitioned on (k, o) — the sampled bounds split a hot key across tasks — sorted inside each
partition and numbered in that order with ``monotonically_increasing_id`` (consecutive inside a
partition). A row's successor is the next position, or for the last row of a partition the first row
of the next non-empty partition (a table of one row per partition, so its size is bounded by the
partition count). It is found by an equi-join of the narrow rows on that position, and meets the
wide row by the row's number; neither join has hot keys. Wide rows are never sorted in key order and
are dealt out once at most: not at all where the narrow result is small enough to be broadcast."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratum.session import scratch_path, shared_dir

_POS, _SUCC, _PID, _ROW = "__pos", "__succ", "__pid", "__row"


def with_successor(df: DataFrame, key: str, order: list[str], carry: list[str], prefix: str = "next_",
                   partitions: int | None = None, chain_nulls: bool = False) -> DataFrame:
    """Adds ``prefix + c`` for every ``c`` in ``carry``: the value on the next row of the same key
    in (key, *order) order, NULL on a key's last row. ``order`` must make rows unique within a key.
    NULL keys are not chained unless ``chain_nulls``. Repeated rows are rows of their own."""
    wide = _numbered(df)
    rows = wide if chain_nulls else wide.filter(F.col(key).isNotNull())
    following = _following(rows, key, order, carry, prefix, partitions, chain_nulls)
    return wide.join(following, _ROW, "left").select(*df.columns, *[prefix + c for c in carry])


def _numbered(df: DataFrame) -> DataFrame:
    """``df``, written, with a number per row: recomputation after a lost executor must see the same numbers."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "successor")
    rows = df.withColumn(_ROW, F.monotonically_increasing_id())
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _following(rows: DataFrame, key: str, order: list[str], carry: list[str], prefix: str,
               partitions: int | None, chain_nulls: bool) -> DataFrame:
    """(row number, carried values of the successor) of the rows that have one; narrow columns only."""
    shared_dir(rows.sparkSession)
    narrow = rows.select(_ROW, *[F.col(c) for c in dict.fromkeys([key, *order, *carry])])
    keys = [F.col(key).asc_nulls_first(), *[F.col(o).asc_nulls_first() for o in order]]
    # without an explicit count the session's shuffle partitions apply and AQE may resize them
    ranged = narrow.repartitionByRange(partitions, *keys) if partitions else narrow.repartitionByRange(*keys)
    ordered = ranged.sortWithinPartitions(*keys).select(
        _ROW, F.col(key).alias("__key"), *[F.col(c).alias(prefix + c) for c in carry],
        F.monotonically_increasing_id().alias(_POS))
    # Pin the positions, as the row numbers above.
    ordered = ordered.checkpoint(eager=True).withColumn(_PID, F.shiftright(F.col(_POS), 33))
    edges = (ordered.groupBy(_PID).agg(F.min(_POS).alias("__first"), F.max(_POS).alias("__last"))
                    .withColumn("__next_first", F.lead("__first").over(Window.orderBy(_PID))))
    # One row per partition: bounded by the partition count, safe to broadcast.
    located = (ordered.join(F.broadcast(edges.select(_PID, "__last", "__next_first")), _PID)
                      .select(_ROW, F.col("__key").alias("__own_key"),
                              F.when(F.col(_POS) == F.col("__last"), F.col("__next_first"))
                               .otherwise(F.col(_POS) + 1).alias(_SUCC)))
    succ = ordered.select(F.col(_POS).alias(_SUCC), "__key", *[prefix + c for c in carry])
    same = F.col("__key").eqNullSafe(F.col("__own_key")) if chain_nulls else F.col("__key") == F.col("__own_key")
    return located.join(succ, _SUCC).filter(same).select(_ROW, *[prefix + c for c in carry])


def with_successor_window(df: DataFrame, key: str, order: list[str], carry: list[str], prefix: str = "next_",
                          chain_nulls: bool = False) -> DataFrame:
    """Reference form with a window (used as the test oracle for ``with_successor``)."""
    w = Window.partitionBy(key).orderBy(*order)
    out = df.select(*df.columns, *[F.lead(c).over(w).alias(prefix + c) for c in carry])
    if not chain_nulls:
        out = out.select(*df.columns, *[F.when(F.col(key).isNotNull(), F.col(prefix + c)).alias(prefix + c)
                                       for c in carry])
    return out
