"""Parallelism guard for CPU-heavy per-row work (JSON parsing, wide projections) on a scan.

A table stored as a few large files scans as a few partitions; per-row work on it would then run
on a few cores. ``spread`` redistributes such a scan round-robin to the cluster's default
parallelism. It is a no-op when the scan already has at least that many partitions, which is the
normal case for large tables.

Apply it to a scan (or a projection/filter of one), never to a frame with a shuffle: counting the
partitions of an adaptive plan materializes its shuffle stages."""
from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, target: int | None = None) -> DataFrame:
    want = target or df.sparkSession.sparkContext.defaultParallelism
    have = df.rdd.getNumPartitions()          # planning only, no job
    return df.repartition(want) if have < want else df
