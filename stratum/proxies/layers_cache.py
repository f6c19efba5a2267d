"""Materialized silver/gold tables shared by the report queries of one session.

A medallion run writes silver and gold once; reports then read the written gold tables. The report
queries do the same: the first one that needs a layer table builds and writes it (under the shared
folder), later ones read it. Entries are keyed by the input folder and the size and modification
time of its files, so changed inputs are rebuilt."""
from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratum.sources import tables as tb

_LOCK = threading.RLock()   # re-entrant: a layer build may need another layer
_TABLES: dict[tuple, str] = {}


def _fingerprint(spark: SparkSession, d: str) -> tuple:
    """Names, sizes and times of the input's files and folders, by the file system that Spark reads them from."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(d)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(path)))


def materialized(spark: SparkSession, d: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    key = (spark.sparkContext.applicationId, d, name, _fingerprint(spark, d))
    with _LOCK:
        t = _TABLES.get(key)
        if t and spark.catalog.tableExists(t):
            return spark.table(t)
        t = f"layer_{uuid.uuid4().hex[:8]}.{name}"
        out = tb.create_table(spark, build(), tb.Target(t, "external"))
        _TABLES[key] = t
        return out
