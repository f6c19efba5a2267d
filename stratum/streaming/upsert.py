"""Bronze files -> silver table, merged per micro-batch (foreachBatch + the A15 merge)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratum.functions.names import clean_column_names
from stratum.session import shared_dir
from stratum.sources import tables as tb


def upsert_stream(spark: SparkSession, bronze_path: str, schema: T.StructType, target: tb.Target, keys,
                  run_ts, checkpoint: str | None = None, on_duplicate: str = "error", order_by: str | None = None):
    """Start an ``availableNow`` stream that merges every new batch of bronze Parquet files into ``target``.
    Returns the StreamingQuery; call ``awaitTermination()`` to wait for the backlog."""
    ckpt = checkpoint or f"{shared_dir(spark)}/stratum/streams/{target.name}"
    stream = spark.readStream.schema(schema).parquet(bronze_path)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        df = clean_column_names(batch)
        if df.isEmpty():
            return
        tb.load(spark, df, target, "merge", keys=keys, run_ts=run_ts, on_duplicate=on_duplicate, order_by=order_by)

    return (stream.writeStream.foreachBatch(merge_batch).option("checkpointLocation", ckpt)
            .trigger(availableNow=True).start())
