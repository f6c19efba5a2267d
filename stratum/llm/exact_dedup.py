"""Exact de-duplication by content sort: range partitions on sampled splitters, a sort that places equal texts next to
each other, and full comparisons of neighbours."""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from stratum.llm.common import stage

WHITE = r"[\x20\x09-\x0D]+"
PREFIX_CHARS = 32


def normalised(col):
    """Text with every run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(col, F.lit("")), WHITE, " ")


def _squeeze(a: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(pc.fill_null(a, ""), r"[\x20\x09-\x0D]+", " ")


def _runs(batches: Iterator[pa.RecordBatch], keep: list[str], first_only: bool) -> Iterator[pa.RecordBatch]:
    """Neighbour comparison within one sorted partition; the last row of a batch is the neighbour of the next one's first."""
    part, run, last = TaskContext.get().partitionId(), -1, None
    for b in batches:
        if not b.num_rows:
            continue
        sha, text = b.column("sha"), b.column("raw")
        head = last[0] if last else None
        before = pa.concat_arrays([pa.array([head], sha.type), sha.slice(0, b.num_rows - 1)])
        same = pc.fill_null(pc.equal(sha, before), False)
        at = pc.indices_nonzero(same).to_pylist()
        if at:
            left = [last[1] if i == 0 else None for i in at[:1]]
            prior = text.take(pa.array([i - 1 for i in at if i], pa.int64()))
            prior = pa.concat_arrays([pa.array([left[0]], text.type), prior]) if at[0] == 0 else prior
            if not pc.all(pc.equal(_squeeze(text.take(pa.array(at, pa.int64()))), _squeeze(prior))).as_py():
                raise RuntimeError("two different texts with one SHA-256")
        opens = pc.invert(same)
        number = pc.add(pc.cumulative_sum(pc.cast(opens, pa.int64())), run)
        run = number[-1].as_py()
        last = (sha[-1].as_py(), text[-1].as_py())
        out = pa.RecordBatch.from_arrays(
            [b.column(c) for c in keep] + [sha, pa.array([part] * b.num_rows, pa.int32()), number, opens],
            names=[*keep, "sha", "part", "run", "opens"])
        yield out.filter(opens) if first_only else out


def sorted_runs(docs: DataFrame, carry: list[str], first_only: bool = False) -> DataFrame:
    """Rows in content order with (sha, part, run, opens): ``run`` numbers the runs of equal texts in partition ``part``,
    ``opens`` marks a run's first row. ``carry`` names the columns that go along (as ``c0``, ``c1``, ...).

    Splitters are sampled on (leading characters, SHA-256, doc_id), not on whole texts, so the sample stays small, and
    a text with very many copies is itself cut over several partitions by doc_id."""
    norm = normalised(F.col("text"))
    base = docs.select(F.substring(norm, 1, PREFIX_CHARS).alias("head"), F.sha2(norm, 256).alias("sha"),
                       F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("raw"),
                       *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry)])
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("head"), F.col("sha"), F.col("id").asc_nulls_last()]
    rows = base.repartitionByRange(n, *order).sortWithinPartitions(*order)
    keep = [f"c{i}" for i in range(len(carry))]
    fields = [rows.schema[c] for c in keep] + [T.StructField("sha", T.StringType()), T.StructField("part", T.IntegerType()),
                                               T.StructField("run", T.LongType()), T.StructField("opens", T.BooleanType())]
    return rows.mapInArrow(lambda it: _runs(it, keep, first_only), T.StructType(fields))


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id (smallest doc_id of the equal texts), group_size, kept, text_sha256.

    Null text is empty; null doc_ids sort last, so a row with an id stays if there is one. Repeated rows (same doc_id
    and text) count in group_size and exactly one of them is kept. An empty table gives an empty result; other
    columns are ignored."""
    rows = stage(sorted_runs(docs.select("doc_id", "text"), ["doc_id"]), "content_runs")
    runs = rows.groupBy("part", "run").agg(F.min("sha").alias("sha"), F.min(F.col("c0").cast("long")).alias("low"),
                                           F.count(F.lit(1)).alias("n"))
    # a text cut over several partitions has one run in each; those runs are few, at most one per partition
    groups = runs.groupBy("sha").agg(F.min("low").alias("keep_id"), F.sum("n").alias("group_size"), F.min("part").alias("first_part"))
    info = runs.select("part", "run", "sha").join(groups, "sha").select("part", "run", "keep_id", "group_size", "first_part")
    return rows.join(info, ["part", "run"]).select(
        F.col("c0").cast("long").alias("doc_id"), "keep_id", "group_size",
        (F.col("opens") & (F.col("part") == F.col("first_part"))).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay (all columns, unchanged): of equal normalised texts the one with the smallest doc_id."""
    cols = docs.columns
    rows = stage(sorted_runs(docs, cols, first_only=True), "content_firsts")
    # a run that began in an earlier partition: at most one row per partition, found by the smallest partition of its text
    again = rows.groupBy("sha").agg(F.min("part").alias("first_part"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = again.withColumnRenamed("sha", "s")
    late = rows.select("sha", "part").join(again, F.col("sha") == F.col("s")).where("part > first_part").select("sha", "part")
    return rows.join(late, ["sha", "part"], "left_anti").select([F.col(f"c{i}").alias(c) for i, c in enumerate(cols)])
