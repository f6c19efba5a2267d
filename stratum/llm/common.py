"""Helpers shared by the operators of this subpackage: input normalisation, staged tables, word hashing."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratum.session import scratch_path

#: Entries a worker keeps in a word cache before it is cleared (bounds the worker's memory, not the result).
CACHE_ENTRIES = 400_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the two columns an operator reads; a null text counts as empty, other columns are ignored."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: cuts lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into slices of few rows, so that Python objects exist for few texts at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def small_pieces(batches: Iterator[pa.RecordBatch], column: int, chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Like ``slices``, cut by the bytes of one text column: a slice holds about ``chars`` bytes, at least one row."""
    for b in batches:
        sizes = b.column(column).nbytes / max(1, b.num_rows)
        step = max(1, min(2048, int(chars / max(1.0, sizes))))
        for i in range(0, b.num_rows, step):
            yield b.slice(i, step)


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash, the same in every worker; cleared when it has grown to ``CACHE_ENTRIES``."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (multiply and xor-shift), vectorised."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(words: list[bytes], hashes: WordHashes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of a word list; fewer words than ``width`` make one shingle, none make none."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    w = min(width, n)
    acc = np.full(n - w + 1, np.uint64(w), np.uint64)
    for i in range(w):
        acc = mix64(acc + h[i:n - w + 1 + i])
    return np.unique(acc)
