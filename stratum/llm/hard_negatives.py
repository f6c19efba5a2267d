"""Hard negatives by exact integer inner products, several candidates to one wide integer (Kronecker packing)."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratum.llm.common import stage
from stratum.llm.vectors import common_length, matrix, usable
from stratum.session import scratch_path

SCALE = 256
#: Anchors scored in one pass over all rows. They travel with the task, so this bounds its memory.
BLOCK_ANCHORS = 4096
#: Bytes of scores a task holds at a time; candidates are taken in portions of that size.
SCORE_BYTES = 64 << 20
#: A row whose product with itself reaches this takes no part: below it no score leaves a long.
LARGEST_SQUARE = 2.0 ** 62
OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


class Packing:
    """How many candidates share one integer. A candidate's component c becomes c + bias >= 0 in a field of ``width``
    bits; an anchor's component a becomes a + bias as well. One product a * P then holds all fields' products, and a
    sum over the components holds all fields' sums, since no sum reaches 2**width.

    Two fields of up to 26 bits fit the 53 bits in which doubles are exact integers, and then the products run as a
    double matrix product. Otherwise the integers are longs, and Python's unbounded ones where not even one field fits."""

    def __init__(self, bound: int, d: int):
        self.bias, self.d = int(bound), d
        self.width = max(1, (d * (2 * self.bias) ** 2).bit_length())
        if self.width <= 53:
            self.fields, self.kind = 53 // self.width, np.float64
        elif self.width <= 63:
            self.fields, self.kind = 1, np.int64
        else:
            self.fields, self.kind = 8, object

    def anchors(self, a: np.ndarray) -> np.ndarray:
        return self._whole(a) + self.bias

    def _whole(self, x: np.ndarray) -> np.ndarray:
        """Integer-valued doubles in the working type."""
        return np.vectorize(int, otypes=[object])(x) if self.kind is object and x.size else x.astype(self.kind)

    def pack(self, c: np.ndarray) -> np.ndarray:
        """Candidates (rows by components) as packed rows, ``fields`` candidates in each."""
        rows = -(-len(c) // self.fields)
        biased = np.zeros((rows * self.fields, self.d), self.kind)   # absent candidates are zero fields
        biased[:len(c)] = self._whole(c) + self.bias
        biased = biased.reshape(rows, self.fields, self.d)
        packed = biased[:, self.fields - 1]
        for j in range(self.fields - 2, -1, -1):   # the first candidate in the lowest field
            packed = packed * (1 << self.width) + biased[:, j]
        return packed

    def scores(self, anchors: np.ndarray, packed: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Exact inner products of all (biased) anchors with all candidates: one product per anchor component and
        packed row, then the fields are taken apart and the bias's share is taken off."""
        wide = anchors @ packed.T
        if self.kind is np.float64:
            wide = wide.astype(np.int64)
        out = np.empty((len(anchors), packed.shape[0], self.fields), wide.dtype)
        low = (1 << self.width) - 1
        for j in range(self.fields):
            out[:, :, j] = wide & low
            wide = wide >> self.width
        out = out.reshape(len(anchors), packed.shape[0] * self.fields)[:, :len(c)]
        whole = object if self.kind is object else np.int64
        own = (self._whole(c) + self.bias).astype(whole).sum(axis=1)
        # (a + B)(c + B) summed = ac + B * sum(a + B) + B * sum(c + B) - d * B * B
        out = out - self.bias * anchors.astype(whole).sum(axis=1)[:, None] - self.bias * own[None, :] + self.d * self.bias ** 2
        return out.astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores among positions ``among``, ties by smaller id, best first."""
    if len(among) > k:
        s = scores[among]
        among = among[s >= s[np.argpartition(s, len(s) - k)[len(s) - k]]]   # all that tie with the last stay
    return among[np.lexsort((ids[among], -scores[among]))][:k]


def _portions(batches: Iterator[pa.RecordBatch], d: int, anchors: int) -> Iterator[tuple]:
    """(row, vec_id, label, components) of candidates, in portions whose scores with all anchors stay bounded."""
    step = max(256, SCORE_BYTES // (8 * max(1, anchors)))
    for batch in batches:
        for i in range(0, batch.num_rows, step):
            b = batch.slice(i, step)
            yield *(b.column(j).to_numpy(zero_copy_only=False) for j in range(3)), matrix(b.column(3), d)


def _keep(held: tuple | None, new: tuple, k: int) -> tuple:
    """The best ``k`` of two small lists of (scores, ids, rows)."""
    s, i, r = new if held is None else (np.concatenate(x) for x in zip(held, new))
    top = np.lexsort((r, i, -s))[:k]
    return s[top], i[top], r[top]


def _positives(batches, block: dict, packing: Packing, k: int) -> Iterator[pa.RecordBatch]:
    """This partition's first ``k`` other rows of the anchor's label, per anchor."""
    anchors, held = packing.anchors(block["x"]), {}
    for rows, ids, labels, x in _portions(batches, packing.d, len(anchors)):
        scores = packing.scores(anchors, packing.pack(x), x)
        for a in range(len(anchors)):
            top = _best(scores[a], ids, np.flatnonzero((labels == block["label"][a]) & (rows != block["row"][a])), k)
            if len(top):
                held[a] = _keep(held.get(a), (scores[a][top], ids[top], rows[top]), k)
    yield from _emit(((block["row"][a], block["vec_id"][a], i, s) for a, (ss, ii, _) in held.items() for s, i in zip(ss, ii)),
                     ["anchor_row", "anchor_id", "positive_id", "positive_score"])


def _negatives(batches, block: dict, packing: Packing, k: int, low: int, high: int) -> Iterator[pa.RecordBatch]:
    """This partition's first ``k`` rows of another label in the window below each positive's score."""
    anchors, held = packing.anchors(block["x"]), {}
    for rows, ids, labels, x in _portions(batches, packing.d, len(anchors)):
        scores = packing.scores(anchors, packing.pack(x), x)
        for a, wanted in enumerate(block["positive_scores"]):
            other = np.flatnonzero(labels != block["label"][a])
            s = scores[a][other]
            for p in wanted:
                # low * p <= high * s <= high * p, as bounds on s alone: products could leave a long
                top = _best(scores[a], ids, other[(s <= p) & (s >= -(-low * p // high))], k)
                if len(top):
                    held[a, p] = _keep(held.get((a, p)), (scores[a][top], ids[top], rows[top]), k)
    yield from _emit(((block["row"][a], n, i, p, s) for (a, p), (ss, ii, rr) in held.items() for s, i, n in zip(ss, ii, rr)),
                     ["anchor_row", "negative_row", "negative_id", "positive_score", "negative_score"])


def _emit(rows, names: list[str]) -> Iterator[pa.RecordBatch]:
    columns = [pa.array(list(map(int, c)), pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * len(names)
    yield pa.RecordBatch.from_arrays(columns, names=names)


def mine_hard_negatives(vectors: DataFrame, anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 5,
                        low: int = 80, high: int = 100, vector: str = "embedding", block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """Per anchor, positive and rank: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Rows have ``vec_id``, a label (``label``, by default the column of that name) and a vector, whose component x
    counts as floor(256 * x). ``anchor`` says which rows are anchors. An anchor's positives are its ``positives``
    highest-scoring other rows of the same label; each positive's negatives are the ``negatives`` highest-scoring rows of
    another label with low * positive_score <= high * negative_score <= high * positive_score. Ties go by smaller vec_id.

    Rows with a null vec_id, label or vector, with a null or non-finite component, with a vector of another length than
    the most frequent one, or with components so large that scores could leave a long take no part. Repeated rows are
    rows of their own. Pairs without negatives, empty vectors and an empty table give no rows; other columns are ignored.

    Anchors are scored in blocks of about ``block_anchors``: a block is sent to the tasks, each of which scores its own
    rows against the whole block and returns at most ``positives`` or ``negatives`` rows per anchor or pair."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"),
                          F.coalesce(anchor, F.lit(False)).alias("anchor"), F.col(vector).cast("array<double>").alias("x"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("x")) & (F.size("x") > 0))
    # floor() of a double is a long and would cut what is larger; the bound on the squares drops such rows first
    wide = F.aggregate("x", F.lit(0.0), lambda s, c: s + (SCALE * F.abs(c) + 1) * (SCALE * F.abs(c) + 1))
    rows = rows.where(wide < LARGEST_SQUARE).withColumn("x", F.transform("x", lambda c: F.floor(SCALE * c).cast("double")))
    found = stage(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "anchor", "x"), "vectors")
    d = common_length(found, "x")
    found = found.where(F.size("x") == d)
    bound, n = found.agg(F.max(F.greatest(F.array_max("x"), -F.array_min("x"))), F.count(F.when(F.col("anchor"), 1))).first()
    packing = Packing(int(bound or 0), d)
    blocks = -(-n // block_anchors)
    anchors = stage(found.where("anchor").withColumn("block", F.floor(F.rand(13) * blocks).cast("int")).drop("anchor"), "anchors") if blocks else None
    candidates = found.select("row", "vec_id", "label", "x")
    # every block's rows are written on their own, so that a plan holds one block and a lost executor costs no earlier one
    folder = scratch_path(spark, "llm", "hard_negatives")
    for b in range(blocks):
        mined = _mine_block(candidates, anchors.where(F.col("block") == b).drop("block"), packing, positives, negatives, low, high)
        mined.write.parquet(f"{folder}/block={b}")
    return spark.read.schema(OUT + ", block int").parquet(folder).drop("block") if blocks else spark.createDataFrame([], OUT)


def _mine_block(candidates: DataFrame, anchors: DataFrame, packing: Packing, n_pos: int, n_neg: int, low: int, high: int) -> DataFrame:
    """One block of anchors: a pass for the positives, a pass for the negatives. Only the block's anchors and their
    positives (a bounded number) are held by the driver."""
    at = sorted(anchors.select("row", "vec_id", "label", "x").collect())
    block = {"row": np.array([r[0] for r in at], np.int64), "vec_id": np.array([r[1] for r in at], np.int64),
             "label": np.array([r[2] for r in at], np.int64), "x": np.array([r[3] for r in at], np.float64).reshape(len(at), packing.d)}
    best = Window.partitionBy("anchor_row").orderBy(F.desc("positive_score"), "positive_id")
    local = candidates.mapInArrow(lambda it: _positives(it, block, packing, n_pos),
                                  "anchor_row long, anchor_id long, positive_id long, positive_score long")
    pos = stage(local.withColumn("place", F.row_number().over(best)).where(F.col("place") <= n_pos), "positives")
    by_row: dict[int, set] = {}
    for r in pos.collect():
        by_row.setdefault(r["anchor_row"], set()).add(r["positive_score"])
    sought = block | {"positive_scores": [sorted(by_row.get(int(r), ())) for r in block["row"]]}
    local = candidates.mapInArrow(lambda it: _negatives(it, sought, packing, n_neg, low, high),
                                  "anchor_row long, negative_row long, negative_id long, positive_score long, negative_score long")
    # positives of an anchor with equal scores have the same negatives: these are found once and joined to each
    rank = Window.partitionBy("anchor_row", "positive_score").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    neg = local.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= n_neg)
    return pos.join(neg, ["anchor_row", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
