"""MinHash near-duplicates with odd sketches: parity bitmaps of MinHash samples estimate high similarities by the
population count of their XOR, and banded candidates that pass are confirmed on their full shingle sets."""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratum.llm.common import WordHashes, fresh, id_text, mix64, shingle_set, small_pieces, stage
from stratum.llm.components import PAIR, group_by_buckets, shared_buckets

#: 32 bands of 4: a pair at similarity 0.8 shares no band with probability (1 - 0.8^4)^32 < 5e-8.
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Bits of an odd sketch.
BITS = 512
#: A pair is passed over below this estimate. At a true similarity of 0.8 the estimate has a standard deviation of about
#: 0.042 (0.035 from 128 samples, 0.023 from the bitmap), so 0.62 is more than four deviations away: one pair in 100,000.
PASS = 0.62

#: Finer sketches for buckets that stay mixed: samples, bits, and the estimate below which a pair is passed over. At 0.8 its
#: standard deviation is about 0.0145 (0.0125 from the samples, 0.0072 from the bitmap), four of which are 0.058.
FINE_HASHES, FINE_BITS, FINE_PASS = 1024, 2048, 0.74

_rng = np.random.default_rng(20240229)
_XOR = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_MUL = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_FINE_XOR = _rng.integers(0, 1 << 32, FINE_HASHES, dtype=np.uint32)
_FINE_MUL = _rng.integers(0, 1 << 31, FINE_HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SALT = mix64(np.arange(1, FINE_HASHES + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def max_differences(similarity: float = PASS, hashes: int = HASHES, bits: int = BITS) -> int:
    """Set bits of an XOR that the sketches of two sets of this similarity have on average: each of the samples that
    differ puts two elements into the symmetric difference."""
    m = 2 * hashes * (1 - similarity)
    return int(bits / 2 * (1 - (1 - 2 / bits) ** m))


def words(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode().lower().split()


def samples(sets: list[np.ndarray], xor: np.ndarray, mul: np.ndarray) -> np.ndarray:
    """MinHash samples of non-empty shingle sets: one row of as many numbers as there are hash functions each, salted."""
    low = np.empty((len(sets), len(xor)), np.uint32)
    i = 0
    while i < len(sets):   # runs of sets whose shingles stay in the processor's cache
        j, size = i, 0
        while j < len(sets) and (j == i or size + len(sets[j]) <= 60_000):
            size += len(sets[j])
            j += 1
        x = (np.concatenate(sets[i:j]) >> np.uint64(32)).astype(np.uint32)
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[i:j - 1]])]).astype(np.int64)
        for k in range(len(xor)):
            h = (x ^ xor[k]) * mul[k]
            low[i:j, k] = np.minimum.reduceat(h ^ (h >> np.uint32(15)), starts)
        i = j
    return mix64(low.astype(np.uint64) + _SALT[:len(xor)])


def odd_sketch(wide: np.ndarray, bits: int) -> np.ndarray:
    """Parity bitmaps of ``bits`` bits of rows of samples, as 64-bit numbers."""
    n = len(wide)
    at = (wide % np.uint64(bits)).astype(np.int64) + np.arange(n)[:, None] * bits
    odd = (np.bincount(at.ravel(), minlength=n * bits) & 1).astype(np.uint8).reshape(n, bits)
    return np.packbits(odd, axis=1).view(np.uint64)


def signatures(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(band keys, odd sketches) of non-empty shingle sets: one row of BANDS and of BITS / 64 64-bit numbers each."""
    n = len(sets)
    wide = samples(sets, _XOR, _MUL)
    bands = np.zeros((n, BANDS), np.uint64)
    for r in range(ROWS):
        bands = mix64(bands + wide.reshape(n, BANDS, ROWS)[:, :, r])
    return bands, odd_sketch(wide, BITS)


def _fine(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(node, sketch): finer sketches of (node, text), the set's size after the bits."""
    hashes = WordHashes()
    for b in small_pieces(batches, 1, 4_000_000):
        sets = [shingle_set(words(t), hashes, width) for t in b.column(1).to_pylist()]
        if sets:
            odd = odd_sketch(samples(sets, _FINE_XOR, _FINE_MUL), FINE_BITS)
            full = np.column_stack([odd, np.array([len(x) for x in sets], np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(full), pa.list_(pa.int64()))], names=["node", "sketch"])


def _alike(x: np.ndarray, y: np.ndarray, percent: int, most: int) -> np.ndarray:
    """How alike the pairs of two blocks of finer sketches are, 0 where they cannot be linked: by their sizes, then by the
    set bits of the XOR."""
    nx, ny = x[:, -1:].astype(np.int64), y[:, -1].astype(np.int64)[None]
    ok = 100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)
    return ok * np.maximum(most + 1 - np.bitwise_count(x[:, None, :-1] ^ y[None, :, :-1]).sum(axis=2, dtype=np.int32), 0)


SIG = "row long, doc_id long, text_hash long, n_shingles long, set_key binary, bands array<long>, odd array<long>"


def _sign(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for b in small_pieces(batches, 3, 4_000_000):
        sets = [shingle_set(words(t), hashes, width) for t in b.column(3).to_pylist()]
        full = [i for i, s in enumerate(sets) if len(s)]
        bands, odd = [None] * len(sets), [None] * len(sets)
        if full:
            bv, ov = signatures([sets[i] for i in full])
            for k, i in enumerate(full):
                bands[i], odd[i] = bv[k].view(np.int64), ov[k].view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), b.column(2), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(odd, pa.list_(pa.int64()))],
            names=["row", "doc_id", "text_hash", "n_shingles", "set_key", "bands", "odd"])


def _confirm(batches: Iterator[pa.RecordBatch], width: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs with 100 * intersection >= percent * union, on full sets. Rows of one left text come together."""
    hashes = WordHashes()
    last, left = None, None
    for b in small_pieces(batches, 4, 4_000_000):
        keep = []
        a, ta, tb = b.column("a").to_pylist(), b.column("ta").to_pylist(), b.column("tb").to_pylist()
        for i, node in enumerate(a):
            if node != last:
                last, left = node, shingle_set(words(ta[i]), hashes, width)
            right = shingle_set(words(tb[i]), hashes, width)
            both = len(np.intersect1d(left, right, assume_unique=True))
            if 100 * both >= percent * (len(left) + len(right) - both):
                keep.append(i)
        yield b.select(["a", "b", "ca", "cb"]).take(pa.array(keep, pa.int64()))


def _apart(x: Column, y: Column) -> Column:
    """Set bits of the XOR of two sketches."""
    total = F.lit(0)
    for k in range(BITS // 64):
        total = total + F.bit_count(x[k].bitwiseXOR(y[k]))
    return total


def near_groups(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: row, doc_id, text_hash, n_shingles, component_id, first_row (whether the row is the first
    one of its component's smallest doc_id; exactly one row of a component is).

    A row's set is the distinct ``width``-word shingles of its text (one shingle if it has fewer words; none without
    words, and then it is linked with nothing). Rows with 100 * intersection >= percent * union are linked.

    Rows with equal sets form one class, so copies never pair up. In a band's bucket every class is first compared with
    the bucket's smallest class and a pivot only. Buckets whose classes are then in one component are done; in the others
    classes of different components are compared too, by odd sketches of more samples, so no candidate is left out however
    large a bucket is.
    Null text is empty; null ids never become a component_id unless a component has no other; repeated rows are in one
    class; an empty table gives an empty result."""
    rows = id_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"), "text")
    sig = stage(rows.mapInArrow(lambda it: _sign(it, width), SIG), "sketches")
    filled = sig.where("set_key IS NOT NULL")
    classes = stage(filled.groupBy("set_key").agg(F.min("row").alias("node")), "classes")
    reps = filled.join(classes.select("node"), F.col("row") == F.col("node"), "left_semi") \
        .select(F.col("row").alias("node"), "doc_id", "text_hash", "n_shingles", "odd", "bands")
    shared = shared_buckets(reps.select(F.explode("bands").alias("bucket"), "node"))
    # texts and sketches of the classes that share a bucket with another one
    known = reps.join(shared.select("node").distinct(), "node", "left_semi").select("node", F.col("doc_id").alias("d"), "text_hash", "odd", "n_shingles")
    texts = id_text(docs).withColumn("text_hash", F.xxhash64("text"))
    cand = stage(texts.join(known, texts.doc_id.eqNullSafe(F.col("d")) & (texts.text_hash == known.text_hash))
                 .groupBy("node").agg(F.first("text").alias("text"), F.first(F.struct("odd", "n_shingles")).alias("sketch")), "candidates")

    limit, fine_limit = max_differences(), max_differences(FINE_PASS, FINE_HASHES, FINE_BITS)

    def passes(x: Column, y: Column) -> Column:
        """Sizes that allow the similarity (a set's share of a union is at most the smaller size by the larger), then the sketches."""
        small, large = F.least(x["n_shingles"], y["n_shingles"]), F.greatest(x["n_shingles"], y["n_shingles"])
        return (100 * small >= percent * large) & (_apart(x["odd"], y["odd"]) <= limit)

    def refine(nodes: DataFrame) -> DataFrame:
        return cand.select("node", "text").join(nodes, "node").mapInArrow(lambda it: _fine(it, width), "node long, sketch array<long>")

    def confirm(pairs: DataFrame) -> DataFrame:
        t = cand.select("node", "text")
        both = pairs.join(t.toDF("b", "tb"), "b").join(t.toDF("a", "ta"), "a").select("a", "b", "ca", "cb", "ta", "tb")
        return both.mapInArrow(lambda it: _confirm(it, width, percent), PAIR)

    comp = group_by_buckets(shared, cand.select("node", "sketch"), passes, confirm, refine,
                            lambda x, y: _alike(x, y, percent, fine_limit))
    low = classes.join(comp, "node", "left").select("set_key", F.coalesce("component", "node").alias("component"))
    named = sig.join(low, "set_key", "left").withColumn("component", F.coalesce("component", "row"))
    placed_rows = named.select("row", "doc_id", "text_hash", "n_shingles", "component")
    ids = placed_rows.groupBy("component").agg(
        F.min("doc_id").alias("component_id"),
        F.min_by("row", F.struct(F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1)), F.col("row"))).alias("first"))
    return placed_rows.join(ids, "component").select("row", "doc_id", "text_hash", "n_shingles", "component_id", (F.col("row") == F.col("first")).alias("first_row"))


def near_duplicates(docs: DataFrame, width: int = 2, percent: int = 80) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept (doc_id is the component's smallest; see ``near_groups``)."""
    return near_groups(docs, width, percent).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` (all columns) of which one per component stays, the one with the smallest doc_id.

    Of rows that repeat the staying row's doc_id and text, any one stays."""
    key, hashed = fresh(docs, "near_key"), fresh(docs, "near_hash")
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    verdict = stage(near_groups(docs, width, percent).groupBy(name.alias(key), F.col("text_hash").alias(hashed))
                    .agg(F.max("first_row").alias("stays"), F.count(F.lit(1)).alias("n")).where("NOT stays OR n > 1"), "verdict")
    keyed = docs.withColumns({key: name, hashed: F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})
    out = keyed.join(verdict.where("NOT stays").select(key, hashed), [key, hashed], "left_anti")
    repeated = verdict.where("stays").select(key, hashed)
    if not repeated.isEmpty():
        out = out.join(repeated, [key, hashed], "left_anti") \
            .unionByName(keyed.join(repeated, [key, hashed], "left_semi").dropDuplicates([key, hashed]))
    return out.select(docs.columns)
