"""Quality classifier from weak labels: expectation-maximisation over heuristic labellers, then a hashed linear scorer."""
import operator
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratum.llm.common import CACHE_ENTRIES, id_text, small_pieces, stage

BAD, GOOD, ABSTAIN = 0, 1, 2
DIMS = 1 << 14
#: Bound on the weakly labelled rows that the scorer is fitted on, for each of the two labels.
FIT_ROWS = 10_000
#: Labellers: (measure, bad from, good up to, or for a falling one bad up to, good from). Between the two it abstains.
LABELLERS = [
    ("symbols", 0.10, 0.06), ("upper", 0.50, 0.25), ("repeats", 0.25, 0.15), ("tails", 0.25, 0.08),
    ("loose", 0.15, 0.05), ("same_lines", 0.60, 0.40), ("distinct", -0.25, -0.40), ("short_words", -0.04, -0.12),
]
_CLASS = np.zeros(256, np.uint8)   # 0 other, 1 white space, 2 lower, 3 upper, 4 digit, 5 symbol
_CLASS[[9, 10, 11, 12, 13, 32]] = 1
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 2, 3, 4, 2
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum()]] = 5


class Words(dict):
    """word -> (feature number of its shape, kind); kind 1: only symbols, 2: ends in two symbols, 3: short plain word, 0: other."""

    def __missing__(self, w: str) -> tuple[int, int]:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        shape, last = [], ""
        for ch in w[:64]:
            c = "A" if ch.isupper() else "a" if ch.isalpha() else "0" if ch.isdigit() else ch
            if c != last:
                shape.append(c)
                last = c
        letters = sum(map(str.isalnum, w))
        tail = len(w) >= 3 and not w[-1].isalnum() and not w[-2].isalnum()
        kind = 1 if not letters else 2 if tail else 3 if letters <= 3 else 0
        v = self[w] = (zlib.crc32("".join(shape).encode()) % (DIMS - 256) + 256, kind)
        return v


def measures(text: str, cache: Words) -> tuple[dict[str, float], Counter, int]:
    """The labellers' measures, the counts of word shapes, and the number of words."""
    ws = text.split()
    n = len(ws)
    if not n:
        return {}, Counter(), 0
    c = np.bincount(_CLASS[np.frombuffer(text.encode(), np.uint8)], minlength=6)
    seen = Counter(map(cache.__getitem__, ws))
    kinds = [0, 0, 0, 0]
    for (_, k), v in seen.items():
        kinds[k] += v
    lines = [x for x in text.split("\n") if x.strip()]
    shown = c.sum() - c[1]
    m = {"symbols": c[5] / (shown + 20), "upper": c[3] / max(1, c[2] + c[3]),   # few characters say little
         "repeats": sum(map(operator.eq, ws, ws[1:])) / (n + 4), "tails": kinds[2] / n, "loose": kinds[1] / n,
         "same_lines": 1 - len(set(lines)) / len(lines)}
    if n >= 40:   # shares of few words say little
        m["distinct"] = -len(set(ws)) / n * max(1.0, np.log10(n / 100))
        if kinds[3] <= 0.8 * n:   # hardly anything but short words is no prose either
            m["short_words"] = -kinds[3] / n
    shapes = Counter()
    for (f, _), v in seen.items():
        shapes[f] += v
    return m, shapes, n


def votes(m: dict[str, float]) -> list[int]:
    out = []
    for name, bad, good in LABELLERS:
        v = m.get(name)
        out.append(ABSTAIN if v is None else BAD if v >= bad else GOOD if v <= good else ABSTAIN)
    return out


def features(m: dict[str, float], shapes: Counter, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed sparse vector: square roots of the shares of word shapes, one indicator per measure's bin, one per vote."""
    idx = np.fromiter(shapes.keys(), np.int32, len(shapes))
    # few words say little: their shares are drawn towards none
    val = np.sqrt(np.fromiter(shapes.values(), np.float64, len(shapes)) / (n + 30))
    bins = [16 * i + int(min(15, 16 * abs(m[name]) ** 0.5)) for i, (name, _, _) in enumerate(LABELLERS) if name in m]
    cast = [128 + 3 * i + v for i, v in enumerate(votes(m))]
    return (np.concatenate([idx, np.array(bins + cast, np.int32)]),
            np.concatenate([val, np.full(len(bins), 0.25 * n / (n + 30)), np.ones(len(cast))]))


def em(patterns: dict[tuple[int, ...], int], steps: int = 200) -> tuple[np.ndarray, np.ndarray, dict[tuple[int, ...], float]]:
    """Dawid and Skene's estimate from counts of vote patterns: (class prior, P(vote | class) per labeller, P(good | pattern)).
    An abstention is a missing vote and says nothing about the class.

    Starts from 'any bad vote means bad', so the classes keep their meaning. Without patterns the accuracies are 0.5."""
    keys = list(patterns)
    if not keys:
        return np.array([0.5, 0.5]), np.full((len(LABELLERS), 2, 2), 0.5), {}
    v, c = np.array(keys), np.array([patterns[k] for k in keys], float)
    good = np.where((v == BAD).any(1), 0.1, 0.9)
    for _ in range(steps):
        w = np.stack([c * (1 - good), c * good])
        prior = (w.sum(1) + 1) / (c.sum() + 2)
        acc = np.stack([np.stack([(w[k][:, None] * (v == s)).sum(0) + 0.5 for s in (BAD, GOOD)], 1) for k in range(2)], 1)
        acc /= acc.sum(2, keepdims=True)
        logs = np.stack([np.log(prior[k]) + np.where(v == ABSTAIN, 0.0, np.log(acc[np.arange(v.shape[1]), k, v % 2])).sum(1) for k in range(2)])
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return prior, acc, dict(zip(keys, good.tolist()))


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, idx: np.ndarray, val: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[idx] @ val + self.bias, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, float, float]], steps: int = 300, rate: float = 0.5, l2: float = 1e-4) -> Scorer:
    """Logistic regression on (indices, values, posterior, weight) by AdaGrad over all rows at once."""
    w, b = np.zeros(DIMS), 0.0
    if not rows:
        return Scorer(w, b)
    idx, val = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    y, c = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
    c = c / c.sum()
    gw, gb = np.full(DIMS, 1e-8), 1e-8
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[idx] * val, len(rows)) + b, -30, 30)))
        g = c * (p - y)
        d = np.bincount(idx, g[row] * val, DIMS) + l2 * w
        gw += d * d
        gb += g.sum() ** 2
        w -= rate * d / np.sqrt(gw)
        b -= rate * g.sum() / np.sqrt(gb)
    return Scorer(w, b)


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, pattern) of (hash, text): how the labellers vote on each text that has words."""
    cache = Words()
    for b in small_pieces(batches, 1):
        out = ([], [])
        for h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            m, _, n = measures(t, cache)
            if n:
                out[0].append(h)
                out[1].append("".join(map(str, votes(m))))
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string())], names=["hash", "pattern"])


def _features(batches) -> Iterator[pa.RecordBatch]:
    cache = Words()
    for b in small_pieces(batches, 1):
        out = ([], [], [])
        for h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            m, shapes, n = measures(t, cache)
            i, v = features(m, shapes, n)
            for col, x in zip(out, (h, i.tolist(), v.tolist())):
                col.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.int32())), pa.array(out[2], pa.list_(pa.float64()))], names=["hash", "idx", "val"])


def learn(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Scorer:
    """Vote patterns are counted over all rows; the scorer is fitted on at most about ``fit_rows`` distinct texts of each
    label, chosen by a hash of the text. A text counts as often as it has copies, so copies cost no rows of the sample."""
    texts = id_text(docs).select(F.xxhash64("text").alias("hash"), "text")
    seen = stage(texts.mapInArrow(_patterns, "hash long, pattern string").groupBy("hash", "pattern").agg(F.count(F.lit(1)).alias("copies")), "vote_patterns")
    counted = seen.groupBy("pattern").agg(F.sum("copies").alias("n"), F.count(F.lit(1)).alias("texts")).collect()   # a row per pattern of eight votes
    key = lambda p: tuple(map(int, p))
    _, _, good = em({key(r["pattern"]): r["n"] for r in counted})
    is_good = {r["pattern"]: bool(good[key(r["pattern"])] >= 0.5) for r in counted}
    n, distinct = ([sum(r[c] for r in counted if is_good[r["pattern"]] == bool(side)) for side in (0, 1)] for c in ("n", "texts"))
    take = tuple(min(1.0, fit_rows / max(1, x)) for x in distinct)
    unit = F.pmod(F.xxhash64("hash"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    chosen = seen.where(unit < F.when(F.col("pattern").isin([p for p, g in is_good.items() if g]), take[1]).otherwise(take[0]))
    rows = texts.where(unit < max(take)).join(chosen.select("hash"), "hash", "left_semi").dropDuplicates(["hash"]) \
        .mapInArrow(_features, "hash long, idx array<int>, val array<double>").join(chosen, "hash").collect()   # about fit_rows a label
    side = Counter()
    for r in rows:   # rows count as many as they stand for
        side[is_good[r["pattern"]]] += r["copies"]
    return fit([(np.array(r["idx"], np.int32), np.array(r["val"]), good[key(r["pattern"])], r["copies"] * n[is_good[r["pattern"]]] / side[is_good[r["pattern"]]])
                for r in sorted(rows, key=lambda r: (r["hash"], r["pattern"]))])


def _apply(texts: pa.Array, scorer: Scorer, cache: Words) -> list[float]:
    out = []
    for t in texts.to_pylist():
        m, shapes, n = measures(t or "", cache)
        out.append(scorer.score(*features(m, shapes, n)) if n else 0.0)
    return out


def _scores(batches, scorer):
    cache = Words()
    for b in small_pieces(batches, 1):
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_apply(b.column(1), scorer, cache), pa.float64())], names=["doc_id", "score"])


def score_quality(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, score (0 to 1), predicted (1: kept, score >= 0.5). Null and white-space texts score 0 and are
    rejected; repeated rows get equal scores; null ids are scored like others; an empty table gives an empty result."""
    scorer = learn(docs)
    out = id_text(docs).mapInArrow(lambda it: _scores(it, scorer), "doc_id long, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def _good_rows(batches, scorer: Scorer, text: int) -> Iterator[pa.RecordBatch]:
    cache = Words()
    for b in small_pieces(batches, text):
        yield b.filter(pa.array([x >= 0.5 for x in _apply(b.column(text), scorer, cache)], pa.bool_()))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that the classifier keeps."""
    scorer, text = learn(docs), [c.lower() for c in docs.columns].index("text")
    return docs.mapInArrow(lambda it: _good_rows(it, scorer, text), docs.schema)
