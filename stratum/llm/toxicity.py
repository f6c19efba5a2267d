"""Toxicity: token log-odds with Dirichlet priors, all maximal scoring segments of a text, extreme-value calibration."""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratum.llm.common import WordHashes, id_text, shingle_set, small_pieces, stage

#: Characters trimmed from both ends of a token.
EDGE = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\u00ab\u00bb\u2018\u2019\u201c\u201d\u2026\u00bf\u00a1"
STEM_CHARS = 4
PRIOR = 0.05         # pseudo-rows of the Dirichlet prior, as a share of the learning rows
SURE = 2.0           # standard deviations taken off a log-odds: a token counts as much as is sure about it
MODEL_TOKENS = 50_000   # bound on the tokens and stems of a model, those with the largest log-odds first
FIT_ROWS = 200_000   # bound on the labelled rows that a model is learnt from
DRIFT = 1.0          # a token has to be e times likelier in toxic texts to lengthen a segment


@dataclass
class Model:
    """Scores of tokens and stems (natural-log odds), and the calibration of segment scores to a probability."""
    tokens: dict[str, float]
    stems: dict[str, float]
    lam: float = 1.0
    logk: float = 0.0
    slope: float = 1.0
    bias: float = 0.0


def words(text: str) -> list[str]:
    return [w for w in (x.strip(EDGE) for x in text.lower().split()) if w]



def segments(scores: list[tuple[int, float]]) -> list[tuple[int, int, float]]:
    """Ruzzo and Tompa's linear scan: every maximal scoring segment (start, end, score) of (position, score) runs."""
    out: list[list[float]] = []   # start, end, left sum, right sum
    total = 0.0
    for pos, s in scores:
        before, total = total, total + s
        if s <= 0:
            continue
        seg = [pos, pos + 1, before, total]
        while True:
            j = len(out) - 1
            while j >= 0 and out[j][2] >= seg[2]:
                j -= 1
            if j < 0 or out[j][3] >= seg[3]:
                out.append(seg)
                break
            seg = [out[j][0], seg[1], out[j][2], seg[3]]
            del out[j:]
    return [(int(a), int(b), r - left) for a, b, left, r in out]


def passages(model: Model, text: str) -> tuple[int, list[tuple[int, int, float]]]:
    """(number of tokens, maximal segments over token numbers). Runs of negative tokens enter as one step."""
    ws = words(text)
    steps, any_pos = [], False
    tokens, stems = model.tokens, model.stems
    last = -1
    for i, w in enumerate(ws):
        s = tokens.get(w)
        if s is None:
            s = stems.get(w[:STEM_CHARS]) if len(w) > STEM_CHARS else None
        if s is not None and s > DRIFT:
            if i - last - 1:
                steps.append((last + 1, -DRIFT * (i - last - 1)))
            steps.append((i, s - DRIFT))
            last, any_pos = i, True
    return len(ws), segments(steps) if any_pos else []


def evidence(model: Model, text: str) -> tuple[float, int, int]:
    """(E, segments, tokens): E is -log of the chance that a clean text of this length has a segment as good as its best
    ones, by extreme-value statistics of segment scores; 0 without any positive segment."""
    n, segs = passages(model, text)
    if not segs:
        return 0.0, 0, n
    # sum of the normalised scores of the significant segments: lambda * S - log(K * n)
    norm = [model.lam * s - model.logk - np.log(n) for _, _, s in segs]
    good = [x for x in norm if x > 0]
    return (float(sum(good)) if good else float(np.exp(min(0.0, max(norm))) - 1.0)), len(good), n


def _score(model: Model, text: str) -> float:
    e, _, _ = evidence(model, text)
    return float(1.0 / (1.0 + np.exp(-np.clip(model.slope * e + model.bias, -30, 30))))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map-side counts per (kind, token): kind 0 tokens, 1 stems; flushed when they grow."""
    acc: dict[tuple[int, str], list[int]] = {}

    def flush():
        keys = list(acc)
        b = pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.int32()), pa.array([t for _, t in keys], pa.string()),
                                        pa.array([acc[k][0] for k in keys], pa.int64()), pa.array([acc[k][1] for k in keys], pa.int64())],
                                       names=["kind", "token", "clean", "toxic"])
        acc.clear()
        return b
    for b in small_pieces(batches, 0):
        for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            for w in set(words(text)):   # documents that have the token, not its repeats
                acc.setdefault((0, w), [0, 0])[y] += 1
                if len(w) > STEM_CHARS:
                    acc.setdefault((1, w[:STEM_CHARS]), [0, 0])[y] += 1
        if len(acc) > 400_000:
            yield flush()
    if acc:
        yield flush()


def log_odds(counts: DataFrame, totals: tuple[int, int], prior: float = PRIOR) -> DataFrame:
    """Adds delta: the log-odds, toxic against clean, with an informative Dirichlet prior of the corpus' shares, drawn
    towards 0 by SURE standard deviations."""
    n0, n1 = (float(x) for x in totals)
    rows = prior * (n0 + n1)
    a = (F.col("clean") + F.col("toxic")) / F.lit(n0 + n1) * rows
    y1, y0 = F.col("toxic") + a, F.col("clean") + a
    delta = F.log(y1 / (F.lit(n1 + rows) - y1 + 1)) - F.log(y0 / (F.lit(n0 + rows) - y0 + 1))
    sure = F.greatest(F.lit(0.0), F.abs(delta) - SURE * F.sqrt(1 / y1 + 1 / y0))
    return counts.withColumn("delta", F.signum(delta) * sure)


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the smallest five-word shingle hash of a text, which near copies mostly share."""
    hashes = WordHashes()
    for b in small_pieces(batches, 0):
        low = [s[0] if len(s) else 0 for s in (shingle_set(t.encode().lower().split(), hashes, 5) for t in b.column(0).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.array(low, np.uint64).view(np.int64))], names=["text", "y", "family"])


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model | None:
    """Learn from labelled rows (doc_id, toxic in 0/1) whose doc_id is in ``docs``: at most about ``fit_rows`` of them,
    chosen by a hash of the id, so that their ids are a bounded broadcast. Of near copies with one label only one counts.
    None without both labels."""
    lab = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y")) \
        .where("doc_id IS NOT NULL AND y IN (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
    lab = stage(lab, "labels")
    n = lab.count()
    some = lab.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(min(1.0, fit_rows / max(1, n)) * 1_000_003) + 1)
    all_rows = id_text(docs).join(F.broadcast(some), "doc_id").select("text", "y")
    data = stage(all_rows.mapInArrow(_families, "text string, y int, family long").groupBy("family", "y").agg(F.min("text").alias("text")).select("text", "y"), "toxic_rows")
    per = {r["y"]: r["n"] for r in data.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = per.get(0, 0), per.get(1, 0)
    if not n0 or not n1:
        return None
    counts = data.mapInArrow(_counts, "kind int, token string, clean long, toxic long") \
        .groupBy("kind", "token").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    top = log_odds(counts, (n0, n1)).where(F.col("delta") > DRIFT).orderBy(F.col("delta").desc(), "kind", "token").limit(MODEL_TOKENS).collect()
    model = Model({r["token"]: float(r["delta"]) for r in top if r["kind"] == 0}, {r["token"]: float(r["delta"]) for r in top if r["kind"] == 1})
    return _calibrate(model, data)


def _calibrate(model: Model, data: DataFrame) -> Model:
    def best(batches):
        for b in small_pieces(batches, 0):
            rows = [(max((s for _, _, s in segs), default=0.0), m) for m, segs in (passages(model, t) for t in b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array([r[0] for r in rows], pa.float64()), pa.array([r[1] for r in rows], pa.int64())], names=["y", "s", "n"])
    # extreme values: for clean texts of n tokens P(best > s) is about 1 - exp(-K n exp(-lambda s)); K n exp(-lambda s) is
    # the expected number of such segments, so two score levels of the clean texts give lambda and K
    scored = data.mapInArrow(best, "y int, s double, n long")
    rows = scored.groupBy("y", F.round("s", 1).alias("s")).agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n")).collect()
    clean = [(r["s"], r["c"], r["n"]) for r in rows if r["y"] == 0]
    tokens = max(1, sum(c[2] for c in clean))
    levels = sorted({c[0] for c in clean if c[0] > 0})
    tail = [(s, sum(c for v, c, _ in clean if v >= s)) for s in levels]
    if len(tail) >= 2 and tail[0][1] > tail[-1][1]:
        x, w = np.array([t[0] for t in tail]), np.array([t[1] for t in tail], float)
        slope, icpt = np.polyfit(x, np.log(w / tokens), 1, w=np.sqrt(w))
        model.lam, model.logk = float(np.clip(-slope, 0.2, 3.0)), float(icpt)
    else:   # hardly a positive segment in clean texts: one in all of their tokens at score 1
        model.lam, model.logk = 1.0, 1.0 - float(np.log(tokens))
    sample_rows = data.mapInArrow(lambda it: _evidence(it, model), "y int, e double").groupBy("y", F.round("e", 1).alias("e")) \
        .agg(F.count(F.lit(1)).alias("c")).collect()
    e = np.array([r["e"] for r in sample_rows])
    y = np.array([r["y"] for r in sample_rows], float)
    c = np.array([r["c"] for r in sample_rows], float)
    model.slope, model.bias = _logistic(e, y, c)
    return model


def _evidence(batches, model):
    for b in small_pieces(batches, 0):
        yield pa.RecordBatch.from_arrays([b.column(1), pa.array([evidence(model, t)[0] for t in b.column(0).to_pylist()], pa.float64())], names=["y", "e"])


def _logistic(x: np.ndarray, y: np.ndarray, c: np.ndarray, l2: float = 0.05) -> tuple[float, float]:
    """Newton steps for a weighted one-variable logistic regression with a small ridge."""
    w = np.zeros(2)
    a = np.stack([np.clip(x, -50, 50), np.ones_like(x)], 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (c * (p - y)) + l2 * w
        h = (a * (c * p * (1 - p))[:, None]).T @ a + l2 * np.eye(2)
        step = np.linalg.solve(h, g)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 1e-6)), float(w[1])


def _apply(batches, model):
    for b in small_pieces(batches, 1):
        scores, spans = [], []
        for t in b.column(1).to_pylist():
            _, segs = passages(model, t)
            scores.append(_score(model, t) if segs else float(1 / (1 + np.exp(-np.clip(model.bias, -30, 30)))))
            spans.append(len(segs))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(spans, pa.int64())], names=["doc_id", "score", "n_passages"])


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted, n_passages (segments above the drift).

    Learns only from labels of rows whose crc32(doc_id as text) mod 5 is not 0. Null text is empty and gets the score of
    a text without toxic passages; rows with null doc_id are scored, held_out false. Conflicting labels of one id count
    as toxic. Without labels of both kinds every score is 0.0."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = train(docs.where(~held), labels.where(~held))
    base = id_text(docs)
    if model is None:
        out = base.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_passages"))
    else:
        out = base.mapInArrow(lambda it: _apply(it, model), "doc_id long, score double, n_passages long")
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_passages")
