"""Whitening, hard negatives and BPE against brute force on small fixtures, with nulls, ties, repeats, empty tables and
clashing names."""
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratum.llm import bpe, hard_negatives, lexicon, queries, whitening

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def rows():
    """Vectors of six dimensions with repeats, ties, nulls, non-finite entries, odd lengths and huge components."""
    rng = np.random.default_rng(3)
    out = [(i, [float(np.float32(x)) for x in rng.normal(0.1, [1.0, .8, .6, .5, .4, .3])], int(rng.integers(0, 3))) for i in range(240)]
    out += [(300 + i, out[i % 5][1], i % 3) for i in range(60)]      # repeated vectors, equal scores
    out += [(None, out[1][1], 1), (7, out[7][1], 2), (100, out[100][1], out[100][2])]
    odd = [(400, None, 1), (401, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (402, [math.nan] + [0.0] * 5, 1), (403, [math.inf] + [0.0] * 5, 1),
           (404, [-math.inf] + [0.0] * 5, 1), (405, [], 1), (406, [1.0, 2.0], 1), (407, [3e38] + [0.0] * 5, 1), (500, out[0][1], None)]
    return out + odd


@pytest.fixture(scope="module")
def vectors(spark, rows):
    return spark.createDataFrame(rows, VECTORS).withColumns({"row": F.lit("x"), "x": F.lit(1), "component": F.lit(2), "n": F.lit(3)}).repartition(3)


def whole(v):
    return v is not None and len(v) == 6 and all(x is not None and math.isfinite(x) and abs(x) < 1e30 for x in v)


def test_whitening_against_dense_eigenvectors(vectors, rows):
    kept = [(i, [math.floor(64 * x) + 1_000_000 for x in v]) for i, v, _ in rows if whole(v)]
    fit = np.unique(np.array([x for _, x in kept]), axis=0)
    n, s = len(fit), fit.sum(axis=0)
    c = fit - s / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    got = whitening.whiten(vectors, components=4).collect()
    assert len(got) == 4 * len(kept)
    assert {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) < 1e-10 and max(r["residual"] for r in got) < 1e-13
    for k in range(4):
        assert all(abs(r["explained"] - e[k] / np.trace(v)) < 1e-12 for r in got if r["component"] == k + 1)
    expected = sorted((-1 if i is None else i, int(((n * np.array(x) - s) ** 2).sum()), round(abs(float((np.array(x) - s / n) @ u[:, 0] / e[0] ** .5)), 8)) for i, x in kept)
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], r["deviation"], round(abs(r["whitened"]), 8)) for r in got if r["component"] == 1) == expected


def test_whitening_of_little(spark, vectors):
    assert whitening.whiten(vectors.limit(0)).collect() == []
    one = spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], VECTORS)
    assert whitening.whiten(one).collect() == []          # no variance, no component
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0], 0) for i in range(4)], VECTORS)
    assert {r["component"] for r in whitening.whiten(line).collect()} == {1}
    assert whitening.whiten(spark.createDataFrame([(1, None, 0), (2, [], 0)], VECTORS)).collect() == []


def test_deviation_that_leaves_a_long(spark):
    far = spark.createDataFrame([(1, [1e10, 0.0], 0), (2, [0.0, 1.0], 0), (3, [0.0, 2.0], 0)], "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(far, components=1).collect()}
    x = np.array([[64 * 10 ** 10, 0], [0, 64], [0, 128]], object)
    d = ((3 * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert got == {i + 1: int(v) if v < 2 ** 63 else None for i, v in enumerate(d)}


@pytest.mark.parametrize("d", [1, 2, 17, 40, 64, 90])
def test_eigenpairs_of_hard_spectra(d):
    rng = np.random.default_rng(d)
    for e in (1 + 0.05 * rng.random(d), 0.7 ** np.arange(d), np.ones(d), np.r_[[5.0] * min(d, 18), np.zeros(max(0, d - 18))]):
        q, _ = np.linalg.qr(rng.standard_normal((d, d)))
        a = (q * e) @ q.T
        a = (a + a.T) / 2
        values, u, residuals = whitening.leading_eigenpairs(lambda x: a @ x, d, 16)
        assert np.abs(values - np.sort(e)[::-1][:16]).max() < 1e-13 * max(e) and residuals.max() < 1e-13 * max(e)
        assert np.abs(u.T @ u - np.eye(u.shape[1])).max() < 1e-13


def mined(rows, label=lambda i, x: x, anchor=100, low=80):
    """All rows against all anchors, plainly."""
    use = [(i, label(i, lab), [math.floor(256 * x) for x in v]) for i, v, lab in rows if i is not None and lab is not None and whole(v)]
    out = []
    for a, (i, lab, v) in enumerate(use):
        if i % anchor:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), j, other != lab) for b, (j, other, w) in enumerate(use) if b != a)
        for s, j, _ in [x for x in scored if not x[2]][:5]:
            hard = [x for x in scored if x[2] and low * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(i, j, k + 1, h, -s, -t) for k, (t, h, _) in enumerate(hard)]
    return sorted(out)


@pytest.mark.parametrize("block", [2, 4096])
def test_hard_negatives_against_all_pairs(vectors, rows, block):
    got = hard_negatives.mine_hard_negatives(vectors, F.col("vec_id") % 10 == 0, block_anchors=block)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == mined(rows, anchor=10)


def test_hard_negatives_query_and_its_labels(spark, rows, tmp_path):
    spark.createDataFrame(rows, VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op13_kronecker_hard_negatives(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == mined(rows, lambda i, x: (x + 1) % 10 if i % 7 == 0 else x)


def test_hard_negatives_of_little(spark, vectors):
    anchor = F.col("vec_id") % 10 == 0
    assert hard_negatives.mine_hard_negatives(vectors.limit(0), anchor).collect() == []
    assert hard_negatives.mine_hard_negatives(vectors.where("vec_id = 10"), anchor).collect() == []
    assert hard_negatives.mine_hard_negatives(vectors.where("vec_id % 10 = 1"), anchor).collect() == []


@pytest.mark.parametrize("bound,fields", [(0, 53), (1, 10), (150, 2), (20_000, 1), (100_000_000, 1), (2_000_000_000, 8)])
def test_packed_products_are_exact(bound, fields):
    """Doubles of two or more fields, of one, longs, and unbounded integers; components at both ends of their range."""
    d = 8
    rng = random.Random(bound)
    p = hard_negatives.Packing(bound, d)
    if bound in (150, 2_000_000_000):
        assert p.fields == fields
    draw = lambda: [rng.choice([-bound, bound, rng.randint(-bound, bound)]) for _ in range(d)]
    a, c = [draw() for _ in range(5)], [draw() for _ in range(23)]
    if bound > 10 ** 9:   # scores themselves must fit a long
        a = [[x // 8 for x in v] for v in a]
    got = p.scores(p.anchors(np.array(a, float)), p.pack(np.array(c, float)), np.array(c, float))
    assert got.tolist() == [[sum(x * y for x, y in zip(v, w)) for w in c] for v in a]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(bpe.default_vocabulary())


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(8)
    parts = list(" \n\t\r\x0b\x1c\x85 ᠎​  　﻿aAbé'srllœ1٣½中🎉́.,!-_\x00") + ["<|endoftext|>", "'s", "  ", "   ", " the", "The", " être", "<|endof"]
    out = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    return out + ["", " ", "\n", "<|endoftext|>", "<|endoftext|><|endoftext|> a", "a <|endoftext|>  b", "ab" * 3000, "x" * 5000, "é" * 2000, "word " * 20_000]


def ids_of(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("words", [0, 50, 1000])
def test_bpe_round_trip_equals_the_library(spark, library, odd_texts, words):
    rows = [(i, t) for i, t in enumerate(odd_texts)] + [(None, "no id"), (5, "again"), (5, "again"), (9000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ids": F.lit(1), "word": F.lit("x"), "n": F.lit(2)}).repartition(3)
    got = bpe.round_trip(docs, words).collect()
    key = lambda r: (-1 if r[0] is None else r[0], *r[1:])
    ids = {t: ids_of(library, t or "") for _, t in rows}
    assert sorted((key((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"])) for r in got)) \
        == sorted(key((i, len(ids[t]) // 4, ids[t], t or "")) for i, t in rows)


def test_bpe_query(spark, library, odd_texts, tmp_path):
    docs = [(i, t) for i, t in enumerate(odd_texts[:500])] + [(900, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.op12_transducer_bpe(spark, str(tmp_path)).collect()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert got == {i: (len(b := ids_of(library, t or "")) // 4, sha(b), sha(library.decode(list(np.frombuffer(b, "<u4")), skip_special_tokens=False).encode())) for i, t in docs}


def test_bpe_of_no_documents(spark):
    assert bpe.round_trip(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_decoding_of_ids_that_are_no_text(library):
    v = bpe.Vocabulary(bpe.default_vocabulary())
    rng = np.random.default_rng(4)
    lists = [rng.integers(0, 50_257, rng.integers(0, 12)) for _ in range(2000)] + [np.array([60_000, 5])]
    got = bpe.Decoder(v).decode(np.concatenate(lists).astype("<u4"), np.cumsum([len(x) for x in lists])).to_pylist()
    assert got == [library.decode([int(i) for i in x if i < 50_257], skip_special_tokens=False) for x in lists]


def test_frequent_words_are_the_most_frequent(spark):
    docs = spark.createDataFrame([(1, "x " + "aa " * 50 + "bb " * 30 + "cc " * 10 + "dd"), (2, "aa bb cc"), (3, None)], "doc_id long, text string")
    assert {r["word"]: r["n"] for r in bpe.frequent_words(docs, 2).collect()} == {" aa": 50, " bb": 31}
    assert bpe.frequent_words(docs, 100).count() == 4


def test_transducer_is_exact_and_minimal(tmp_path):
    rng = random.Random(9)
    words = {bytes(rng.choice(b"abcd") for _ in range(rng.randint(1, 7))): tuple(rng.randint(0, 3) for _ in range(rng.randint(0, 4))) for _ in range(1500)}
    words |= {b"\x00": (7,), b"\xff\xff": (8, 9)}
    (tmp_path / "lexicon").write_bytes(lexicon.compile_words(words.items()))
    lex = lexicon.Lexicon(str(tmp_path / "lexicon"))
    asked = list(words) + [b"", b"abcdabcdabcd", b"\x01", b"ab\x00"]
    length = np.array(list(map(len, asked)))
    found, word, at, size = lex.look_up(np.frombuffer(b"".join(asked), np.uint8), np.cumsum(length) - length, length)
    assert found.tolist() == [w in words for w in asked]
    ids = [[] for _ in asked]
    for w, a, s in zip(word, at, size):
        ids[w] += lex.pool[a:a + s].tolist()
    assert [tuple(i) for i in ids] == [words.get(w, ()) for w in asked]
    # one output for all: equal ends are shared, so the states are those of the smallest automaton, one for each right language
    b = lexicon.Builder()
    for w in sorted(words):
        b.add(w, ())
    b.file()
    prefixes = {w[:k] for w in words for k in range(len(w) + 1)}
    assert len(b.states) == len({frozenset(w[len(p):] for w in words if w.startswith(p)) for p in prefixes})
