"""Benchmark decontamination: latent semantic retrieval (randomised SVD of TF-IDF passages, cosine search), then
weighted longest-common-subsequence and answer checks."""
from __future__ import annotations

import itertools
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratum.llm.common import fresh, id_text, small_pieces, stage

#: ASCII punctuation and controls as spaces.
_SPACED = bytes(c if c > 127 or chr(c).isalnum() or c == 95 else 32 for c in range(256))
#: Scripts without spaces (Thai, Lao, Myanmar, Khmer, kana, Han): each character is a word.
_ALONE = re.compile("([\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
#: Words of a passage: of the corpus for counts and the SVD, and the longest of a benchmark item.
PASSAGE = 64
#: Window lengths of the search, each with a stride of half its length; an item is searched with the first not below its length.
SCALES = (32, 64)
#: Known words that are laid end to end; a longer text goes through in parts.
TOGETHER = 50_000
#: Benchmark passages that are searched for in one run over the corpus (bounds the vocabulary and the latent space).
BLOCK = 256
#: Latent dimensions beyond those that the block's own passages need.
EXTRA_DIMS = 32
#: Dimensions of a random fold of the latent space, in which windows are compared first; cosines move there by about
#: 1 / sqrt(FOLD), so the first comparison passes COSINE - SLACK.
FOLD, SLACK = 64, 0.2
#: Words in more than this share of the passages have no part in the latent space ...
MAX_SHARE = 0.005
#: ... nor, beyond this share, in the bound that prunes windows. All words count in the verification.
BOUND_SHARE = 0.02
#: A window is a candidate from this cosine in the latent space.
COSINE = 0.45
#: A leak: this share of the item's inverse-document-frequency mass in a common subsequence ...
FULL = 0.75
#: ... or, for paraphrases, this share of the item and ANSWER of its answer (the last ANSWER_PART if none is given).
PARTLY, ANSWER, ANSWER_PART = 0.5, 0.8, 1 / 3


def words_of(text: str) -> list[bytes]:
    """Words in lower case: runs of letters, digits, marks and underscores; single characters in scripts without spaces."""
    text = text.lower()
    if not text.isascii():
        # punctuation, symbols, spaces and controls, the zero-width space and the byte order mark
        for c in [c for c in set(text) if c > "\x7f" and (unicodedata.category(c)[0] in "PSZ" or c < "\xa0" or c in "\u200b\ufeff")]:
            text = text.replace(c, " ")
        text = _ALONE.sub(r" \1 ", text)
    return text.encode().translate(_SPACED).split()


def word_numbers(text: str, words: dict[bytes, int]) -> np.ndarray:
    """The number of each word of a text, -1 for words outside ``words``."""
    found = words_of(text)
    return np.fromiter(map(words.get, found, itertools.repeat(-1)), np.int32, len(found))


@dataclass
class Block:
    """Some benchmark passages as word numbers, with what the passes over the corpus find out about their words."""
    items: list[tuple[int, np.ndarray, np.ndarray]]   # item_id, words, answer words
    weight: np.ndarray | None = None    # per word: inverse document frequency
    rare: np.ndarray | None = None      # per word: has a part in the latent space
    bound: np.ndarray | None = None     # per word: counts in ``need``
    folded: np.ndarray | None = None    # per word: latent vector folded into FOLD dimensions
    near: np.ndarray | None = None      # per item: folded latent direction
    latent: np.ndarray | None = None    # per word: weighted latent vector
    unit: np.ndarray | None = None      # per item: latent direction
    mass: np.ndarray | None = None      # per item: weight of its words
    need: np.ndarray | None = None      # per item: weight of ``bound`` words that any leak of it has
    window: np.ndarray | None = None    # per item: length of the windows it is searched in
    has: np.ndarray | None = None       # per item and word: whether it has the word


def passages(benchmark: DataFrame) -> DataFrame:
    """(item_id, words, answer): benchmark items in passages of PASSAGE words; a remainder under half goes with its predecessor."""
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")

    def cut(batches):
        for b in batches:
            out = ([], [], [])
            for i, t, a in zip(*(b.column(c).to_pylist() for c in range(3))):
                w = words_of(t or "")
                ends = list(range(PASSAGE, len(w), PASSAGE)) + [len(w)] if w else []
                if len(ends) > 1 and ends[-1] - ends[-2] < PASSAGE // 2:
                    ends.pop(-2)
                for lo, hi in zip([0, *ends], ends):
                    part = w[lo:hi]
                    goal = words_of(a) if a else part[-max(1, round(len(part) * ANSWER_PART)):]
                    for col, x in zip(out, (i, part, goal)):
                        col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.binary())), pa.array(out[2], pa.list_(pa.binary()))], names=["item_id", "words", "answer"])
    return benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"), answer.alias("answer")) \
        .mapInArrow(cut, "item_id long, words array<binary>, answer array<binary>")


def _numbers(batches: Iterator[pa.RecordBatch], words: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Per text the numbers of its words that occur in the benchmark, and the words between them."""
    for b in small_pieces(batches, 2):
        rows, gaps, nums, size = [], [], [], []
        for i, t in enumerate(b.column(2).to_pylist()):
            codes = word_numbers(t, words)
            at = np.flatnonzero(codes >= 0)
            rows.append(i)
            size.append(len(codes))
            gaps.append(np.diff(at, prepend=-1).astype(np.int32))
            nums.append(codes[at])
        if rows:
            off = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in nums])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(size, pa.int64()),
                                              pa.ListArray.from_arrays(off, pa.array(np.concatenate(gaps))), pa.ListArray.from_arrays(off, pa.array(np.concatenate(nums)))],
                                             names=["doc_id", "text_hash", "size", "gaps", "words"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """(doc_id, text_hash, words, positions of known words, their numbers) of each row."""
    for b in batches:
        gaps, nums = b.column(3), b.column(4)
        gv, nv, off = gaps.flatten().to_numpy(), nums.flatten().to_numpy(), np.concatenate([[0], np.cumsum(gaps.value_lengths().to_numpy())])
        ids, hashes, size = (b.column(i).to_pylist() for i in range(3))
        for i in range(b.num_rows):
            lo, hi = off[i], off[i + 1]
            yield ids[i], hashes[i], size[i], np.cumsum(gv[lo:hi], dtype=np.int64) - 1, nv[lo:hi]


def _together(batches, rare: np.ndarray | None = None, overlap: int = 0) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Several rows laid end to end: [(doc_id, text_hash, first position)], positions and word numbers of the known (or
    rare) words. Rows start at multiples of PASSAGE and are two passages apart, so no window holds words of two rows.
    A very long text goes through in parts, each of which begins ``overlap`` words before the end of the former one."""
    rows, at, nums, base, size = [], [], [], 2 * PASSAGE, 0
    for doc, text_hash, n, pos, num in _texts(batches):
        if rare is not None:
            keep = rare[num]
            pos, num = pos[keep], num[keep]
        lo = 0
        while lo < len(num):
            hi = max(lo + TOGETHER, int(np.searchsorted(pos, pos[lo] + 2 * overlap)))
            rows.append((doc, text_hash, base))
            at.append(pos[lo:hi] + base)
            nums.append(num[lo:hi])
            size += len(nums[-1])
            if size >= TOGETHER:
                yield rows, np.concatenate(at), np.concatenate(nums)
                rows, at, nums, size = [], [], [], 0
            lo = int(np.searchsorted(pos, pos[hi] - overlap)) if hi < len(num) else hi
        base = 2 * PASSAGE if not rows else base + (-(-n // PASSAGE) + 3) * PASSAGE
    if rows:
        yield rows, np.concatenate(at), np.concatenate(nums)


def _frequencies(batches, n_words: int) -> Iterator[pa.RecordBatch]:
    """Passages of the corpus that hold each known word; word -1 counts the passages that hold any."""
    df, total = np.zeros(n_words, np.int64), 0
    for _, pos, num in _together(batches):
        cell = pos // PASSAGE
        row = np.cumsum(np.diff(cell, prepend=cell[0]) > 0)
        df += np.bincount(np.unique(row.astype(np.int64) * n_words + num) % n_words, minlength=n_words)   # once a passage
        total += int(row[-1]) + 1
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int64()), pa.array(np.append(df[at], total), pa.int64())], names=["word", "n"])


def _sketch(batches, weight: np.ndarray, rare: np.ndarray, test: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (word, A^T A Omega) of this task's TF-IDF passages A, words outside ``rare`` left out."""
    out, used = np.zeros(test.shape, np.float64), np.zeros(len(weight), bool)
    wt = (weight[:, None] * test).astype(np.float32)
    for _, pos, num in _together(batches, rare):
        first = np.flatnonzero(np.diff(pos // PASSAGE, prepend=-1))
        y = np.add.reduceat(wt[num], first, axis=0)
        row = np.repeat(np.arange(len(first)), np.diff([*first, len(num)]))
        order = np.argsort(num, kind="stable")
        start = np.flatnonzero(np.diff(num[order], prepend=-1))
        which = num[order][start]
        out[which] += weight[which][:, None] * np.add.reduceat(y[row[order]], start, axis=0)
        used[which] = True
    at = np.flatnonzero(used)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), *(pa.array(out[at, k]) for k in range(out.shape[1]))],
                                     names=["word", *(f"s{k}" for k in range(out.shape[1]))])


def nystrom(sketch: np.ndarray, test: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors (columns, by falling singular value) of A from Y = A^T A Omega, by the stable Nystrom method."""
    shift = np.finfo(np.float64).eps * max(1e-12, np.linalg.norm(sketch)) * 10
    y = sketch + shift * test
    core = test.T @ y
    core = (core + core.T) / 2
    vals, vecs = np.linalg.eigh(core)
    good = vals > max(vals.max(), 0) * 1e-12
    if not good.any():
        return np.zeros((len(sketch), 0))
    u, _, _ = np.linalg.svd(y @ (vecs[:, good] / np.sqrt(vals[good])), full_matrices=False)
    return u[:, :rank]


def common_mass(item: np.ndarray, region: np.ndarray, weight: np.ndarray) -> float:
    """Heaviest common subsequence of two word lists by the words' weights."""
    row = np.zeros(len(region) + 1)
    for w in item:
        row[1:] = np.maximum(row[1:], row[:-1] + np.where(region == w, weight[w], 0.0))
        row = np.maximum.accumulate(row)
    return float(row[-1])


def _search(batches, block: Block) -> Iterator[pa.RecordBatch]:
    out = ([], [], [], [], [], [])
    for rows, pos, num in _together(batches, overlap=2 * SCALES[-1]):   # a window and half of it on both sides
        starts = np.array([r[2] for r in rows])
        for at, m, cosine in _candidates(pos, num, block):
            a, b = _region(pos, at, block.window[m])
            share, answer = _verified(block, m, num[a:b])
            if share >= FULL or share >= PARTLY and answer >= ANSWER:
                doc, text_hash, _ = rows[int(np.searchsorted(starts, pos[a], "right")) - 1]
                for col, x in zip(out, (doc, text_hash, block.items[m][0], share, answer, cosine)):
                    col.append(x)
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()))],
                                     names=["doc_id", "text_hash", "item_id", "overlap", "answer", "cosine"])


def _candidates(pos: np.ndarray, num: np.ndarray, block: Block) -> Iterator[tuple[int, int, float]]:
    """(window start, item, cosine) of the windows near an item in the latent space. A window whose words weigh less
    than a leak of the item has to weigh cannot hold one."""
    some = block.bound[num]
    at, w = pos[some], np.concatenate([[0.0], np.cumsum(block.weight[num[some]])])
    some = block.rare[num]
    rpos, rnum = pos[some], num[some]
    if not len(rpos):
        return
    for scale in SCALES:
        members = np.flatnonzero(block.window == scale)
        step = scale // 2
        starts = np.unique(np.concatenate([rpos // step - 1, rpos // step])) * step
        mass = w[np.searchsorted(at, starts + scale)] - w[np.searchsorted(at, starts)]
        lo, hi = np.searchsorted(rpos, starts), np.searchsorted(rpos, starts + scale)   # never empty: starts come from rpos
        # items in groups of like need, so that most windows meet the few items of little need only
        groups = [g for g in np.array_split(members[np.argsort(block.need[members])], 6) if len(g)]
        heavy = np.flatnonzero(mass >= block.need[groups[0][0]]) if groups else []
        for i in range(0, len(heavy), 8192):
            part = [x[heavy[i:i + 8192]] for x in (starts, mass, lo, hi)]
            folded = _directions(block.folded, rnum, *part[2:])   # once a window, for all groups that it meets
            for some in groups:
                meets = np.flatnonzero(part[1] >= block.need[some[0]])
                if len(meets):
                    yield from _near(pos, num, rnum, block, some, scale, folded[meets], *(x[meets] for x in part))


def _near(pos, num, rnum, block: Block, members, scale: int, folded, starts, mass, lo, hi) -> Iterator[tuple[int, int, float]]:
    """The pairs of these windows and items that are near each other and have enough words in common for a leak."""
    r, m = np.nonzero((folded @ block.near[members].T >= COSINE - SLACK) & (mass[:, None] >= block.need[members]))
    if not len(r):
        return
    used, back = np.unique(r, return_inverse=True)
    exact = (_directions(block.latent, rnum, lo[used], hi[used]) @ block.unit[members].T)[back, m]
    ok = exact >= COSINE
    r, m, exact = r[ok], members[m[ok]], exact[ok]
    if not len(r):
        return
    a, b = _region(pos, starts[r], scale)
    size = b - a
    end = np.cumsum(size)
    word = num[np.repeat(a - end + size, size) + np.arange(end[-1])]
    common = np.add.reduceat(block.weight[word] * block.has[np.repeat(m, size), word], end - size)
    for j in np.flatnonzero(common >= PARTLY * block.mass[m]):
        yield int(starts[r[j]]), int(m[j]), float(exact[j])


def _region(pos: np.ndarray, start, scale: int):
    """Bounds of the known words that a leak found in a window may take in: half a window more on both sides."""
    return np.searchsorted(pos, start - scale // 2), np.searchsorted(pos, start + scale + scale // 2)


def _directions(vectors: np.ndarray, num: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Directions of the windows num[lo:hi] (not empty): sums of their words' vectors, of length 1."""
    size = hi - lo
    end = np.cumsum(size)
    at = np.repeat(lo - end + size, size) + np.arange(end[-1])
    v = np.add.reduceat(vectors[num[at]], end - size, axis=0)
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _verified(block: Block, m: int, region: np.ndarray) -> tuple[float, float]:
    """(share of the item's mass, share of its answer's mass) in a common subsequence with the region."""
    _, words, goal = block.items[m]
    share = common_mass(words, region, block.weight) / block.mass[m]
    goal_mass = block.weight[goal].sum()
    return share, common_mass(goal, region, block.weight) / goal_mass if goal_mass else 0.0


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document row and benchmark item (item_id, text, optional answer) that it holds, exactly or reworded:
    doc_id, text_hash, item_id, overlap (share of the item's idf mass in a common subsequence), answer (the same of its
    answer), cosine (in the latent space). Documents without a leak have no row.

    Counts, SVD and search run over all passages of all documents; the benchmark goes through in blocks of BLOCK
    passages, each a pass over the documents' known words, staged once. Windows are pruned only by bounds that no leak
    can miss and by the cosine. Null texts are empty, items without words match nothing, repeated rows and items give
    rows of their own (items by id), empty tables give an empty result."""
    spark = docs.sparkSession
    base = id_text(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    bench = stage(passages(benchmark).withColumn("at", F.monotonically_increasing_id()), "passages")
    n_blocks = -(-bench.count() // BLOCK)
    found = None
    for k in range(n_blocks):
        rows = bench.where(F.pmod(F.xxhash64("at"), F.lit(n_blocks)) == k).orderBy("at").collect()   # about BLOCK of them
        if rows:
            hits = stage(_find_block(base, rows), "leaks")
            found = hits if found is None else found.unionByName(hits)
    if found is None:
        return spark.createDataFrame([], "doc_id long, text_hash long, item_id long, overlap double, answer double, cosine double")
    return found.groupBy("doc_id", "text_hash", "item_id").agg(F.max("overlap").alias("overlap"), F.max("answer").alias("answer"), F.max("cosine").alias("cosine"))


def _find_block(base: DataFrame, rows: list) -> DataFrame:
    words = {w: i for i, w in enumerate(dict.fromkeys(bytes(w) for r in rows for w in [*r["words"], *r["answer"]]))}
    n = len(words)
    block = Block([(r["item_id"], np.array([words[bytes(w)] for w in r["words"]]),
                    np.array([words[bytes(w)] for w in r["answer"]], np.int64)) for r in rows])
    known = stage(base.mapInArrow(lambda it: _numbers(it, words), "doc_id long, text_hash long, size long, gaps array<int>, words array<int>"), "known_words")
    df, total = np.zeros(n), 1
    for r in known.mapInArrow(lambda it: _frequencies(it, n), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():   # one row per word of the block
        if r["word"] < 0:
            total = max(1, r["n"])
        else:
            df[r["word"]] = r["n"]
    block.weight = np.log((1 + total) / (1 + df)) + 0.1
    asked = np.zeros(n, bool)   # words of answers only have no part in the latent space
    asked[np.concatenate([w for _, w, _ in block.items])] = True
    block.rare, block.bound = asked & (df <= MAX_SHARE * total), df <= BOUND_SHARE * total
    for _, w, _ in block.items:   # an item's rarest words that make up half of its weight always have a part
        w = w[np.argsort(df[w], kind="stable")]
        part = np.cumsum(block.weight[w])
        block.rare[w[:int(np.searchsorted(part, part[-1] / 2)) + 1]] = True
    weight, rare, bound = block.weight, block.rare, block.bound
    block.mass = np.array([max(1e-9, weight[w].sum()) for _, w, _ in block.items])
    block.need = PARTLY * block.mass - np.array([weight[w[~bound[w]]].sum() for _, w, _ in block.items]) - 1e-6
    block.window = np.array([next((s for s in SCALES if len(w) <= s), SCALES[-1]) for _, w, _ in block.items])
    test = np.random.default_rng(11).standard_normal((n, min(EXTRA_DIMS + 16, n))) * rare[:, None]
    cols = [f"s{i}" for i in range(test.shape[1])]
    sums = known.mapInArrow(lambda it: _sketch(it, weight, rare, test), "word long, " + ", ".join(f"{c} double" for c in cols)) \
        .groupBy("word").agg(*[F.sum(c).alias(c) for c in cols])
    sketch = np.zeros(test.shape)
    for r in sums.toLocalIterator():   # one row per word of the block
        sketch[r["word"]] = r[1:]
    block.has = np.zeros((len(rows), n), bool)
    for i, (_, w, _) in enumerate(block.items):
        block.has[i, w] = True
    # the latent space: the leading right singular vectors of the corpus' passages, and those of the block's own passages
    own = np.zeros((len(rows), n))
    for i, (_, w, _) in enumerate(block.items):
        np.add.at(own[i], w[rare[w]], weight[w[rare[w]]])
    mine = np.linalg.svd(own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-12), full_matrices=False)[2]
    vectors = np.linalg.qr(np.concatenate([nystrom(sketch, test, EXTRA_DIMS), mine.T], axis=1))[0]
    place = own @ vectors
    fold = np.random.default_rng(12).standard_normal((vectors.shape[1], min(FOLD, vectors.shape[1])))

    def directions(x):
        return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    block.latent = (weight[:, None] * rare[:, None] * vectors).astype(np.float32)
    block.folded = (block.latent @ fold).astype(np.float32)
    block.unit, block.near = directions(place), directions(place @ fold)
    return known.mapInArrow(lambda it: _search(it, block), "doc_id long, text_hash long, item_id long, overlap double, answer double, cosine double")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that hold no benchmark item."""
    key, hashed = fresh(docs, "leak_key"), fresh(docs, "leak_hash")
    leaks = find_leaks(docs, benchmark).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias(key), F.col("text_hash").alias(hashed)).distinct()
    keyed = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), hashed: F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})
    return keyed.join(leaks, [key, hashed], "left_anti").select(docs.columns)
