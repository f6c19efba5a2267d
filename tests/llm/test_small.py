"""The training-data operators against brute force on small fixtures, with nulls, ties, repeats, empty tables and clashing names."""
import hashlib
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratum.llm import (components, decontaminate, exact_dedup, fixity, fuzzy_lines, near_dedup, packing, quality, secret_scan,
                         token_count, toxicity)
from stratum.llm.components import connected

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefghiklmnoprstuvé") for _ in range(rng.randint(2, 9))) for _ in range(400)]


@pytest.fixture(scope="module")
def texts(vocabulary):
    """Plain texts, exact and near copies, a very long one, empty ones."""
    rng = random.Random(6)
    base = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(30, 120))) for _ in range(25)]
    out = list(base)
    for t in base[:8]:
        w = t.split(" ")
        w[len(w) // 2] = "changed"
        out += [t.replace(" ", "\t \n", 3), " ".join(w), t.upper()]
    return out + ["", "   ", "one", " ".join(rng.choice(vocabulary) for _ in range(30_000)), base[0], base[0]]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    rows += [(1000, None, None, None, None), (None, texts[0], "en", "s", 1), (3, texts[3], "en", "s", 1)]
    return spark.createDataFrame(rows, SCHEMA).withColumns({"row": F.lit(1), "node": F.lit(2), "sha": F.lit("x")}).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_spans(text):
    out = []
    for rank, r in enumerate(secret_scan.RULES):
        for m in re.finditer(r.pattern, text):
            if len(m.group(r.group)) >= r.least:
                out.append((m.start(), rank, r.kind, m.end()))
    return sorted(out)


def test_secret_scan(spark, empty):
    cases = ["password=abc; TOKEN: 'abcdef99' é api_key=\"zzzzzzzz\"", "api-key=abcdefgh ApiKey:abcdefg", "x" * 50 + "AKIA" + "A" * 16 + " AKIAshort",
             "é" * 7 + "deadbeef" * 3 + " deadbeef", "token=abc token=abcdefg", "secret: token=abcdef", None, "",
             "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 18 + " xoxb-123456789012 AIza" + "b" * 35 + " sk_live_" + "c" * 16, "passw0rd=notamatch tok en=abcdefgh"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)] + [(0, cases[0])], "doc_id long, text string").withColumn("found", F.lit(1))
    got = sorted((r["doc_id"], r["spans"], r["base_sha256"], r["n_assign"], r["n_access"], r["n_hex"]) for r in secret_scan.digest(secret_scan.find_secrets(df)).collect())
    want = []
    for i, t in [*enumerate(cases), (0, cases[0])]:
        s = brute_spans(t or "")
        base = ",".join(f"{k}:{a}:{b}" for a, r, k, b in s if r < 3)
        want.append((i, ",".join(f"{k}:{a}:{b}" for a, _, k, b in s), hashlib.sha256(base.encode()).hexdigest(),
                     *(sum(1 for x in s if x[2] == k) for k in ("assign", "access", "hex"))))
    assert got == sorted(want)
    assert secret_scan.find_secrets(empty).count() == 0


def test_trigram_queries_hold_for_matches():
    assert secret_scan.trigram_query("[0-9a-f]+") == []
    assert secret_scan.trigram_query("AKIA[A-Z0-9]+") == [[frozenset({"aki", "kia"})]]
    for r in secret_scan.RULES:
        for text in ("password=abcdefg", 'api_key: "abcdefg', "passwd='abcdefg", "AKIA" + "Z" * 16, "rk_live_" + "a" * 16, "xoxs-" + "1" * 10):
            if re.search(r.pattern, text):
                for alternatives in secret_scan.trigram_query(r.pattern):
                    assert any(all(g in text.lower() for g in grams) for grams in alternatives)


def test_token_counts(spark, docs, empty):
    import public_tokenizers as P
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    odd = spark.createDataFrame([(1, "日本語 テキスト" * 300, "", "", 0), (2, "x" * 3000, "", "", 0), (3, "a  b\n\n\tc ▁d </s><s> <unk> " * 100, "", "", 0)], SCHEMA)
    both = docs.select("doc_id", "text", "lang", "row").unionByName(odd.select("doc_id", "text", "lang", F.lit(1).alias("row")))
    for chunk in (200, 50_000):
        got = sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_count.count_tokens(both, chunk_chars=chunk, overlap_chars=2).collect())
        want = sorted(((r["doc_id"] if r["doc_id"] is not None else -1), len((r["text"] or "").encode()), n := len(sp.encode(r["text"] or "")), n > 4096) for r in both.collect())
        assert got == want
    assert token_count.count_tokens(empty).count() == 0


def test_exact_groups(docs, empty):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    rows = docs.select("doc_id", "text").collect()
    ids, size = {}, {}
    for r in rows:
        ids.setdefault(norm(r["text"]), []).append(r["doc_id"])
    got = exact_dedup.exact_groups(docs).collect()
    key = lambda x: tuple(str(v) for v in x)
    want = sorted(((r["doc_id"], min((i for i in ids[norm(r["text"])] if i is not None), default=None), len(ids[norm(r["text"])]),
                    hashlib.sha256(norm(r["text"]).encode()).hexdigest()) for r in rows), key=key)
    assert sorted(((g["doc_id"], g["keep_id"], g["group_size"], g["text_sha256"]) for g in got), key=key) == want
    assert sum(g["kept"] for g in got) == len(ids) and all(g["doc_id"] == g["keep_id"] for g in got if g["kept"])
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns and left.count() == len(ids)
    assert exact_dedup.exact_groups(empty).count() == 0 and exact_dedup.drop_exact_copies(empty).count() == 0


def brute_near(texts, width, percent=80):
    sets = []
    for t in texts:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", w) if x]
        sets.append({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    comp = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = comp[i], comp[j]
                comp = [min(a, b) if c in (a, b) else c for c in comp]
    return sets, comp


@pytest.mark.parametrize("width", [2, 5])
def test_near_duplicates(docs, width):
    rows = docs.select("doc_id", "text").collect()
    sets, comp = brute_near([r["text"] for r in rows], width)
    low = {c: min((r["doc_id"] for r, k in zip(rows, comp) if k == c and r["doc_id"] is not None), default=None) for c in set(comp)}
    key = lambda x: tuple(str(v) for v in x)
    got = near_dedup.near_duplicates(docs, width).collect()
    assert sorted(((g["doc_id"], g["n_shingles"], g["component_id"], g["kept"]) for g in got), key=key) == \
        sorted(((r["doc_id"], len(s), low[c], r["doc_id"] == low[c]) for r, s, c in zip(rows, sets, comp)), key=key)
    assert near_dedup.drop_near_copies(docs, width).count() == len(set(comp))


def test_near_duplicates_in_buckets_that_stay_mixed(spark, vocabulary, monkeypatch):
    """Variants of one text around the threshold: mixed buckets, cut into portions of three, lose no link."""
    monkeypatch.setattr(components, "PORTION", 3)
    rng = random.Random(8)
    base = [rng.choice(vocabulary) + str(i) for i in range(100)]
    texts = []
    for i in range(60):
        w = list(base)
        for k in rng.sample(range(100), rng.randint(3, 8)):
            w[k] = f"x{i}y{k}"
        texts.append(" ".join(w))
    _, comp = brute_near(texts, 2)
    assert 3 < len(set(comp)) < 58
    got = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 2).collect()
    assert sorted((g["doc_id"], g["component_id"]) for g in got) == list(enumerate(comp))


def test_near_duplicates_of_an_empty_table(empty):
    assert near_dedup.near_duplicates(empty).count() == 0 and near_dedup.drop_near_copies(empty).count() == 0


def test_odd_sketches_tell_similarities_apart():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    for similarity in (0.95, 0.8, 0.2):
        k = round(1000 * (1 - similarity) / (1 + similarity))
        other = np.concatenate([base[k:], rng.integers(0, 1 << 63, k).astype(np.uint64)])
        _, odd = near_dedup.signatures([np.unique(base), np.unique(other)])
        apart = sum(bin(int(a ^ b)).count("1") for a, b in zip(*odd))
        assert (apart <= near_dedup.max_differences()) == (similarity >= 0.8)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(200 + rng.randint(0, 30), 200 + rng.randint(0, 30)) for _ in range(25)]
    comp = {}
    for a, b in edges:
        comp.setdefault(a, a), comp.setdefault(b, b)
        x, y = comp[a], comp[b]
        comp = {k: min(x, y) if v in (x, y) else v for k, v in comp.items()}
    linked = {k for e in edges if e[0] != e[1] for k in e}
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: comp[k] for k in linked if comp[k] != k}


def test_fuzzy_lines(spark, vocabulary, empty):
    rng = random.Random(8)
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared = [line(40) for _ in range(6)]
    near = [s[:-3] + "qq" for s in shared]
    rows = [(i, "\n".join([line(12), rng.choice(shared), "", line(3), rng.choice(near + shared).upper() if i % 3 else "x"])) for i in range(40)]
    rows += [(5, None), (None, shared[0]), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted((str(r["doc_id"]), r["n_lines"], r["dropped_lines"]) for r in fuzzy_lines.fuzzy_line_report(df).collect())
    from stratum.llm.common import WordHashes
    occ = [(i, k, fuzzy_lines.normalised(x)) for i, (_, t) in enumerate(rows) for k, x in enumerate((t or "").encode().split(b"\n")) if x.strip()]
    keys = list(dict.fromkeys(o[2] for o in occ))
    sim = [int(h) for h in fuzzy_lines.simhashes(keys, WordHashes())]
    comp = list(range(len(keys)))
    for i in range(len(keys)):
        for j in range(i):
            a, b = keys[i].decode(), keys[j].decode()
            if bin(sim[i] ^ sim[j]).count("1") <= 3 and 100 * plain_edits(a, b) <= 20 * max(len(a), len(b)):
                x, y = comp[i], comp[j]
                comp = [min(x, y) if c in (x, y) else c for c in comp]
    seen, drop = set(), {}
    for i, k, n in occ:
        c = comp[keys.index(n)]
        if c in seen:
            drop.setdefault(i, []).append(str(k))
        seen.add(c)
    want = sorted((str(d), sum(1 for o in occ if o[0] == i), ",".join(drop.get(i, []))) for i, (d, _) in enumerate(rows))
    assert got == want and any(drop.values())
    clean = fuzzy_lines.drop_fuzzy_lines(df.withColumn("line", F.lit("kept")))
    assert clean.columns == ["doc_id", "text", "line"] and clean.where("text IS NULL").count() == 1
    assert sum(len([x for x in (r["text"] or "").split("\n") if x.strip()]) for r in clean.collect()) == len(seen)
    assert fuzzy_lines.fuzzy_line_report(empty).count() == 0


def test_fuzzy_lines_by_edit_similarity_alone(spark, vocabulary, empty):
    """Replaced words, changed letters, accents and short lines: all links of plain edit similarity, whatever their SimHashes."""
    rng = random.Random(21)
    line = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    lines = ["abcd", "abce", "abcde", "abcdf", "abxde", "abcdefghij", "bcdefghijk", "abcdxxghij", "xbcdefghix"]
    for n in (3, 6, 10, 25, 50, 100):
        for _ in range(4):
            w = line(n)
            other = list(w)
            other[rng.randrange(n)] = rng.choice(vocabulary)
            t = " ".join(w)
            at = rng.randrange(len(t))
            lines += [t, " ".join(other), t[:at] + "q" + t[at + 1:], t.upper(), t[:len(t) * 3 // 4]]
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[4 * i:4 * i + 4])) for i in range(-(-len(lines) // 4))] + [(900, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    occ = [(str(i), k, fuzzy_lines.normalised(x).decode()) for i, t in rows for k, x in enumerate((t or "").encode().split(b"\n")) if x.strip()]
    comp = list(range(len(occ)))
    for i in range(len(occ)):
        for j in range(i):
            a, b = occ[i][2], occ[j][2]
            longer = max(len(a), len(b))
            if comp[i] != comp[j] and 5 * abs(len(a) - len(b)) <= longer and 5 * plain_edits(a, b) <= longer:
                x, y = comp[i], comp[j]
                comp = [min(x, y) if c in (x, y) else c for c in comp]
    drop = {}
    for (d, k, _), c, i in zip(occ, comp, range(len(occ))):
        if c != i:
            drop.setdefault(d, []).append(str(k))
    got = {str(r["doc_id"]): r["dropped_lines"] for r in fuzzy_lines.fuzzy_line_report(df, bits=None).collect()}
    assert got == {str(d): ",".join(drop.get(str(d), [])) for d, _ in rows}
    assert sum(len(x) for x in drop.values()) > 70
    clean = fuzzy_lines.drop_fuzzy_lines(df, bits=None).collect()
    assert sum(len([x for x in (r["text"] or "").split("\n") if x.strip()]) for r in clean) == len(set(comp))
    assert fuzzy_lines.fuzzy_line_report(empty, bits=None).count() == 0


def test_counts_pass_over_no_similar_pair():
    rng = random.Random(22)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcdé") for _ in range(rng.randint(1, 30))) for _ in range(2))
        e = plain_edits(a, b)
        percent = 100 - -(-100 * e // max(len(a), len(b)))
        assert fuzzy_lines.may_link(fuzzy_lines.counts(a)[None], fuzzy_lines.counts(b)[None], percent).all()


def test_edits_within_a_limit():
    rng = random.Random(23)
    pairs = []
    for _ in range(900):
        a = "".join(rng.choice("abcdé\U0001f600 ") for _ in range(rng.choice([1, 2, 5, 20, 63, 64, 65, 70])))
        b = list(a)
        for _ in range(rng.randint(0, max(1, len(a) // 3))):
            k = rng.randrange(len(b))
            b[k:k + 1] = rng.choice([["x"], ["y", b[k]], [] if len(b) > 1 else ["z"]])
        pairs.append((a, "".join(b)))
    want = [5 * plain_edits(a, b) <= max(len(a), len(b)) for a, b in pairs]
    got = fuzzy_lines.edits_within([a for a, _ in pairs], [b for _, b in pairs], np.array([max(len(a), len(b)) // 5 for a, b in pairs]))
    assert got.tolist() == want and 200 < sum(want) < 800
    for (a, b), w in zip(pairs, want):
        assert (fuzzy_lines.edits(a, b, max(len(a), len(b)) // 5) <= max(len(a), len(b)) // 5) == w


def test_rows_without_a_partner_of_their_size_are_left_out():
    rng = random.Random(24)
    rows = sorted((rng.randrange(40), rng.choice([10, 12, 14, 40, 45, 80, 200, 241, 300]), k) for k in range(120))
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i:i + 7])], names=["bucket", "size", "node"]) for i in range(0, 120, 7)]
    got = {n for b in fuzzy_lines._not_alone(iter(batches), 80) for n in b.column("node").to_pylist()}
    want = {n for k, s, n in rows if any(k == j and n != m and 5 * abs(s - t) <= max(s, t) for j, t, m in rows)}
    assert want <= got and len(got - want) <= len([1 for r in rows if r[0] in (rows[0][0], rows[-1][0])]) and len(got) < 120


def test_fuzzy_lines_leave_no_keys_behind_and_compare_large_buckets(spark, vocabulary, monkeypatch):
    """One bucket in portions of three lines; of a round's keys and shared buckets nothing stays on disk."""
    from stratum.session import shared_dir
    monkeypatch.setattr(fuzzy_lines, "PORTION", 3)
    rng = random.Random(25)
    bases = [" ".join(rng.choice(vocabulary) for _ in range(20)) for _ in range(3)]
    rows = [(k, bases[k % 3][:-4] + format(k, "04d") + ("\n" + bases[0] + bases[1] if k == 9 else "")) for k in range(30)]
    folder = Path(shared_dir(spark).removeprefix("file:")) / "stratum" / "llm"

    def left():
        return {f for name in ("keys", "buckets", "shared") for f in folder.glob(f"{name}/*")}
    before = left()
    got = {r["doc_id"]: r["n_dropped"] for r in fuzzy_lines.fuzzy_line_report(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), bits=None).collect()}
    assert got == {k: int(k > 2) for k in range(30)}
    assert left() == before


def plain_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_edit_distance():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 12))) for _ in range(2))
        assert fuzzy_lines.edits(a, b) == plain_edits(a, b)


def test_packing(spark, docs, empty):
    from tokenizers import Tokenizer
    import public_tokenizers as P
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    more = spark.createDataFrame([(2000, "a <|endoftext|> b", "", "", 0), (2001, "a \n b  c  d 's x", "", "", 0)], SCHEMA)
    both = docs.select("doc_id", "text").unionByName(more.select("doc_id", "text"))
    want = []
    for r in both.collect():
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        want += [(str(r["doc_id"]), k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got = packing.pack_documents(both).collect()
    assert sorted((str(g["doc_id"]), g["piece"], g["start"], g["length"], g["ids_crc32"]) for g in got) == sorted(want)
    bins = {}
    for g in got:
        bins.setdefault(g["sequence_id"], []).append((g["offset"], g["length"]))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(bins) <= -(-sum(w[3] for w in want) // 1024) * 1.1 + 1
    assert packing.pack_documents(empty).count() == 0


def test_local_search_empties_bins():
    rng = random.Random(4)
    for _ in range(20):
        sizes = [rng.randint(1, 400) for _ in range(rng.randint(1, 300))]
        place = packing.pack(sizes)
        fill = {}
        for (b, o), s in zip(place, sizes):
            fill[b] = fill.get(b, 0) + s
        assert max(fill.values()) <= 1024 and len(fill) <= -(-sum(sizes) // 1024) + 1


def test_local_search_empties_a_bin_of_many_tiny_items():
    """More items than any fixed number of moves: 900 of one token go into the gaps that 300 bins have left."""
    place = packing.pack([1021] * 300 + [1] * 900)
    assert len({b for b, _ in place}) == 300
    sizes = [600] * 200 + [300] * 200 + [124] * 190 + [2] * 620
    place = packing.pack(sizes)
    fill = {}
    for (b, o), s in zip(place, sizes):
        fill[b] = fill.get(b, 0) + s
    assert max(fill.values()) <= 1024 and sum(fill.values()) == sum(sizes) and len(fill) == 200


def test_a_swap_is_found_in_whichever_bin_it_lies():
    """Neither behind other bins of one free space, nor behind many fuller bins, nor in a bin that is only as full."""
    def filled(*bins):
        b = packing._Bins(packing.LIMIT)
        for items in bins:
            at = b.open()
            for size in items:
                b.put(at, (size, 100 * at + len(b.items[at])))
        return b
    for others in ([(1000, 23)] * 20 + [(600, 423)], [(1000, 24 - k) for k in range(1, 24)] * 20 + [(600, 300)], [(600, 1)]):
        bins = filled(*others, (601,))
        assert packing._swap(bins, len(others), 601)
        assert list(bins.items[len(others)]) == [600] and 601 in bins.items[len(others) - 1]
        assert not packing._swap(bins, len(others), 600)


def test_local_search_leaves_no_move_and_no_swap():
    rng = random.Random(11)
    ended_early = 0
    for _ in range(30):
        sizes = [rng.choice((rng.randint(250, 700), rng.randint(500, 530), 1024)) for _ in range(rng.randint(2, 150))]
        bins = {}
        for (b, _), s in zip(packing.pack(sizes), sizes):
            bins.setdefault(b, []).append(s)
        assert max(map(sum, bins.values())) <= 1024
        if len(bins) == -(-sum(sizes) // 1024):
            continue
        ended_early += 1
        for a, mine in bins.items():
            gifts = {s: 1 for s in mine} | {s + t: 2 for k, s in enumerate(mine) for t in mine[k + 1:]}
            for b, theirs in bins.items():
                if a != b:
                    for s in gifts:
                        for o in [*theirs, *[0] * (s in mine)]:
                            gain = s - o
                            assert not (gain > 0 and sum(theirs) + gain <= 1024 and sum(theirs) + gain > sum(mine))
    assert ended_early > 5


def test_each_window_is_summed_once(monkeypatch):
    """However many groups of items a window is heavy enough for; and words are counted once a passage."""
    rng, n = np.random.default_rng(5), 60
    items = [(i, rng.integers(0, n, 30), np.array([0])) for i in range(12)]
    has = np.array([np.isin(np.arange(n), w) for _, w, _ in items])
    vectors = rng.standard_normal((n, 8)).astype(np.float32)
    block = decontaminate.Block(items, weight=np.ones(n), rare=np.ones(n, bool), bound=np.ones(n, bool), folded=vectors[:, :4].copy(), near=np.eye(12, 4, dtype=np.float32),
                                latent=vectors, unit=np.eye(12, 8, dtype=np.float32), mass=np.full(12, 30.0), need=np.linspace(1, 15, 12), window=np.full(12, 32), has=has)
    seen, real = [], decontaminate._directions
    monkeypatch.setattr(decontaminate, "_directions", lambda v, num, lo, hi: (seen.extend(lo) if v is block.folded else None, real(v, num, lo, hi))[1])
    pos, num = np.arange(128, 728), rng.integers(0, n, 600).astype(np.int32)
    list(decontaminate._candidates(pos, num, block))
    # the first window may begin where the second does: before the first word
    assert len(seen) - len(set(seen)) <= 1 and len(seen) >= 600 // 16
    monkeypatch.setattr(decontaminate, "_together", lambda batches: iter([([], pos, num)]))
    counted = dict(zip(*(c.to_pylist() for c in next(decontaminate._frequencies([], n)).columns)))
    cells = [set(num[pos // 64 == c].tolist()) for c in sorted(set(pos // 64))]
    assert counted.pop(-1) == len(cells) and counted == {w: sum(w in c for c in cells) for w in set(num.tolist())}


def test_toxicity(spark, vocabulary):
    rng = random.Random(9)
    bad = ["vilex", "vilor", "scumm", "trashy"]
    rows, labels = [], []
    for i in range(600):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows + [(None, None), (9000, "")], "doc_id long, text string").withColumn("score", F.lit("x"))
    lab = spark.createDataFrame(labels + [(None, 1)], "doc_id long, toxic int")
    out = toxicity.score_toxicity(docs, lab).collect()
    truth = dict(labels)
    held = [r for r in out if r["doc_id"] in truth and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(out) == 602 and all(r["held_out"] for r in held)
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    flipped = lab.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert {(r["doc_id"], r["score"]) for r in toxicity.score_toxicity(docs, flipped).collect()} == {(r["doc_id"], r["score"]) for r in out}
    assert toxicity.score_toxicity(docs, lab.where("toxic = 0")).where("score > 0").count() == 0


def test_maximal_segments():
    def brute(s):   # the definition: best segment first, then the same to its left and right
        best = max(((sum(s[i:j]), -(j - i), i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=(0, 0, 0, 0))
        if best[0] <= 0:
            return []
        _, _, i, j = best
        return brute(s[:i]) + [(i, j)] + [(a + j, b + j) for a, b in brute(s[j:])]
    rng = random.Random(3)
    for _ in range(200):
        s = [rng.choice([-3, -2, -1, 1, 2, 3]) + rng.random() / 7 for _ in range(rng.randint(0, 14))]
        assert sorted((a, b) for a, b, _ in toxicity.segments(list(enumerate(s)))) == sorted(brute(s))


def test_fixity(spark):
    rows = [(i, f"http://x/{i}", "é" * (i % 7) + f"<p>{i}</p>") for i in range(2500)] + [(None, None, None)] + [(1, "http://x/1", "<p>same</p>")] * 40
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"file": F.lit(1), "idx": F.lit(2)}).repartition(4)
    rot = F.when(F.col("page_id").isin(7, 1300, 2499), F.concat(F.lit("#"), F.coalesce("html", F.lit("")))).otherwise(F.col("html"))
    out = fixity.fixity_report(pages, rot).collect()
    assert len(out) == len(rows) and sorted(r["page_id"] for r in out if not r["intact"]) == [7, 1300, 2499]
    by = {}
    for r in out:
        by.setdefault(r["file"], []).append((r["pos"], r["length"]))
    for items in by.values():   # offsets tile each file
        at = 0
        for pos, length in sorted(items):
            assert pos == at
            at += length
    assert fixity.fixity_report(pages.limit(0), F.col("html")).count() == 0


def test_fixity_of_a_second_table(spark):
    """Changed, longer, missing and extra records, also among copies, in a replica with offsets of its own."""
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>" * (i % 5)) for i in range(1500)] + [(None, None, None)] + [(1, "http://x/1", "<p>same</p>")] * 40
    other = []
    for i, u, h in rows[:1500]:
        if i not in (13, 800):
            other.append((i, u, {7: "#" + h[1:], 11: h + "longer"}.get(i, h)))
    other += [(None, None, None), (4000, "http://x/new", "")] + [(1, "http://x/1", "<p>same</p>")] * 37 + [(20, "http://x/20", "copy")]
    schema = "page_id long, url string, html string"
    left, right = (spark.createDataFrame(x, schema).repartition(3) for x in (rows, other))
    out = fixity.replica_report(left, right).collect()
    bad = sorted((r["status"], r["page_id"]) for r in out if r["status"] not in ("intact", "displaced"))
    assert bad == [("changed", 7), ("changed", 11), ("extra", 20), ("extra", 4000), ("missing", 1), ("missing", 1), ("missing", 1), ("missing", 13), ("missing", 800)]
    assert len(out) == len(rows) + 2 and any(r["status"] == "displaced" for r in out)
    for r in out:
        moved = (r["pos"], r["length"], r["sha256"]) != (r["replica_pos"], r["replica_length"], r["replica_sha256"])
        assert r["status"] != "intact" or not moved
        assert r["status"] != "displaced" or r["sha256"] == r["replica_sha256"]
    for pos, length in (("pos", "length"), ("replica_pos", "replica_length")):   # offsets tile each file of both
        by = {}
        for r in out:
            if r[pos] is not None:
                by.setdefault(r["file"], []).append((r[pos], r[length]))
        for items in by.values():
            at = 0
            for p, n in sorted(items):
                assert p == at
                at += n
    report = fixity.fixity_report(left, right).collect()
    assert len(report) == len(rows) and sorted(r["page_id"] for r in report if not r["intact"]) == [1, 1, 1, 7, 11, 13, 800]
    nothing = fixity.replica_report(left.limit(0), right).groupBy("status").count().collect()
    assert [(r["status"], r["count"]) for r in nothing] == [("extra", len(other))]


def test_warc_files_hold_the_records(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "<p>é</p>"), (2, "v", None)], "page_id long, url string, html string")
    fixity.write_warc(pages, str(tmp_path / "w"))
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").rglob("part-*")))
    assert data.count(b"WARC/1.1\r\n") == 2 and b"Content-Length: 9\r\n\r\n" + "<p>é</p>".encode() + b"\r\n\r\n" in data


def test_audit_finds_missing_records(spark):
    leaf = lambda n, skip=(): spark.createDataFrame([("f", i, 10 * i, 10, f"h{i}") for i in range(n) if i not in skip], "file string, idx long, pos long, length long, hash string")
    assert [(r["file"], r["idx"]) for r in fixity.audit(fixity.tree(leaf(300)), fixity.tree(leaf(300, {123}))).collect()] == [("f", 123)]
    assert fixity.audit(fixity.tree(leaf(300)), fixity.tree(leaf(300))).count() == 0


def test_quality(spark, vocabulary, empty):
    rng = random.Random(10)
    word = lambda: rng.choice(vocabulary)
    rows = []
    for i in range(400):
        w = [word() for _ in range(rng.randint(60, 200))]
        kind = i % 8
        text = {0: " ".join(x + "***" for x in w), 1: " ".join(x.upper() + "!!" for x in w), 2: " ".join([w[0]] * 80)}.get(kind)
        rows.append((i, text or " ".join(w).capitalize() + ".", int(text is None)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(9000, None), (None, " ")], "doc_id long, text string").withColumn("quality_score", F.lit("x"))
    got = {r["doc_id"]: r["predicted"] for r in quality.score_quality(docs).collect()}
    assert sum(got[i] == y for i, _, y in rows) >= 0.98 * len(rows) and got[9000] == 0 and got[None] == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(got.values())
    assert quality.score_quality(empty).count() == 0


def test_quality_sample_is_of_distinct_texts(spark, vocabulary, monkeypatch):
    """Copies are one row of the sample, weighted by their number; every other text has its chance."""
    rng = random.Random(11)
    texts = [" ".join(rng.choice(vocabulary) for _ in range(80)).capitalize() + "." for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, texts[0]) for i in range(3000)] + [(5000 + i, texts[i].upper()) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = []
    monkeypatch.setattr(quality, "fit", lambda rows: got.append(rows))
    quality.learn(docs, 1000)
    assert len(got[0]) == 80 and abs(sum(r[3] for r in got[0]) - len(rows)) < 1e-6 * len(rows)
    assert max(r[3] for r in got[0]) == 3001
    quality.learn(docs, 30)
    assert len(got[1]) < 60 and abs(sum(r[3] for r in got[1]) - len(rows)) < 1e-6 * len(rows)


def test_em_recovers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.92, 0.97, 0.9, 0.93, 0.9, 0.95])
    votes = np.where(rng.random((20_000, 8)) < right, truth[:, None], ~truth[:, None]).astype(int)
    from collections import Counter
    prior, acc, _ = quality.em(Counter(map(tuple, votes.tolist())))
    assert abs(prior[1] - 0.8) < 0.02 and np.abs(acc[np.arange(8), 1, 1] - right).max() < 0.03


@pytest.fixture(scope="module")
def leaky(spark, vocabulary):
    rng = random.Random(12)
    words = [w + x for w in vocabulary for x in ("", "ta", "ri", "mo", "lu")]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(text(rng.randint(15, 59)))) for i in range(12)] + [(50, ""), (51, None), (52, " ".join(text(150)))]
    rows, truth = [], set()
    for d in range(120):
        w = text(rng.randint(80, 300))
        if d % 6 == 0:
            item, t = items[d // 6 % 12]
            leak = t.split(" ")
            if d % 12 == 0:   # reworded: some words replaced, all in order
                leak = [x if k % 6 else "other" + x for k, x in enumerate(leak)]
            at = rng.randrange(len(w))
            w[at:at] = ["(" + leak[0].upper(), *leak[1:-1], leak[-1] + ")."]
            truth.add((d, item))
        rows.append((d, " ".join(w)))
    rows[7] = (7, rows[7][1] + " " + items[14][1])
    truth.add((7, 52))
    docs = spark.createDataFrame(rows + [(500, None), (None, rows[0][1])], "doc_id long, text string").withColumn("size", F.lit(1))
    return docs, spark.createDataFrame(items, "item_id long, text string"), truth


def test_decontamination(leaky, empty):
    docs, bench, truth = leaky
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert {g for g in got if g[0] is not None} == truth and (None, 0) in got
    left = decontaminate.drop_leaks(docs, bench)
    assert left.columns == docs.columns and left.count() == docs.count() - len({d for d, _ in truth}) - 1
    assert decontaminate.find_leaks(empty, bench).count() == 0 and decontaminate.find_leaks(docs, bench.limit(0)).count() == 0


def test_decontamination_of_a_text_in_parts(spark, leaky, vocabulary, monkeypatch):
    """Verbatim items at every place of a text that goes through in parts of 300 known words."""
    monkeypatch.setattr(decontaminate, "TOGETHER", 300)
    docs, bench, _ = leaky
    rng = random.Random(13)
    words = [w + x for w in vocabulary for x in ("", "ta", "ri", "mo", "lu")]
    items = [(r["item_id"], r["text"]) for r in bench.where("item_id < 12").collect()]
    rows = []
    for d in range(30):
        w = [rng.choice(words) for _ in range(rng.randint(0, 900))]
        for _, t in rng.sample(items, len(items)):
            w += t.split(" ") + [rng.choice(words) for _ in range(rng.randint(0, 120))]
        rows.append((1000 + d, " ".join(w)))
    long_ = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs.select("doc_id", "text").unionByName(long_), bench).collect()}
    assert {(d, i) for d, _ in rows for i, _ in items} <= got


def test_decontamination_with_answers_of_their_own(spark, leaky):
    """Reworded items (two words of five kept out) whose answer follows them in the text, not in the item."""
    docs, bench, truth = leaky
    items = [(r["item_id"], r["text"], f"quux{r['item_id']} zork{r['item_id']}") for r in bench.where("item_id < 12").collect()]
    rows = []
    for i, t, a in items:
        part = [x if k % 5 not in (1, 3) else "other" + x for k, x in enumerate(t.split(" "))]
        rows += [(2000 + i, " ".join(part) + " " + a), (3000 + i, " ".join(part))]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(both, spark.createDataFrame(items, "item_id long, text string, answer string")).collect()}
    near = {(2000 + i, i) for i, _, _ in items}
    assert len(near & got) >= 10 and not any(3000 <= (d or 0) < 4000 for d, _ in got)


def test_words_beyond_ascii():
    said = lambda t: [w.decode() for w in decontaminate.words_of(t)]
    assert said("“Né” — l’été\u00a0fini… «so» a\u200bb na\u00efve_1") == ["né", "l", "été", "fini", "so", "a", "b", "naïve_1"]
    assert said("日本語、x1「テスト」。") == ["日", "本", "語", "x1", "テ", "ス", "ト"]


def test_decontamination_in_a_script_without_spaces(spark):
    rng = random.Random(14)
    text = lambda n: "".join(chr(rng.randrange(0x4e00, 0x5200)) for _ in range(n))
    items = [(i, text(50)) for i in range(6)]
    rows = [(d, text(200) + (items[d][1] if d < 6 else "，") + text(200)) for d in range(60)]
    leaks = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r["doc_id"], r["item_id"]) for r in leaks.collect()) == [(i, i) for i in range(6)]


def test_common_mass_is_the_heaviest_subsequence():
    rng = np.random.default_rng(2)
    weight = rng.random(6)
    for _ in range(50):
        a, b = rng.integers(0, 6, 6), rng.integers(0, 6, 8)
        table = np.zeros((7, 9))
        for i in range(6):
            for j in range(8):
                table[i + 1, j + 1] = max(table[i, j + 1], table[i + 1, j], table[i, j] + weight[a[i]] if a[i] == b[j] else 0)
        assert abs(decontaminate.common_mass(a, b, weight) - table[-1, -1]) < 1e-9
