"""Byte-level BPE: words that are frequent in the corpus come from a shared transducer, all others are merged exactly."""
from __future__ import annotations

import json
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F

from stratum.llm.common import id_text, small_pieces, stage
from stratum.llm.lexicon import Lexicon, compile_words
from stratum.session import scratch_path

#: Words the transducer holds at most: a bound on its size (a few MB), not on the result, which it never changes.
LEXICON_WORDS = 150_000
#: Different chunks a counting task holds before it passes their counts on.
COUNT_ENTRIES = 400_000
#: Words of up to this many bytes are merged side by side, longer ones each on its own.
SHORT_WORD = 64
NO_MERGE = 1 << 40
#: Bytes of text that are encoded together.
SLICE_BYTES = 3_000_000

#: Fixed value: how byte-level vocabularies of this kind cut texts into words.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
ASCII_WORD = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+")
PLAIN = re.compile("[\t\n\r\x20-\x7e\xa1-\u024f]*")


def default_vocabulary() -> str:
    import public_tokenizers as P
    return P.path("byte_bpe_50k.json")


def _byte_symbols() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if it is visible, else from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols, hidden = {b: chr(b) for b in visible}, 0
    for b in range(256):
        if b not in symbols:
            symbols[b] = chr(0x100 + hidden)
            hidden += 1
    return [symbols[b] for b in range(256)]


class Vocabulary:
    """Merges, byte ids and token bytes of a byte-level BPE file, and the library's own cutting of texts into words."""

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        added = spec["added_tokens"]
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if not plain or spec["normalizer"] or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space") \
                or any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        ids = model["vocab"]
        symbols = _byte_symbols()
        self.cut = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        self.byte_ids = [ids[s] for s in symbols]
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        self.ranks = np.argsort(keys, kind="stable")   # the place in the file is the rank
        self.pairs = keys[self.ranks]
        self.joined = np.array([ids[a + b] for a, b in pairs], np.int64)
        self.rank_of: dict[int, int] | None = None
        byte_of = {s: b for b, s in enumerate(symbols)}
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in ids.items()}
        self.special = {t["content"]: t["id"] for t in added}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.at_special = [re.escape(t.encode()) for t in sorted(self.special, key=len, reverse=True)]

    def words(self, chunk: bytes) -> list[bytes]:
        """A chunk's words. Where all versions of Unicode agree on the characters, a pattern of the same form cuts it."""
        if chunk.isascii():
            return ASCII_WORD.findall(chunk)
        text = chunk.decode()
        if PLAIN.fullmatch(text):
            return [w.encode() for w in WORD.findall(text)]
        return [text[a:b].encode() for _, (a, b) in self.cut(text)]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words: of all neighbours that may merge, those of the lowest rank, the leftmost first, until none may.
        Returns a pool of ids, and where each word's ids begin in it and how many they are. Words of about one length
        take their next merge together."""
        length = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(length, kind="stable")
        size, pool = np.zeros(len(words), np.int64), [np.empty(0, np.int64)]
        long = int(np.searchsorted(length[order], SHORT_WORD, "right"))
        for i in range(0, long, 4096):
            some = order[i:min(long, i + 4096)]
            ids, size[some] = self._merge_short([words[j] for j in some])
            pool.append(ids)
        for i in order[long:]:
            ids = self._merge_long(list(map(self.byte_ids.__getitem__, words[i])))
            size[i] = len(ids)
            pool.append(np.array(ids, np.int64))
        at = np.empty(len(words), np.int64)
        at[order] = np.cumsum(size[order]) - size[order]
        return np.concatenate(pool), at, size

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], NO_MERGE)

    def _merge_short(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        n, width = len(words), max(map(len, words))
        length = np.fromiter(map(len, words), np.int64, n)
        column = np.arange(width)
        ids = np.full((n, width + 1), -1, np.int64)   # a last column of nothing moves in from the right
        ids[:, :width][column < length[:, None]] = np.array(self.byte_ids)[np.frombuffer(b"".join(words), np.uint8)]
        rank = self._rank(ids[:, :-1], ids[:, 1:])    # of each id with the next one; none where there is no next one
        done, row = np.empty((n, width), np.int64), np.arange(n)
        while len(row):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(row)), at]
            go = best != NO_MERGE
            done[row[~go]] = ids[~go, :-1]
            row, at, best, ids, rank = row[go], at[go], best[go], ids[go], rank[go]
            here = np.arange(len(row))
            length[row] -= 1
            ids[here, at] = self.joined[best]
            behind = column >= at[:, None]                   # what follows the merged pair moves one to the left
            ids[:, 1:-1] = np.where(behind[:, :-1], ids[:, 2:], ids[:, 1:-1])
            rank[:, :-1] = np.where(behind[:, :-1], rank[:, 1:], rank[:, :-1])
            rank[here, at] = self._rank(ids[here, at], ids[here, at + 1])
            some = at > 0
            rank[here[some], at[some] - 1] = self._rank(ids[here[some], at[some] - 1], ids[here[some], at[some]])
        return done[column < length[:, None]], length

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for one long word, with a queue of the pairs that may merge: time n log n."""
        n = len(ids)
        if self.rank_of is None:
            self.rank_of = dict(zip(self.pairs.tolist(), self.ranks.tolist()))
        get, joined = self.rank_of.get, self.joined
        heap = [(m, i) for i in range(n - 1) if (m := get(ids[i] << 32 | ids[i + 1])) is not None]
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            m, i = heappop(heap)
            j = after[i]
            if ids[i] is None or j >= n or get(ids[i] << 32 | ids[j]) != m:
                continue   # one of the two has been merged since
            ids[i], ids[j] = int(joined[m]), None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (m := get(ids[i] << 32 | ids[k])) is not None:
                    heappush(heap, (m, i))
            k = before[i]
            if k >= 0 and (m := get(ids[k] << 32 | ids[i])) is not None:
                heappush(heap, (m, k))
        return [i for i in ids if i is not None]


def _count_words(batches) -> Iterator[pa.RecordBatch]:
    """Counts of what stands between spaces in the texts, with the space before it."""
    counts: Counter = Counter()

    def emit():
        return pa.RecordBatch.from_arrays([pa.array([" " + c for c in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
    for b in small_pieces(batches, 1):
        for text in b.column(1).to_pylist():
            counts.update(text.split(" ")[1:])
        if len(counts) > COUNT_ENTRIES:
            yield emit()
            counts.clear()
    yield emit()


def _ids_of_words(batches, make) -> Iterator[pa.RecordBatch]:
    v = make()
    for b in batches:
        words = [w.encode() for w in b.column(0).to_pylist()]
        parts = [v.words(w) for w in words]
        pool, at, size = v.merge([w for ws in parts for w in ws])
        of = np.repeat(np.arange(len(parts)), np.fromiter(map(len, parts), np.int64, len(parts)))
        ids, ends = _gather(pool, of, at, size, len(parts))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), lists], names=["word", "ids"])


def frequent_words(docs: DataFrame, most: int = LEXICON_WORDS) -> DataFrame:
    """(word, n) of the most frequent words of all texts, at most ``most``; a word here is a space and what follows it up
    to the next one. The least count is read off a histogram of sixteenths of powers of two, so no list is sorted."""
    words = stage(id_text(docs).mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    level = F.floor(16 * F.log2("n")).cast("int")
    held, least = 0, 0
    for r in words.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():   # at most 1,024 levels
        held, least = held + r["count"], r["level"]
        if held > most:
            least += 1
            break
    return words.where(level >= least)


def compile_lexicon(docs: DataFrame, most: int = LEXICON_WORDS, vocabulary: Callable[[], str] = default_vocabulary) -> str:
    """Compile the corpus's frequent words into a transducer, put it into the shared folder and let Spark bring it to every
    executor, now and when one is replaced. Returns its name among the files of the session. At most ``most`` words pass
    the driver."""
    found = frequent_words(docs, most).select("word").mapInArrow(lambda it: _ids_of_words(it, lambda: Vocabulary(vocabulary())), "word binary, ids array<int>")
    return share_file(docs.sparkSession, compile_words((bytes(r["word"]), tuple(r["ids"])) for r in found.collect()))


def share_file(spark: SparkSession, data: bytes) -> str:
    """Write bytes below the shared folder, whatever kind of store that is, and add the file to the session's files."""
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = scratch_path(spark, "llm", "lexicon") + "/" + name
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    out = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(at)
    try:
        for i in range(0, len(data), 1 << 20):
            out.write(data[i:i + (1 << 20)])
    finally:
        out.close()
    spark.sparkContext.addFile(path)
    return name


def _white(*before: np.ndarray) -> np.ndarray:
    """Whether the UTF-8 character that ends with the bytes ``before`` (last, last but one, last but two) is white space,
    or counts as such in some version of Unicode."""
    a, b, c = before
    two, three = b.astype(np.int32) << 8 | a, c.astype(np.int32) << 16 | b.astype(np.int32) << 8 | a
    return (a == 0x20) | ((a >= 0x09) & (a <= 0x0D)) | ((a >= 0x1C) & (a <= 0x1F)) | (two == 0xC285) | (two == 0xC2A0) | ((three >= 0xE28080) & (three <= 0xE2808B)) \
        | np.isin(three, [0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080, 0xE19A80, 0xE1A08E, 0xEFBBBF])


class Encoder:
    """Texts to ids, a slice of texts at a time, as one run of bytes. A space after anything but white space always begins
    a word, so texts are cut there; most of these chunks are words of the lexicon as they stand and never become Python
    objects. Chunks that are none are cut by the vocabulary's own rule, and words that the lexicon has not are merged."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.v, self.lexicon = vocabulary, lexicon
        self.special = re.compile(b"|".join(vocabulary.at_special)) if vocabulary.at_special else None

    def _chunks(self, text: bytes, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, dict[int, int]]:
        """Places where chunks begin, and of those that are special strings the ids."""
        space = np.flatnonzero(data == 0x20)
        back = [np.where(space >= k, data[np.maximum(space - k, 0)], 0) for k in (1, 2, 3)]
        cuts, special = [space[~_white(*back)], starts], {}
        if self.special and self.special.search(text):
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(text)]):   # none lies across two texts
                for m in self.special.finditer(text[a:b]):
                    special[a + m.start()] = self.v.special[m.group().decode()]
                    cuts.append(np.array([a + m.start(), a + m.end()]))
        begin = np.sort(np.concatenate(cuts))
        begin = begin[(np.diff(begin, append=len(data)) > 0) & (begin < len(data))]
        if special:   # no chunk begins inside a special string
            held = [(a, a + len(t)) for a, i in special.items() for t in [self.v.bytes_of[i]]]
            begin = begin[~np.any([(begin > a) & (begin < b) for a, b in held], axis=0)]
        return begin, special

    def _unseen(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks that are no words of the lexicon one after another, and where each one's ids end."""
        numbers: dict[bytes, int] = {}
        cut = [[numbers.setdefault(w, len(numbers)) for w in self.v.words(c)] for c in chunks]
        words = list(numbers)
        length = np.fromiter(map(len, words), np.int64, len(words))
        found, *pieces = self.lexicon.look_up(np.frombuffer(b"".join(words), np.uint8), np.cumsum(length) - length, length)
        known, ends = _gather(self.lexicon.pool, *pieces, len(words))
        merged, at, size = self.v.merge([words[i] for i in np.flatnonzero(~found)])
        place, count = ends - np.diff(ends, prepend=0), np.diff(ends, prepend=0)
        place[~found], count[~found] = at + len(known), size
        parts = np.fromiter((w for ws in cut for w in ws), np.int64)
        chunk = np.repeat(np.arange(len(cut)), np.fromiter(map(len, cut), np.int64, len(cut)))
        return _gather(np.concatenate([known, merged]), chunk, place[parts], count[parts], len(cut))

    def encode(self, text: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that stand one after another in ``text`` from the places ``starts`` on, and where each text's ids end."""
        data = np.frombuffer(text, np.uint8)
        begin, special = self._chunks(text, data, starts)
        n = len(begin)
        length = np.diff(begin, append=len(data))
        found, word, at, size = self.lexicon.look_up(data, begin, length)
        if special:
            mine = np.isin(begin, list(special))
            found |= mine
            word, at, size = (c[~mine[word]] for c in (word, at, size))
        missed = np.flatnonzero(~found)
        numbers: dict[bytes, int] = {}
        which = np.array([numbers.setdefault(text[a:b], len(numbers)) for a, b in zip(begin[missed].tolist(), (begin + length)[missed].tolist())], np.int64)
        more, stop = self._unseen(list(numbers))
        count = np.diff(stop, prepend=0)
        start = len(self.lexicon.pool) + stop - count
        pieces = [(word, at, size), (missed, start[which], count[which])]
        pool = [self.lexicon.pool, more]
        if special:   # a special string's one id
            pieces.append((np.searchsorted(begin, list(special)), len(self.lexicon.pool) + len(more) + np.arange(len(special)), np.ones(len(special), np.int64)))
            pool.append(list(special.values()))
        ids, ends = _gather(np.concatenate(pool), *map(np.concatenate, zip(*pieces)), n)
        after = np.searchsorted(begin, [*starts[1:], len(data)])   # chunks up to each text's end
        return ids, np.concatenate([[0], ends])[after] if len(starts) else ends


def _gather(pool: np.ndarray, word: np.ndarray, at: np.ndarray, size: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of ``n`` words in order, out of pieces of a pool, and where each word's ids end."""
    order = np.argsort(word, kind="stable")
    word, at, size = word[order], at[order], size[order]
    first = np.cumsum(size) - size
    return pool[np.repeat(at - first, size) + np.arange(int(size.sum()))], np.cumsum(np.bincount(word, size, n).astype(np.int64))


def _encode(batches, make, name: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(make(), Lexicon(SparkFiles.get(name)))
    for b in small_pieces(batches, 1, SLICE_BYTES):
        text, starts = _bytes_of(b.column(1))
        ids, stop = encoder.encode(text, starts[:-1])
        stop = np.concatenate([[0], stop])
        whole = pa.Array.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer((4 * stop).astype("<i8")), pa.py_buffer(ids.astype("<u4"))])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(stop)), whole.cast(pa.binary())], names=["doc_id", "n_tokens", "ids"])


class Decoder:
    """Ids to texts: the tokens' bytes one after another."""

    def __init__(self, vocabulary: Vocabulary):
        of = vocabulary.bytes_of
        tokens = [of.get(i, b"") for i in range(max(of) + 1)] + [b""]   # the last stands for ids that there are not
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """Texts of ids that stand one after another, each text's up to its place in ``ends``."""
        ids = np.minimum(ids, len(self.size) - 1).astype(np.int64)
        size = self.size[ids]
        stop = np.cumsum(size)
        whole = self.bytes[np.repeat(self.at[ids] - (stop - size), size) + np.arange(int(size.sum()))]
        stop = np.concatenate([[0], stop])[np.concatenate([[0], ends])]
        data = whole.tobytes()
        try:
            data.decode()
            split = stop[(stop > 0) & (stop < len(whole))]
            proper = not ((whole[split] & 0xC0) == 0x80).any()   # no text begins inside a character
        except UnicodeDecodeError:
            proper = False
        if proper:
            return pa.Array.from_buffers(pa.large_string(), len(ends), [None, pa.py_buffer(stop.astype("<i8")), pa.py_buffer(data)]).cast(pa.string())
        return pa.array([data[a:b].decode("utf-8", "replace") for a, b in zip(stop[:-1].tolist(), stop[1:].tolist())], pa.string())


def _bytes_of(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """A string or binary column without nulls as one run of bytes, and where each row begins and the last one ends."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or ends[-1] == ends[0]:
        return b"", np.zeros(len(column) + 1, np.int64)
    return column.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes(), ends - ends[0]


def _decode(batches, make) -> Iterator[pa.RecordBatch]:
    decoder = Decoder(make())
    for b in small_pieces(batches, 2):
        ids, ends = _bytes_of(b.column(2))
        yield pa.RecordBatch.from_arrays([*b.columns, decoder.decode(np.frombuffer(ids, "<u4"), ends[1:] // 4)], names=["doc_id", "n_tokens", "ids", "decoded"])


def encode(docs: DataFrame, lexicon: str, vocabulary: Callable[[], str] = default_vocabulary) -> DataFrame:
    """Per row: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers). ``lexicon`` is a name that ``compile_lexicon``
    returned, of this or of other texts: which words it holds does not change the result. A null text is empty and has no ids; repeated rows
    and null ids are rows of their own; an empty table gives an empty result; other columns are ignored."""
    return id_text(docs).mapInArrow(lambda it: _encode(it, lambda: Vocabulary(vocabulary()), lexicon), "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, vocabulary: Callable[[], str] = default_vocabulary) -> DataFrame:
    """``encoded`` (see ``encode``) with ``decoded``, the text of the ids: special tokens are written out, ids that the
    vocabulary has not are left out, and bytes that are no UTF-8 become replacement characters."""
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(lambda it: _decode(it, lambda: Vocabulary(vocabulary())),
                                                                  "doc_id long, n_tokens long, ids binary, decoded string")


def round_trip(docs: DataFrame, most: int = LEXICON_WORDS, vocabulary: Callable[[], str] = default_vocabulary) -> DataFrame:
    """doc_id, n_tokens, ids and decoded of every text, by a lexicon of the corpus's own frequent words."""
    return decode(encode(docs, compile_lexicon(docs, most, vocabulary), vocabulary), vocabulary)
