"""Packing token sequences into bins: best-fit first, then a swap-based local search over the underfull bins."""
from __future__ import annotations

import base64
import bisect
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratum.llm.common import CACHE_ENTRIES, small_pieces, stage

LIMIT = 1024
END_ID = 2
#: Pieces packed together in one group: enough for a group's last bins not to count, small enough for one task.
GROUP_ITEMS = 20_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class ByteBpe:
    """Ids of the byte-level vocabulary as little-endian unsigned 32-bit integers.

    A space after a character that is no white space always starts a new pre-token, so a text is cut there and the
    pieces' ids are remembered. Texts with other white space before a space, or with the vocabulary's special
    string, go to the library whole."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.whole = Tokenizer.from_file(json_path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}
        self.unsafe = re.compile(r"\s ")
        outer = self

        class Cache(dict):
            def __missing__(self, s):
                if len(self) >= CACHE_ENTRIES:
                    self.clear()
                v = self[s] = outer._pack(outer.bpe.encode_ordinary(" " + s))
                return v
        self.cache = Cache()

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        import numpy as np
        return np.asarray(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self._pack(self.whole.encode(text, add_special_tokens=False).ids)
        if self.unsafe.search(text):
            return self._pack(self.bpe.encode_ordinary(text))
        first, *rest = text.split(" ")
        return self._pack(self.bpe.encode_ordinary(first)) + b"".join(map(self.cache.__getitem__, rest))


def _tokenizer() -> ByteBpe:
    import public_tokenizers as P
    return ByteBpe(P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)


def _pieces(batches: Iterator[pa.RecordBatch], limit: int, end_id: int, make) -> Iterator[pa.RecordBatch]:
    bpe = make()
    end = end_id.to_bytes(4, "little")
    for b in small_pieces(batches, 1):
        out = ([], [], [], [], [])
        for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            ids = bpe.encode(text) + end
            n = len(ids) // 4
            first = n % limit or limit   # only a first piece may be shorter
            cuts = [0, *range(first, n + 1, limit)]
            for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                for col, v in zip(out, (doc, k, lo, hi - lo, zlib.crc32(ids[4 * lo:4 * hi]))):
                    col.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                         names=["doc_id", "piece", "start", "length", "ids_crc32"])


def token_pieces(docs: DataFrame, limit: int = LIMIT, end_id: int = END_ID, make=_tokenizer) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): a document's ids followed by ``end_id``, cut into ``limit``-token
    pieces of which only the first may be shorter. Null text is empty (one piece of one token); repeated rows and
    null ids are documents of their own."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return base.mapInArrow(lambda it: _pieces(it, limit, end_id, make), PIECES)


class _Bins:
    """Bins by free space; a bit mask of the free spaces in use makes 'smallest that still fits' one bit operation. Per free
    space another mask has the item sizes that its bins hold, so that every partner of a swap is found without a look at each bin."""

    def __init__(self, limit: int):
        self.limit, self.free, self.mask = limit, [], 0
        self.items: list[dict[int, list[int]] | None] = []   # per bin its items by size
        self.by_free: list[set[int]] = [set() for _ in range(limit + 1)]
        self.sizes = [0] * (limit + 1)
        self.holders: list[dict[int, set[int]]] = [{} for _ in range(limit + 1)]

    def _enter(self, b: int):
        f = self.free[b]
        self.by_free[f].add(b)
        self.mask |= 1 << f
        if f:   # nothing more goes into a full bin
            for size in self.items[b]:
                self.holders[f].setdefault(size, set()).add(b)
                self.sizes[f] |= 1 << size

    def _leave(self, b: int):
        f = self.free[b]
        s = self.by_free[f]
        s.discard(b)
        if not s:
            self.mask &= ~(1 << f)
        if f:
            for size in self.items[b]:
                s = self.holders[f][size]
                s.discard(b)
                if not s:
                    del self.holders[f][size]
                    self.sizes[f] &= ~(1 << size)

    def best(self, size: int) -> int | None:
        """Some bin with the least free space that is at least ``size``."""
        m = self.mask >> size
        return None if not m else next(iter(self.by_free[size + (m & -m).bit_length() - 1]))

    def change(self, b: int, out: list[int] = (), new: list[tuple[int, int]] = ()) -> list[tuple[int, int]]:
        """Take one item of each size in ``out`` from a bin and put the ``new`` ones in; returns those taken."""
        self._leave(b)
        held, taken = self.items[b], []
        for size in out:
            taken.append((size, held[size].pop()))
            if not held[size]:
                del held[size]
        for size, i in new:
            held.setdefault(size, []).append(i)
        self.free[b] += sum(out) - sum(size for size, _ in new)
        self._enter(b)
        return taken

    def put(self, b: int, item: tuple[int, int]):
        self.change(b, new=[item])

    def open(self) -> int:
        self.items.append({})
        self.free.append(self.limit)
        self._enter(len(self.items) - 1)
        return len(self.items) - 1

    def drop(self, b: int):
        """Take an empty bin out of use."""
        self._leave(b)
        self.items[b] = None


def pack(sizes: list[int], limit: int = LIMIT) -> list[tuple[int, int]]:
    """(bin, offset) per item. Best fit, largest first, then local search between underfull bins: a move, a swap of one
    item for one or of two for one is made when the sum of squared fills rises, so that lightly filled bins drain into
    fuller ones until they are empty and go. Stops at the lower bound, or when no move and no swap between any two bins
    raises the sum: squared fills only rise, so it ends."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    bins = _Bins(limit)
    for i in order:
        b = bins.best(sizes[i]) if sizes[i] < limit else None
        bins.put(bins.open() if b is None else b, (sizes[i], i))
    least = -(-sum(sizes) // limit)
    live = len(bins.items)
    changed = True
    while changed and live > least:
        changed = False
        for src in sorted((b for b in range(len(bins.items)) if bins.items[b] and bins.free[b]), key=lambda b: -bins.free[b]):
            if live <= least:
                break
            if not bins.items[src]:
                continue
            changed |= _drain(bins, src)
            if not bins.items[src]:
                bins.drop(src)
                live -= 1
    place, n = [None] * len(sizes), 0
    for held in bins.items:
        if held:
            at = 0
            for size, some in held.items():
                for i in some:
                    place[i] = (n, at)
                    at += size
            n += 1
    return place


def _drain(bins: _Bins, src: int) -> bool:
    """Empty ``src`` as far as moves and swaps that raise the sum of squared fills allow. True if anything moved."""
    moved = False
    while bins.items[src]:
        done = False
        fill = bins.limit - bins.free[src]
        for size in sorted(bins.items[src], reverse=True):
            bins._leave(src)   # not its own target
            dst = bins.best(size)
            bins._enter(src)
            if dst is not None and 2 * size * (bins.limit - bins.free[dst] - fill + size) > 0:
                bins.change(dst, new=bins.change(src, [size]))
                done = True
                break
        if not done:
            done = _swap(bins, src, fill)
        if not done:
            return moved
        moved = True
    return moved


def _below(offers: int, limit: int) -> list[int]:
    """Masks of the numbers that lie 1 to 2**k below some number of a mask, by k, as far as ``limit``."""
    out = [offers >> 1]
    while len(out) < limit.bit_length():
        out.append(out[-1] | out[-1] >> (1 << len(out) - 1))
    return out


def _swap(bins: _Bins, src: int, fill: int) -> bool:
    """One swap with any other bin: one or two items of ``src`` for one smaller item there, so that what the other bin then
    holds is more than ``src`` holds now, which is when squared fills rise. The fullest bins that offer one come first, and
    of them the swap that fills most. False only if no bin at all offers one."""
    mine = sorted(bins.items[src])
    offers: dict[int, list[int]] = {}   # tokens to give: the sizes that make them up
    for k, a in enumerate(mine):
        for c in mine[k if len(bins.items[src][a]) > 1 else k + 1:]:
            offers[a + c] = [a, c]
    offers |= {a: [a] for a in mine}
    below = _below(sum(1 << s for s in offers), bins.limit)
    own = bins.limit - fill
    bins._leave(src)
    try:
        m = bins.mask & ~1
        while m:
            free = (m & -m).bit_length() - 1
            m &= m - 1
            # the other bin gains between ``least + 1`` and ``free`` tokens
            least = max(0, free - own)
            width = free - least
            if not width:
                continue
            k = width.bit_length() - 1
            hits = (below[k] | below[k] >> (width - (1 << k))) >> least & bins.sizes[free]
            if hits:
                give, other = _most(sorted(offers), hits, free)
                dst = next(iter(bins.holders[free][other]))
                break
        else:
            return False
    finally:
        bins._enter(src)
    back = bins.change(dst, [other])
    bins.change(dst, new=bins.change(src, offers[give], back))
    return True


def _most(offers: list[int], hits: int, free: int) -> tuple[int, int]:
    """The offer and the item given back for it that fill a bin most."""
    best = (0, 0, 0)
    while hits:
        other = hits.bit_length() - 1
        hits ^= 1 << other
        s = offers[bisect.bisect_right(offers, other + free) - 1]
        best = max(best, (s - other, s, other))
    return best[1:]


def _pack_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["length", "doc_id", "piece"], kind="stable").reset_index(drop=True)
    place = pack(pdf["length"].tolist())
    pdf["sequence_id"] = [int(pdf["grp"].iat[0]) << 32 | b for b, _ in place]
    pdf["offset"] = [o for _, o in place]
    return pdf.drop(columns="grp")


def pack_documents(docs: DataFrame, group_items: int = GROUP_ITEMS) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Every document is packed.

    Pieces are dealt at random over groups of about ``group_items``, which are packed independently (each group adds at
    most about one underfull bin). An empty table gives an empty result."""
    pieces = stage(token_pieces(docs), "pieces")
    n = max(1, -(-pieces.count() // group_items))
    # dealt by a random number, so that equal rows do not meet in one group; groups only serve the search
    dealt = stage(pieces.withColumn("grp", F.floor(F.rand(7) * n).cast("long")), "dealt") if n > 1 else pieces.withColumn("grp", F.lit(0).cast("long"))
    return dealt.groupBy("grp").applyInPandas(_pack_group, PIECES + ", sequence_id long, offset long")
