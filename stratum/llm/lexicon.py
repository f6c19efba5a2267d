"""A minimal acyclic transducer from words to id sequences: sorted construction, one flat file, vectorised lookup.

Words are byte strings. Reading one takes an arc per byte; the outputs met on the way and at the final state, strung
together, are its ids. States with equal arcs, outputs and final outputs are one state, so words share their ends as well
as their beginnings; outputs stand as early on a path as they can, which is what lets ends be shared."""
from __future__ import annotations

from collections.abc import Iterable

import numpy as np

Ids = tuple[int, ...]
#: Sections of the file, with their types. By state: where its row of arcs begins, its final output (length -1: not
#: final). By slot, at row + byte: the state an arc belongs to (-1: none), its target and output. Last the pool of ids.
SECTIONS = [("row", "<i4"), ("end_at", "<i4"), ("end_len", "<i4"), ("owner", "<i4"), ("target", "<i4"), ("out_at", "<i4"), ("out_len", "<i4"), ("pool", "<u4")]


class _State:
    __slots__ = ("arcs", "final", "end")

    def __init__(self):
        self.arcs: list[list] = []   # [byte, target, output], bytes rising
        self.final, self.end = False, ()


def _shared(a: Ids, b: Ids) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


class Builder:
    """Takes (word, ids) in rising order of the words and keeps one open path; what leaves it is shared or new."""

    def __init__(self):
        self.path, self.word = [_State()], b""
        self.register: dict[tuple, int] = {}
        self.states: list[tuple] = []

    def add(self, word: bytes, ids: Ids):
        if word <= self.word:
            raise ValueError("words must rise and not be empty")
        shared = 0
        for x, y in zip(word, self.word):
            if x != y:
                break
            shared += 1
        self._close(shared)
        for byte in word[shared:]:
            self.path[-1].arcs.append([byte, -1, ()])
            self.path.append(_State())
        self.path[-1].final = True
        for at in range(shared):   # outputs on the shared path shrink to what both words have; the rest moves on
            arc = self.path[at].arcs[-1]
            n = _shared(arc[2], ids)
            rest, arc[2], ids = arc[2][n:], arc[2][:n], ids[n:]
            if rest:
                after = self.path[at + 1]
                for a in after.arcs:
                    a[2] = rest + a[2]
                if after.final:
                    after.end = rest + after.end
        self.path[shared].arcs[-1][2] = ids
        self.word = word

    def _close(self, keep: int):
        """States of the open path beyond ``keep`` bytes are done: each becomes an equal earlier state, or a new one."""
        while len(self.path) > keep + 1:
            done = self.path.pop()
            self.path[-1].arcs[-1][1] = self._number(done)

    def _number(self, s: _State) -> int:
        key = (s.final, s.end, tuple(map(tuple, s.arcs)))
        n = self.register.get(key)
        if n is None:
            n = self.register[key] = len(self.states)
            self.states.append(key)
        return n

    def file(self) -> bytes:
        """The transducer as bytes: the lengths of the sections, then the sections, each on an 8-byte boundary."""
        self._close(0)
        root = self._number(self.path[0])
        pool: list[int] = []
        places: dict[Ids, int] = {}

        def place(ids: Ids) -> int:
            if ids not in places:
                places[ids] = len(pool)
                pool.extend(ids)
            return places[ids]
        # the root becomes state 0
        number = [n + 1 if n < root else 0 if n == root else n for n in range(len(self.states))]
        rows, slots = _interleave({number[n]: [a[0] for a in arcs] for n, (_, _, arcs) in enumerate(self.states)})
        by_slot = [(-1, 0, 0, 0)] * slots
        ends = [(0, -1)] * len(self.states)
        for n, (final, end, arcs) in enumerate(self.states):
            for byte, target, ids in arcs:
                by_slot[rows[number[n]] + byte] = (number[n], number[target], place(ids), len(ids))
            if final:
                ends[number[n]] = (place(end), len(end))
        columns = [rows, *zip(*ends), *zip(*by_slot), pool]
        out = [np.array([len(c) for c in columns], "<u8").tobytes()]
        for (_, kind), c in zip(SECTIONS, columns):
            b = np.array(list(c), kind).tobytes()
            out.append(b + bytes(-len(b) % 8))
        return b"".join(out)


def _interleave(bytes_of: dict[int, list[int]]) -> tuple[list[int], int]:
    """Where each state's row of 256 slots begins, so that no two states' arcs share a slot, and the number of slots.
    Rows lie inside one another: the fullest are placed first, each where it fits next, and the many with one arc fill
    the gaps that are left."""
    rows, used, at = [0] * len(bytes_of), bytearray(1024), 256
    for state in sorted(bytes_of, key=lambda s: (-len(bytes_of[s]), s)):
        some = bytes_of[state]
        if not some:
            break
        if len(some) == 1 and at:
            at = 0   # from here on the first free slot will do
        slot, tries = max(at, some[0]), 0
        while True:
            if slot + 512 > len(used):
                used.extend(bytes(len(used)))
            slot = used.find(0, slot)
            if slot < 0 or slot + 256 > len(used):
                slot = len(used)
                used.extend(bytes(len(used)))
            first = slot - some[0]
            if not any(used[first + b] for b in some):
                break
            slot += 1
            tries += 1
            if tries > 32 and len(some) > 1:
                at = slot   # gaps before are too narrow for rows like this
        rows[state] = first
        for b in some:
            used[first + b] = 1
    return rows, max(rows) + 256


def compile_words(words: Iterable[tuple[bytes, Ids]]) -> bytes:
    b = Builder()
    for word, ids in sorted(words):
        b.add(word, ids)
    return b.file()


class Lexicon:
    """A compiled transducer, mapped from its file: pages are read as they are needed and shared by a machine's workers."""

    def __init__(self, path: str):
        sizes = np.fromfile(path, "<u8", len(SECTIONS))
        at = 8 * len(SECTIONS)
        for (name, kind), n in zip(SECTIONS, map(int, sizes)):
            whole = np.memmap(path, kind, "r", at, (n,)) if n else np.empty(0, kind)
            setattr(self, name, whole.view(np.ndarray))
            at += -(-n * np.dtype(kind).itemsize // 8) * 8

    def look_up(self, text: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Which of the words (places and lengths in the bytes ``text``) there are, and the outputs met on their ways: word,
        place in the pool, length, a word's outputs in order. All words take their next arc together."""
        n = len(begin)
        state, found = np.zeros(n, np.int32), length > 0
        live, step = np.flatnonzero(found), 0
        emitted = []
        while len(live):
            now = state[live]
            slot = self.row[now] + text[begin[live] + step]
            hit = self.owner[slot] == now
            found[live[~hit]] = False
            live, slot = live[hit], slot[hit]
            state[live] = self.target[slot]
            out = self.out_len[slot]
            some = np.flatnonzero(out)
            emitted.append((live[some], self.out_at[slot[some]], out[some]))
            step += 1
            live = live[length[live] > step]
        ended = np.flatnonzero(found)
        size = self.end_len[state[ended]]
        found[ended[size < 0]] = False   # a beginning of words, but none itself
        some = size > 0
        emitted.append((ended[some], self.end_at[state[ended[some]]], size[some]))
        word, at, size = (np.concatenate(c).astype(np.int64) for c in zip(*emitted))
        there = found[word]
        return found, word[there], at[there], size[there]
