"""Token counts. Huge texts are encoded as overlapping chunks and spliced at boundaries that no vocabulary piece can cross."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratum.llm.common import id_text, small_pieces, stage

#: Texts of more characters than this are encoded as chunks of this many characters.
CHUNK_CHARS = 50_000
#: First overlap searched for a splice; doubled until one is found.
OVERLAP_CHARS = 64
#: Characters of context in front of a chunk's splice, so that a chunk's artificial start never touches it.
LEAD_CHARS = 16
SPACE = "▁"   # how the vocabulary writes a space


class PieceCounter:
    """Counts and splices over one sentencepiece model. ``exact_offsets`` is False for a model whose normaliser changes
    texts or whose white space handling is not the plain one; then every text is encoded whole."""

    def __init__(self, model: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = self.sp.get_piece_size()
        pieces = [self.sp.id_to_piece(i) for i in range(n)]
        special = [self.sp.is_byte(i) or self.sp.is_control(i) or self.sp.is_unknown(i) for i in range(n)]
        # bytes of a text that each id stands for; an unknown id has no fixed length
        self.width = np.array([1 if self.sp.is_byte(i) else len(p.replace(SPACE, " ").encode()) for i, p in enumerate(pieces)])
        self.unknown = [i for i in range(n) if self.sp.is_unknown(i)]
        #: every two characters that stand next to each other inside some piece
        self.pairs = {p[i:i + 2] for p, s in zip(pieces, special) if not s for i in range(len(p) - 1)}
        probe = " a  b\téﬁ　 x\n "
        self.exact_offsets = self.sp.decode(self.sp.encode(probe)) == probe and self.sp.encode("a", out_type=str)[0].startswith(SPACE)

    def stable(self, text: str, i: int) -> bool:
        """No piece has text[i-1] and text[i] next to each other, so no encoding joins them and both sides are independent."""
        return text[i - 1:i + 1].replace(" ", SPACE) not in self.pairs

    def splice(self, text: str, at: int, overlap: int) -> int | None:
        """The first stable boundary at or after ``at``, searched in an overlap that doubles until one is found."""
        lo = max(1, at)
        while lo < len(text):
            hi = min(len(text), lo + overlap)
            for i in range(lo, hi):
                if self.stable(text, i):
                    return i
            lo, overlap = hi, 2 * overlap
        return None

    def chunks(self, text: str, chunk: int, overlap: int) -> Iterator[tuple[str, int, int]]:
        """(chunk text with its overlaps, first byte to count, byte to count up to); counted ranges tile the text."""
        text = text.replace(SPACE, " ")   # both are one symbol to the model
        head, n = 0, len(text)
        while head < n or head == 0:
            tail = self.splice(text, head + chunk, overlap) if head + chunk < n else None
            tail = n if tail is None else tail
            lo, hi = max(0, head - LEAD_CHARS), min(n, tail + overlap)
            skip = len(text[lo:head].encode())
            yield text[lo:hi], skip, skip + len(text[head:tail].encode())
            head = tail
            if head >= n:
                return

    def between(self, part: str, lo: int, hi: int) -> int:
        """Tokens of ``part``'s encoding that lie in bytes [lo, hi); both must be token boundaries of it."""
        ids = np.asarray(self.sp.encode(part), np.int64)
        if np.isin(ids, self.unknown).any():
            raise ValueError("an unknown token has no byte length")
        ends = np.cumsum(self.width[ids]) - 1   # the artificial leading space is no byte of the text
        a = 0 if lo == 0 else int(np.searchsorted(ends, lo)) + 1
        b = int(np.searchsorted(ends, hi)) + 1
        if (lo and (a > len(ends) or ends[a - 1] != lo)) or b > len(ends) or ends[b - 1] != hi:
            raise ValueError("chunk encodings do not meet at the splice")
        return b - a


def _model() -> PieceCounter:
    import public_tokenizers as P
    return PieceCounter(P.path("piece_bpe_32k.model"))


OUT = "row long, doc_id long, n_bytes long, n_tokens long, part string, lo long, hi long"


def _encode(batches, make, chunk, overlap) -> Iterator[pa.RecordBatch]:
    m = make()
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = ["row", "doc_id", "n_bytes", "n_tokens", "part", "lo", "hi"]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
    for b in small_pieces(batches, 2):
        keys, ids, texts = (b.column(i).to_pylist() for i in range(3))
        short = [i for i, t in enumerate(texts) if len(t) <= chunk or not m.exact_offsets]
        counts = dict(zip(short, map(len, m.sp.encode([texts[i] for i in short], num_threads=1))))
        rows = [(keys[i], ids[i], len(texts[i].encode()), n, None, None, None) for i, n in counts.items()]
        if rows:
            yield batch(rows)
        for i, t in enumerate(texts):
            if i not in counts:
                for k, (part, lo, hi) in enumerate(m.chunks(t, chunk, overlap)):
                    yield batch([(keys[i], ids[i], len(t.encode()) if k == 0 else 0, None, part, lo, hi)])


def _encode_chunks(batches, make) -> Iterator[pa.RecordBatch]:
    m = make()
    for b in small_pieces(batches, 3):
        n = [m.between(*x) for x in zip(*(b.column(i).to_pylist() for i in (3, 4, 5)))]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(n, pa.int64())],
                                         names=["row", "doc_id", "n_bytes", "n_tokens"])


def count_tokens(docs: DataFrame, limit: int = 4096, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS,
                 make=_model) -> DataFrame:
    """Per row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    Texts up to ``chunk_chars`` characters are encoded whole. Longer ones become overlapping chunks, dealt evenly over
    the tasks; each chunk is counted between its two splices, which both neighbours' encodings must have as token
    boundaries. A text without any stable boundary stays one chunk. Null text is empty (0 bytes, 0 tokens); repeated
    rows and null ids give one row each; an empty table an empty result; other columns are ignored."""
    conf = docs.sparkSession.conf
    tasks = int(conf.get("spark.sql.shuffle.partitions"))
    base = id_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    first = stage(base.mapInArrow(lambda it: _encode(it, make, chunk_chars, overlap_chars), OUT), "token_counts")
    whole = first.where("part IS NULL").select("doc_id", "n_bytes", "n_tokens")
    parts = first.where("part IS NOT NULL").select("row", "doc_id", "n_bytes", "part", "lo", "hi").repartition(tasks)
    counted = parts.mapInArrow(lambda it: _encode_chunks(it, make), "row long, doc_id long, n_bytes long, n_tokens long")
    spliced = counted.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.sum("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens"))
    return whole.unionByName(spliced.select("doc_id", "n_bytes", "n_tokens")).withColumn("over_limit", F.col("n_tokens") > limit)
