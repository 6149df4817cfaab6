"""Token ids of a public byte-level BPE tokenizer."""

from __future__ import annotations

import base64
import sys
import types
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
REMEMBERED = 200_000


class RankQueue:
    """Ranks that have positions waiting, in three levels of 64-bit words: finding the lowest takes three find-first-sets."""

    def __init__(self, ranks: int):
        self.low = [0] * (-(-ranks // 64))
        self.mid = [0] * (-(-len(self.low) // 64))
        self.top = 0
        self.bucket: dict[int, list[int]] = {}

    def push(self, rank: int, position: int) -> None:
        if (b := self.bucket.get(rank)) is not None:
            b.append(position)
            return
        self.bucket[rank] = [position]
        w, v = rank >> 6, rank >> 12
        self.low[w] |= 1 << (rank & 63)
        self.mid[v] |= 1 << (w & 63)
        self.top |= 1 << v

    def pop(self) -> tuple[int, list[int]]:
        """The lowest rank and its positions from left to right."""
        v = (self.top & -self.top).bit_length() - 1
        w = (v << 6) + (self.mid[v] & -self.mid[v]).bit_length() - 1
        rank = (w << 6) + (self.low[w] & -self.low[w]).bit_length() - 1
        self.low[w] &= self.low[w] - 1
        if not self.low[w]:
            self.mid[v] &= self.mid[v] - 1
            if not self.mid[v]:
                self.top &= self.top - 1
        b = self.bucket.pop(rank)
        if len(b) > 1:
            b.sort()
        return rank, b


class Known(dict):
    """Ids, as bytes of 32-bit integers, of strings met before: made when missing and kept if short, up to REMEMBERED."""

    def __init__(self, make, longest: int):
        super().__init__()
        self.make, self.longest = make, longest

    def __missing__(self, s: str) -> bytes:
        ids = self.make(s)
        if len(s) <= self.longest:
            if len(self) >= REMEMBERED:
                self.clear()
            self[s] = ids
        return ids


class Seams(dict):
    """Whether a token can reach over the seam between two characters of three bytes each; other seams always can."""

    def __init__(self, ranks):
        super().__init__()
        self.over = {(t[max(0, o - 3) : o], t[o : o + 3]) for t in ranks if not t.isascii() for o in range(1, len(t))}

    def __missing__(self, pair: str) -> bool:
        a, b = (c.encode("utf-8", "replace") for c in pair)
        # a token begins within the first character or covers it, and ends within the second or covers it
        out = len(a) != 3 or len(b) != 3 or any((a[-i:], b[:j]) in self.over for i in (1, 2, 3) for j in (1, 2, 3))
        if len(self) < 4 * REMEMBERED:
            self[pair] = out
        return out


class Encoder:
    """Byte-level BPE over ranks (bytes to id).

    Texts are cut at single blanks between other characters, which always begin a pre-token, those pieces by the
    pattern into pre-tokens, and these at seams that no token of the vocabulary reaches over; the ids of each piece
    are remembered, so merges run on new ones only.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.split = ranks, regex.compile(PATTERN).findall
        self.odd, self.blank = regex.compile(r" \s|\s ").search, regex.compile(r"(?<=\S) (?=\S)").split
        self.queue, self.seams = RankQueue(max(ranks.values()) + 1), Seams(ranks)
        self.parts = Known(lambda s: array("i", self.merge(s.encode("utf-8", "replace"))).tobytes(), 64)
        self.words = Known(self.pieces, 24)
        self.blank_words = Known(lambda s: self.pieces(" " + s), 24)

    def pieces(self, text: str) -> bytes:
        return b"".join([self.parts[x] if len(x) < 4 or x.isascii() else b"".join(map(self.parts.__getitem__, self.segments(x))) for x in self.split(text)])

    def segments(self, x: str) -> list[str]:
        seams, out, at = self.seams, [], 0
        for i in range(1, len(x)):
            if not seams[x[i - 1 : i + 1]]:
                out.append(x[at:i])
                at = i
        out.append(x[at:])
        return out

    def merge(self, raw: bytes) -> list[int]:
        """Ids of one pre-token: the waiting pair of lowest rank, leftmost first, is merged until none is left."""
        ranks, queue = self.ranks, self.queue
        if (whole := ranks.get(raw)) is not None:
            return [whole]
        n = len(raw)
        piece: list = [raw[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        waits = [-1] * n  # the rank of the pair that begins at a position; what a bucket holds beside that is stale
        for i in range(n - 1):
            if (r := ranks.get(raw[i : i + 2])) is not None:
                waits[i] = r
                queue.push(r, i)
        while queue.top:
            rank, places = queue.pop()
            for i in places:
                if waits[i] != rank:
                    continue
                j = after[i]
                k = after[j]
                piece[i], waits[j], after[i] = piece[i] + piece[j], -1, k
                waits[i] = -1
                if k < n:
                    before[k] = i
                    if (r := ranks.get(piece[i] + piece[k])) is not None:
                        waits[i] = r
                        queue.push(r, i)
                if (h := before[i]) >= 0:
                    if (r := ranks.get(piece[h] + piece[i])) is not None:
                        waits[h] = r
                        queue.push(r, h)
                    else:
                        waits[h] = -1
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i]])
            i = after[i]
        return out

    def encode(self, text: str) -> bytes:
        """The ids as bytes of 32-bit integers."""
        first, *rest = self.blank(text) if self.odd(text) else text.split(" ")
        return self.words[first] + b"".join(map(self.blank_words.__getitem__, rest))


def read_ranks(path: str = VOCABULARY) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encoder(content: bytes) -> Encoder:
    """The worker process's encoder for a rank file; it outlives a task."""
    kept = sys.modules.setdefault("_newsloom_kept", types.ModuleType("_newsloom_kept")).__dict__
    key = f"encoder {hash(content)}"
    if key not in kept:
        kept[key] = Encoder({base64.b64decode(a): int(b) for a, b in (x.split() for x in content.splitlines() if x)})
    return kept[key]


def token_ids(documents: DataFrame, vocabulary: str = VOCABULARY, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, ids): the ids of every text without special tokens, whose strings are ordinary text. Null and empty
    texts give an empty list; a key that occurs twice gives two rows; an empty table gives none."""
    content = read_ranks(vocabulary)

    def encode(batches):
        e = encoder(content)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                each = [e.encode(t) if t else b"" for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, each)], dtype=np.int64) // 4
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(each), np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    return documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(encode, "doc_id long, ids array<int>")


def token_counts(documents: DataFrame, vocabulary: str = VOCABULARY, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(doc_id, n_tokens), 0 for null and empty texts."""
    content = read_ranks(vocabulary)

    def count(batches):
        e = encoder(content)
        for b in batches:
            n = [len(e.encode(t)) // 4 if t else 0 for t in (x.as_py() for x in b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32())], ["doc_id", "n_tokens"])

    return documents.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(count, "doc_id long, n_tokens int")
