"""One form for texts that look the same."""

from __future__ import annotations

import base64
import hashlib
import re
import sys
import types
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .tokens import VOCABULARY, read_ranks

# Letters and signs of other scripts with the Latin ones they look like.
ALIKE = {
    "ΑВΒЕΕΖНΗΙІΚКΜМΝОΟРΡЅТΤΥХΧАЈСҮԌԚԜ": "ABBEEZHHIIKKMMNOOPPSTTYXXAJCYGQW",
    "аеорсухіјѕһԁԛԝοϲϳ": "aeopcyxijshdqwocj",
    "‐‑": "--",
}
# Letters that most typefaces draw nearly like the Latin letter at the same place.
RESEMBLING_LETTERS = ("αβγικνορστυωχабвгкмнтиɡɩıℓɑʋոօսհցᴏᴄᴠᴡᴢ", "aByikvopotuwxabBrkmntugiilavnouhgocvwz")
RESEMBLE = 0.25
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st"}
INVISIBLE = [0xAD, 0x34F, 0x61C, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2070), *range(0xFE00, 0xFE10), 0xFEFF]


def look_table() -> dict[int, str | None]:
    """What each decomposed character looks like: widths and blanks from the character database, the rest as above."""
    out: dict[int, str | None] = {}
    for i in range(0xFF00, 0xFFF0):
        if unicodedata.decomposition(chr(i)).startswith(("<wide>", "<narrow>")):
            out[i] = unicodedata.normalize("NFKD", chr(i))
    out |= {i: " " for i in range(0x80, 0x3001) if unicodedata.category(chr(i)) == "Zs"}
    for a, b in ALIKE.items():
        out |= {ord(x): y for x, y in zip(a, b, strict=True)}
    return out | {ord(k): v for k, v in LIGATURES.items()} | dict.fromkeys(INVISIBLE)


TABLE = look_table()


def resembling() -> dict[str, tuple[str, ...]]:
    """The doubtful letters with the plain ones they resemble: those above, and by the character database the letters
    that are others in a style or one sign for several (compatibility forms)."""
    out = {x: (y,) for x, y in zip(*RESEMBLING_LETTERS, strict=True) if ord(x) not in TABLE}
    for i in [*range(0x2100, 0x2150), *range(0x1D400, 0x1D7CC), 0x132, 0x133, *range(0x1C7, 0x1CD), *range(0x1F1, 0x1F4)]:
        kind, plain = unicodedata.decomposition(chr(i)), unicodedata.normalize("NFKD", chr(i))
        if kind.startswith(("<font>", "<compat>")) and plain.isalpha() and i not in TABLE:
            out[chr(i)] = (plain,)
    return out


RESEMBLING = resembling()
DOUBTFUL, PLAIN = frozenset(RESEMBLING), re.compile("[A-Za-z]")


def normal(text: str) -> str:
    """By table alone."""
    return unicodedata.normalize("NFC", unicodedata.normalize("NFD", text).translate(TABLE))


class Trie:
    """Words in their plain spelling, read by a weighted edit automaton.

    Its states are places in the trie, each with the least cost of reaching it. A character may go on as itself, as
    what it looks like beyond doubt (or as nothing, if it is invisible), both at no cost, or as a letter that it resembles
    in most typefaces (RESEMBLING), at RESEMBLE. Every other edit is visible and is none.
    """

    def __init__(self, words):
        self.root: dict = {}
        for w in words:
            node = self.root
            for c in unicodedata.normalize("NFD", w):
                node = node.setdefault(c, {})
            node.setdefault("", w)

    def spell(self, token: str, most: float = 0.0) -> tuple[str, float] | None:
        """The word that the token reaches at the least cost, `most` at most, and that cost; of words at one cost the
        smallest."""
        states: dict[int, tuple[float, dict]] = {0: (0.0, self.root)}
        for c in unicodedata.normalize("NFD", token):
            sure = TABLE.get(ord(c), c)
            ways = [("" if sure is None else sure, 0.0)]
            if sure == c:
                ways += [(x, RESEMBLE) for x in RESEMBLING.get(c, ())]
            after: dict[int, tuple[float, dict]] = {}
            for cost, node in states.values():
                for way, more in ways:
                    at: dict | None = node
                    for y in way:
                        at = at.get(y) if at else None
                    if at is not None and cost + more <= most and (id(at) not in after or cost + more < after[id(at)][0]):
                        after[id(at)] = (cost + more, at)
            if not after:
                return None
            states = after
        ends = [(cost, w) for cost, at in states.values() if (w := at.get("")) is not None]
        return min(ends)[::-1] if ends else None


BLANKS = re.compile(r"[^\x00-\x20]+")
LETTERS = re.compile(f"(?:[^\\W\\d_]|[\u0300-\u036f{re.escape(''.join(map(chr, INVISIBLE)))}])+")


class Speller:
    """Texts in their one form: each run of letters is spelled as the word that it reaches, by the table if none.

    A resemblance counts only in a run that has a plain Latin letter as well and half of whose letters at most are
    doubtful, and only if the vocabulary has the word: a run of one script that is no such word stays as it is.
    """

    def __init__(self, content: bytes):
        words = (base64.b64decode(x.split()[0]).decode("utf-8", "ignore").strip() for x in content.splitlines() if x)
        self.trie = Trie(w for w in words if len(w) > 1 and w.isalpha() and normal(w) == w)
        self.known: dict[str, tuple[str, int, int]] = {}
        self.by_word = self.changed = 0

    def read(self, t: str) -> tuple[str, int, int]:
        """The run's spelling, whether it is a word's, and whether the table alone would give another."""
        doubtful = 0 if DOUBTFUL.isdisjoint(t) else sum(c in DOUBTFUL for c in t)
        some = doubtful and 2 * doubtful <= len(t) and len(t) > 2 and PLAIN.search(t)
        word = self.trie.spell(t, RESEMBLE * doubtful if some else 0.0)
        table = normal(t)
        return (table, 0, 0) if word is None else (word[0], 1, int(word[0] != table))

    def token(self, m: re.Match) -> str:
        t = m[0]
        if t.isascii():
            return t
        if (x := self.known.get(t)) is None:
            words = changed = 0
            parts, at = [], 0
            for run in LETTERS.finditer(t):
                if not run[0].isascii():
                    spelled, by_word, differs = self.read(run[0])
                    words, changed = words + by_word, changed + differs
                    parts += [t[at : run.start()], spelled]
                    at = run.end()
            x = (normal("".join(parts) + t[at:]), words, changed)
            if len(t) < 80:
                if len(self.known) > 100_000:
                    self.known.clear()
                self.known[t] = x
        self.by_word += x[1]
        self.changed += x[2]
        return x[0]

    def text(self, text: str) -> str:
        """The text in its one form; marks that begin a run join what stands before."""
        if text.isascii():
            return text
        return unicodedata.normalize("NFC", BLANKS.sub(self.token, text))


def speller(content: bytes) -> Speller:
    kept = sys.modules.setdefault("_newsloom_kept", types.ModuleType("_newsloom_kept")).__dict__
    key = f"speller {hash(content)}"
    if key not in kept:
        kept[key] = Speller(content)
    return kept[key]


def canonical(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text): every text in its one form; null stays null, empty stays empty."""
    content = read_ranks(vocabulary)

    def run(batches):
        s = speller(content)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([t and s.text(t) for t in b.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return documents.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id long, text string")


def look_keys(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, k, v) of every text that isn't null or empty: 128-bit keys of its one form and of its own characters."""
    content = read_ranks(vocabulary)
    key = lambda t: hashlib.blake2b(t.encode("utf-8", "surrogatepass"), digest_size=16).digest()

    def run(batches):
        s = speller(content)
        for b in batches:
            ids, ks, vs = [], [], []
            for i, t in zip(b.column(0).to_pylist(), (x.as_py() for x in b.column(1))):
                ids.append(i)
                vs.append(key(t))
                c = s.text(t)
                ks.append(vs[-1] if c == t else key(c))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(ks, pa.binary()), pa.array(vs, pa.binary())], ["doc_id", "k", "v"])

    return documents.where(F.length("text") > 0).select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id long, k binary, v binary")


def same_look(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_a, doc_b), doc_a the smaller: documents whose texts differ in code points but look the same.

    Spellings are paired, not documents: copies of one spelling, however many, are never compared with each other.
    """
    keys = cut(look_keys(documents, vocabulary), "looks")
    spellings = keys.groupBy("k", "v").agg(F.count("*").alias("n"))
    mixed = spellings.groupBy("k").agg(F.count("*").alias("spellings")).where("spellings > 1").select("k")
    rows = cut(keys.join(mixed, "k", "left_semi"), "mixed")
    each = rows.select("k", "v").distinct()
    pairs = each.withColumnRenamed("v", "va").join(each.withColumnRenamed("v", "vb"), "k").where("va < vb")
    out = pairs.join(rows.select("k", F.col("v").alias("va"), F.col("doc_id").alias("x")), ["k", "va"]).join(rows.select("k", F.col("v").alias("vb"), F.col("doc_id").alias("y")), ["k", "vb"])
    return out.select(F.least("x", "y").alias("doc_a"), F.greatest("x", "y").alias("doc_b"))


def look_readings(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, by_word, decided): of each text that isn't null or empty, how many runs of letters the vocabulary
    spelled, and for how many of these the table alone would have given another spelling."""
    content = read_ranks(vocabulary)

    def run(batches):
        s = speller(content)
        for b in batches:
            words, decided = [], []
            for t in b.column(1).to_pylist():
                s.by_word = s.changed = 0
                s.text(t)
                words.append(s.by_word)
                decided.append(s.changed)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.int64()), pa.array(decided, pa.int64())], ["doc_id", "by_word", "decided"])

    return documents.where(F.length("text") > 0).select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id long, by_word long, decided long")


def look_groups(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, same_as, spellings): of each document that looks like one of other characters the group's smallest id
    and number of spellings."""
    keys = cut(look_keys(documents, vocabulary), "looks")
    spellings = keys.groupBy("k", "v").agg(F.min("doc_id").alias("first"))
    group = spellings.groupBy("k").agg(F.min("first").alias("same_as"), F.count("*").alias("spellings")).where("spellings > 1")
    return keys.join(group, "k").select("doc_id", "same_as", "spellings")
