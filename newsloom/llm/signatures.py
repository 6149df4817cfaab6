"""Sketches of texts and the regions of an LSH forest."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

SHINGLE = 5
FUNCTIONS = 64
DEPTH = 3
BOUND = 512
SUBTREES, STEP, LEVELS = 24, 3, 3
LEAST_MATCHES = 30  # of the pairs alike by just 0.60 that share a region, 0.02 % have less
ROW = "k long, id long, w0 long, w1 long, w2 long, n int"
SKETCH = ["w0", "w1", "w2"]
_U = np.uint64


def _constants(trees: int):
    rng = np.random.default_rng(20240501)
    mul = (rng.integers(0, 2**31, FUNCTIONS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
    xor = rng.integers(0, 2**32, FUNCTIONS, dtype=np.uint32)
    perm = np.array([rng.permutation(FUNCTIONS) for _ in range(trees)])
    return mul, xor, perm


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles_of(text: str) -> set[str]:
    """All different stretches of 5 characters."""
    return {text[i : i + SHINGLE] for i in range(len(text) - SHINGLE + 1)}


def minhashes(texts: list[str], mul: np.ndarray, xor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts of at least 5 characters: their places, numbers of stretches and minimum hash values."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    at = np.flatnonzero(lens >= SHINGLE)
    if not len(at):
        return at, lens[at], np.empty((0, FUNCTIONS), np.uint32)
    a = np.frombuffer("".join([texts[i] for i in at]).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = lens[at]
    ends = np.cumsum(n)
    h = a[: len(a) - SHINGLE + 1].copy()
    for k in range(1, SHINGLE):
        h = h * _U(0x9E3779B97F4A7C15) + a[k : len(a) - SHINGLE + 1 + k]
    keep = np.ones(len(h), bool)
    for k in range(1, SHINGLE):  # stretches over the end of a text
        keep[ends[:-1] - k] = False
    h = (_mix(h[keep]) >> _U(32)).astype(np.uint32)
    counts = n - SHINGLE + 1
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    sig = np.empty((len(at), FUNCTIONS), np.uint32)
    for k in range(FUNCTIONS):
        v = (h ^ xor[k]) * mul[k]
        v ^= v >> np.uint32(16)
        v *= np.uint32(0x85EBCA6B)
        sig[:, k] = np.minimum.reduceat(v, starts)
    return at, counts, sig


def forest(texts: DataFrame, trees: int) -> DataFrame:
    """texts (id, text) to the rows of the forest's trees: (k, id, w0, w1, w2, n).

    k is the tree with its first DEPTH values, each of w0, w1 and w2 one bit of all values, n the number of stretches.
    Texts under 5 characters are in no tree.
    """
    place = (np.uint64(1) << np.arange(FUNCTIONS, dtype=np.uint64)).astype(np.uint64)
    mul, xor, perm = _constants(trees)

    def rows(batches):
        for b in batches:
            ids, texts_ = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_pylist()
            for lo in range(0, len(texts_), 500):
                at, n, sig = minhashes(texts_[lo : lo + 500], mul, xor)
                if not len(at):
                    continue
                sym = (sig * np.uint32(0x9E3779B1)) >> np.uint32(29)
                planes = [np.where((sym >> np.uint32(b)) & np.uint32(1), place, _U(0)).sum(1, dtype=np.uint64) for b in range(3)]
                big = sig.astype(np.uint64)
                m = len(at)
                k = np.empty((trees, m), np.uint64)
                for t in range(trees):
                    x = np.full(m, t + 1, np.uint64)
                    for f in perm[t, :DEPTH]:
                        x = _mix(x * _U(0x9E3779B97F4A7C15) + big[:, f])
                    k[t] = x
                tiled = lambda x: pa.array(np.tile(x, trees))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k.ravel().view(np.int64)), tiled(ids[lo : lo + 500][at]), *(tiled(w.view(np.int64)) for w in planes), tiled(n.astype(np.int32))],
                    ["k", "id", *SKETCH, "n"],
                )

    return texts.select("id", "text").mapInArrow(rows, ROW)


def neighbours(rows: DataFrame, alike: float, fresh: bool = False, bound: int = BOUND, levels: int = LEVELS) -> DataFrame:
    """Candidates (a, b, m, ratio), a < b, m the matching values of the sketches, from the regions of all trees.

    A region is the rows of a tree that have their first DEPTH values in common: in sorted order, neighbours whose
    longest common prefix is that long. Every two rows of a region of up to `bound` rows are compared. A denser region
    becomes deeper: its rows are put into SUBTREES orders of STEP more values each, and again where that still
    isn't enough. What is dense after `levels` of that is compared whole, in pairs of blocks spread over tasks, so no
    region is cut short. fresh: only pairs whose later id is odd.
    """
    found, level = [], 0
    while True:
        out = cut(regions(rows, alike, fresh, bound), "regions")
        found.append(out.where("m is not null").select("a", "b", "m", "ratio"))
        dense = out.where("m is null").select("k", F.col("a").alias("id"), *SKETCH, "n")
        if dense.isEmpty():
            break
        if level == levels:
            found.append(regions(blocks(dense, bound), alike, fresh, None).select("a", "b", "m", "ratio"))
            break
        rows, level = deeper(dense, level), level + 1
    return reduce(DataFrame.unionByName, found).groupBy("a", "b").agg(F.max("m").alias("m"), F.max("ratio").alias("ratio"))


def regions(rows: DataFrame, alike: float, fresh: bool, bound: int | None) -> DataFrame:
    """One level: candidates (a, b, m, ratio) of the regions of up to `bound` rows, and the rows of denser ones as
    (k, a, w0, w1, w2, n) with m null. Tasks stream rows in order of k and keep one region of up to `bound` rows."""

    def near(batches):
        carry = None  # the last region, which may go on
        flood = None  # a dense region that may go on
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            if flood is not None:
                end = int(np.searchsorted(cols[0], flood, "right"))
                if end:
                    yield dense([c[:end] for c in cols])
                    cols = [c[end:] for c in cols]
                if not len(cols[0]):
                    continue
                flood = None
            cols = cols if carry is None else [np.concatenate(x) for x in zip(carry, cols)]
            last = int(np.searchsorted(cols[0], cols[0][-1], "left"))
            carry = [c[last:].copy() for c in cols]
            yield from compare([c[:last] for c in cols])
            if bound is not None and len(carry[0]) > bound:
                flood = carry[0][0]
                yield dense(carry)
                carry = None
        if carry is not None:
            yield from compare(carry)

    def compare(cols):
        k = cols[0]
        if not len(k):
            return
        begins = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        sizes = np.diff(np.concatenate((begins, [len(k)])))
        size = np.repeat(sizes, sizes)
        if bound is not None and (many := size > bound).any():
            yield dense([c[many] for c in cols])
        keep = size > 1 if bound is None else (size > 1) & (size <= bound)
        if not keep.any():
            return
        k, ids, *w, n = (c[keep] for c in cols)
        w = [x.view(np.uint64) for x in w]
        begins = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        start = np.repeat(begins, np.diff(np.concatenate((begins, [len(k)]))))
        live, v, held = np.arange(len(k)), 0, 0
        pairs: list[tuple[np.ndarray, ...]] = []
        while True:  # each row and the v-th of its region
            live = live[start[live] + v < live]
            if not len(live):
                break
            i, j = live, start[live] + v
            v += 1
            low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            some = low >= 0.5 * alike * high
            if fresh:
                some &= (np.maximum(ids[i], ids[j]) & 1) == 1
            i, j, ratio = i[some], j[some], (low[some] / high[some]).astype(np.float32)
            off = np.bitwise_count((w[0][i] ^ w[0][j]) | (w[1][i] ^ w[1][j]) | (w[2][i] ^ w[2][j])).astype(np.int32)
            ok = (FUNCTIONS - off >= LEAST_MATCHES) & (ids[i] != ids[j])
            if ok.any():
                x, y = ids[i[ok]], ids[j[ok]]
                pairs.append((np.minimum(x, y), np.maximum(x, y), (FUNCTIONS - off[ok]).astype(np.int32), ratio[ok]))
                held += len(x)
                if held > 50_000:
                    yield batch(pairs)
                    pairs, held = [], 0
        if pairs:
            yield batch(pairs)

    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.float32(), *[pa.int64()] * 4, pa.int32()]
    names = ["a", "b", "m", "ratio", "k", *SKETCH, "n"]

    def batch(pairs):
        x = [np.unique(np.rec.fromarrays([np.concatenate(c) for c in zip(*pairs)]))] if pairs else []
        cols = [pa.array(np.ascontiguousarray(x[0][f])) for f in x[0].dtype.names]
        return pa.RecordBatch.from_arrays(cols + [pa.nulls(len(cols[0]), t) for t in kinds[4:]], names)

    def dense(cols):
        k, ids, *rest = (pa.array(c) for c in cols)
        none = [pa.nulls(len(k), t) for t in kinds[1:4]]
        return pa.RecordBatch.from_arrays([ids, *none, k, *rest], names)

    spread = rows.select("k", "id", *SKETCH, "n").repartition("k").sortWithinPartitions("k")
    return spread.mapInArrow(near, "a long, b long, m int, ratio float, k long, w0 long, w1 long, w2 long, n int")


def deeper(dense: DataFrame, level: int) -> DataFrame:
    """Rows of dense regions in SUBTREES orders of their region, by STEP more values, three bits of each.

    A pair alike by 0.60 has such a value in common with 0.65, so it shares none of the deeper regions with
    (1 - 0.65 ** STEP) ** SUBTREES, 0.05 %."""
    places = np.random.default_rng(977 + level).permuted(np.tile(np.arange(FUNCTIONS), (SUBTREES, 1)), axis=1)[:, :STEP]

    def rows(batches):
        for b in batches:
            k, ids, *w, n = (b.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            u = [x.view(np.uint64) for x in w]
            sub = np.empty((SUBTREES, len(k)), np.uint64)
            for t in range(SUBTREES):
                x = _mix(k.view(np.uint64) * _U(0x9E3779B97F4A7C15) + _U(t + 1 + 1000 * (level + 1)))
                for f in places[t]:
                    symbol = sum((((p >> _U(f)) & _U(1)) << _U(b) for b, p in enumerate(u)), _U(0))
                    x = _mix(x * _U(0x9E3779B97F4A7C15) + symbol)
                sub[t] = x
            cols = [pa.array(sub.ravel().view(np.int64)), *(pa.array(np.tile(c, SUBTREES)) for c in (ids, *w, n))]
            yield pa.RecordBatch.from_arrays(cols, ["k", "id", *SKETCH, "n"])

    return dense.select("k", "id", *SKETCH, "n").mapInArrow(rows, ROW)


def blocks(dense: DataFrame, bound: int) -> DataFrame:
    """The rows of each region dealt into blocks of about `bound` rows, once for every pair of blocks: k then names the
    region and the pair, so all pairs of a region of any size are compared by many tasks."""
    n = dense.groupBy("k").agg(F.ceil(F.count("*") / bound).cast("int").alias("parts"))
    x = dense.join(n, "k").withColumn("mine", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    x = x.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return x.select(F.xxhash64("k", F.least("mine", "other"), F.greatest("mine", "other")).alias("k"), "id", *SKETCH, "n")


def checked(pairs: DataFrame, texts: DataFrame, alike: float) -> DataFrame:
    """The candidates (a, b) whose texts share at least that part of their different stretches of 5 characters."""
    a = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))

    def exact(batches):
        for x in batches:
            keep, seen = [], {}
            for p, q, s, t in zip(*(x.column(i).to_pylist() for i in range(4))):
                if len(seen) > 256:
                    seen.clear()
                u = seen.get(p) or seen.setdefault(p, shingles_of(s))
                v = seen.get(q) or seen.setdefault(q, shingles_of(t))
                both = len(u & v)
                keep.append(both > 0 and both / (len(u) + len(v) - both) >= alike)
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "ta", "tb")
    return joined.mapInArrow(exact, "a long, b long")
