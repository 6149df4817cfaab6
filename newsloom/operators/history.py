"""Past articles that share entities."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import views

SUBSETS = 6
KINDS = ("countries", "companies", "commodities", "geopolitical_entities")


def entities(*columns: str) -> Column:
    """The sorted union of entity arrays, blanks left out."""
    every = F.flatten(F.array(*(F.coalesce(F.col(c), F.array().cast("array<string>")) for c in columns)))
    return F.array_sort(F.array_distinct(F.filter(every, lambda x: x.isNotNull() & (x != ""))))


def matches(current: DataFrame, past: DataFrame, top: int = 20, lookback_days: int = 730) -> DataFrame:
    """current (cur, t, e), past (old, t, e), e sorted entity sets and t timestamps, to (cur, old, relevance, rank):
    the `top` most relevant past rows up to lookback_days older. relevance = 0.7 Jaccard + 0.3 recency.

    Sets of up to SUBSETS entities meet in the lists of their common subsets, larger ones by a join of the sets.
    """
    few = lambda d: d.where(F.size("e").between(1, SUBSETS))
    many = lambda d: d.where(F.size("e") > SUBSETS)
    rows = by_subsets(few(current), few(past), top, lookback_days).unionByName(by_sets(many(current), past)).unionByName(by_sets(few(current), many(past)))
    days = (F.unix_seconds("tc") - F.unix_seconds("tp")) / 86400.0
    rows = rows.where(F.col("cur") != F.col("old")).withColumn("days", days).where((F.col("days") > 0) & (F.col("days") <= lookback_days))
    score = F.round(F.least(F.lit(1.0), 0.7 * F.col("overlap") + 0.3 * F.greatest(F.lit(0.0), 1 - F.col("days") / lookback_days)), 4)
    w = Window.partitionBy("cur").orderBy(F.col("relevance").desc(), "old")
    return rows.select("cur", "old", score.alias("relevance")).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def by_sets(current: DataFrame, past: DataFrame) -> DataFrame:
    """All pairs (cur, old, tc, tp, overlap) that share an entity. Equal sets are joined once, by their entities."""
    sets = lambda d, n: d.where(F.size("e") > 0).select(F.col("e").alias(n)).distinct()
    a, b = sets(current, "ea"), sets(past, "eb")
    pairs = a.select("ea", F.explode("ea").alias("x")).join(b.select("eb", F.explode("eb").alias("x")), "x").select("ea", "eb").distinct()
    pairs = pairs.withColumn("overlap", F.size(F.array_intersect("ea", "eb")) / F.size(F.array_union("ea", "eb")))
    rows = current.select("cur", F.col("t").alias("tc"), F.col("e").alias("ea")).join(pairs, "ea")
    return rows.join(past.select("old", F.col("t").alias("tp"), F.col("e").alias("eb")), "eb").select("cur", "old", "tc", "tp", "overlap")


def by_subsets(current: DataFrame, past: DataFrame, top: int, lookback_days: int) -> DataFrame:
    """Pairs (cur, old, tc, tp, overlap) with each current row's `top` most relevant past rows among them.

    A past row of n entities is in the list (s, n) of each subset s of its entities. With |s| entities in common
    its relevance falls with its age alone, and rows of a list that have more in common are only better: the `top` of a
    list by age hold every row of the result that has just s in common. Lists stream in order of time; no hot entity
    is joined with itself.
    """
    def subsets(e: Column) -> Column:
        grown = lambda acc, x: F.concat(acc, F.transform(acc, lambda s: F.concat(s, F.array(x))))
        return F.filter(F.aggregate(e, F.array(F.array().cast("array<string>")), grown), lambda s: F.size(s) > 0)

    def listed(d: DataFrame, seq: str, is_past: bool) -> DataFrame:
        n = F.size("e") if is_past else F.explode(F.sequence(F.lit(1), F.lit(SUBSETS)))
        x = d.select(F.col(seq).cast("bigint").alias("q"), F.unix_seconds("t").alias("t"), "e", n.alias("n"), F.lit(is_past).alias("past"))
        x = x.select("*", F.explode(subsets(F.col("e"))).alias("s")).where(F.size("s") <= F.col("n"))
        return x.select(F.to_json("s").alias("s"), F.size("s").alias("k"), "n", "t", "past", "q", "e")

    span = lookback_days * 86400
    step = span * 1e-4 / 0.3 * 1.01 + 1  # seconds that change a rounded relevance for sure

    def near(batches):
        held = None  # the last list and its past rows that may still be needed: times, numbers, sets
        for b in batches:
            s, k, n, t, p, q, e = (b.column(i) for i in range(7))
            s, e = s.to_pylist(), e.to_pylist()
            k, n, t, p, q = (x.to_numpy(zero_copy_only=False) for x in (k, n, t, p, q))
            out: list[tuple] = []
            lo = 0
            while lo < len(s):
                hi = lo + 1
                while hi < len(s) and s[hi] == s[lo] and n[hi] == n[lo]:
                    hi += 1
                at = np.flatnonzero(p[lo:hi]) + lo
                tp, old, sets = t[at], q[at], [frozenset(e[i]) for i in at]
                if held and held[0] == (s[lo], n[lo]):
                    tp, old, sets = np.concatenate((held[1], tp)), np.concatenate((held[2], old)), held[3] + sets
                for i in np.flatnonzero(~p[lo:hi]) + lo:
                    end = int(np.searchsorted(tp, t[i], "left"))
                    first = int(np.searchsorted(tp, t[i] - span, "left"))
                    if end - first > top + 1:  # one more, since the row itself doesn't count
                        first = max(first, int(np.searchsorted(tp, tp[end - top - 1] - step, "left")))
                    if first >= end:
                        continue
                    mine = frozenset(e[i])
                    overlap = k[i] / (len(mine) + n[i] - k[i])
                    score = (0.7 * overlap + 0.3 * (1 - (t[i] - tp[first:end]) / span)) * 1e4 + 0.5
                    low, high = np.floor(score - 1e-6), np.floor(score + 1e-6)
                    order = np.lexsort((old[first:end], -low))
                    best = set(order[: top + 1].tolist())
                    if len(order) > top + 1:  # on the edge of rounding: left to the final ranking
                        best.update(np.flatnonzero((low != high) & (high >= low[order[top]])).tolist())
                    out += [(q[i], old[first + j], t[i], tp[first + j], overlap) for j in best if len(mine & sets[first + j]) == k[i]]
                keep = int(np.searchsorted(tp, tp[-top - 1] - step, "left")) if len(tp) > top + 1 else 0
                held = (s[lo], n[lo]), tp[keep:], old[keep:], sets[keep:]
                lo = hi
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, [pa.int64()] * 4 + [pa.float64()])], ["cur", "old", "tc", "tp", "overlap"])

    rows = listed(past, "old", True).unionByName(listed(current, "cur", False))
    rows = rows.repartition("s", "n").sortWithinPartitions("s", "n", "t", "past")  # a row of the same second isn't past
    found = rows.mapInArrow(near, "cur long, old long, tc long, tp long, overlap double")
    return found.select(F.col("cur").cast(current.schema["cur"].dataType), F.col("old").cast(past.schema["old"].dataType), F.timestamp_seconds("tc").alias("tc"), F.timestamp_seconds("tp").alias("tp"), "overlap")


def context(found: DataFrame, articles: DataFrame, seq: str) -> DataFrame:
    """What may be shown of matches (cur, old, relevance, rank): (cur, rank) and the nine columns of the past article, with
    the entities both have."""
    pairs = found.select(F.col("cur").alias("_cur"), F.col("old").alias("_old"), F.col("relevance").alias("_relevance"), F.col("rank").alias("_rank"))
    mine = articles.select(F.col(seq).alias("_cur"), entities(*KINDS).alias("_mine"))
    x = pairs.join(mine, "_cur").join(articles.withColumn("_theirs", entities(*KINDS)), F.col("_old") == F.col(seq))
    return x.select(F.col("_cur").alias("cur"), F.col("_rank").alias("rank"), *views.context_view(F.array_sort(F.array_intersect("_mine", "_theirs")), F.col("_relevance")))
