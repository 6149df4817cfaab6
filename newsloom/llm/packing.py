"""Filling containers of fixed capacity."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .tokens import VOCABULARY, token_counts

CAPACITY = 2048
MAX_ITEMS = 48
COST_SHARE = 0.9
SHARD = 10_000


def best_fit(sizes: np.ndarray, capacity: int, max_items: int, max_cost: float, weights: tuple[float, float, float]) -> np.ndarray:
    """The bin of each item, sizes falling: of the open bins that can take an item under every constraint, the one
    left with the smallest weighted norm of its residual tokens, places and attention cost (the sum of squared sizes).
    An item that exceeds the cost alone has a bin of its own."""
    smallest = sizes[-1] if len(sizes) else 0
    room = np.empty((3, 1024))
    number = np.empty(1024, np.int64)
    open_, made = 0, 0
    scale = np.sqrt(np.array(weights)) / np.array([capacity, max_items, max_cost])
    out = np.empty(len(sizes), np.int64)
    for i, s in enumerate(sizes):
        need = (s, 1.0, float(s) * s)
        best = -1
        if open_:
            r = room[:, :open_]
            fits = np.flatnonzero((r[0] >= need[0]) & (r[1] >= need[1]) & (r[2] >= need[2]))
            if len(fits):
                left = r[0, fits] - need[0]
                norm = (left * scale[0]) ** 2 + ((r[1, fits] - need[1]) * scale[1]) ** 2 + ((r[2, fits] - need[2]) * scale[2]) ** 2
                best = fits[np.argmin(norm)]
        if best < 0:
            if open_ == room.shape[1]:
                room, number = np.concatenate((room, room), 1), np.concatenate((number, number))
            best = open_
            room[:, best], number[best] = (capacity, max_items, max_cost), made
            open_, made = open_ + 1, made + 1
        out[i] = number[best]
        room[:, best] -= need
        if room[0, best] < smallest or room[1, best] < 1 or room[2, best] < float(smallest) ** 2:
            open_ -= 1
            room[:, best], number[best] = room[:, open_], number[open_]
    return out


def pack(items: DataFrame, capacity: int = CAPACITY, max_items: int = MAX_ITEMS, max_cost: float | None = None, weights: tuple[float, float, float] = (1.0, 0.05, 0.05), shard: int = SHARD) -> DataFrame:
    """items (doc_id, n_tokens) to (doc_id, part, n_tokens, container).

    An item over the capacity is divided into full parts and a rest, no other is. Each container keeps to the
    capacity, to max_items and to max_cost, the sum of its squared sizes (by default COST_SHARE of the capacity squared,
    so nearly full single documents take no others); a part that exceeds the cost alone is alone. Items of no or unknown
    size take a place but no room. Items are dealt by key into shards of about `shard` parts, each a task of its own;
    every shard is packed on its own, so only its last few containers aren't full.
    """
    max_cost = COST_SHARE * float(capacity) ** 2 if max_cost is None else max_cost
    n = F.greatest(F.coalesce("n_tokens", F.lit(0)), F.lit(0))
    parts = items.select("doc_id", n.alias("n")).select("doc_id", "n", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / capacity).cast("int"), F.lit(1)) - 1)).alias("part"))
    parts = cut(parts.select("doc_id", "part", F.least(F.lit(capacity), F.col("n") - F.col("part") * capacity).cast("int").alias("n_tokens")), "parts")
    shards = max(1, -(-parts.count() // shard))

    def fill(batches):
        if not (got := list(batches)):
            return
        x = pd.concat(got).sort_values(["n_tokens", "doc_id", "part"], ascending=[False, True, True], kind="stable")
        bins = best_fit(x["n_tokens"].to_numpy(), capacity, max_items, max_cost, weights)
        yield x.assign(container=(TaskContext.get().partitionId() << 32) + bins)

    # a number of partitions that is asked for isn't changed by adaptive execution
    return parts.repartition(shards, F.xxhash64("doc_id", "part")).mapInPandas(fill, "doc_id long, part int, n_tokens int, container long")


def containers(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """The container of every document, null and empty ones included, sized by the tokens of its text."""
    return pack(token_counts(documents, vocabulary), capacity)


def invariants(documents: DataFrame, capacity: int = CAPACITY, max_items: int = MAX_ITEMS, vocabulary: str = VOCABULARY) -> DataFrame:
    """(documents, over_capacity, over_places, over_cost, divided_small, torn): how many documents have a container, how
    many containers break a constraint, how many documents within the capacity are divided and how many don't add up."""
    sizes = cut(token_counts(documents, vocabulary), "sizes")
    x = cut(pack(sizes, capacity, max_items), "packed")
    n = F.col("n_tokens").cast("double")
    bins = x.groupBy("container").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("k"), F.sum(n * n).alias("c"))
    bad = lambda c: F.count_if(c).cast("int")
    bins = bins.agg(bad(F.col("t") > capacity).alias("over_capacity"), bad(F.col("k") > max_items).alias("over_places"), bad((F.col("k") > 1) & (F.col("c") > COST_SHARE * capacity**2)).alias("over_cost"))
    got = x.groupBy("doc_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("k"))
    docs = sizes.groupBy("doc_id").agg(F.sum(F.coalesce("n_tokens", F.lit(0))).alias("whole")).join(got, "doc_id", "left")
    docs = docs.agg(F.count("t").alias("documents"), bad((F.col("k") > 1) & (F.col("whole") <= capacity)).alias("divided_small"), bad(~F.col("t").eqNullSafe(F.col("whole"))).alias("torn"))
    return docs.join(bins, F.lit(True)).select("documents", "over_capacity", "over_places", "over_cost", "divided_small", "torn")  # one row each
