"""Representatives of linked rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


FEW_LINKS = 200_000


def united(batches):
    """(u, v) to (id, rep) by union-find, all in one task."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (y := up.setdefault(root, root)) != root:
            root = y
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    for b in batches:
        for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            x, y = find(u), find(v)
            up[max(x, y)] = min(x, y)
    ids = list(up)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([find(i) for i in ids], pa.int64())], ["id", "rep"])


def representatives(links: DataFrame, rounds: int = 60, few: int = FEW_LINKS) -> DataFrame:
    """links (a, b) to (id, rep): the smallest id that each linked id reaches. Ids without a link aren't listed.

    Up to `few` links, as a batch has, are united by one task. More of them go in rounds over all tasks: large-star and
    small-star steps in turn hang every id below smaller ones until only stars are left; the rounds grow with the
    logarithm of a component's length. The links are kept between rounds in the shared folder; only their count and
    a checksum come to the driver. Null ends and links of an id to itself are none.
    """
    edges = cut(links.select(F.greatest("a", "b").cast("bigint").alias("u"), F.least("a", "b").cast("bigint").alias("v")).where("u <> v").distinct(), "links")
    if edges.count() <= few:
        return edges.coalesce(1).mapInArrow(united, "id long, rep long")
    seen = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = cut(large.join(least, "u").select(F.explode(pairs).alias("e")).select("e.u", "e.v").where("u <> v").distinct(), "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
    else:
        raise RuntimeError(f"not at rest after {rounds} rounds")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("rep")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("rep")).distinct())


def merge_representatives(known: DataFrame, links: DataFrame) -> DataFrame:
    """known (id, rep), new links (a, b) to the changed rows (id, rep) of affected clusters only.

    The links are lifted to representatives (an id not yet known is its own), joined among themselves, and only rows
    of a representative that moved, and new ids, come out.
    """
    k = known.select("id", "rep")
    lift = lambda d, c: d.join(k.select(F.col("id").alias(c), F.col("rep").alias("r" + c)), c, "left").withColumn("r" + c, F.coalesce("r" + c, c))
    lifted = cut(lift(lift(links.select("a", "b"), "a"), "b"), "lifted")
    moved = representatives(lifted.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
    ids = lifted.select(F.col("a").alias("id"), F.col("ra").alias("old")).unionByName(lifted.select(F.col("b").alias("id"), F.col("rb").alias("old"))).distinct()
    touched = k.join(moved.where("id <> rep").select(F.col("id").alias("old")), k.rep == F.col("old"), "left_semi").select("id", F.col("rep").alias("old"))
    every = ids.unionByName(touched).distinct()
    return every.join(moved.select(F.col("id").alias("old"), "rep"), "old", "left").select("id", F.coalesce("rep", "old").alias("rep"))
