"""Duplicates by keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def known(new: DataFrame, store: DataFrame, keys: list[str]) -> DataFrame:
    """new without the rows that share any of the keys with the store: one anti-join for each key, never one on all.

    The store is only asked which of the new rows' keys it has, so a small batch's keys can go to the store's files
    by a broadcast and the store isn't shuffled.
    """
    out = new
    for k in keys:
        asked = new.select(k).dropna().distinct()
        out = out.join(store.select(k).join(asked, k, "left_semi").distinct(), k, "left_anti")
    return out


def first_wins(rows: DataFrame, seq: str, keys: list[str], rounds: int = 100) -> DataFrame:
    """(seq) of the rows that a reader in order of seq keeps, who drops a row that shares a key with a kept one.

    A dropped row's keys count for nothing. Rows first in all their keys are kept and those that share a key with
    them dropped; what is left goes round again, from a table in the shared folder. Null keys equal none.
    """
    live = cut(rows.select(seq, *keys), "live")
    kept = None
    for _ in range(rounds):
        firsts = live
        for i, k in enumerate(keys):
            low = live.where(F.col(k).isNotNull()).groupBy(k).agg(F.min(seq).alias(f"_low{i}"))
            firsts = firsts.join(low, k, "left")
        won = cut(firsts.where(" and ".join(f"({k} is null or _low{i} = {seq})" for i, k in enumerate(keys))).select(seq, *keys), "won")
        kept = won if kept is None else kept.unionByName(won)
        rest = live.join(won.select(seq), seq, "left_anti")
        for k in keys:
            rest = rest.join(won.where(F.col(k).isNotNull()).select(k).distinct(), k, "left_anti")
        live = cut(rest.select(seq, *keys), "live")
        if live.isEmpty():
            return kept.select(seq)
    raise RuntimeError(f"rows left after {rounds} rounds")


def exact_partners(rows: DataFrame, seq: str) -> DataFrame:
    """rows (seq, c, x): keys of address and content, null for none, to (seq, partners, first_partner) of rows that have
    an address and a partner of the same c or x.

    Partners of either key less those of both: counts of three groupings, so no pair is made.
    """
    k = rows.where("c is not null or x is not null").select(seq, "c", "x")

    def counted(*keys: str) -> DataFrame:
        name = "".join(keys)
        return k.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias(f"n_{name}"), F.min(seq).alias(f"f_{name}"))

    later = lambda key: k.dropna(subset=[key]).join(counted(key), key).where(F.col(seq) > F.col(f"f_{key}")).groupBy(key).agg(F.min(seq).alias(f"s_{key}"))
    out = k.where("c is not null").join(counted("c"), "c", "left").join(later("c"), "c", "left").join(counted("x"), "x", "left").join(later("x"), "x", "left").join(counted("c", "x"), ["c", "x"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    partners = zero("n_c") - 1 + F.when(F.col("x").isNotNull(), zero("n_x") - zero("n_cx")).otherwise(0)
    other = lambda key: F.when(F.col(f"f_{key}") != F.col(seq), F.col(f"f_{key}")).otherwise(F.col(f"s_{key}"))
    return out.select(seq, partners.cast("bigint").alias("partners"), F.least(other("c"), other("x")).alias("first_partner")).where("partners > 0")


def syndicated_partners(rows: DataFrame, seq: str, domain: str) -> DataFrame:
    """rows (seq, t, c, x, domain) to (seq, partners): rows under the same title t of other domains, less the exact
    duplicates, which a row with an address has, of the same c or the same x. All from counts of groupings."""
    k = cut(rows.where("t is not null").select(seq, "t", "c", "x", F.coalesce(domain, F.lit("")).alias("d")), "titles")
    every = cut(k.groupBy("t", "d", "c", "x").agg(F.count("*").alias("n")), "combinations")

    def away(out: DataFrame, name: str, *keys: str) -> DataFrame:
        """Adds how many rows share the keys under another domain."""
        part = every.dropna(subset=list(keys)) if keys else every
        whole = part.groupBy("t", *keys).agg(F.sum("n").alias("whole"))
        own = part.groupBy("t", *keys, "d").agg(F.sum("n").alias("own"))
        out = out.join(whole, ["t", *keys], "left").join(own, ["t", *keys, "d"], "left")
        return out.withColumn(name, F.coalesce("whole", F.lit(0)) - F.coalesce("own", F.lit(0))).drop("whole", "own")

    combos = every.select("t", "d", "c", "x")
    out = away(away(away(away(combos, "all_"), "by_c", "c"), "by_x", "x"), "by_cx", "c", "x")
    exact = F.when(F.col("c").isNotNull(), F.col("by_c") + F.col("by_x") - F.col("by_cx")).otherwise(0)
    out = out.withColumn("partners", F.col("all_") - exact).where("partners > 0").select("t", "d", *(F.coalesce(c, F.lit("")).alias(c) for c in "cx"), "partners")
    mine = k.withColumns({c: F.coalesce(c, F.lit("")) for c in "cx"})
    return mine.join(out, ["t", "d", "c", "x"]).select(seq, "partners")
