"""Capped greedy selection."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scoring, times
from ..functions.scoring import number
from ..session import cut


def caps(target: int, source_share: float, theme_share: float) -> tuple[int, int]:
    return max(1, int(target * source_share)), max(1, int(target * theme_share))


def take(rows: pd.DataFrame, target: int, source_cap: int, theme_cap: int, cluster_cap: int) -> pd.DataFrame:
    """Rows in order, each taken unless its source, theme or cluster is full, until the target is met."""
    full: dict[tuple[str, str], int] = {}
    limits = (("src", source_cap), ("theme", theme_cap), ("cluster", cluster_cap))
    keep = []
    for i, row in enumerate(rows[["src", "theme", "cluster"]].fillna("").itertuples(index=False)):
        if len(keep) == target:
            break
        keys = [((k, v), n) for (k, n), v in zip(limits, row) if k != "cluster" or v]
        if any(full.get(k, 0) >= n for k, n in keys):
            continue
        for k, _ in keys:
            full[k] = full.get(k, 0) + 1
        keep.append(i)
    return rows.iloc[keep].assign(rank=range(1, len(keep) + 1))


def select_diverse(rows: DataFrame, score: Column, target: int, max_source_share: float = 0.25, max_theme_share: float = 0.35, max_cluster: int = 3) -> DataFrame:
    """rows (article_seq, src, theme, cluster) to the selected (rank, article_seq, score).

    Only rows that can be selected reach the ordered fold: of one (source, theme, cluster) at most as many as the
    smallest cap. Batches of best candidates go to the fold until it is full or they are used up, so what a task holds
    is bounded by the batch.
    """
    source_cap, theme_cap = caps(target, max_source_share, max_theme_share)
    x = rows.select("article_seq", "src", "theme", "cluster", score.alias("score"))
    # within one (source, theme, cluster) no row after the cluster's cap can be taken; without a cluster none after the source's
    bound = F.when(F.coalesce("cluster", F.lit("")) == "", min(source_cap, theme_cap)).otherwise(min(source_cap, theme_cap, max_cluster))
    w = Window.partitionBy("src", "theme", "cluster").orderBy(F.col("score").desc(), "article_seq")
    x = x.withColumn("r", F.row_number().over(w)).where(F.col("r") <= min(source_cap, theme_cap)).where(F.col("r") <= bound).drop("r")
    best = cut(x, "candidates").orderBy(F.col("score").desc(), "article_seq")  # the scores are made once

    def fold(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["score", "article_seq"], ascending=[False, True], kind="stable")
        return take(p, target, source_cap, theme_cap, max_cluster)[["rank", "article_seq", "score"]]

    size = max(1000, 50 * target)
    while True:
        out = best.limit(size).groupBy().applyInPandas(fold, "rank long, article_seq long, score double")
        if out.count() == target or best.limit(size + 1).count() <= size:
            return out
        size *= 8


def retrieval_scores(articles: DataFrame, reactions: DataFrame, now: Column) -> DataFrame:
    """(article_seq, src, theme, cluster, score): what the selection goes by. reactions: (event_cluster_id, has_reaction,
    magnitude); a row without one has none. Freshness is that of `now`; null and NaN scores count as 0."""
    half = (number(F.col("importance_score")) + number(F.col("market_impact_score"))) / 2
    parts = {
        "relevance": F.when(half == 0, 0.5).otherwise(F.least(F.lit(1.0), half)), "market_reaction": scoring.reaction(F.coalesce("has_reaction", F.lit(False)), F.coalesce("magnitude", F.lit(0.0))),
        "freshness": times.freshness(times.parse_iso(F.col("published_at_utc")), now), "source_trust": number(F.col("source_trust")), "urgency": number(F.col("urgency_score")), "structural": number(F.col("structural_score")),
        "independent_source_confirmation": scoring.confirmation(F.lit(1)),
    }
    theme = F.coalesce(F.try_element_at("themes", F.lit(1)), F.col("primary_category"))
    needed = ["article_seq", "event_cluster_id", "source_domain", "primary_category", "themes", "published_at_utc", "importance_score", "market_impact_score", "source_trust", "urgency_score", "structural_score"]
    x = articles.select(*needed).join(reactions.select("event_cluster_id", "has_reaction", "magnitude"), "event_cluster_id", "left")
    return x.select("article_seq", F.col("source_domain").alias("src"), theme.alias("theme"), F.col("event_cluster_id").alias("cluster"), scoring.retrieval(parts).alias("score"))
