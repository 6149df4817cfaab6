"""Search over the article store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ARRAYS = {"country": "countries", "company": "companies", "commodity": "commodities", "geopolitical_entity": "geopolitical_entities"}


def predicate(category=None, date_from=None, date_to=None, min_source_trust=None, mode="exact", **entities) -> Column:
    """The given conditions together; what is None or '' asks nothing. mode: an entity is an element of its array
    ("exact") or, "compat", any part of the array's JSON text, in any case."""
    out = F.lit(True)
    if category:
        out &= F.col("primary_category") == category
    for k, v in entities.items():
        if v:
            c = F.col(ARRAYS[k])
            out &= F.array_contains(c, v) if mode == "exact" else F.to_json(c).ilike(f"%{v}%")
    if date_from:
        out &= F.col("published_at_utc") >= date_from
    if date_to:
        out &= F.col("published_at_utc") <= date_to
    if min_source_trust is not None:
        out &= F.col("source_trust") >= min_source_trust
    return out


def search(articles: DataFrame, limit: int = 1000, **conditions) -> DataFrame:
    """article_id, newest first, ties by article_seq."""
    hits = articles.where(predicate(**conditions)).select("article_id", "article_seq", "published_at_utc")
    return hits.orderBy(F.col("published_at_utc").desc_nulls_last(), "article_seq").limit(limit)
