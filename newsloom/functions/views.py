"""What may be shown of articles, events and past events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LISTS = ["themes", "countries", "regions", "companies", "tickers", "commodities", "policies", "geopolitical_entities", "causal_keywords"]
SCORES = ["importance_score", "market_impact_score", "urgency_score", "structural_score", "source_trust", "potential_risk_score"]
CONTEXT = 140


def first_of(*columns: str) -> Column:
    """The first that isn't empty, else the last."""
    return F.coalesce(*(F.when(F.col(c) != "", F.col(c)) for c in columns[:-1]), F.col(columns[-1]))


def real(c: str) -> Column:
    """A number or null; JSON has no NaN."""
    return F.when(~F.isnan(c), F.col(c)).alias(c)


def article_view() -> list[Column]:
    """The 23 columns of an article's public view: neither its description nor its body."""
    return [
        F.col("article_id"), first_of("title_ja", "title_original").alias("title"), F.col("canonical_url").alias("url"), F.col("source_name").alias("source"), first_of("published_at_jst", "published_at_utc").alias("published_at"),
        F.col("public_excerpt"), F.col("primary_category").alias("category"), *map(F.col, LISTS), *map(real, SCORES), F.col("event_cluster_id"),
    ]


def cluster_view() -> list[Column]:
    """The 16 columns of an event's public view."""
    return [
        *map(F.col, ("event_cluster_id", "event_title", "category", "countries", "actors", "first_seen_at", "last_seen_at", "article_count", "independent_source_count")),
        *map(real, ("importance_score", "market_impact_score", "urgency_score")), *map(F.col, ("affected_assets", "escalation_status", "priced_in_status")), F.col("representative_articles").alias("representative_article_ids"),
    ]


def context_view(shared: Column, relevance: Column) -> list[Column]:
    """The nine columns of a past article as context."""
    text = F.substring(F.coalesce(first_of("public_excerpt", "description"), F.lit("")), 1, CONTEXT)
    return [
        first_of("event_cluster_id", "article_id").alias("historical_event_id"), F.col("title_original").alias("title"), first_of("published_at_jst", "published_at_utc").alias("date"), relevance.alias("relevance_score"), shared.alias("related_entities"),
        F.col("affected_assets").alias("related_assets"), F.col("priced_in_status").alias("observed_market_reaction"), text.alias("short_context"), F.lit(1).alias("source_count"),
    ]


def flat(df: DataFrame) -> DataFrame:
    """Lists as text, joined by commas."""
    return df.select(*(F.coalesce(F.array_join(c, ","), F.lit("")).alias(c) if t.startswith("array") else F.col(c) for c, t in df.dtypes))
