"""Raw records to articles, in one chain of expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import classify, scoring, text, times, url

EXCERPT = 200


def some(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def build_articles(raw: DataFrame, sources: DataFrame, now: Column, run_id: str = "", keywords: dict | None = None) -> DataFrame:
    """raw (seq, source_id, title, url, description, published_at_utc, published_raw) to articles.

    Null fields count as empty; a record whose source is unknown keeps trust 0.5 and no country. Every record comes
    out, times that can't be right replaced by the fetch's.
    """
    cat = sources.groupBy("id").agg(F.min_by(F.struct("name", "trust", "country", "language", "source_class"), "name").alias("s")).select(F.col("id").alias("source_id"), "s")
    canonical = url.normalize_url(F.col("url"))
    fetched = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    x = raw.select("seq", "source_id", some("title").alias("title_original"), some("url").alias("normalized_url"), canonical.alias("canonical_url"), url.host_of(F.col("url")).alias("source_domain"), some("description").alias("description"), times.sanitize_published(F.col("published_at_utc"), F.col("published_raw"), fetched, now).alias("d"))
    x = x.join(cat, "source_id", "left").withColumn("published", times.parse_iso(F.col("d.published")))
    x = classify.with_text(x).withColumn("c", classify.classified(classify.category_hits(keywords)))
    x = x.withColumn("g", scoring.signals(F.col("title_original"), F.col("c.primary"), F.col("c.themes"), F.coalesce("s.trust", F.lit(0.5))))
    return x.select(
        "seq", "source_id", text.article_id(F.col("canonical_url")).alias("article_id"), "canonical_url", "normalized_url", F.coalesce("s.name", F.lit("")).alias("source_name"), "source_domain", F.coalesce("s.trust", F.lit(0.5)).alias("source_trust"),
        F.coalesce("s.language", F.lit("ja")).alias("language"), "title_original", "description", F.substring("description", 1, EXCERPT).alias("public_excerpt"), (F.col("description") != "").alias("body_available"),
        F.array_compact(F.array(F.when(F.col("s.country") != "", F.col("s.country")))).alias("countries"), F.col("d.published").alias("published_at_utc"), times.jst_date(F.col("published")).alias("published_at_jst"), fetched.alias("fetched_at_utc"),
        F.col("d.inferred").alias("date_inferred"), F.col("d.raw").alias("raw_published_at"), F.col("c.primary").alias("primary_category"), F.col("c.secondary").alias("secondary_categories"), F.col("c.themes").alias("themes"),
        F.col("g.importance").alias("importance_score"), F.col("g.impact").alias("market_impact_score"), F.col("g.urgency").alias("urgency_score"), F.col("g.structural").alias("structural_score"), times.freshness(F.col("published"), now).alias("freshness_score"),
        text.canonical_hash(F.col("canonical_url")).alias("canonical_hash"), text.title_hash(F.col("title_original")).alias("title_hash"), text.content_hash(F.col("title_original"), F.col("description")).alias("content_hash"), F.lit(run_id).alias("ingestion_run_id"),
    )
