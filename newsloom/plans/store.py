"""Queries on the store: search, retention, shards and upserts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import times
from ..operators.search import search
from ..tables import load
from .common import Registry, now_column
from .scalars import sql_ts

query = Registry()
ORDER = "order by published_at_utc desc nulls last, article_seq limit"


@query("search_category", f"select article_id, article_seq, published_at_utc from articles where primary_category = 'shipping' {ORDER} 1000")
def search_category(s, d):
    return search(load(s, d, "articles"), category="shipping")


@query("search_entity_compat", f"select article_id, article_seq, published_at_utc from articles where to_json(countries) ilike '%us%' {ORDER} 500")
def search_entity_compat(s, d):
    return search(load(s, d, "articles"), 500, country="us", mode="compat")


@query("search_entity_exact", f"select article_id, article_seq, published_at_utc from articles where list_contains(countries, 'US') {ORDER} 500")
def search_entity_exact(s, d):
    return search(load(s, d, "articles"), 500, country="US")


@query("search_date_trust", f"select article_id, article_seq, published_at_utc from articles where published_at_utc >= '2026-01-01' and published_at_utc <= '2026-03-31' and source_trust >= 0.8 {ORDER} 1000")
def search_date_trust(s, d):
    return search(load(s, d, "articles"), date_from="2026-01-01", date_to="2026-03-31", min_source_trust=0.8)


SHARD = "coalesce(nullif(published_at_jst, ''), substr(fetched_at_jst, 1, 10))"


def shard_date():
    return F.coalesce(F.when(F.col("published_at_jst") != "", F.col("published_at_jst")), F.substring("fetched_at_jst", 1, 10))


@query("shard_manifest", f"select count(distinct {SHARD}) as shards, count(*) as articles, min({SHARD}) as oldest, max({SHARD}) as newest from articles")
def shard_manifest(s, d):
    x = load(s, d, "articles").select(shard_date().alias("shard"))
    return x.agg(F.count_distinct("shard").alias("shards"), F.count("*").alias("articles"), F.min("shard").alias("oldest"), F.max("shard").alias("newest"))


@query("retention", f"select {SHARD} < '2026-06-15' as expired, count(*) as n from articles group by 1")
def retention(s, d):
    return load(s, d, "articles").groupBy((shard_date() < "2026-06-15").alias("expired")).agg(F.count("*").alias("n"))


@query("retention_keep", f"select article_seq from articles where not coalesce({SHARD} <> '' and {SHARD} < '2026-06-15', false)")
def retention_keep(s, d):
    c = shard_date()
    return load(s, d, "articles").where(~F.coalesce((c != "") & (c < "2026-06-15"), F.lit(False))).select("article_seq")


@query("hot_window", f"select article_seq, {SHARD} as shard from articles where {SHARD} >= '2026-07-05' order by 2, 1 limit 5000")
def hot_window(s, d):
    return load(s, d, "articles").select("article_seq", shard_date().alias("shard")).where("shard >= '2026-07-05'").orderBy("shard", "article_seq").limit(5000)


@query("daily_shards", f"select {SHARD} as shard, count(*) as n, count(distinct source_domain) as domains from articles group by 1")
def daily_shards(s, d):
    return load(s, d, "articles").groupBy(shard_date().alias("shard")).agg(F.count("*").alias("n"), F.count_distinct("source_domain").alias("domains"))


@query("keep_last", "select article_id, article_seq from articles qualify row_number() over (partition by article_id order by article_seq desc) = 1")
def keep_last(s, d):
    """The upsert of the store: of each id the last delivery."""
    return load(s, d, "articles").groupBy("article_id").agg(F.max("article_seq").alias("article_seq"))


@query("upsert_incoming", "select article_id, max(r) as row_no, count(*) as deliveries from (select article_id, article_seq r from articles union all select article_id, incoming_seq + 1000000000000 from incoming_articles) group by 1")
def upsert_incoming(s, d):
    new = load(s, d, "incoming_articles").select("article_id", (F.col("incoming_seq") + 1_000_000_000_000).alias("r"))
    return load(s, d, "articles").select("article_id", F.col("article_seq").alias("r")).unionByName(new).groupBy("article_id").agg(F.max("r").alias("row_no"), F.count("*").alias("deliveries"))


_SINCE = "2026-07-14T00:00:00+00:00"  # a day before NOW, compared as text like every time of the store


def status_of_store(articles, quarantined: int = 0, since: str = _SINCE):
    """(total_articles, new_articles_24h, source_count, latest_article_at, storage_status) of a store of which so many
    files are in quarantine."""
    x = articles.agg(F.count("*").alias("total_articles"), F.count_if(F.col("published_at_utc") >= since).alias("new_articles_24h"), F.count_distinct("source_domain").alias("source_count"), F.coalesce(F.max("published_at_utc"), F.lit("")).alias("latest_article_at"))
    return x.withColumn("storage_status", F.lit("degraded" if quarantined > 0 else "healthy"))


@query("store_status", f"select count(*) as total_articles, count_if(published_at_utc >= '{_SINCE}') as new_articles_24h, count(distinct source_domain) as source_count, coalesce(max(published_at_utc), '') as latest_article_at, 'healthy' as storage_status from articles")
def store_status(s, d):
    """The tables are read whole, so nothing is in quarantine; tests hold the other case."""
    return status_of_store(load(s, d, "articles"))


@query("cursors", "select source_name, last_fetch_started_at, last_fetch_completed_at, latest_published_at, latest_article_id, etag, last_modified, last_http_status, consecutive_failures, last_success_count, coalesce(epoch(try_cast(nullif(trim(next_retry_at), '') as timestamptz)) <= epoch(timestamp '2026-07-15'), true) as retry_now from source_cursors")
def cursors(s, d):
    kept = ["source_name", "last_fetch_started_at", "last_fetch_completed_at", "latest_published_at", "latest_article_id", "etag", "last_modified", "last_http_status", "consecutive_failures", "last_success_count"]
    return load(s, d, "source_cursors").select(*kept, times.should_retry(F.col("next_retry_at"), now_column()).alias("retry_now"))


@query("fetch_from", f"select source_name, cast(floor({sql_ts('latest_published_at')}) as bigint) - 48 * 3600 as from_epoch from source_cursors")
def fetch_from(s, d):
    """Where each source's next run begins: its latest article less the overlap, null where there is none."""
    return load(s, d, "source_cursors").select("source_name", F.unix_seconds(times.fetch_from(F.col("latest_published_at"))).alias("from_epoch"))


@query("source_health", "select source_name, last_fetch_completed_at, consecutive_failures, last_http_status from source_cursors order by consecutive_failures desc nulls last, source_name limit 100")
def source_health(s, d):
    return load(s, d, "source_cursors").select("source_name", "last_fetch_completed_at", "consecutive_failures", "last_http_status").orderBy(F.col("consecutive_failures").desc_nulls_last(), "source_name").limit(100)


@query("rebuild_index", f"select article_id, article_seq, {SHARD} as shard_date, primary_category, source_domain, source_trust, published_at_utc, canonical_hash, title_hash, content_hash from articles qualify row_number() over (partition by article_id order by {SHARD} desc nulls last, article_seq desc) = 1")
def rebuild_index(s, d):
    """The index as it comes out of the shards in order of their day: of each id the last row."""
    kept = ["primary_category", "source_domain", "source_trust", "published_at_utc", "canonical_hash", "title_hash", "content_hash"]
    x = load(s, d, "articles").select("article_id", "article_seq", shard_date().alias("shard_date"), *kept)
    last = x.groupBy("article_id").agg(F.max(F.struct("shard_date", "article_seq")).alias("last"))
    return last.select("last.article_seq").join(x, "article_seq").select("article_id", "article_seq", "shard_date", *kept)


@query("newest_per_source", "select source_name, article_seq from articles where published_at_utc <> '' qualify row_number() over (partition by source_name order by published_at_utc desc, article_seq) = 1")
def newest_per_source(s, d):
    w = Window.partitionBy("source_name").orderBy(F.col("published_at_utc").desc(), "article_seq")
    return load(s, d, "articles").where("published_at_utc <> ''").select("source_name", "article_seq", "published_at_utc").withColumn("r", F.row_number().over(w)).where("r = 1").select("source_name", "article_seq")
