"""Rollups of articles, runs, reactions and the catalogue."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import views
from ..functions.scoring import number, reaction
from ..functions.text import ASCII, DASHES, WIDE, name_key
from ..tables import load
from .common import Registry

query = Registry()


def exact_avg(c):
    """An average that doesn't depend on the order of its rows: sums of millionths."""
    return F.round(F.sum(F.round(c * 1_000_000).cast("bigint")) / F.count(c) / 1_000_000, 10)


def sql_avg(c: str) -> str:
    return f"round(cast(sum(cast(round({c} * 1000000) as bigint)) as double) / count({c}) / 1000000, 10)"


_NUM = "coalesce(case when isnan(importance_score) then null else importance_score end, 0e0)"


@query("theme_summary", f"select theme, count(*) as n, {sql_avg('i')} as mean_importance from (select unnest(case when len(themes) > 0 then themes else [primary_category] end) as theme, {_NUM} as i from articles) where theme not in ('', 'uncategorized') group by 1 order by n desc, theme limit 30")
def theme_summary(s, d):
    themes = F.when(F.size("themes") > 0, F.col("themes")).otherwise(F.array("primary_category"))
    x = load(s, d, "articles").select(F.explode(themes).alias("theme"), number(F.col("importance_score")).alias("i"))
    x = x.where(~F.col("theme").isin("", "uncategorized")).groupBy("theme").agg(F.count("*").alias("n"), exact_avg(F.col("i")).alias("mean_importance"))
    return x.orderBy(F.col("n").desc(), "theme").limit(30)


_R = lambda c: f"case when isnan({c}) then null else {c} end"
SQL_COVERED = "select count(*) from (select event_cluster_id from market_reactions where value is not null group by 1)"


@query("quality_metrics", f"""select round(cast(sum(cast(round(coalesce({_R('freshness_score')}, 0) * 1000000) as bigint)) as double) / count(*) / 1000000, 4) as freshness_score,
 round(least(1, 0.5e0 * count(distinct coalesce(source_domain, '')) / count(*) + 0.5e0 * count(distinct coalesce(themes[1], primary_category, '')) / count(*)), 4) as diversity_score,
 round(cast(sum(cast(round(coalesce(nullif(coalesce({_R('source_score')}, 0), 0), {_R('source_trust')}, 0) * 1000000) as bigint)) as double) / count(*) / 1000000, 4) as source_quality_score,
 round(({SQL_COVERED}) / cast(count(*) as double), 4) as market_reaction_coverage,
 round(count_if(coalesce(primary_category, '') in ('ai', 'semiconductor') or coalesce(list_has_any(themes, ['ai', 'semiconductor']), false)) / cast(count(*) as double), 4) as ai_semiconductor_share from articles""")
def quality_metrics(s, d):
    """The five figures of the published block; reaction coverage counts the clusters with a measured reaction."""
    covered = load(s, d, "market_reactions").where("value is not null").agg(F.count_distinct("event_cluster_id").alias("covered"))
    return quality(load(s, d, "articles"), covered)


def quality(articles, covered):
    """(freshness_score, diversity_score, source_quality_score, market_reaction_coverage, ai_semiconductor_share) of
    articles; covered: one row with how many clusters have a reaction. No articles give zeros."""
    theme = F.coalesce(F.try_element_at("themes", F.lit(1)), F.col("primary_category"), F.lit(""))
    n = F.greatest(F.count("*"), F.lit(1))
    total = lambda c: F.coalesce(F.sum(F.round(c * 1_000_000).cast("bigint")), F.lit(0)) / 1_000_000
    trust = number(F.when(number(F.col("source_score")) != 0, F.col("source_score")).otherwise(F.col("source_trust")))
    tech = F.coalesce(F.col("primary_category").isin("ai", "semiconductor"), F.lit(False)) | F.coalesce(F.arrays_overlap("themes", F.array(F.lit("ai"), F.lit("semiconductor"))), F.lit(False))
    x = articles.agg(
        n.alias("n"), F.round(total(number(F.col("freshness_score"))) / n, 4).alias("freshness_score"),
        F.round(F.least(F.lit(1.0), 0.5 * F.count_distinct(F.coalesce("source_domain", F.lit(""))) / n + 0.5 * F.count_distinct(theme) / n), 4).alias("diversity_score"),
        F.round(total(trust) / n, 4).alias("source_quality_score"), F.round(F.count_if(tech) / n, 4).alias("ai_semiconductor_share"),
    )
    x = x.join(F.broadcast(covered), F.lit(True))  # one row each
    return x.select("freshness_score", "diversity_score", "source_quality_score", F.round(F.col("covered") / F.col("n"), 4).alias("market_reaction_coverage"), "ai_semiconductor_share")


@query("package_distribution", "select coalesce(nullif(source_name, ''), 'unknown') as source, count(*) as n from articles group by 1")
def package_distribution(s, d):
    return load(s, d, "articles").groupBy(F.coalesce(F.when(F.col("source_name") != "", F.col("source_name")), F.lit("unknown")).alias("source")).agg(F.count("*").alias("n"))


LEVELS = "case when share >= 0.6 then 'critical' when share >= 0.35 then 'warning' else 'ok' end"


@query("source_concentration", f"with t as (select run_id, source, sum(new_items) n from source_results where new_items > 0 group by 1, 2), w as (select *, cast(sum(n) over (partition by run_id) as double) total, row_number() over (partition by run_id order by n desc, source) r from t) select run_id, source as top_source, cast(n as bigint) as top_new, share, {LEVELS} as level from (select *, round(n / total, 4) share from w where r = 1)")
def source_concentration(s, d):
    t = load(s, d, "source_results").where("new_items > 0").groupBy("run_id", "source").agg(F.sum("new_items").alias("n"))
    # one pass: the run's total, and its top source as the smallest (-n, source)
    x = t.groupBy("run_id").agg(F.sum("n").alias("total"), F.min(F.struct((-F.col("n")).alias("m"), F.col("source").alias("source"))).alias("top"))
    x = x.select("run_id", F.col("top.source").alias("top_source"), (-F.col("top.m")).alias("top_new"), F.round(-F.col("top.m") / F.col("total"), 4).alias("share"))
    return x.withColumn("level", F.expr(LEVELS))


_DONE = "select distinct * from source_results"
SQL_RUN = f"""select run_id, count(*) as sources, count_if(status = 'success') as succeeded, count_if(status = 'unchanged') as unchanged, count_if(status = 'failed') as failed,
 cast(coalesce(sum(fetched), 0) as bigint) as fetched, cast(coalesce(sum(new_items), 0) as bigint) as new_items, cast(coalesce(sum(duplicates), 0) as bigint) as duplicates, cast(coalesce(sum(date_inferred), 0) as bigint) as inferred from ({_DONE}) group by run_id"""


def _runs(s, d):
    x = load(s, d, "source_results").distinct()
    of = lambda v: F.count_if(F.col("status") == v)
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return x.groupBy("run_id").agg(F.count("*").alias("sources"), of("success").alias("succeeded"), of("unchanged").alias("unchanged"), of("failed").alias("failed"), total("fetched").alias("fetched"), total("new_items").alias("new_items"), total("duplicates").alias("duplicates"), total("date_inferred").alias("inferred"))


@query("run_stats", SQL_RUN)
def run_stats(s, d):
    return _runs(s, d)


def run_health(failed, succeeded, published, publication_ok):
    """(status, exit_code): without a published package failed; with failures, or without a success, degraded."""
    status = F.when(~(published & publication_ok), "failed").when((failed > 0) | (succeeded == 0), "degraded").otherwise("healthy")
    return status.alias("status"), F.when(status == "failed", 1).otherwise(0).alias("exit_code")


@query("run_status", f"""select run_id, published, publication_ok, case when not published or not publication_ok then 'failed' when failed > 0 or succeeded = 0 then 'degraded' else 'healthy' end as status, case when published and publication_ok then 0 else 1 end as exit_code
 from (select *, not (sources > 0 and failed = sources) as published, new_items + duplicates > 0 or fetched = 0 as publication_ok from ({SQL_RUN}))""")
def run_status(s, d):
    """Publication follows the run: not where all sources failed, and not well where what was fetched got lost."""
    published = ~((F.col("sources") > 0) & (F.col("failed") == F.col("sources")))
    ok = (F.col("new_items") + F.col("duplicates") > 0) | (F.col("fetched") == 0)
    x = _runs(s, d).select("run_id", published.alias("published"), ok.alias("publication_ok"), "failed", "succeeded")
    return x.select("run_id", "published", "publication_ok", *run_health(F.col("failed"), F.col("succeeded"), F.col("published"), F.col("publication_ok")))


@query("cluster_counters", "select count(*) as clusters_created, count_if(n > 1) as clusters_updated from (select event_cluster_id, count(distinct article_id) n from articles where event_cluster_id <> '' group by 1)")
def cluster_counters(s, d):
    n = load(s, d, "articles").where("event_cluster_id <> ''").groupBy("event_cluster_id").agg(F.count_distinct("article_id").alias("n"))
    return n.agg(F.count("*").alias("clusters_created"), F.count_if(F.col("n") > 1).alias("clusters_updated"))


@query("latest_run", f"select * from ({SQL_RUN}) order by run_id desc limit 1")
def latest_run(s, d):
    return _runs(s, d).orderBy(F.col("run_id").desc()).limit(1)


@query("duplicate_rate", "select status, cast(sum(duplicates) as bigint) as duplicates, round(sum(duplicates) / nullif(cast(sum(fetched) as double), 0), 4) as rate from source_results group by 1")
def duplicate_rate(s, d):
    return load(s, d, "source_results").groupBy("status").agg(F.sum("duplicates").alias("duplicates"), F.round(F.try_divide(F.sum("duplicates"), F.sum("fetched")), 4).alias("rate"))


# ---- reactions

SQL_REACTION = "select event_cluster_id, count(value) > 0 as has_reaction, coalesce(least(1e0, round(cast(sum(cast(round(abs(value) * 1000000) as bigint)) as double) / count(value) / 1000000, 10)), 0e0) as magnitude, count(value) as cells from (select distinct * from market_reactions) group by 1"


def reactions(s, d):
    x = load(s, d, "market_reactions").distinct()
    return x.groupBy("event_cluster_id").agg((F.count("value") > 0).alias("has_reaction"), F.coalesce(F.least(F.lit(1.0), exact_avg(F.abs("value"))), F.lit(0.0)).alias("magnitude"), F.count("value").alias("cells"))


@query("reaction_magnitude", SQL_REACTION)
def reaction_magnitude(s, d):
    return reactions(s, d)


SQL_CLUSTERS = "select * from event_clusters qualify row_number() over (partition by event_cluster_id order by last_seen_at desc, article_count desc, event_title) = 1"


def clusters(s, d):
    """The newest snapshot of every cluster."""
    w = Window.partitionBy("event_cluster_id").orderBy(F.col("last_seen_at").desc_nulls_last(), F.col("article_count").desc_nulls_last(), "event_title")
    return load(s, d, "event_clusters").withColumn("r", F.row_number().over(w)).where("r = 1").drop("r")


@query("reaction_lookup", f"select c.event_cluster_id, coalesce(r.has_reaction, false) as has_reaction, coalesce(r.magnitude, 0e0) as magnitude from ({SQL_CLUSTERS}) c left join ({SQL_REACTION}) r using (event_cluster_id)")
def reaction_lookup(s, d):
    return clusters(s, d).select("event_cluster_id").join(reactions(s, d), "event_cluster_id", "left").select("event_cluster_id", F.coalesce("has_reaction", F.lit(False)).alias("has_reaction"), F.coalesce("magnitude", F.lit(0.0)).alias("magnitude"))


@query("reaction_view", f"""select event_cluster_id, event_title, cells, reactions from ({SQL_CLUSTERS}) join ({SQL_REACTION}) using (event_cluster_id)
 join (select event_cluster_id, string_agg(target || ' ' || reaction_window || ' ' || case when value is null then '-' else printf('%.6f', value) end, ',' order by target, reaction_window) as reactions from (select event_cluster_id, target, reaction_window, max(value) as value from market_reactions group by all) group by 1) using (event_cluster_id) order by cells desc, event_cluster_id limit 30""")
def reaction_view(s, d):
    """The clusters with the most measured reactions, and their grid."""
    top = clusters(s, d).select("event_cluster_id", "event_title").join(reactions(s, d), "event_cluster_id").select("event_cluster_id", "event_title", "cells").orderBy(F.col("cells").desc(), "event_cluster_id").limit(30)
    cell = load(s, d, "market_reactions").join(F.broadcast(top.select("event_cluster_id")), "event_cluster_id", "left_semi").groupBy("event_cluster_id", "target", "reaction_window").agg(F.max("value").alias("value"))  # 30 rows
    text = F.concat_ws(" ", "target", "reaction_window", F.coalesce(F.format_string("%.6f", "value"), F.lit("-")))
    grid = cell.select("event_cluster_id", F.when(F.col("value").isNull(), F.concat_ws(" ", "target", "reaction_window", F.lit("-"))).otherwise(text).alias("cell"), F.struct("target", "reaction_window").alias("o"))
    grid = grid.groupBy("event_cluster_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "cell"))), lambda x: x["cell"]), ",").alias("reactions"))
    return top.join(grid, "event_cluster_id")


_IMP = "least(1e0, coalesce(case when isnan(importance_score) then null else importance_score end, 0e0))"


SQL_CVIEW = ", ".join(["event_cluster_id", "event_title", "category", *(f"coalesce(array_to_string({c}, ','), '') as {c}" for c in ("countries", "actors", "affected_assets")), "first_seen_at", "last_seen_at", "article_count", "independent_source_count", *(f"{_R(c)} as {c}" for c in ("importance_score", "market_impact_score", "urgency_score")), "escalation_status", "priced_in_status", "coalesce(array_to_string(representative_articles, ','), '') as representative_article_ids"])


def _view(x, *more):
    return views.flat(x.select(*views.cluster_view(), *more))


@query("global_drivers", f"select {SQL_CVIEW}, score from (select c.*, round(0.7e0 * case when has_reaction then greatest(0.3e0, least(1e0, magnitude)) else 0e0 end + 0.3e0 * {_IMP}, 6) as score from ({SQL_CLUSTERS}) c left join ({SQL_REACTION}) using (event_cluster_id)) order by score desc, event_cluster_id limit 20")
def global_drivers(s, d):
    """Clusters by measured reaction before importance."""
    x = clusters(s, d).join(reactions(s, d), "event_cluster_id", "left")
    score = F.round(0.7 * reaction(F.coalesce("has_reaction", F.lit(False)), F.coalesce("magnitude", F.lit(0.0))) + 0.3 * F.least(F.lit(1.0), number(F.col("importance_score"))), 6)
    return _view(x.withColumn("score", score).orderBy(F.col("score").desc(), "event_cluster_id").limit(20), "score")


RISKS = ["geopolitics", "diplomacy_war", "us_china", "us_iran_middle_east", "taiwan", "ukraine", "north_korea", "sanctions", "cyber"]  # fixed values


@query("risk_radar", f"select {SQL_CVIEW}, score from (select *, round(coalesce({_R('urgency_score')}, 0e0) + coalesce({_R('importance_score')}, 0e0), 6) as score from ({SQL_CLUSTERS}) where category in ({', '.join(repr(x) for x in RISKS)})) order by score desc, event_cluster_id limit 20")
def risk_radar(s, d):
    x = clusters(s, d).where(F.col("category").isin(*RISKS))
    return _view(x.withColumn("score", F.round(number(F.col("urgency_score")) + number(F.col("importance_score")), 6)).orderBy(F.col("score").desc(), "event_cluster_id").limit(20), "score")


@query("event_clusters", f"select {SQL_CVIEW} from ({SQL_CLUSTERS}) order by event_cluster_id limit 30")
def event_clusters(s, d):
    return _view(clusters(s, d).orderBy("event_cluster_id").limit(30))


@query("cluster_view", f"select {SQL_CVIEW} from ({SQL_CLUSTERS})")
def cluster_view(s, d):
    """The 16 columns that may be shown of every event."""
    return _view(clusters(s, d))


# ---- clusters from their articles

SQL_ROLL = """select event_cluster_id, count(distinct article_id) as articles, count(distinct nullif(source_domain, '')) as domains,
 min(nullif(published_at_utc, '')) as first_seen, max(nullif(published_at_utc, '')) as last_seen, max(case when isnan(importance_score) then null else importance_score end) as importance,
 max(case when isnan(market_impact_score) then null else market_impact_score end) as impact, max(case when isnan(urgency_score) then null else urgency_score end) as urgency, max(case when isnan(source_trust) then null else source_trust end) as source_trust_max, case when count(distinct article_id) >= 5 then 'escalating' else 'steady' end as escalation,
 coalesce(array_to_string(list_sort(list_distinct(flatten(list(countries)))), ','), '') as countries, coalesce(array_to_string(list_sort(list_distinct(flatten(list(geopolitical_entities)))), ','), '') as actors, coalesce(array_to_string(list_sort(list_distinct(flatten(list(affected_assets)))), ','), '') as assets
 from articles where event_cluster_id <> '' group by 1"""


def _named(name):
    return lambda x: F.struct(F.lit(name).alias("k"), x.alias("v"))


@query("cluster_rollup", SQL_ROLL)
def cluster_rollup(s, d):
    """Sets are merged from distinct elements per cluster, so a cluster of very many rows gathers a few elements."""
    a = load(s, d, "articles").where("event_cluster_id <> ''")
    real = lambda c: F.max(F.when(~F.isnan(c), F.col(c)))
    base = a.groupBy("event_cluster_id").agg(
        F.count_distinct("article_id").alias("articles"), F.count_distinct(F.when(F.col("source_domain") != "", F.col("source_domain"))).alias("domains"),
        F.min(F.when(F.col("published_at_utc") != "", F.col("published_at_utc"))).alias("first_seen"), F.max(F.when(F.col("published_at_utc") != "", F.col("published_at_utc"))).alias("last_seen"),
        real("importance_score").alias("importance"), real("market_impact_score").alias("impact"), real("urgency_score").alias("urgency"), real("source_trust").alias("source_trust_max"),
    )
    lists = {"countries": "countries", "assets": "affected_assets", "actors": "geopolitical_entities"}
    every = F.concat(*(F.transform(F.coalesce(c, F.array().cast("array<string>")), _named(n)) for n, c in lists.items()))
    sets = a.select("event_cluster_id", F.explode(every).alias("e")).select("event_cluster_id", "e.k", "e.v").distinct()
    sets = sets.groupBy("event_cluster_id").agg(*(F.array_join(F.array_sort(F.collect_list(F.when(F.col("k") == F.lit(n), F.col("v")))), ",").alias(n) for n in lists))
    x = base.join(sets, "event_cluster_id", "left").withColumn("escalation", F.when(F.col("articles") >= 5, "escalating").otherwise("steady"))
    return x.withColumns({n: F.coalesce(n, F.lit("")) for n in lists})


_BEST = "coalesce(case when isnan(importance_score) then null else importance_score end, 0e0) + coalesce(case when isnan(source_trust) then null else source_trust end, 0e0)"


@query("cluster_top3", f"select event_cluster_id, article_seq, r as rank from (select event_cluster_id, article_seq, row_number() over (partition by event_cluster_id order by round({_BEST}, 6) desc, coalesce(published_at_utc, ''), article_seq) r from articles where event_cluster_id <> '') where r <= 3")
def cluster_top3(s, d):
    best = F.round(number(F.col("importance_score")) + number(F.col("source_trust")), 6)
    x = load(s, d, "articles").where("event_cluster_id <> ''").select("event_cluster_id", "article_seq", best.alias("b"), F.coalesce("published_at_utc", F.lit("")).alias("p"))
    w = Window.partitionBy("event_cluster_id").orderBy(F.col("b").desc(), "p", "article_seq")
    return x.withColumn("rank", F.row_number().over(w)).where("rank <= 3").select("event_cluster_id", "article_seq", "rank")


@query("stale_counts", f"select event_cluster_id, article_count as stored, articles as counted from ({SQL_CLUSTERS}) join ({SQL_ROLL}) using (event_cluster_id) where article_count is distinct from articles")
def stale_counts(s, d):
    n = load(s, d, "articles").where("event_cluster_id <> ''").groupBy("event_cluster_id").agg(F.count_distinct("article_id").alias("counted"))
    return clusters(s, d).select("event_cluster_id", F.col("article_count").alias("stored")).join(n, "event_cluster_id").where(~F.col("stored").eqNullSafe(F.col("counted")))


@query("entity_jaccard", f"select article_seq, round(case when len(a) = 0 or len(b) = 0 then 0e0 else len(list_intersect(a, b)) / cast(len(list_distinct(list_concat(a, b))) as double) end, 6) as jaccard from (select article_seq, event_cluster_id, list_distinct(countries) a from articles) join (select event_cluster_id, list_distinct(countries) b from ({SQL_CLUSTERS})) using (event_cluster_id)")
def entity_jaccard(s, d):
    c = clusters(s, d).select("event_cluster_id", F.array_distinct("countries").alias("b"))
    x = load(s, d, "articles").select("article_seq", "event_cluster_id", F.array_distinct("countries").alias("a")).join(c, "event_cluster_id")
    j = F.size(F.array_intersect("a", "b")) / F.size(F.array_union("a", "b"))
    return x.select("article_seq", F.round(F.when((F.size("a") == 0) | (F.size("b") == 0), 0.0).otherwise(j), 6).alias("jaccard"))


# ---- the catalogue

TIER1 = ["primary_official", "official_corporate", "international_institution", "exchange", "regulator", "statistics_agency"]  # fixed values
CLASSES = [*TIER1, "major_news", "specialist_media", "aggregator", "unknown"]
_Q = lambda xs: ", ".join(f"'{x}'" for x in xs)
TIER = f"coalesce(tier, case when source_class in ({_Q(TIER1)}) then 1 when source_class = 'major_news' then 2 when source_class = 'specialist_media' then 3 else 4 end)"


@query("enabled_sources", "select id from sources where coalesce(enabled, true) and coalesce(url, '') <> ''")
def enabled_sources(s, d):
    return load(s, d, "sources").where("coalesce(enabled, true) and coalesce(url, '') <> ''").select("id")


@query("normalized_sources", f"select id, case when format in ('auto', 'rss', 'atom') then format else 'auto' end as format, case when source_class in ({_Q(CLASSES)}) then source_class else 'unknown' end as source_class, coalesce(trust_score, cast(round(trust * 100) as int), 50) as trust_score, greatest(0, least(1, coalesce(trust_score, cast(round(trust * 100) as int), 50) / 100e0)) as trust, {TIER} as tier from sources")
def normalized_sources(s, d):
    score = F.coalesce("trust_score", F.round(F.col("trust") * 100).cast("int"), F.lit(50))
    return load(s, d, "sources").select("id", F.when(F.col("format").isin("auto", "rss", "atom"), F.col("format")).otherwise("auto").alias("format"), F.when(F.col("source_class").isin(*CLASSES), F.col("source_class")).otherwise("unknown").alias("source_class"), score.alias("trust_score"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), score / 100.0)).alias("trust"), F.expr(TIER).alias("tier"))


DIMENSIONS = ["tier", "source_class", "region", "country", "language", "primary_category"]


@query("coverage_metrics", "with e as (select cast(" + TIER + " as varchar) tier, source_class, region, country, language, primary_category from sources where coalesce(enabled, true)) select dimension, value, n, round(n / cast(sum(n) over (partition by dimension) as double), 4) as share from (" + " union all ".join(f"select '{c}' as dimension, coalesce({c}, 'unknown') as value, count(*) as n from e group by 2" for c in DIMENSIONS) + ")")
def coverage_metrics(s, d):
    e = load(s, d, "sources").where("coalesce(enabled, true)").withColumn("tier", F.expr(TIER).cast("string"))
    x = e.select(F.explode(F.array(*(F.struct(F.lit(c).alias("dimension"), F.coalesce(c, F.lit("unknown")).alias("value")) for c in DIMENSIONS))).alias("x")).groupBy("x.dimension", "x.value").agg(F.count("*").alias("n"))
    return x.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("dimension")), 4))


_WHERE = lambda c: f"coalesce(nullif({c}, ''), '?')"
_TOP = lambda c: f"(select {{}} from (select {_WHERE(c)} v, count(*) n from e group by 1 order by n desc, v limit 1))"


@query("coverage_summary", f"""with e as (select *, {TIER} t from sources where coalesce(enabled, false)) select count(*) as enabled_total, round(count_if(t = 1) / count(*)::double, 4) as tier1_share, round(count_if(country = 'JP') / count(*)::double, 4) as japan_share, round(count_if(country = 'US') / count(*)::double, 4) as us_share,
 round(count_if(source_class in ({_Q(TIER1)})) / count(*)::double, 4) as primary_source_share, count(distinct {_WHERE('region')}) as region_diversity, count(distinct {_WHERE('primary_category')}) as category_diversity, count(distinct {_WHERE('language')}) as language_diversity,
 {_TOP('region').format('v')} as top_region, round({_TOP('region').format('n')} / count(*)::double, 4) as top_region_share, {_TOP('primary_category').format('v')} as top_category, round({_TOP('primary_category').format('n')} / count(*)::double, 4) as top_category_share from e""")
def coverage_summary(s, d):
    """How widely the enabled sources spread, in one row; of equal tops the first by name. No row without sources."""
    e = load(s, d, "sources").where("coalesce(enabled, false)").withColumn("t", F.expr(TIER))
    named = {c: F.coalesce(F.when(F.col(c) != "", F.col(c)), F.lit("?")) for c in ("region", "primary_category", "language")}
    e = e.withColumns({f"_{c}": v for c, v in named.items()})
    n = F.count("*")
    share = lambda c, a: F.round(F.count_if(c) / n, 4).alias(a)
    x = e.agg(n.alias("enabled_total"), share(F.col("t") == 1, "tier1_share"), share(F.col("country") == "JP", "japan_share"), share(F.col("country") == "US", "us_share"), share(F.col("source_class").isin(*TIER1), "primary_source_share"), *(F.count_distinct(f"_{c}").alias(f"{a}_diversity") for c, a in (("region", "region"), ("primary_category", "category"), ("language", "language"))))
    for c, a in (("region", "region"), ("primary_category", "category")):
        top = e.groupBy(f"_{c}").agg(F.count("*").alias("k")).agg(F.min(F.struct((-F.col("k")).alias("m"), F.col(f"_{c}").alias("v"))).alias(f"top_{a}"))
        x = x.join(F.broadcast(top), F.lit(True))  # one row each
        x = x.withColumn(f"top_{a}_share", F.round(-F.col(f"top_{a}.m") / F.col("enabled_total"), 4)).withColumn(f"top_{a}", F.col(f"top_{a}.v"))
    return x.where("enabled_total > 0")


@query("coverage_gaps", f"""with e as (select {TIER} t, country, region from sources where coalesce(enabled, true)), m as (select count(*) n, count_if(country = 'JP') jp, count_if(country = 'US') us, count_if(t = 1) t1, (select max(c) from (select count(*) c from e group by region)) top from e)
select unnest([case when jp / n::double < 0.12 then 'japan_low' end, case when us / n::double < 0.18 then 'us_low' end, case when top / n::double > 0.35 then 'region_high' end, case when t1 / n::double < 0.35 then 'tier1_low' end]) as gap from m""")
def coverage_gaps(s, d):
    e = load(s, d, "sources").where("coalesce(enabled, true)").select(F.expr(TIER).alias("t"), "country", "region")
    top = e.groupBy("region").count().agg(F.max("count").alias("top"))
    m = e.agg(F.count("*").alias("n"), *(F.count_if(c).alias(a) for a, c in (("jp", F.col("country") == "JP"), ("us", F.col("country") == "US"), ("t1", F.col("t") == 1)))).join(F.broadcast(top), F.lit(True))  # one row each
    part = lambda a: F.col(a) / F.col("n")
    return m.select(F.explode(F.array(F.when(part("jp") < 0.12, "japan_low"), F.when(part("us") < 0.18, "us_low"), F.when(part("top") > 0.35, "region_high"), F.when(part("t1") < 0.35, "tier1_low"))).alias("gap"))


@query("validate_sources", f"""select id, 'name' as problem from sources where coalesce(name, '') = '' union all select id, 'url' from sources where coalesce(url, '') = '' union all select id, 'class' from sources where source_class is null or source_class not in ({_Q(CLASSES)})
 union all select id, 'tier' from sources where tier is null or tier not between 1 and 4 union all select id, 'trust' from sources where trust_score is null or trust_score not between 0 and 100 union all select id, 'max_items' from sources where max_items_per_fetch <= 0
 union all select id, 'country' from sources where coalesce(country, '') = '' and source_class <> 'international_institution' union all select id, 'duplicate_id' from sources group by id having count(*) > 1
 union all select min(id), 'duplicate_url' from sources group by url having count(*) > 1 union all select id, 'unverified' from sources where enabled and verify_status is not null and verify_status <> 'verified_healthy'""")
def validate_sources(s, d):
    x = load(s, d, "sources")
    rules = {"name": "coalesce(name, '') = ''", "url": "coalesce(url, '') = ''", "class": f"source_class is null or source_class not in ({_Q(CLASSES)})", "tier": "tier is null or tier not between 1 and 4", "trust": "trust_score is null or trust_score not between 0 and 100", "max_items": "max_items_per_fetch <= 0", "country": "coalesce(country, '') = '' and source_class <> 'international_institution'", "unverified": "enabled and verify_status is not null and verify_status <> 'verified_healthy'"}
    broken = F.array_compact(F.array(*(F.when(F.expr(r), p) for p, r in rules.items())))  # one pass over the rows
    out = x.select("id", F.explode(broken).alias("problem"))
    twice = x.groupBy("id").count().where("count > 1").select("id", F.lit("duplicate_id").alias("problem"))
    urls = x.groupBy("url").agg(F.min("id").alias("id"), F.count("*").alias("n")).where("n > 1").select("id", F.lit("duplicate_url").alias("problem"))
    return out.unionByName(twice).unionByName(urls)


def sql_name_key(c: str) -> str:
    return f"lower(regexp_replace(translate({c}, '{(WIDE + DASHES).replace(chr(39), chr(39) * 2)}', '{(ASCII + '-' * len(DASHES)).replace(chr(39), chr(39) * 2)}'), '[\\s\\p{{Z}}]+|[\\x{{00AD}}\\x{{200B}}-\\x{{200F}}\\x{{2060}}\\x{{FEFF}}]', '', 'g'))"


_KEYED = sql_name_key("source")


@query("per_source_stats", f"select coalesce({_KEYED}, '') as source, count(*) as runs, cast(sum(coalesce(fetched, 0)) as bigint) as fetched, cast(sum(coalesce(new_items, 0)) as bigint) as new_items, count_if(status = 'failed') as failures from ({_DONE}) group by 1")
def per_source_stats(s, d):
    """All sources, whatever their spelling; null and blank ones are ''."""
    x = load(s, d, "source_results").distinct()
    return x.groupBy(F.coalesce(name_key(F.col("source")), F.lit("")).alias("source")).agg(F.count("*").alias("runs"), F.sum(F.coalesce("fetched", F.lit(0))).alias("fetched"), F.sum(F.coalesce("new_items", F.lit(0))).alias("new_items"), F.count_if(F.col("status") == "failed").alias("failures"))
