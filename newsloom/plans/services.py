"""Sources, private texts and package parts, over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import pipeline
from ..functions import classify, times, views
from ..functions.scoring import number
from ..operators import building, history, private
from ..sources import apis, feeds
from ..tables import load
from . import matching, rollups, store
from .common import Registry, now_column
from .scalars import GAP, SQL_HOST, SQL_SANE, SQL_URL, classified_sql, sql_norm, sql_plain

query = Registry()
_DT = "case article_seq % 4 when 0 then '120' when 1 then '350' when 2 then '180' else '999' end"
_KIND = "case article_seq % 4 when 0 then 'earnings' when 1 then 'large_shareholding' end"
SQL_BY_TEXT = "case " + " ".join(f"when regexp_matches(x, '{'|'.join(classify.pattern(w) for w in ws)}') then '{k}'" for k, ws in classify.DISCLOSURES) + " else 'other' end"
_HIGH = ", ".join(f"'{x}'" for x in classify.HIGH)


@query("edinet_map", f"""select article_id as doc_id, coalesce(nullif(t, ''), regexp_replace(src || '（' || dt || '）', '^[（）]+|[（）]+$', '', 'g')) as title, 'https://disclosure2.edinet-fsa.go.jp/WEEK0010.aspx?docID=' || article_id as url, substr(t, 1, 400) as description, '2026-07-01T00:30:00+00:00' as published_at_utc, '2026-07-01 09:30' as published_raw,
 src as company_name, coalesce({_KIND}, k) as disclosure_type, case when k = 'other' then 'low' when k in ({_HIGH}) then 'high' else 'medium' end as materiality, article_seq % 3 = 0 as is_correction from (select *, {SQL_BY_TEXT} k from (select article_id, article_seq, coalesce(title_original, '') t, coalesce(source_name, '') src, {_DT} dt, lower(coalesce(title_original, '') || ' ' || {_DT}) x from articles where article_seq % 10 <> 9 and coalesce(trim(article_id), '') <> ''))""")
def edinet_map(s, d):
    """The store written as disclosure payloads and read back; documents without an id are none."""
    doc = F.struct(F.col("article_id").alias("docID"), F.col("source_country").alias("edinetCode"), F.col("source_name").alias("filerName"), F.expr(_DT).alias("docTypeCode"), F.col("title_original").alias("docDescription"), F.lit("2026-07-01 09:30").alias("submitDateTime"), F.when(F.col("article_seq") % 10 == 9, "1").otherwise("0").alias("withdrawalStatus"), F.when(F.col("article_seq") % 3 == 0, "P").alias("parentDocID"))
    body = load(s, d, "articles").select(F.lit("u").alias("url"), F.to_json(F.struct(F.array(doc).alias("results"))).alias("body"))
    return apis.edinet(body).select("doc_id", "title", "url", "description", "published_at_utc", "published_raw", "company_name", "disclosure_type", "materiality", "is_correction")


_ESTAT = "select cast(doc_id as varchar) as doc_id, coalesce(source, '') as gov_org, trim(coalesce(category, '') || ' ' || coalesce(title, '')) as series_name from documents"


@query("estat_map", f"select doc_id, '[統計更新] ' || series_name as title, 'https://www.e-stat.go.jp/dbview?sid=' || doc_id as url, substr(series_name, 1, 400) as description, series_name, gov_org, case when contains(series_name, 'copper') then 'copper' else 'freight' end as category from ({_ESTAT}) where contains(series_name, 'copper') or contains(series_name, 'freight')")
def estat_map(s, d):
    text = lambda c: F.struct(F.coalesce(F.col(c), F.lit("")).alias("$"))
    t = F.struct(F.col("doc_id").cast("string").alias("@id"), text("category").alias("STAT_NAME"), F.coalesce("title", F.lit("")).alias("TITLE"), text("source").alias("GOV_ORG"))
    lone = F.to_json(F.struct(F.struct(F.struct(t.alias("TABLE_INF")).alias("DATALIST_INF")).alias("GET_STATS_LIST")))
    many = F.to_json(F.struct(F.struct(F.struct(F.array(t).alias("TABLE_INF")).alias("DATALIST_INF")).alias("GET_STATS_LIST")))
    body = load(s, d, "documents").select(F.lit("u").alias("url"), F.when(F.col("doc_id") % 2 == 0, lone).otherwise(many).alias("body"))
    return apis.estat(body, ["copper", "freight"]).select("doc_id", "title", "url", "description", "series_name", "gov_org", "category")


_BARE = lambda c: f"regexp_replace(regexp_replace(coalesce({c}, ''), '^' || {GAP}, ''), {GAP} || '$', '')"


@query("feed_items", f"""select cast(article_seq as varchar) as feed, {sql_plain('title_original')} as title, {_BARE('canonical_url')} as url, substr({sql_plain('description')}, 1, 400) as description, {_BARE('raw_published_at')} as published_raw, '' as updated_raw, {sql_plain('source_name')} as source
 from articles where {_BARE('title_original')} <> '' or {_BARE('canonical_url')} <> ''""")
def feed_items(s, d):
    """Every article as a feed payload, read back by the lenient reader."""
    esc = lambda c: F.replace(F.replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    item = F.concat(F.lit("<item><title>"), esc("title_original"), F.lit("</title><link>"), esc("canonical_url"), F.lit("</link><description>"), esc("description"), F.lit("</description><pubDate>"), esc("raw_published_at"), F.lit("</pubDate></item>"))
    body = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><rss><channel><title>'), esc("source_name"), F.lit("</title>"), item, F.lit("</channel></rss>"))
    return feeds.parse(load(s, d, "articles").select(F.col("article_seq").cast("string").alias("url"), F.encode(body, "UTF-8").alias("content")))


@query("whitelist_match", "select article_seq, case when contains(title_original, 'copper') then 'copper' when contains(title_original, 'shipping') then 'shipping' when contains(title_original, '銅') then '銅' end as term from articles")
def whitelist_match(s, d):
    return load(s, d, "articles").select("article_seq", apis.whitelisted(F.col("title_original"), ["copper", "shipping", "銅"]).alias("term"))


@query("doctype_lookup", "select article_seq, case cast(100 + 10 * (article_seq % 30) as varchar) " + " ".join(f"when '{k}' then '{v}'" for k, v in apis.DOCTYPES.items()) + " end as kind from articles")
def doctype_lookup(s, d):
    return load(s, d, "articles").select("article_seq", apis.doctype((100 + 10 * (F.col("article_seq") % 30)).cast("string")).alias("kind"))


_HAS = f"length(regexp_replace(coalesce(text, ''), {GAP}, '', 'g')) > 0"


def _listed(xs) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]::varchar[]"


def _play(c: str, part: int) -> str:
    return f"case {c} " + " ".join(f"when '{k}' then {_listed(v[part])}" for k, v in private.PLAYBOOK.items()) + f" else {_listed(private.DEFAULT_PLAY[part])} end"


def _joined(x: str) -> str:
    return f"coalesce(array_to_string({x}, ','), '')"


_EVIDENCE = "case article_seq % 5 when 0 then 'article_based_hypothesis' when 1 then 'market_confirmed' when 2 then 'historically_supported' when 3 then 'speculative' else 'rumour' end"
_CAP = "case e when 'market_confirmed' then 0.85e0 when 'historically_supported' then 0.75e0 when 'speculative' then 0.4e0 else 0.6e0 end"
_LABEL = "coalesce(nullif(theme, ''), '記事テーマ')"
_SCENES = ", ".join(f"('{t}', '{n}', '{p}', {c}e0, '{h}')" for t, n, p, c, h in private.SCENARIOS)


@query("forecasts", f"""select 'fc_' || substr(sha256(cast(article_seq as varchar) || '|' || t), 1, 12) as forecast_id, article_seq, '2026-07-15T00:00:00+00:00' as created_at, h as horizon, t as scenario_type, replace(n, '%s', {_LABEL}) as scenario_title, p as probability_range,
 replace(n, '%s', {_LABEL}) || 'する可能性（記事ベースの仮説であり断定ではない）' as prediction, {_LABEL} || '関連の発表・受注・投資計画の増減' as expected_developments, '日本株,関連コモディティ/為替' as affected_markets, {_joined(f'list_concat({_play("theme", 2)}, {_play("theme", 3)})')} as affected_sectors,
 {_joined(_play('theme', 0))} as leading_indicators, {_joined(f"list_transform(({_play('theme', 0)})[1:2], lambda x: x || 'の記事方向への変化')")} as confirmation_triggers, {_joined(_play('theme', 1))} as invalidation_triggers, '2026-08-14' as next_review_date,
 round(least(b, 0.6e0), 2) as confidence, 'article_based_hypothesis' as evidence_level, 'pending' as validation_status from (select article_seq, primary_category as theme from articles), (values {_SCENES}) v(t, n, p, b, h)""")
def forecasts(s, d):
    return views.flat(private.forecasts(load(s, d, "articles"), "article_seq", F.col("primary_category"), now_column()))


@query("confidence_caps", f"select article_seq, round(least(coalesce(try_cast(case when article_seq % 7 = 0 then 'high' else cast(importance_score as varchar) end as double), 0e0), {_CAP}), 2) as confidence from (select article_seq, case when isnan(importance_score) then null else round(importance_score, 2) end importance_score, {_EVIDENCE} e from articles)")
def confidence_caps(s, d):
    score = F.when(~F.isnan("importance_score"), F.round("importance_score", 2))
    said = F.when(F.col("article_seq") % 7 == 0, "high").otherwise(score.cast("string"))
    return load(s, d, "articles").select("article_seq", private.capped(said, F.expr(_EVIDENCE)).alias("confidence"))


# a dictionary of few words, so that the SQL side ends soon; the operator takes any
_THEMES = {"ai": ["data works", "cloud contract"], "fx": ["currency", "Kronen"], "oil": ["refinery", "石油"], "semiconductor": ["optics", "robotics"], "shipping": ["freight", "harbour", "海運"]}
_BODY = "coalesce(text, '')"
_TITLE = "coalesce(title, '')"
SQL_ANALYSIS = f"""with d as (select doc_id as article_seq, {_TITLE} as _t, {_BODY} as _b, coalesce(nullif({_TITLE}, ''), substr({_BODY}, 1, 80)) as title_original, substr({_BODY}, 1, 2000) as description from documents),
 k as ({classified_sql(_THEMES, 'd')})
select article_seq as doc_id, coalesce(nullif(category, 'uncategorized'), '') as theme, category as primary_category, themes, regexp_matches(_t || substr(_b, 1, 500), '{'|'.join(private.URGENT_HINTS)}') as urgent, length(_b) as n, _t from d join k using (article_seq)"""


@query("rule_analysis", f"""select doc_id, theme, primary_category, themes, urgent, substr('「' || _t || '」に関するprivate保存記事。主テーマは' || coalesce(nullif(theme, ''), '特定テーマなし') || '。本文' || n || '字。' || case when urgent then '緊急性の高い語を含む。' else '' end, 1, 200) as summary_200,
 {_joined(_play('theme', 2))} as beneficiary_sectors, {_joined(_play('theme', 3))} as headwind_sectors, coalesce(nullif(theme, ''), '特定テーマなし') || ',関連業種の受注・投資,関連銘柄の業績期待' as causal_chain from ({SQL_ANALYSIS})""")
def rule_analysis(s, d):
    x = private.analysis(load(s, d, "documents"), "doc_id", body="text", keywords=_THEMES)
    return views.flat(x.select("doc_id", "theme", "primary_category", "themes", "urgent", "summary_200", "beneficiary_sectors", "headwind_sectors", "causal_chain"))


@query("derived_summary", f"""select doc_id, themes, {_joined(_play('theme', 2))} as industries, {_joined(_play('theme', 2))} as sectors, '日本株,関連コモディティ/為替' as related_assets, 0.5e0 as importance_score, 0.5e0 as structural_score, '主テーマ' || coalesce(nullif(theme, ''), '特定テーマなし') || 'は保存時点でユーザーが注目した領域であり、テーマ蓄積の材料になる' as impression_hint,
 {_joined(f"list_transform([{', '.join(chr(39) + n + chr(39) for _, n, *_x in private.SCENARIOS)}], lambda x: replace(x, '%s', coalesce(nullif(theme, ''), '記事テーマ')))")} as scenarios, 'base 0.55 1m,upside 0.35 3m,downside 0.35 3m,tail_risk 0.15 1y' as outlook, {_joined(f"({_play('theme', 0)})[1:4]")} as indicators, 0.55e0 as confidence, '2026-08-14' as next_review_date from ({SQL_ANALYSIS})""")
def derived_summary(s, d):
    """What may be shown of private texts, here the documents."""
    x = private.derived_summary(private.analysis(load(s, d, "documents"), "doc_id", body="text", keywords=_THEMES), "doc_id", now_column())
    f = F.col("forecast_summary")
    outlook = F.transform(f, lambda y: F.concat_ws(" ", y["scenario_type"], y["confidence"].cast("string"), y["horizon"]))
    x = x.withColumn("scenarios", F.transform(f, lambda y: y["scenario_title"])).withColumn("outlook", outlook).withColumn("indicators", f[0]["leading_indicators"])
    return views.flat(x.drop("forecast_summary", "short_summary"))


@query("private_records", f"""select 'pai_' || substr(body_hash, 1, 20) as private_article_id, title, n as character_count, submissions from (select sha256(regexp_replace(text, {GAP}, '', 'g')) as body_hash, count(*) as submissions, coalesce(nullif(arg_min(coalesce(title, ''), published_at), ''), '無題のprivate記事（' || strftime(min(published_at) + interval 9 hours, '%m/%d %H:%M') || '保存）') as title,
 arg_min(length(regexp_replace(regexp_replace(text, '^' || {GAP}, ''), {GAP} || '$', '')), published_at) as n from documents where {_HAS} and length(text) <= 30000 and published_at is not null group by 1)""")
def private_records(s, d):
    """The metadata of private texts, one per body, here of the dated documents."""
    good, _ = private.intake(load(s, d, "documents").where("published_at is not null").select("title", F.col("text").alias("body"), F.col("published_at").alias("submitted_at")))
    return private.records(good).select("private_article_id", "title", "character_count", "submissions")


@query("intake_checks", f"select case when length(regexp_replace(coalesce(text, ''), {GAP}, '', 'g')) = 0 then 'empty' when length(text) > 30000 then 'too_long' else 'accepted' end as outcome, count(*) as n from documents group by 1")
def intake_checks(s, d):
    good, bad = private.intake(load(s, d, "documents").select("doc_id", F.col("text").alias("body")))
    return good.select(F.lit("accepted").alias("outcome")).unionByName(bad.select(F.col("reason").alias("outcome"))).groupBy("outcome").agg(F.count("*").alias("n"))


@query("resubmissions", f"""with g as (select *, sha256(regexp_replace(text, {GAP}, '', 'g')) as body_hash from documents where {_HAS} and length(text) <= 30000),
 n as (select body_hash, title as note, min(published_at) as t0 from g where length(regexp_replace(coalesce(title, ''), {GAP}, '', 'g')) > 0 group by 1, 2)
select body_hash, min(doc_id) as private_id, count(*) as submissions, cast(epoch(min(published_at)) as bigint) as first_at, cast(epoch(max(published_at)) as bigint) as last_at, coalesce(any_value(notes), '') as notes
 from g left join (select body_hash, string_agg(note, chr(10) order by t0 asc nulls first, note) as notes from n group by 1) using (body_hash) group by body_hash""")
def resubmissions(s, d):
    """One record per body, with its first and last submission and its different notes in order of time."""
    good, _ = private.intake(load(s, d, "documents").select(F.col("doc_id").alias("private_id"), F.col("text").alias("body"), F.col("title").alias("user_note"), F.col("published_at").alias("submitted_at")))
    return private.merged(good).select("body_hash", "private_id", "submissions", F.unix_seconds("first_at").alias("first_at"), F.unix_seconds("last_at").alias("last_at"), "notes")


@query("pending_records", "select article_seq from articles where classification_status in ('stored', 'queued', 'needs_review', 'failed', 'pending', 'error')")
def pending_records(s, d):
    """Rows whose state is one of those that wait, of private texts or of the store."""
    return load(s, d, "articles").where(F.col("classification_status").isin(*private.PENDING, "pending", "error")).select("article_seq")


_FETCHED = "2026-07-15T00:00:00+00:00"
SQL_BUILD = f"""with h as ({SQL_URL}), z as ({SQL_SANE})
select a.article_seq as seq, coalesce(s.id, '') as source_id, 'art_' || substr(sha256(h.url), 1, 24) as article_id, h.url as canonical_url, coalesce(a.canonical_url, '') as normalized_url, coalesce(s.name, '') as source_name, coalesce({SQL_HOST}, '') as source_domain, coalesce(s.trust, 0.5e0) as source_trust, coalesce(s.language, 'ja') as language,
 coalesce(title_original, '') as title_original, coalesce(description, '') as description, substr(coalesce(description, ''), 1, 200) as public_excerpt, coalesce(description, '') <> '' as body_available, coalesce(s.country, '') as countries, case when z.inferred then '{_FETCHED}' else z.published end as published_at_utc, z.inferred as date_inferred, z.raw as raw_published_at,
 sha256(h.url) as canonical_hash, sha256({sql_norm('title_original')}) as title_hash, sha256({sql_norm('title_original')} || '|' || {sql_norm('description')}) as content_hash
 from articles a join h using (article_seq) join z using (article_seq) left join sources s on s.name = a.source_name"""


@query("build_articles", SQL_BUILD)
def build_articles(s, d):
    """The whole chain over the store's rows as raw records of the sources that they name; scores and categories, which
    other queries compare, are left out here."""
    src = load(s, d, "sources")
    by_name = src.groupBy(F.col("name").alias("source_name")).agg(F.min("id").alias("source_id"))
    raw = load(s, d, "articles").join(by_name, "source_name", "left").select(F.col("article_seq").alias("seq"), F.coalesce("source_id", F.lit("")).alias("source_id"), F.col("title_original").alias("title"), F.col("canonical_url").alias("url"), "description", "published_at_utc", F.col("raw_published_at").alias("published_raw"))
    kept = ["seq", "source_id", "article_id", "canonical_url", "normalized_url", "source_name", "source_domain", "source_trust", "language", "title_original", "description", "public_excerpt", "body_available", "countries", "published_at_utc", "date_inferred", "raw_published_at", "canonical_hash", "title_hash", "content_hash"]
    return views.flat(building.build_articles(raw, src, now_column()).select(*kept))


_FIRST = "article_seq = (select a.article_seq from a join articles x using (article_seq) where a.t is not null and len(a.e) > 0 order by coalesce(case when isnan(x.importance_score) then null else x.importance_score end, 0) desc, a.t desc, a.article_seq limit 1)"
_COUNTED = {
    **{k: rollups.query.oracles[n] for k, n in (("theme_summary", "theme_summary"), ("global_drivers", "global_drivers"), ("risk_radar", "risk_radar"), ("market_reactions", "reaction_view"), ("event_clusters", "event_clusters"), ("quality_metrics", "quality_metrics"))},
    **{k: store.query.oracles[k] for k in ("source_health", "store_status")}, "hot_articles": matching.query.oracles["hot_articles"], "historical_matches": matching.SQL_HISTORY.replace("article_seq % 20 = 0", _FIRST),
}


@query("published_package", " union all ".join(f"select '{k}' as part, (select cast(count(*) as int) from ({q})) as items" for k, q in sorted(_COUNTED.items())))
def published_package(s, d):
    """Item counts of the package built from the tables; the history is that of its most important article."""
    a = load(s, d, "articles")
    e = history.entities(*history.KINDS)
    x = a.select("article_seq", e.alias("e"), F.date_trunc("second", times.parse_iso(F.col("published_at_utc"))).alias("t"), number(F.col("importance_score")).alias("i"))
    first = x.where("t is not null and size(e) > 0").orderBy(F.col("i").desc(), F.col("t").desc(), "article_seq").limit(1)
    found = history.matches(first.select(F.col("article_seq").alias("cur"), "t", "e"), x.where("t is not null").select(F.col("article_seq").alias("old"), "t", "e"))
    parts = {
        "theme_summary": rollups.theme_summary(s, d), "global_drivers": rollups.global_drivers(s, d), "risk_radar": rollups.risk_radar(s, d), "market_reactions": rollups.reaction_view(s, d), "event_clusters": rollups.event_clusters(s, d), "source_health": store.source_health(s, d),
        "store_status": store.store_status(s, d), "quality_metrics": rollups.quality_metrics(s, d), "historical_matches": history.context(found, a, "article_seq").orderBy("rank"),
    }
    p = pipeline.package(a, parts, rollups.reactions(s, d), now_column())
    return s.createDataFrame([(k, len(v)) for k, v in sorted(p.items())], "part string, items int")
