"""Duplicates, selection, history and events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scoring, text, times, views
from ..functions.scoring import number
from ..operators import clustering, dedup, history, selecting
from ..operators import reactions as measured
from ..tables import load
from .common import NOW, Registry, now_column
from .rollups import SQL_REACTION, reactions
from .scalars import SQL_AGE, SQL_VIEW

query = Registry()
SQL_KEYS = "(select article_seq, nullif(canonical_hash, '') as c, nullif(title_hash, '') as t, nullif(content_hash, '') as x, source_domain, source_trust, published_at_utc from articles)"


def _keys(s, d):
    some = lambda c: F.when(F.col(c) != "", F.col(c))
    return load(s, d, "articles").select("article_seq", some("canonical_hash").alias("c"), some("title_hash").alias("t"), some("content_hash").alias("x"), "source_domain", "source_trust", "published_at_utc")


@query("exact_duplicates", f"""select article_seq, count(*) as partners, min(other) as first_partner from (select a.article_seq, b.article_seq as other from {SQL_KEYS} a join {SQL_KEYS} b on a.c = b.c and a.article_seq <> b.article_seq
 union select a.article_seq, b.article_seq from {SQL_KEYS} a join {SQL_KEYS} b on a.x = b.x and a.article_seq <> b.article_seq where a.c is not null) group by 1""")
def exact_duplicates(s, d):
    """Each row's exact duplicates, of its address or of its content: how many and the first. A row without an address
    has none. Classes are counted by groupings, so a class of any size makes no pairs."""
    return dedup.exact_partners(_keys(s, d), "article_seq")


@query("syndicated", f"select a.article_seq, count(*) as partners from {SQL_KEYS} a join {SQL_KEYS} b on a.t = b.t and coalesce(a.source_domain, '') <> coalesce(b.source_domain, '') where not coalesce(a.c is not null and (coalesce(a.c = b.c, false) or coalesce(a.x = b.x, false)), false) group by 1")
def syndicated(s, d):
    """Each row's number of deliveries under its title by other domains that aren't exact duplicates of it."""
    return dedup.syndicated_partners(_keys(s, d), "article_seq", "source_domain")


_TRUST = "coalesce(case when isnan(source_trust) then null else source_trust end, 0e0)"


@query("pick_representative", f"select t as title_hash, article_seq from {SQL_KEYS} where t is not null qualify row_number() over (partition by t order by {_TRUST} desc, coalesce(nullif(published_at_utc, ''), '9999'), article_seq) = 1")
def pick_representative(s, d):
    at = F.coalesce(F.when(F.col("published_at_utc") != "", F.col("published_at_utc")), F.lit("9999"))
    w = Window.partitionBy("t").orderBy(F.col("trust").desc(), "at", "article_seq")
    x = _keys(s, d).where("t is not null").select("article_seq", "t", number(F.col("source_trust")).alias("trust"), at.alias("at"))
    return x.withColumn("r", F.row_number().over(w)).where("r = 1").select(F.col("t").alias("title_hash"), "article_seq")


@query("new_rows", "select incoming_seq from incoming_articles i where not exists (select 1 from articles a where a.canonical_hash = i.canonical_hash and i.canonical_hash <> '') and not exists (select 1 from articles a where a.title_hash = i.title_hash and i.title_hash <> '') and not exists (select 1 from articles a where a.content_hash = i.content_hash and i.content_hash <> '')")
def new_rows(s, d):
    keys = ["canonical_hash", "title_hash", "content_hash"]
    some = [F.when(F.col(k) != "", F.col(k)).alias(k) for k in keys]
    return dedup.known(load(s, d, "incoming_articles").select("incoming_seq", *some), load(s, d, "articles").select(*some), keys).select("incoming_seq")


def sql_first(keys: str) -> str:
    """The rows (article_seq, c, t) that a reader keeps, who takes them one by one."""
    return f"""with recursive t as (select row_number() over (order by article_seq) i, article_seq, case when c is not null then hash('c' || c) end hc, case when t is not null then hash('t' || t) end ht from {keys}),
 r(i, q, keep, seen) as (select 0::bigint, null::bigint, false, []::ubigint[] union all
  select i, article_seq, ok, case when ok then list_concat(seen, list_filter([hc, ht], lambda x: x is not null)) else seen end
  from (select t.i, t.article_seq, hc, ht, seen, not (coalesce(list_contains(seen, hc), false) or coalesce(list_contains(seen, ht), false)) ok from r join t on t.i = r.i + 1))
select q as article_seq from r where keep"""


@query("first_wins", sql_first(SQL_KEYS))
def first_wins(s, d):
    """Order decides: the SQL reads the rows one by one."""
    return dedup.first_wins(_keys(s, d), "article_seq", ["c", "t"])


_CUR = "list_sort(list_distinct(list_filter(list_concat(countries, companies, commodities, geopolitical_entities), x -> x <> '')))".replace("x -> x", "lambda x: x")


SQL_HISTORY = f"""with a as (select article_seq, {_CUR} e, cast(floor({SQL_AGE}) as bigint) t, cast(epoch(timestamp '{NOW}') as bigint) n from articles), m as (
 select c.article_seq cur, o.article_seq old, any_value(list_sort(list_intersect(c.e, o.e))) shared, round(least(1e0, 0.7e0 * (len(list_intersect(c.e, o.e)) / len(list_distinct(list_concat(c.e, o.e)))::double) + 0.3e0 * greatest(0e0, 1 - (c.t - o.t) / 86400e0 / 730)), 4) relevance
 from (select article_seq, e, coalesce(t, n) t, unnest(e) u from a where article_seq % 20 = 0) c join (select *, unnest(e) u from a) o on c.u = o.u and c.article_seq <> o.article_seq and c.t > o.t and (c.t - o.t) / 86400e0 <= 730 group by all)
select cur, old, shared, relevance, r as rank from (select *, row_number() over (partition by cur order by relevance desc, old) r from m) where r <= 20"""


@query("historical_matches", f"select cur, old, relevance, rank from ({SQL_HISTORY})")
def historical_matches(s, d):
    """Every twentieth row is a query against all rows; now holds for one without a readable time."""
    e = history.entities(*history.KINDS)
    x = load(s, d, "articles").select("article_seq", e.alias("e"), F.date_trunc("second", times.parse_iso(F.col("published_at_utc"))).alias("t"))
    current = x.where("article_seq % 20 = 0").select(F.col("article_seq").alias("cur"), F.coalesce("t", now_column()).alias("t"), "e")
    return history.matches(current, x.where("t is not null").select(F.col("article_seq").alias("old"), "t", "e"))


@query("historical_context", f"""select cur, rank, coalesce(nullif(event_cluster_id, ''), article_id) as historical_event_id, title_original as title, coalesce(nullif(published_at_jst, ''), published_at_utc) as date, relevance as relevance_score, array_to_string(shared, ',') as related_entities,
 coalesce(array_to_string(affected_assets, ','), '') as related_assets, priced_in_status as observed_market_reaction, substr(coalesce(nullif(public_excerpt, ''), description, ''), 1, 140) as short_context, 1 as source_count from ({SQL_HISTORY}) join articles on old = article_seq""")
def historical_context(s, d):
    """The nine columns of each match that a package shows."""
    a = load(s, d, "articles")
    return views.flat(history.context(historical_matches(s, d), a, "article_seq"))


# ---- scores and selection

_N = lambda c: f"coalesce(case when isnan({c}) then null else {c} end, 0e0)"
SQL_RETRIEVAL = f"""select article_seq, source_domain as src, coalesce(themes[1], primary_category) as theme, event_cluster_id as cluster,
 round(greatest(0e0, least(1e0, 0.25e0 * rel + 0.25e0 * rea + 0.15e0 * fresh + 0.1e0 * least(1e0, tr) + 0.1e0 * ur + 0.1e0 * st + 0.05e0 * 0.25e0)) * 100, 6) as score from (
 select a.*, case when (imp + mi) / 2 = 0 then 0.5e0 else least(1e0, (imp + mi) / 2) end rel, case when coalesce(r.has_reaction, false) then greatest(0.3e0, least(1e0, r.magnitude)) else 0e0 end rea from (
  select *, {_N('importance_score')} imp, {_N('market_impact_score')} mi, {_N('freshness_score')} fresh, {_N('source_trust')} tr, {_N('urgency_score')} ur, {_N('structural_score')} st from articles) a
 left join ({SQL_REACTION}) r using (event_cluster_id))"""


def scored(s, d):
    a, r = load(s, d, "articles"), reactions(s, d)
    imp, mi = number(F.col("importance_score")), number(F.col("market_impact_score"))
    relevance = F.when((imp + mi) / 2 == 0, 0.5).otherwise(F.least(F.lit(1.0), (imp + mi) / 2))
    parts = {
        "relevance": relevance, "market_reaction": scoring.reaction(F.coalesce("has_reaction", F.lit(False)), F.coalesce("magnitude", F.lit(0.0))), "freshness": number(F.col("freshness_score")),
        "source_trust": F.least(F.lit(1.0), number(F.col("source_trust"))), "urgency": number(F.col("urgency_score")), "structural": number(F.col("structural_score")), "independent_source_confirmation": scoring.confirmation(F.lit(1)),
    }
    theme = F.coalesce(F.try_element_at("themes", F.lit(1)), F.col("primary_category"))
    return a.join(r, "event_cluster_id", "left").select("article_seq", F.col("source_domain").alias("src"), theme.alias("theme"), F.col("event_cluster_id").alias("cluster"), scoring.retrieval(parts, digits=6).alias("score"))


@query("retrieval_score", SQL_RETRIEVAL)
def retrieval_score(s, d):
    return scored(s, d)


@query("top_retrieval", f"select article_seq, score from ({SQL_RETRIEVAL}) order by score desc, article_seq limit 100")
def top_retrieval(s, d):
    return scored(s, d).select("article_seq", "score").orderBy(F.col("score").desc(), "article_seq").limit(100)


def sql_diverse(scored: str, target: int, source_cap: int, theme_cap: int) -> str:
    """The capped selection row by row."""
    full = lambda name, v, cap: f"len(list_filter({name}, lambda x: x = {v})) >= {cap}"
    return f"""with recursive t as (select row_number() over (order by score desc, article_seq) i, article_seq, score, coalesce(src, '') s, coalesce(theme, '') h, coalesce(cluster, '') c from ({scored})),
 r(i, q, score, keep, ss, hs, cs) as (select 0::bigint, null::bigint, null::double, false, []::varchar[], []::varchar[], []::varchar[] union all
  select i, article_seq, score, ok, case when ok then list_append(ss, s) else ss end, case when ok then list_append(hs, h) else hs end, case when ok then list_append(cs, c) else cs end
  from (select t.*, ss, hs, cs, not ({full('ss', 's', source_cap)} or {full('hs', 'h', theme_cap)} or (c <> '' and {full('cs', 'c', 3)})) ok from r join t on t.i = r.i + 1 where len(ss) < {target}))
select row_number() over (order by i) as rank, q as article_seq, score from r where keep"""


@query("select_diverse", sql_diverse(SQL_RETRIEVAL, 100, 25, 35))
def select_diverse(s, d):
    """Three caps at once: the SQL reads the candidates one by one."""
    return selecting.select_diverse(scored(s, d), F.col("score"), 100)


_FRESH = f"(select article_seq, case when t is null then 0e0 when n - t <= 0 then 1e0 else greatest(0e0, least(1e0, pow(0.5e0, (n - t) / 3600 / 24))) end as freshness_score from (select article_seq, cast({SQL_AGE} as double) t, cast(epoch(timestamp '{NOW}') as double) n from articles))"
SQL_SCORED = SQL_RETRIEVAL.replace("* 100, 6)", "* 100, 2)").replace("from articles) a", f"from (select * exclude (freshness_score) from articles) join {_FRESH} using (article_seq)) a").replace("least(1e0, tr)", "tr")


@query("hot_articles", f"select rank, article_seq, score, {SQL_VIEW} from ({sql_diverse(SQL_SCORED, 100, 20, 35)}) join articles using (article_seq)")
def hot_articles(s, d):
    """The published selection: a fifth of the places for one source at most, then the public view."""
    a = load(s, d, "articles")
    best = selecting.select_diverse(selecting.retrieval_scores(a, reactions(s, d), now_column()), F.col("score"), 100, max_source_share=0.20)
    return views.flat(best.join(a.select("article_seq", *views.article_view()), "article_seq"))


@query("source_cap_top", f"select article_seq, score from ({SQL_RETRIEVAL}) qualify row_number() over (partition by src order by score desc, article_seq) <= 20")
def source_cap_top(s, d):
    w = Window.partitionBy("src").orderBy(F.col("score").desc(), "article_seq")
    return scored(s, d).withColumn("r", F.row_number().over(w)).where("r <= 20").select("article_seq", "score")


@query("event_clustering")
def event_clustering(s, d):
    """Order decides; tests hold it against a plain reader. Scope: the category, over all sources. An article looks for
    its countries, companies and actors among an event's countries and actors."""
    a = load(s, d, "articles")
    t = times.parse_iso(F.col("published_at_utc"))
    rows = a.select(
        F.col("article_seq").alias("seq"), F.coalesce("article_id", F.lit("")).alias("article_id"), F.coalesce("primary_category", F.lit("")).alias("category"), F.coalesce("source_domain", F.lit("")).alias("source"),
        F.unix_seconds(t).cast("double").alias("t"), text.title_tokens(F.col("title_original")).alias("tokens"), history.entities("countries", "companies", "geopolitical_entities").alias("entities"), history.entities("countries", "geopolitical_entities").alias("marks"),
        (number(F.col("importance_score")) + number(F.col("source_trust"))).alias("weight"),
    )
    return clustering.cluster_articles(rows, scope=["category"])


@query("escalation", "select event_cluster_id, case when n >= 5 then 'escalating' else 'steady' end as status from (select event_cluster_id, count(distinct article_id) n from articles where event_cluster_id <> '' group by 1)")
def escalation(s, d):
    n = load(s, d, "articles").where("event_cluster_id <> ''").groupBy("event_cluster_id").agg(F.count_distinct("article_id").alias("n"))
    return n.select("event_cluster_id", F.when(F.col("n") >= 5, "escalating").otherwise("steady").alias("status"))


@query("reaction_stub", """select c.event_cluster_id, t.target, x.w as reaction_window, v.value from (select distinct event_cluster_id from market_reactions) c, (select distinct target from market_reactions) t, (select unnest(['1h', '4h', '1d', '5d', '20d']) w) x
 left join (select event_cluster_id, target, reaction_window, max(value) as value from market_reactions group by 1, 2, 3) v on v.event_cluster_id = c.event_cluster_id and v.target = t.target and v.reaction_window = x.w""")
def reaction_stub(s, d):
    """Every cluster's full grid of targets and windows, filled with what the table has."""
    r = load(s, d, "market_reactions")
    return measured.record(measured.stub(r), r)[0]


@query("reaction_tracking", f"""with ids as (select distinct event_cluster_id from event_clusters where event_cluster_id <> ''), had as (select distinct event_cluster_id from market_reactions)
select (select count(*) from market_reactions) + 14 * 5 * (select count(*) from ids where event_cluster_id not in (select event_cluster_id from had)) as cells, (select count(*) from (select event_cluster_id from had union select event_cluster_id from ids)) as events""")
def reaction_tracking(s, d):
    """How large the table gets when every cluster is tracked."""
    ids = load(s, d, "event_clusters").where("event_cluster_id <> ''").select("event_cluster_id")
    x = measured.start_tracking(load(s, d, "market_reactions"), ids.distinct())
    return x.agg(F.count("*").alias("cells"), F.count_distinct("event_cluster_id").alias("events"))
