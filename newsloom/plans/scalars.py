"""Functions of one row, over the whole article store."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import classify, scoring, text, times, url, views
from ..tables import load
from .common import NOW, Registry, now_column

query = Registry()

GAP = "'[\\s\\x0B\\x1C-\\x1F\\x{0085}\\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+'"  # every Unicode blank
TRACK = ", ".join(f"'{x}'" for x in url.TRACKING)
PARTS = "'^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\\?([^#]*))?'"


def sql_norm(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower(coalesce({c}, '')), {GAP}, ' ', 'g'), '[^\\p{{L}}\\p{{N}}_ ]', '', 'g'))"


def sql_ts(c: str) -> str:
    """Epoch seconds of ISO text, UTC where it names no offset."""
    x = f"trim({c})"
    return f"(case when regexp_matches({x}, '^\\d{{4}}-\\d{{2}}-\\d{{2}}[T ]\\d{{2}}:\\d{{2}}') then epoch(try_cast(case when regexp_matches({x}, '([Zz]|[+-]\\d{{2}}:?\\d{{2}})$') then {x} else {x} || '+00:00' end as timestamptz)) end)"


SQL_HOST = f"regexp_replace(lower(regexp_extract(trim(canonical_url), {PARTS}, 2)), '^www\\.', '')"
SQL_URL = f"""
with p as (select article_seq, trim(coalesce(canonical_url, '')) u from articles),
q as (select article_seq, u, lower(regexp_extract(u, {PARTS}, 1)) s, regexp_replace(lower(regexp_extract(u, {PARTS}, 2)), '^www\\.', '') h,
  regexp_replace(regexp_extract(u, {PARTS}, 3), '/+$', '') p,
  list_sort(list_transform(list_filter(string_split(regexp_extract(u, {PARTS}, 4), '&'), lambda x: x <> ''),
    lambda x, i: {{'k': url_decode(replace(string_split(x, '=')[1], '+', ' ')), 'i': i, 'v': case when contains(x, '=') then url_decode(replace(substr(x, strpos(x, '=') + 1), '+', ' ')) else '' end}})) a from p)
select article_seq, case when u = '' then '' else (case when s in ('', 'http', 'https') then 'https' else s end) || ':' || (case when h <> '' then '//' || h else '' end) || p
  || coalesce('?' || nullif(list_aggregate(list_transform(list_filter(a, lambda e: lower(e.k) not in ({TRACK}) and not starts_with(lower(e.k), 'utm_')),
     lambda e: replace(url_encode(e.k), '%20', '+') || '=' || replace(url_encode(e.v), '%20', '+')), 'string_agg', '&'), ''), '') end as url from q"""


@query("url_normalize", SQL_URL)
def url_normalize(s, d):
    return load(s, d, "articles").select("article_seq", url.normalize_url(F.col("canonical_url")).alias("url"))


@query("url_domain", f"select article_seq, coalesce({SQL_HOST}, '') as host from articles")
def url_domain(s, d):
    return load(s, d, "articles").select("article_seq", url.host_of(F.col("canonical_url")).alias("host"))


@query("tracking_params", f"select key, count(*) as n, count_if(lower(key) in ({TRACK}) or starts_with(lower(key), 'utm_')) as n_tracking from (select unnest(list_transform(list_filter(string_split(regexp_extract(trim(canonical_url), {PARTS}, 4), '&'), lambda x: x <> ''), lambda x: string_split(x, '=')[1])) as key from articles) group by key")
def tracking_params(s, d):
    raw = F.regexp_extract(F.trim("canonical_url"), PARTS[1:-1], 4)
    key = F.explode(F.transform(F.filter(F.split(raw, "&"), lambda x: x != ""), lambda x: F.substring_index(x, "=", 1)))
    return load(s, d, "articles").select(key.alias("key")).groupBy("key").agg(F.count("*").alias("n"), F.count_if(url.is_tracking(F.col("key"))).alias("n_tracking"))


@query("text_normalize", f"select article_seq, {sql_norm('title_original')} as title from articles")
def text_normalize(s, d):
    return load(s, d, "articles").select("article_seq", text.normalize_text(F.col("title_original")).alias("title"))


@query("hashes", f"select article_seq, sha256(coalesce(canonical_url, '')) as canonical, sha256({sql_norm('title_original')}) as title, sha256({sql_norm('title_original')} || '|' || {sql_norm('description')}) as content from articles")
def hashes(s, d):
    return load(s, d, "articles").select("article_seq", text.canonical_hash(F.col("canonical_url")).alias("canonical"), text.title_hash(F.col("title_original")).alias("title"), text.content_hash(F.col("title_original"), F.col("description")).alias("content"))


@query("stale_hashes", f"select coalesce(source_name, '') as source, count_if(canonical_hash is distinct from sha256(coalesce(canonical_url, ''))) as n_canonical, count_if(title_hash is distinct from sha256({sql_norm('title_original')})) as n_title from articles group by 1")
def stale_hashes(s, d):
    c, t = text.canonical_hash(F.col("canonical_url")), text.title_hash(F.col("title_original"))
    return load(s, d, "articles").groupBy(F.coalesce("source_name", F.lit("")).alias("source")).agg(F.count_if(~c.eqNullSafe(F.col("canonical_hash"))).alias("n_canonical"), F.count_if(~t.eqNullSafe(F.col("title_hash"))).alias("n_title"))


@query("article_ids", "select article_seq, 'art_' || substr(sha256(coalesce(canonical_url, '')), 1, 24) as id, 'evc_' || regexp_replace(right(article_id, 12), '[^a-z0-9]', '', 'g') as cluster from articles")
def article_ids(s, d):
    return load(s, d, "articles").select("article_seq", text.article_id(F.col("canonical_url")).alias("id"), text.cluster_id(F.col("article_id")).alias("cluster"))


STOPS = ", ".join(f"'{x}'" for x in text.STOPWORDS)


@query("title_tokens", f"""
select article_seq, coalesce(list_aggregate(list_sort(list_distinct(list_filter(list_concat(list_filter(list_transform(regexp_extract_all(coalesce(title_original, ''), '[A-Za-z0-9]+'), lambda x: lower(x)), lambda x: length(x) > 1),
  flatten(list_transform(list_filter(regexp_extract_all(coalesce(title_original, ''), '[一-龯ぁ-んァ-ヶ]+'), lambda r: length(r) > 1), lambda r: list_transform(range(1, length(r)), lambda i: substr(r, i, 2))))), lambda x: x not in ({STOPS})))), 'string_agg', ' '), '') as tokens from articles""")
def title_tokens(s, d):
    return load(s, d, "articles").select("article_seq", F.array_join(text.title_tokens(F.col("title_original")), " ").alias("tokens"))


_ENTITIES = {"&lt;": "<", "&lt": "<", "&gt;": ">", "&gt": ">", "&quot;": '"', "&quot": '"', "&apos;": "'", "&nbsp;": " ", "&nbsp": " ", "&hellip;": "…", "&#x2026;": "…", "&amp;": "&", "&amp": "&"}


def _unescaped(c: str) -> str:
    number = "case when i = 1 then p when regexp_matches(p, '^[0-9]') then chr(cast(regexp_extract(p, '^[0-9]+') as int)) || regexp_replace(p, '^[0-9]+;?', '') else '&#' || p end"
    c = f"array_to_string(list_transform(string_split({c}, '&#'), lambda p, i: {number}), '')"
    for k, v in _ENTITIES.items():
        c = "replace({}, '{}', '{}')".format(c, k, v.replace("'", "''"))
    return c


def sql_plain(c: str) -> str:
    x = _unescaped("regexp_replace(" + _unescaped(f"coalesce({c}, '')") + ", '<[^>]+>', ' ', 'g')")
    return f"trim(regexp_replace({x}, {GAP}, ' ', 'g'))"


@query("html_strip", f"select article_seq, {sql_plain('description')} as description from articles")
def html_strip(s, d):
    """All entities; the SQL knows those that the tables hold."""
    return load(s, d, "articles").select("article_seq", text.strip_html(F.col("description")).alias("description"))


@query("iso_parse", f"select article_seq, cast(floor({sql_ts('published_at_utc')}) as bigint) as published, cast(floor({sql_ts('first_seen_at')}) as bigint) as seen from articles")
def iso_parse(s, d):
    return load(s, d, "articles").select("article_seq", *(times.epoch(times.parse_iso(F.col(c))).alias(a) for c, a in (("published_at_utc", "published"), ("first_seen_at", "seen"))))


@query("feed_dates")
def feed_dates(s, d):
    """Every row, null where its date is none. Feeds' RFC 822 is more than SQL's formats can state; tests hold it against
    plain values."""
    return load(s, d, "articles").select("article_seq", F.udf(times.read_feed_date, "long", useArrow=True)("raw_published_at").alias("published"))


@query("jst_dates", f"select article_seq, strftime(make_timestamp(cast(floor({sql_ts('published_at_utc')}) as bigint) * 1000000) + interval 9 hours, '%Y-%m-%d') as day from articles")
def jst_dates(s, d):
    return load(s, d, "articles").select("article_seq", times.jst_date(times.parse_iso(F.col("published_at_utc"))).alias("day"))


@query("jst_to_utc", "select source_name, coalesce(strftime(coalesce(try_strptime(x, '%Y-%m-%d %H:%M:%S'), try_strptime(x, '%Y-%m-%d %H:%M'), try_strptime(x, '%Y-%m-%d')) - interval 9 hours, '%Y-%m-%dT%H:%M:%S+00:00'), '') as utc from (select source_name, replace(trim(latest_published_at), '/', '-') x from source_cursors)")
def jst_to_utc(s, d):
    return load(s, d, "source_cursors").select("source_name", times.jst_to_utc(F.col("latest_published_at")).alias("utc"))


SQL_AGE = f"({sql_ts('published_at_utc')})"


SQL_SANE = f"""
with x as (select article_seq, published_at_utc p, coalesce(raw_published_at, '') r, fetched_at_utc f, {SQL_AGE} t, epoch(timestamp '{NOW}') n from articles),
y as (select *, case when trim(coalesce(p, '')) = '' and trim(r) = '' then 'missing' when t is null then 'unparsable' when t > n + 86400 then 'future' when t < n - 365 * 20 * 86400 then 'too_old' else '' end a from x)
select article_seq, case when a = '' then p else f end as published, a <> '' as inferred, case when a = '' then '' else r end as raw, a as anomaly from y"""


@query("date_sanitize", SQL_SANE)
def date_sanitize(s, d):
    x = times.sanitize_published(F.col("published_at_utc"), F.col("raw_published_at"), F.col("fetched_at_utc"), now_column())
    return load(s, d, "articles").select("article_seq", x.alias("x")).select("article_seq", "x.published", "x.inferred", "x.raw", "x.anomaly")


@query("freshness", f"select article_seq, round(case when t is null then 0 when n - t <= 0 then 1 else greatest(0, least(1, pow(0.5, (n - t) / 3600 / 24))) end, 6) as freshness from (select article_seq, cast({SQL_AGE} as double) t, cast(epoch(timestamp '{NOW}') as double) n from articles)")
def freshness(s, d):
    return load(s, d, "articles").select("article_seq", F.round(times.freshness(times.parse_iso(F.col("published_at_utc")), now_column()), 6).alias("freshness"))


_LIST = lambda xs: ", ".join(f"'{x}'" for x in xs)
SQL_SIGNALS = f"""
select article_seq, urgency, round(impact, 4) as impact, structural, round(least(1, 0.35e0 * impact + 0.25e0 * structural + 0.2e0 * trust + 0.1e0 * least(1, len(th) / 3.0e0) + 0.1e0 * urgency), 4) as importance from (
 select article_seq, th, trust, case when u then 0.7e0 else 0.2e0 end urgency,
  least(1e0, case when c in ({_LIST(scoring.HIGH_IMPACT)}) then 0.6e0 when c not in ('', 'uncategorized') then 0.35e0 else 0.1e0 end + case when u then 0.2e0 else 0e0 end) impact,
  case when c in ({_LIST(scoring.STRUCTURAL)}) then 1e0 when list_has_any(th, [{_LIST(scoring.STRUCTURAL)}]) then 0.5e0 else 0e0 end structural
 from (select article_seq, coalesce(primary_category, '') c, coalesce(themes, []) th, coalesce(case when isnan(source_trust) then null else source_trust end, 0e0) trust, regexp_matches(lower(coalesce(title_original, '')), '{"|".join(scoring.URGENT)}') u from articles))"""


@query("signal_scores", SQL_SIGNALS)
def signal_scores(s, d):
    x = scoring.signals(F.col("title_original"), F.col("primary_category"), F.col("themes"), F.col("source_trust"))
    return load(s, d, "articles").select("article_seq", x.alias("x")).select("article_seq", "x.urgency", "x.impact", "x.structural", "x.importance")


def _sql_keyword(k: str) -> str:
    if not k.isascii():
        return f"contains(x, '{k}')"
    return f"(contains(l, '{k.lower()}') and regexp_matches(l, '(^|[^\\p{{L}}\\p{{N}}_]){classify.pattern(k.lower())}([^\\p{{L}}\\p{{N}}_]|$)'))"


CUSTOM = {"finance": ["bond sale", "reserve ratio", "Kronen", "couronnes"], "transport": ["port fee", "freight", "海運", "shipping"], "metals": ["copper", "rolled zinc", "亜鉛板", "銅"], "plan": ["budget", "forecast", "hiring plan"]}


def classified_sql(words, table="articles"):
    entries = ", ".join("{'m': -(" + " + ".join(f"cast({_sql_keyword(k)} as int)" for k in ks) + f"), 'c': '{c}'}}" for c, ks in words.items())
    return f"""with t as (select article_seq, coalesce(title_original, '') || ' ' || coalesce(description, '') x, lower(x) l from {table}),
h as (select article_seq, list_transform(list_sort(list_filter([{entries}], lambda e: e.m < 0)), lambda e: e.c) c from t)
select article_seq, coalesce(c[1], 'uncategorized') as category, array_to_string(c[2:6], ',') as secondary, array_to_string(c[1:6], ',') as themes from h"""


def _classify(s, d, words):
    x = classify.with_text(load(s, d, "articles")).select("article_seq", classify.classified(classify.category_hits(words)).alias("x"))
    return x.select("article_seq", F.col("x.primary").alias("category"), F.array_join("x.secondary", ",").alias("secondary"), F.array_join("x.themes", ",").alias("themes"))


@query("classify_default", classified_sql(classify.CATEGORY_KEYWORDS))
def classify_default(s, d):
    return _classify(s, d, classify.CATEGORY_KEYWORDS)


@query("classify_custom", classified_sql(CUSTOM))
def classify_custom(s, d):
    return _classify(s, d, CUSTOM)


_KIND = "case " + " ".join(f"when regexp_matches(x, '{'|'.join(classify.pattern(w) for w in ws)}') then '{k}'" for k, ws in classify.DISCLOSURES) + " else 'other' end"


@query("disclosure_class", f"select article_seq, kind, case when kind = 'other' then 'low' when kind in ({_LIST(classify.HIGH)}) then 'high' else 'medium' end as materiality from (select article_seq, {_KIND} kind from (select article_seq, lower(coalesce(title_original, '') || ' ' || coalesce(event_type, '')) x from articles))")
def disclosure_class(s, d):
    x = classify.disclosure(F.col("title_original"), F.col("event_type"))
    return load(s, d, "articles").select("article_seq", x.alias("x")).select("article_seq", "x.kind", "x.materiality")


@query("body_hash", f"select doc_id, sha256(regexp_replace(coalesce(text, ''), {GAP}, '', 'g')) as hash from documents")
def body_hash(s, d):
    return load(s, d, "documents").select("doc_id", text.body_hash(F.col("text")).alias("hash"))


VIEW_TEXT = {"article_id": "article_id", "url": "canonical_url", "source": "source_name", "public_excerpt": "public_excerpt", "category": "primary_category", "event_cluster_id": "event_cluster_id"}
_real = lambda c: f"case when isnan({c}) then null else {c} end as {c}"
SQL_VIEW = ", ".join([
    "coalesce(nullif(title_ja, ''), title_original) as title", "coalesce(nullif(published_at_jst, ''), published_at_utc) as published_at", *(f"{c} as {a}" for a, c in VIEW_TEXT.items()),
    *(f"coalesce(array_to_string({c}, ','), '') as {c}" for c in views.LISTS), *map(_real, views.SCORES),
])


@query("public_view", f"select article_seq, {SQL_VIEW} from articles")
def public_view(s, d):
    """The 23 columns that may be shown of every article."""
    return views.flat(load(s, d, "articles").select("article_seq", *views.article_view()))
