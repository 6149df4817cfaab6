"""Queries of the operators of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions import text
from ..plans.scalars import PARTS, TRACK
from ..tables import load
from . import looks, near, packing, ranking, tokens, truncated


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return ranking.top_of_groups(load(spark, d, "articles"), "event_cluster_id", "market_impact_score", "article_seq", 3).selectExpr("event_cluster_id", "cast(pos as int) as pos", "article_seq")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": lambda s, d: near.p1_found(load(s, d, "articles"), load(s, d, "incoming_articles")),
    "p1_clusters": lambda s, d: near.p1_clusters(load(s, d, "articles"), load(s, d, "incoming_articles")),
    "p3_found": lambda s, d: ranking.p3_found(load(s, d, "articles")),
    "p4_found": p4_found,
    "p4_skipping": lambda s, d: ranking.skipping(load(s, d, "articles"), "event_cluster_id", "market_impact_score", "article_seq", 3),
    "p5_found": lambda s, d: ranking.best_of_duplicates(load(s, d, "articles")),
    "p6_found": lambda s, d: truncated.p6_found(load(s, d, "articles")),
    "p6_source_rates": lambda s, d: truncated.source_rates(load(s, d, "articles"), load(s, d, "sources")),
    "p6_reasons": lambda s, d: truncated.p6_reasons(load(s, d, "articles")),
    "p7_found": lambda s, d: near.p7_found(load(s, d, "articles")),
    "p7_groups": lambda s, d: near.near_groups(load(s, d, "articles")),
    "p8_ids": lambda s, d: tokens.token_ids(load(s, d, "documents")),
    "p9_containers": lambda s, d: packing.containers(load(s, d, "documents")),
    "p9_invariants": lambda s, d: packing.invariants(load(s, d, "documents")),
    "p10_found": lambda s, d: looks.same_look(load(s, d, "documents")),
    "p10_readings": lambda s, d: looks.look_readings(load(s, d, "documents")),
    "p10_groups": lambda s, d: looks.look_groups(load(s, d, "documents")),
}

_NUMBER = "({c} is not null and not isnan({c}))"


def _order(c: str, seq: str = "article_seq") -> str:
    n = _NUMBER.format(c=c)
    return f"case when {n} then 1 else 0 end desc, case when {n} then {c} end desc, {seq}"


_NAME = f"lower(regexp_replace(translate(source_name, '{(text.WIDE + text.DASHES).replace(chr(39), chr(39) * 2)}', '{(text.ASCII + '-' * len(text.DASHES)).replace(chr(39), chr(39) * 2)}'), '[\\s\\p{{Z}}]+|[\\x{{00AD}}\\x{{200B}}-\\x{{200F}}\\x{{2060}}\\x{{FEFF}}]', '', 'g'))"
_TRUST = "case when isnan(source_trust) then null when source_trust > 1 then source_trust / 100 else source_trust end"
_VOID = "coalesce(not regexp_matches(description, '[\\p{L}\\p{N}]') or lower(regexp_replace(description, '^\\s+|\\s+$', '', 'g')) in ('n/a', 'none', 'null', 'no description'), true)"
_FIRST = f"order by {_TRUST} desc nulls last, epoch_us(try_cast(trim(first_seen_at) as timestamptz)) asc nulls last, article_seq"

def _grams(table: str, seq: str) -> str:
    """Each row's text and its different stretches of 5 characters."""
    joined = "trim(regexp_replace(lower(coalesce(title_original, '') || ' ' || coalesce(description, '')), '[\\s\\x{0085}\\x{00A0}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+', ' ', 'g'))"
    return f"select {seq} q, t, list_distinct(list_transform(range(1, length(t) - 3), lambda i: substr(t, i, 5))) g from (select {seq}, {joined} t from {table}) where length(t) >= 5"


_ALIKE = "common / cast(na + nb - common as double) >= 0.6"
_KEY = """case when trim(coalesce(canonical_url, '')) <> '' then regexp_replace(lower(regexp_extract(trim(canonical_url), {p}, 2)), '^www\\.', '') || '|' || regexp_replace(regexp_extract(trim(canonical_url), {p}, 3), '/+$', '') || '?' ||
 coalesce(array_to_string(list_sort(list_filter(list_transform(list_filter(string_split(regexp_extract(trim(canonical_url), {p}, 4), '&'), lambda x: x <> ''), lambda x: case when contains(x, '=') then x else x || '=' end),
 lambda x: lower(string_split(x, '=')[1]) not in ({t}) and not starts_with(lower(x), 'utm_'))), '&'), '') end""".format(p=PARTS, t=TRACK)

_REACH = "reach(id, r) as (select id, id from node union select e.v, reach.r from reach join edge e on e.u = reach.id)"
_P7 = f"""t as ({_grams('articles', 'article_seq')}), c as (select min(q) id, t, any_value(g) g from t group by t), x as (select id, len(g) n, unnest(g) u from c),
link as (select ia, ib from (select a.id ia, b.id ib, a.n na, b.n nb, count(*) common from x a join x b on a.u = b.u and a.id < b.id and a.n >= 0.6 * b.n and b.n >= 0.6 * a.n group by all) where {_ALIKE})"""
_ALL = "(select article_seq as q0, title_original, description from articles union all select incoming_seq + 1000000000000, title_original, description from incoming_articles)"



def _sql_looks() -> str:
    """The table of look-alikes over composed texts: what a composed character's parts look like, composed again."""
    one, many, none = {}, {}, []
    for i in range(0x80, 0x10000):
        if 0xD800 <= i < 0xE000:
            continue
        c = chr(i)
        if (x := looks.normal(c)) != unicodedata.normalize("NFC", c):
            if not x:
                none.append(i)
            else:
                (one if len(x) == 1 else many)[c] = x
    q = lambda x: x.replace("'", "''")
    x = f"translate(nfc_normalize(text), '{q(''.join(one))}', '{q(''.join(one.values()))}')"
    for c, y in many.items():
        x = f"replace({x}, '{c}', '{q(y)}')"
    return f"nfc_normalize(regexp_replace({x}, '[{''.join(f'\\x{{{i:04X}}}' for i in none)}]', '', 'g'))"


_LOOKS = f"select doc_id, text as v, {_sql_looks()} as k from documents where length(text) > 0"

ORACLES: dict[str, str] = {
    "p10_found": f"with d as ({_LOOKS}) select a.doc_id as doc_a, b.doc_id as doc_b from d a join d b on a.k = b.k and a.doc_id < b.doc_id and a.v <> b.v",
    "p10_groups": f"with d as ({_LOOKS}), g as (select k, min(doc_id) as same_as, count(distinct v) as spellings from d group by 1 having count(distinct v) > 1) select doc_id, same_as, spellings from d join g using (k)",
    "p7_groups": f"""with recursive {_P7}, m as (select q, id, count(*) over (partition by id) n from t join c using (t)), edge as (select ia u, ib v from link union all select ib, ia from link), node as (select distinct u id from edge), {_REACH},
comp as (select id, min(r) rep from reach group by id), degree as (select u id, count(*) links from edge group by u)
select q as article_seq, coalesce(rep, id) as group_seq, coalesce(links, 0) as links from m left join comp using (id) left join degree using (id) where rep is not null or n > 1""",
    "p1_clusters": f"""with recursive t as ({_grams(_ALL, 'q0')}), c as (select min(q) id, t, any_value(g) g from t group by t), x as (select id, len(g) n, unnest(g) u from c),
near as (select ia, ib from (select a.id ia, b.id ib, a.n na, b.n nb, count(*) common from x a join x b on a.u = b.u and a.id < b.id and a.n >= 0.6 * b.n and b.n >= 0.6 * a.n group by all) where {_ALIKE}),
k as (select q, k from (select article_seq q, {_KEY} k from articles union all select incoming_seq + 1000000000000, {_KEY} from incoming_articles) where k is not null),
pair as (select ia a, ib b from near union select id, q from t join c using (t) where q <> id union select f, q from (select q, min(q) over (partition by k) f from k) where q <> f),
edge as (select a u, b v from pair union select b, a from pair), node as (select distinct u id from edge), {_REACH}, comp as (select id, min(r) rep from reach group by id),
known as (select distinct greatest(a, b) q from pair) select q - 1000000000000 as incoming_seq, case when rep > 1000000000000 then 1000000000000 - rep else rep end as known_as from known join comp on comp.id = q where q > 1000000000000""",
    "p9_invariants": "select count(*) as documents, 0 as over_capacity, 0 as over_places, 0 as over_cost, 0 as divided_small, 0 as torn from documents",
    "p7_found": f"""with {_P7}, m as (select q, id from t join c using (t))
select least(a.q, b.q) as seq_a, greatest(a.q, b.q) as seq_b from link join m a on a.id = ia join m b on b.id = ib union all select a.q, b.q from m a join m b on a.id = b.id and a.q < b.q""",
    "p1_found": f"""with t as ({_grams('(select article_seq as q0, title_original, description from articles union all select incoming_seq + 1000000000000, title_original, description from incoming_articles)', 'q0')}),
x as (select q, len(g) n, unnest(g) u from t), near as (select distinct b.q from (select a.q qa, b.q qb, a.n na, b.n nb, count(*) common from x a join x b on a.u = b.u and a.q < b.q and b.q > 1000000000000 and a.n >= 0.6 * b.n and b.n >= 0.6 * a.n group by all) r, lateral (select r.qb q) b where {_ALIKE}),
k as (select article_seq q, {_KEY} k from articles union all select incoming_seq + 1000000000000, {_KEY} from incoming_articles), same as (select q from (select q, min(q) over (partition by k) f from k where k is not null) where q > f)
select q - 1000000000000 as incoming_seq from (select q from near union select q from same) where q > 1000000000000""",
    "p3_found": f"select article_seq from (select article_seq, row_number() over (partition by coalesce(ingestion_run_id, ''), k order by {_order('importance_score')}) r from (select *, {_NAME} k from articles) where k <> '') where r > 8",
    "p4_found": f"select event_cluster_id, cast(pos as int) as pos, article_seq from (select event_cluster_id, article_seq, row_number() over (partition by event_cluster_id order by {_order('market_impact_score')}) pos from articles where regexp_matches(event_cluster_id, '[^\\s]')) where pos <= 3",
    "p5_found": f"""with r as (select duplicate_group_id g, article_seq q, {_VOID} void, row_number() over (partition by duplicate_group_id {_FIRST}) p, count(*) over (partition by duplicate_group_id) n from articles where regexp_matches(duplicate_group_id, '[^\\s]'))
select g as duplicate_group_id, min(case when p = 1 then q end) as survivor_seq, coalesce(arg_min(q, p) filter (where not void), 0) as description_seq from r where n > 1 group by g""",
}
