"""SQL that reads one instant out of text in many notations, to hold the reader in Python against."""

from __future__ import annotations

from ..functions import moments
from ..functions.text import ASCII, WIDE
from .rollups import sql_name_key
from .scalars import GAP, PARTS

_T = r"(\d{1,2})\s*[:hH時]\s*(\d{2})分?(?::(\d{2})(?:[.,]\d+)?)?\s*(?:([AaPp]\.?\s?[Mm]\.?)(?:\s|$))?(?:\s*Uhr)?"
_Z = r"(Z|z|(?:UTC|GMT|utc|gmt)?[+-]\d{1,2}(?::?\d{2})?|[A-Za-z]+(?:/[A-Za-z_+-]+)+|[A-Za-z]{1,5})"
_WORD = r"(\pL+)"
_DAY = r"(?:\pL+\.?,?\s+)?"
_AT = rf"(?:,?\s*(?:à|um|at|a las|в)?\s*{_T})?(?:\s*{_Z})?"
_ERA = "(令和|平成|R|H)"
# notation: pattern and what its groups are
NOTATIONS = {
    "iso": (rf"(\d{{4}})[-/](\d{{1,2}})[-/](\d{{1,2}})(?:(?:[Tt]|\s+){_T})?(?:\s*{_Z})?(?:\s*\[[^\]]*\])?", "y m d h mi s ap z"),
    "basic": (rf"(\d{{4}})(\d{{2}})(\d{{2}})(?:[Tt]?(\d{{2}})(\d{{2}})(\d{{2}})?(?:[.,]\d+)?)?\s*{_Z}?", "y m d h mi s z"),
    "named": (rf"{_DAY}(\d{{1,2}})(?:\.|er|st|nd|rd|th)?(?:\s+|-)(?:de\s+)?{_WORD}\.?(?:\s+|-)(?:de\s+)?(\d{{4}}|\d{{2}})(?:\s*г\.?)?{_AT}", "d mon y h mi s ap z"),
    "first": (rf"{_DAY}{_WORD}\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}}){_AT}", "mon d y h mi s ap z"),
    "ctime": (rf"\pL+\s+{_WORD}\s+(\d{{1,2}})\s+{_T}\s+(?:{_Z}\s+)?(\d{{4}})", "mon d h mi s ap z y"),
    "number": (rf"(\d{{1,2}})(?:\.(\d{{1,2}})\.|/(\d{{1,2}})/|-(\d{{1,2}})-)(\d{{4}}|\d{{2}}){_AT}", "a b1 b2 b3 y h mi s ap z"),
    "kanji": (rf"(?:(\d{{4}})|{_ERA}(\d{{1,2}}|元))年\s*(\d{{1,2}})月\s*(\d{{1,2}})日(?:\([^)]*\))?\s*(?:(午前|午後)?\s*{_T})?(?:\s*{_Z})?", "y era ey m d half h mi s ap z"),
    "era": (rf"{_ERA}(\d{{1,2}})[./-](\d{{1,2}})[./-](\d{{1,2}})(?:\s+{_T})?(?:\s*{_Z})?", "era ey m d h mi s ap z"),
}
PARTS_OF = "y m mon d a b1 b2 b3 era ey half h mi s ap z".split()


def _q(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _month() -> str:
    by = {n: " ".join(f"when {_q(x)} then {m}" for m, xs in moments.MONTHS.items() for x in xs if len(x) == n) for n in (4, 3)}
    return f"coalesce(case substr(lower(f.mon), 1, 4) {by[4]} end, case substr(lower(f.mon), 1, 3) {by[3]} end)"


def read_sql(name: str, source: str, codes: str = "(select upper(zone_code) c, min(offset_minutes) o from zone_codes group by 1)") -> str:
    """CTEs that end in `name`: (q, form, zoned, e), whole seconds since 1970, from `source`, a query of (q, t, ord, tz)."""
    fields = []
    for form, (pattern, groups) in NOTATIONS.items():
        names = groups.split()
        got = f"regexp_extract(x, {_q('^(?:' + pattern + ')$')}, [{', '.join(map(_q, names))}])"
        fields.append(f"when regexp_full_match(x, {_q(pattern)}) then {{'form': '{form}', " + ", ".join(f"'{p}': " + (f"nullif(struct_extract({got}, '{p}'), '')" if p in names else "null::varchar") for p in PARTS_OF) + "}")
    eras = " ".join(f"when {_q(k)} then {v}" for k, v in moments.ERAS.items())
    year = f"case when f.era is not null then (case f.era {eras} end) + case when f.ey = '元' then 1 else try_cast(f.ey as int) end else try_cast(f.y as int) + case when length(f.y) = 2 then 2000 else 0 end end"
    b = "coalesce(f.b1, f.b2, f.b3)"
    month = f"case when f.mon is not null then {_month()} when f.a is not null then try_cast(case when ord = 'mdy' then f.a else {b} end as int) else try_cast(f.m as int) end"
    day = f"try_cast(case when f.a is null then f.d when ord = 'mdy' then {b} else f.a end as int)"
    hour = "case when f.ap is not null then case when try_cast(f.h as int) between 1 and 12 then try_cast(f.h as int) % 12 + case when lower(substr(f.ap, 1, 1)) = 'p' then 12 else 0 end end when f.half is not null then try_cast(f.h as int) % 12 + case when f.half = '午後' then 12 else 0 end else coalesce(try_cast(f.h as int), 0) end"
    off = "regexp_extract(upper(f.z), '^(?:UTC|GMT)?([+-])(\\d{1,2}):?(\\d{2})?$', ['sign', 'h', 'm'])"
    return f"""{name}_x as (select q, ord, tz, trim(regexp_replace(translate(coalesce(t, ''), {_q(WIDE)}, {_q(ASCII)}), {GAP}, ' ', 'g')) x from ({source})),
{name}_f as (select q, ord, tz, x, case {' '.join(fields)} end f from {name}_x),
{name}_p as (select q, tz, x, f.form form, f.z z, {year} y, {month} mo, {day} d, {hour} h, coalesce(try_cast(f.mi as int), 0) mi, coalesce(try_cast(f.s as int), 0) s, {off} off from {name}_f),
{name}_t as (select *, case when h <= 23 then try_cast(printf('%04d-%02d-%02d %02d:%02d:%02d', y, mo, d, h, mi, s) as timestamp) end wall, case when z is null then tz when contains(z, '/') then z end zone from {name}_p),
{name}_u as (select t.*, k.o code, n.name known, epoch(timezone(n.name, wall)) u from {name}_t t left join {codes} k on k.c = upper(z) left join (select distinct name from pg_timezone_names()) n on n.name = zone),
{name} as (select q, x, z is not null zoned, wall, case when regexp_full_match(x, '\\d{{10}}|\\d{{13}}|\\d{{16}}|\\d{{19}}') then 'epoch' when regexp_full_match(x, '\\d{{10}}\\.\\d+') then 'epoch' else coalesce(form, 'words') end form, off, z,
 cast(case when regexp_full_match(x, '\\d{{10}}|\\d{{13}}|\\d{{16}}|\\d{{19}}') then cast(substr(x, 1, 10) as bigint) when regexp_full_match(x, '\\d{{10}}\\.\\d+') then cast(substr(x, 1, 10) as bigint)
  when zone is not null then case when timezone(known, to_timestamp(u - 3600)) = wall then u - 3600 else u end when z is null then null when z in ('Z', 'z') then epoch(wall)
  when off.sign <> '' then epoch(wall) - case when off.sign = '-' then -1 else 1 end * (try_cast(off.h as int) * 3600 + coalesce(try_cast(nullif(off.m, '') as int), 0) * 60) else epoch(wall) - code * 60 end as bigint) e from {name}_u)"""


_HOST = f"regexp_replace(lower(regexp_extract(trim(url), {PARTS}, 2)), '^www\\.', '')"
SQL_SOURCE = f"""hosts as (select {_HOST} h, arg_min({{'tz': tz_name, 'ord': date_order}}, id) s from sources where {_HOST} <> '' group by 1),
names as (select {sql_name_key('name')} h, arg_min({{'tz': tz_name, 'ord': date_order}}, id) s from sources where coalesce({sql_name_key('name')}, '') <> '' group by 1),
placed as (select a.article_seq, coalesce(x.s, y.s) s, raw_published_at, published_at_utc, published_at_jst, fetched_at_utc from articles a left join hosts x on x.h = regexp_replace(lower(trim(coalesce(source_domain, ''))), '^www\\.', '') left join names y on y.h = coalesce({sql_name_key('source_name')}, ''))"""
_JST = "(select * from (values ('UTC', 0), ('GMT', 0), ('JST', 540)) v(c, o))"
SQL_FOUND = f"""with {SQL_SOURCE}, {read_sql('said', "select article_seq q, raw_published_at t, s.ord ord, s.tz tz from placed")},
{read_sql('utc', "select article_seq q, published_at_utc t, 'ymd' ord, 'UTC' tz from articles")}, {read_sql('got', "select article_seq q, fetched_at_utc t, 'ymd' ord, 'UTC' tz from articles")},
{read_sql('jst', "select article_seq q, published_at_jst t, 'ymd' ord, 'Asia/Tokyo' tz from articles", _JST)},
jday as (select q, case when form in ('iso', 'basic') then cast(floor((e + 32400) / 86400e0) as bigint) end as jst_day from jst)
select said.q as article_seq, said.e as published_epoch from said join utc using (q) join got using (q) join jday using (q) where said.e between got.e - 7300 * 86400 and got.e + 86400 and not coalesce(utc.e = said.e and jday.jst_day = cast(floor((said.e + 32400) / 86400e0) as bigint), false)"""
