"""Disclosure and statistics services: JSON text to raw records, all by expressions."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import disclosure
from ..functions.times import jst_to_utc

EDINET_URL = "https://disclosure.edinet-fsa.go.jp/api/v2/documents.json?date={date}&type=2&Subscription-Key={key}"
ESTAT_URL = "https://api.e-stat.go.jp/rest/3.0/app/json/getStatsList?appId={key}&limit={limit}"
_NAMES = ["docID", "filerName", "issuerName", "docDescription", "secCode", "securityCode", "edinetCode", "docTypeCode", "submitDateTime", "submitDate", "periodStart", "periodEnd", "withdrawalStatus", "parentDocID"]
_SPELLED = {"docId": "docID", "submitDatetime": "submitDateTime", "parentDocId": "parentDocID"}  # other spellings, which Spark doesn't tell apart
DOCUMENT = ", ".join(f"{n} string" for n in _NAMES)
RESULT = "source_name string, adapter string, status string, http_status int, error string, max_items int, body string"
JsonTransport = Callable[[str, dict, float], "tuple[int, str | dict | None]"]
# Kinds of the usual form codes.
DOCTYPES = {"120": "earnings", "130": "earnings", "140": "earnings", "150": "earnings", "160": "earnings", "180": "other", "350": "large_shareholding", "360": "large_shareholding"}
_TEXT = "struct<`$`:string>"
TABLE = f"struct<`@id`:string,STAT_NAME:{_TEXT},TITLE:{_TEXT},GOV_ORG:{_TEXT},UPDATED_DATE:string,UPDATE_DATE:string,SURVEY_DATE:string>"


def some(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def doctype(code: Column, names: dict[str, str] | None = None) -> Column:
    pairs = [F.lit(x) for kv in (names or DOCTYPES).items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), code)


def first(*names: str) -> Column:
    """The first field that is there and isn't empty, else ''."""
    return F.coalesce(*(F.when(F.col(n) != "", F.col(n)) for n in names), F.lit(""))


def edinet(payloads: DataFrame, names: dict[str, str] | None = None, max_items: int | Column = 2000) -> DataFrame:
    """payloads (url, body) to raw records of documents that aren't withdrawn, max_items of each payload; feed is the
    payload's url."""
    body = F.col("body")
    for k, v in _SPELLED.items():
        body = F.replace(body, F.lit(f'"{k}":'), F.lit(f'"{v}":'))
    docs = F.from_json(body, f"results array<struct<{DOCUMENT.replace(' string', ':string')}>>")
    docs = F.filter(docs["results"], lambda x: some(x["docID"]).isNotNull() & (F.coalesce(x["withdrawalStatus"], F.lit("0")) != "1"))
    x = payloads.select(F.col("url").alias("feed"), F.posexplode(F.slice(docs, 1, max_items)).alias("pos", "doc")).select("feed", "pos", "doc.*")
    code, filer, text = first("docTypeCode"), first("filerName", "issuerName"), first("docDescription")
    kind, by_text = doctype(code, names), disclosure(text, code)
    kind = F.when(some(kind).isNotNull() & (kind != "other"), kind).otherwise(by_text["kind"])
    lone = F.regexp_replace(F.concat(filer, F.lit("（"), code, F.lit("）")), "^[（）]+|[（）]+$", "")
    ident, submitted, parent = first("docID"), first("submitDateTime", "submitDate"), first("parentDocID")
    address = F.concat(F.lit("https://disclosure2.edinet-fsa.go.jp/WEEK0010.aspx?docID="), ident)
    more = {
        "adapter": F.lit("edinet"), "doc_id": ident, "edinet_code": first("edinetCode"), "security_code": first("secCode", "securityCode"), "company_name": filer, "doc_type_code": code, "disclosure_type": kind, "materiality": by_text["materiality"], "period_start": first("periodStart"),
        "period_end": first("periodEnd"), "is_withdrawal": F.lit("false"), "is_correction": (parent != "").cast("string"), "parent_doc_id": parent, "official_url": address,
    }
    return x.select(
        "feed", ident.alias("doc_id"), F.when(text != "", text).otherwise(lone).alias("title"), address.alias("url"), F.substring(text, 1, 400).alias("description"), jst_to_utc(submitted).alias("published_at_utc"), submitted.alias("published_raw"), F.lit("EDINET").alias("source"),
        filer.alias("company_name"), kind.alias("disclosure_type"), by_text["materiality"].alias("materiality"), (parent != "").alias("is_correction"), F.create_map(*(y for k, v in more.items() for y in (F.lit(k), v))).alias("source_metadata"),
    )


def whitelisted(name: Column, terms: list[str]) -> Column:
    """The first term, in order, that the name contains; null for none."""
    return F.coalesce(*(F.when(name.contains(t), t) for t in terms)) if terms else F.lit(None).cast("string")


def estat(payloads: DataFrame, terms: list[str], max_items: int | Column = 200) -> DataFrame:
    """payloads (url, body) to raw records of tables named in the list; a lone table may stand without its array, and
    names may be text or hold it under $."""
    at = "$.GET_STATS_LIST.DATALIST_INF.TABLE_INF"
    raw = F.get_json_object("body", at)
    raw = F.regexp_replace(raw, '"(STAT_NAME|TITLE|GOV_ORG)":("(?:[^"\\\\]|\\\\.)*")', '"$1":{"\\$":$2}')
    tables = F.when(raw.startswith("["), F.from_json(raw, f"array<{TABLE}>")).otherwise(F.array_compact(F.array(F.from_json(raw, TABLE))))
    part = lambda t, c: F.coalesce(t[c]["$"], F.lit(""))
    named = lambda t: F.trim(F.concat(part(t, "STAT_NAME"), F.lit(" "), part(t, "TITLE")))
    good = F.filter(tables, lambda t: (F.coalesce(t["@id"], F.lit("")) != "") & whitelisted(named(t), terms).isNotNull())
    x = payloads.select(F.col("url").alias("feed"), F.posexplode(F.slice(good, 1, max_items)).alias("pos", "t"))
    series, updated, ident = named(F.col("t")), F.coalesce(some(F.col("t.UPDATED_DATE")), some(F.col("t.UPDATE_DATE")), F.lit("")), F.col("t")["@id"]
    address, released = F.concat(F.lit("https://www.e-stat.go.jp/dbview?sid="), ident), jst_to_utc(updated)
    category, org, period = whitelisted(series, terms), part(F.col("t"), "GOV_ORG"), F.coalesce("t.SURVEY_DATE", F.lit(""))
    blank = {k: F.lit("") for k in ("value", "unit", "previous_value", "revised_value")}
    more = {"adapter": F.lit("estat"), "statistical_type": F.lit("statistical_release"), "stats_data_id": ident, "series_name": series, "reference_period": period, "released_at": released, **blank, "revision_flag": F.lit("false"), "category": category, "gov_org": org, "official_url": address}
    return x.select(
        "feed", ident.alias("doc_id"), F.concat(F.lit("[統計更新] "), series).alias("title"), address.alias("url"), F.substring(series, 1, 400).alias("description"), released.alias("published_at_utc"), updated.alias("published_raw"), F.lit("e-Stat").alias("source"),
        series.alias("series_name"), org.alias("gov_org"), period.alias("reference_period"), category.alias("category"), F.create_map(*(y for k, v in more.items() for y in (F.lit(k), v))).alias("source_metadata"),
    )


ADAPTERS = {"edinet": "edinet_key", "estat": "estat_app_id"}


def request_url(adapter: str, key: str, day: str, max_items: int, updated: str = "") -> str:
    if adapter == "edinet":
        return EDINET_URL.format(date=day, key=key)
    return ESTAT_URL.format(key=key, limit=max_items) + (f"&updatedDate={updated}" if updated else "")


def ask(name: str, adapter: str, max_items: int | None, day: str, context: dict, transport: JsonTransport, timeout: float = 12) -> tuple:
    """One row of RESULT; never raises. Without a key nothing is asked; an answer that isn't a JSON object fails."""
    limit = max_items or (2000 if adapter == "edinet" else 200)
    row = lambda status, http, error, body: (name, adapter, status, http, error, limit, body)
    if adapter not in ADAPTERS:
        return row("failed", None, f"unknown_adapter:{adapter}", None)
    if not (key := context.get(ADAPTERS[adapter])):
        return row("failed", None, "api_key_unset", None)
    try:
        status, got = transport(request_url(adapter, key, day, limit, context.get("estat_updated", "")), {"Accept": "application/json"}, timeout)
    except Exception as x:
        return row("failed", 0, f"{type(x).__name__}: {x}"[:120].replace(key, "***"), None)
    try:
        got = json.loads(got) if isinstance(got, str) else got
    except ValueError:
        got = None
    if status != 200 or not isinstance(got, dict):
        return row("failed", status, f"http_{status}", None)
    return row("ok", 200, "", json.dumps(got, ensure_ascii=False))


def fetch(sources: DataFrame, day: str, context: dict, transport: JsonTransport, timeout: float = 12) -> DataFrame:
    """sources (name, adapter, max_items_per_fetch) to RESULT; the day is Japan's. A source that fails stops no other."""

    def run(batches):
        for p in batches:
            rows = [ask(r.name, (r.adapter or "rss").lower(), None if pd.isna(r.max_items_per_fetch) else int(r.max_items_per_fetch), day, context, transport, timeout) for r in p.itertuples(index=False)]
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])
            yield out.astype({"http_status": "Int32", "max_items": "Int32"})

    return sources.select("name", "adapter", "max_items_per_fetch").mapInPandas(run, RESULT)


def records(results: DataFrame, context: dict) -> DataFrame:
    """Raw records (source_name, title, url, description, published_at_utc, published_raw, source, source_metadata) of
    the results that are ok, as many of each source as it may have."""
    good = results.where("status = 'ok'").select(F.col("source_name").alias("url"), "adapter", "max_items", "body")
    kept = [F.col("feed").alias("source_name"), "title", "url", "description", "published_at_utc", "published_raw", "source", "source_metadata"]
    a = edinet(good.where("adapter = 'edinet'"), context.get("edinet_doctypes"), F.col("max_items")).select(*kept)
    b = estat(good.where("adapter = 'estat'"), context.get("estat_terms") or [], F.col("max_items")).select(*kept)
    return a.unionByName(b)
