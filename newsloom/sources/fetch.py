"""Conditional fetching with an injected transport."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .feeds import items

Transport = Callable[[str, dict, float], tuple[int, dict, bytes]]
FINAL = {401, 403, 404, 410, 429}  # fixed values: statuses that a repeat doesn't mend
CURSOR = {
    "last_fetch_started_at": "string", "last_fetch_completed_at": "string", "latest_published_at": "string", "latest_article_id": "string", "etag": "string", "last_modified": "string", "last_http_status": "int", "consecutive_failures": "int",
    "last_success_count": "int", "next_retry_at": "string", "last_error": "string",
}
RESULT = "source_name string, status string, http_status int, etag string, last_modified string, error string, items array<struct<title string, url string, description string, published_raw string, updated_raw string, source string>>"


def user_agent(name: str, contact: str = "", home: str = "") -> str:
    more = "; ".join(x for x in (f"contact: {contact}" if contact else "", home) if x)
    return f"{name} ({more})" if more else name


def headers(etag: str | None, modified: str | None, agent: str) -> dict[str, str]:
    out = {"User-Agent": agent, "Accept": "application/rss+xml, application/atom+xml, application/xml;q=0.9, */*;q=0.5"}
    if etag:
        out["If-None-Match"] = etag
    if modified:
        out["If-Modified-Since"] = modified
    return out


def http_transport(url: str, head: dict, timeout: float) -> tuple[int, dict, bytes]:
    """A plain GET; any status is an answer, no connection is an exception."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=head), timeout=timeout) as r:
            return r.status, dict(r.headers), r.read()
    except urllib.error.HTTPError as x:
        return x.code, dict(x.headers or {}), b""


def json_transport(url: str, head: dict, timeout: float) -> tuple[int, dict | None]:
    """http_transport's answer as JSON, None where it is none."""
    status, _, body = http_transport(url, head, timeout)
    try:
        return status, json.loads(body)
    except ValueError:
        return status, None


def file_transport(url: str, _headers: dict, _timeout: float) -> tuple[int, dict, bytes]:
    with open(url.removeprefix("file://"), "rb") as f:
        return 200, {}, f.read()


def fetch_one(name: str, url: str, etag: str | None, modified: str | None, transport: Transport, timeout: float = 12, retry: int = 1, max_items: int = 200, agent: str = "newsloom") -> tuple:
    """One row of RESULT; never raises. 304 is not_modified; statuses in FINAL aren't tried again."""
    status, error = 0, ""
    for _ in range(retry + 1):
        try:
            status, got, body = transport(url, headers(etag, modified, agent), timeout)
        except Exception as x:
            status, error = 0, f"{type(x).__name__}: {x}"[:200]
            continue
        lower = {k.lower(): v for k, v in got.items()}
        if status == 304:
            return name, "not_modified", 304, etag, modified, "", []
        if status == 200:
            return name, "ok", 200, lower.get("etag", ""), lower.get("last-modified", ""), "", items(body, url, max_items)
        error = f"http_{status}"
        if status in FINAL:
            break
    return name, "failed", status or None, etag, modified, error, []


def fetch(sources: DataFrame, transport: Transport, per_host: int = 2, pause: float = 0.0, **options) -> DataFrame:
    """sources (source_name, url, etag, last_modified) to RESULT. A host's sources share per_host tasks at most."""
    host = F.regexp_extract("url", "^[a-z]+://([^/]*)", 1)
    spread = sources.withColumn("_host", host).withColumn("_lane", F.pmod(F.xxhash64("url"), F.lit(per_host))).repartition("_host", "_lane")

    def run(batches):
        for p in batches:
            import pandas as pd

            rows = []
            for r in p.itertuples(index=False):
                rows.append(fetch_one(r.source_name, r.url, r.etag, r.last_modified, transport, **options))
                time.sleep(pause)
            out = pd.DataFrame(rows, columns=["source_name", "status", "http_status", "etag", "last_modified", "error", "items"])
            names = ["title", "url", "description", "published_raw", "updated_raw", "source"]
            out["items"] = [[dict(zip(names, i)) for i in x] for x in out["items"]]
            out["http_status"] = out["http_status"].astype("Int32")
            yield out

    return spread.select("source_name", "url", "etag", "last_modified").mapInPandas(run, RESULT)


def advance(cursors: DataFrame, results: DataFrame, now: str, newest: DataFrame | None = None) -> DataFrame:
    """Cursors after a run over results (source_name, status, http_status, etag, last_modified, error).

    An answer clears the failures and takes over the marks it has; one with new articles, newest (source_name,
    latest_published_at, latest_article_id, n), moves the position; a failure counts, waits half an hour and moves
    nothing. Sources without a result stay as they are, new ones get a cursor.
    """
    known = set(cursors.columns)
    had = cursors.select("source_name", *((F.col(c) if c in known else F.lit(None).cast(t)).alias(c) for c, t in CURSOR.items()))
    r = results.select("source_name", F.col("status").alias("_s"), F.col("http_status").alias("_h"), F.col("etag").alias("_e"), F.col("last_modified").alias("_m"), F.col("error").alias("_x"))
    n = newest.select("source_name", F.col("latest_published_at").alias("_p"), F.col("latest_article_id").alias("_a"), F.col("n").alias("_n")) if newest is not None else None
    x = had.join(r, "source_name", "full")
    x = x.join(n, "source_name", "left") if n is not None else x.withColumns({c: F.lit(None).cast(t) for c, t in (("_p", "string"), ("_a", "string"), ("_n", "bigint"))})
    ok, answered, bad = F.col("_s") == "ok", F.col("_s").isin("ok", "not_modified"), F.col("_s") == "failed"
    later = F.date_format(F.lit(now).cast("timestamp") + F.expr("interval 30 minutes"), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    moved = lambda new, old: F.when(ok & F.col(new).isNotNull(), F.col(new)).otherwise(F.col(old)).alias(old)
    mark = lambda new, old: F.when(answered & (F.coalesce(new, F.lit("")) != ""), F.col(new)).otherwise(F.col(old)).alias(old)
    stamp = lambda old: F.when(F.col("_s").isNotNull(), F.lit(now)).otherwise(F.col(old)).alias(old)
    return x.select(
        "source_name", stamp("last_fetch_started_at"), stamp("last_fetch_completed_at"), moved("_p", "latest_published_at"), moved("_a", "latest_article_id"), mark("_e", "etag"), mark("_m", "last_modified"),
        F.when(F.col("_s").isNotNull(), F.col("_h")).otherwise(F.col("last_http_status")).alias("last_http_status"), F.when(answered, 0).when(bad, F.coalesce("consecutive_failures", F.lit(0)) + 1).otherwise(F.col("consecutive_failures")).alias("consecutive_failures"),
        F.when(ok, F.coalesce("_n", F.lit(0)).cast("int")).otherwise(F.col("last_success_count")).alias("last_success_count"), F.when(bad, later).otherwise(F.col("next_retry_at")).alias("next_retry_at"), F.when(answered, "").when(bad, F.col("_x")).otherwise(F.col("last_error")).alias("last_error"),
    )


def reachable(sources: DataFrame, transport: Transport, **options) -> DataFrame:
    """(status, n): one request to each source (source_name, url), as a check before it is enabled; nothing is kept."""
    asked = sources.select("source_name", "url", F.lit(None).cast("string").alias("etag"), F.lit(None).cast("string").alias("last_modified"))
    status = F.when(F.col("status").isin("ok", "not_modified"), "reachable").otherwise("failed")
    return fetch(asked, transport, **options).groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def load_cursors(spark: SparkSession, path: str) -> DataFrame:
    """The last whole set of cursors under a folder; an empty one where there is none."""
    v = _versions(spark, path)
    if v:
        return spark.read.parquet(f"{path}/{v[-1]}")
    return spark.createDataFrame([], "source_name string, " + ", ".join(f"{c} {t}" for c, t in CURSOR.items()))


def save_cursors(cursors: DataFrame, path: str) -> None:
    """Writes a new set beside the old one, which goes when the new one is whole."""
    spark, v = cursors.sparkSession, _versions(cursors.sparkSession, path)
    cursors.coalesce(1).write.parquet(f"{path}/v{int(v[-1][1:]) + 1 if v else 0:09d}")  # a row for each source
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for old in v:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{old}"), True)


def _versions(spark: SparkSession, path: str) -> list[str]:
    to = spark._jvm.org.apache.hadoop.fs.Path
    fs = to(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(to(path)):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(to(path))) if fs.exists(to(f"{path}/{n}/_SUCCESS")))
