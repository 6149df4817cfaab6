from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from newsloom import pipeline
from newsloom.sources import catalog, fetch

RAW = "seq long, source_id string, title string, url string, description string, published_at_utc string, published_raw string"


def test_second_run_adds_nothing(spark, tmp_path):
    rows = [(1, "a", "Iran sanctions", "https://e.com/1?utm_a=1", "d", "2026-07-14T00:00:00Z", ""), (2, "a", "Iran sanctions!", "https://e.com/2", "d", "2026-07-14T00:00:00Z", ""), (3, "b", "Other", "http://www.e.com/1/", "", "2050-01-01T00:00:00Z", "r"), (4, "zz", "Third", "https://e.com/3", None, None, None), (5, None, None, None, None, None, None)]
    sources = spark.createDataFrame([("a", "A", 0.9, "JP", "ja", "major_news"), ("b", "B", 0.1, "", "en", None)], "id string, name string, trust double, country string, language string, source_class string")
    now, store = F.lit("2026-07-15T00:00:00+00:00").cast("timestamp"), str(tmp_path / "store")
    raw = spark.createDataFrame(rows, RAW)
    new, counts = pipeline.run(raw, sources, store, now, "r1")
    got = {x.seq: x for x in new.collect()}
    assert set(got) == {1, 4, 5} and counts["duplicates"] == 2 and got[1].countries == ["JP"] and got[4].source_trust == 0.5
    assert got[4].date_inferred and got[4].published_at_utc == "2026-07-15T00:00:00+00:00"
    _, again = pipeline.run(raw, sources, store, now, "r2")
    assert again["new"] == 0 and again["duplicates"] == 5 and spark.read.parquet(store).count() == 3


RSS = b"<?xml version='1.0'?><rss><channel><title>c</title>%s</channel></rss>"
ITEM = b"<item><title>%s</title><link>%s</link><pubDate>Tue, 14 Jul 2026 0%d:00:00 GMT</pubDate></item>"


def test_live_runs(spark, tmp_path):
    """Two sources, one of which fails at first, and a service without a key; then again with what is new."""
    sources = catalog.load_sources(spark, {"sources": [{"id": "a", "name": "A", "url": "http://h/a"}, {"id": "b", "name": "B", "url": "http://h/b"}, {"id": "e", "name": "E", "url": "http://e", "adapter": "edinet"}, {"id": "off", "name": "Off", "url": "http://h/off", "enabled": False}]})
    cursors = spark.createDataFrame([], "source_name string, etag string, last_modified string")
    one, two = ITEM % (b"Copper quota", b"http://n/1", 1), ITEM % (b"Zinc levy", b"http://n/2", 2)
    first = lambda u, h, t: (200, {"ETag": "v1"}, RSS % (one + two)) if u.endswith("a") else (500, {}, b"")
    later = lambda u, h, t: (304, {}, b"") if h.get("If-None-Match") == "v1" else (200, {}, RSS % (one + ITEM % (b"Bond sale", b"http://n/3", 3)))
    store, seen = str(tmp_path / "store"), []
    after, results, counts = pipeline.run_live(sources, cursors, store, first, "2026-07-15T00:00:00+00:00", "r1", log=seen.append)
    got = {r.source: (r.status, r.fetched, r.new_items, r.duplicates) for r in results.collect()}
    assert got == {"A": ("success", 2, 2, 0), "B": ("failed", 0, 0, 0), "E": ("failed", 0, 0, 0)} and counts["new"] == 2 and [r["source"] for r in seen] == ["A", "B", "E"]
    c = {r.source_name: r for r in after.collect()}
    assert c["A"].etag == "v1" and c["A"].latest_published_at == "2026-07-14T02:00:00+00:00" and c["A"].last_success_count == 2 and c["A"].latest_article_id.startswith("art_")
    assert c["B"].consecutive_failures == 1 and c["B"].next_retry_at == "2026-07-15T00:30:00+00:00" and c["E"].last_error == "api_key_unset"
    after, results, counts = pipeline.run_live(sources, after, store, later, "2026-07-15T06:00:00+00:00", "r2")
    got = {r.source: (r.status, r.fetched, r.new_items, r.duplicates) for r in results.collect()}
    assert got["A"] == ("unchanged", 0, 0, 0) and got["B"] == ("success", 2, 1, 1) and spark.read.parquet(store).count() == 3
    c = {r.source_name: r for r in after.collect()}
    assert c["A"].latest_published_at == "2026-07-14T02:00:00+00:00" and c["B"].consecutive_failures == 0 and c["B"].latest_published_at == "2026-07-14T03:00:00+00:00"

    at = datetime(2026, 7, 15, tzinfo=timezone.utc)
    stats = pipeline.run_stats("r2", at, at + timedelta(seconds=2), results, 4, 3, quarantine_count=0)
    assert stats["run_status"] == "degraded" and stats["successful_sources"] == 1 and stats["new_unique_articles"] == 1 and stats["total_seconds"] == 2
    assert pipeline.run_stats("r", at, at, results, 4, 3, publication_ok=False)["exit_code"] == 1
    where = str(tmp_path / "stats")
    assert pipeline.latest_run_stats(spark, where) is None
    for s in (stats | {"run_id": "r1"}, stats):
        pipeline.save_run_stats(spark, where, s)
    assert pipeline.latest_run_stats(spark, where) == stats and pipeline.new_run_id(at, "abc123") == "20260715T000000Z-abc123"
    _, results, _ = pipeline.run_live_source(sources, "B", after, store, later, "2026-07-15T12:00:00+00:00", "r3")
    assert [(r.source, r.duplicates) for r in results.collect()] == [("B", 2)]


def test_reachable(spark):
    s = spark.createDataFrame([("a", "http://h/1"), ("b", "http://h/2")], "source_name string, url string")
    got = {r.status: r.n for r in fetch.reachable(s, lambda u, h, t: (304, {}, b"") if u.endswith("1") else (404, {}, b"")).collect()}
    assert got == {"reachable": 1, "failed": 1}
