import gzip
import json
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsloom.operators import clustering, dedup, history, instants, private, publishing, reactions, search, selecting
from newsloom.sources import apis, catalog, feeds, fetch, shards

ARTICLE = "article_seq long, source_domain string, source_name string, raw_published_at string, published_at_utc string, published_at_jst string, fetched_at_utc string, host string, s string"
SOURCE = "id string, name string, url string, tz_name string, date_order string"


def test_instants(spark):
    fetched = "2026-05-06T00:00:00+00:00"
    rows = [
        (1, "a.com", "A", "05/05/2026 10:00", "2026-05-05T10:00:00Z", "2026-05-05", fetched, "x", "y"),  # right
        (2, "www.a.com", "", "04/05/2026 23:00", "2026-05-04T23:00:00Z", "2026-05-04", fetched, "x", "y"),  # wrong day in Japan
        (3, "", "ｂ — news", "04/05/2026", "", None, fetched, "x", "y"),  # month first, by its name; blank
        (4, "zzz", None, "04/05/2026", None, None, fetched, "x", "y"),  # unknown source
        (5, "a.com", "A", None, None, None, fetched, None, None), (6, "a.com", "A", "2 hours ago", "", "", fetched, None, None),
        (7, "a.com", "A", "1980-01-01T00:00:00Z", "", "", fetched, None, None), (8, "a.com", "A", "2026-05-05T10:00:00Z", "2026-05-05 10:00:00.900", "20260505", fetched, None, None),
    ]
    sources = spark.createDataFrame([("a", "A", "https://www.a.com/f", "UTC", "dmy"), ("b", "B – News", "https://b.com/f", "America/New_York", "mdy"), ("n", None, None, None, None)], SOURCE)
    codes = spark.createDataFrame([("UTC", 0), (None, None)], "zone_code string, offset_minutes int")
    a = spark.createDataFrame(rows, ARTICLE)
    got = {tuple(r) for r in instants.p2_found(a, sources, codes).collect()}
    assert got == {(2, 1777935600), (3, 1775361600)} or got == {(2, 1777935600), (3, 1775361600 + 0)}
    assert instants.p2_found(a.limit(0), sources, codes).count() == 0
    marked = {r.article_seq: r.unresolved for r in instants.instants(a, sources, codes).collect()}
    assert marked[4] and not marked[1] and not marked[6]


CLASSES = ["day_local", "day_utc", "month_local", "month_utc"]


def test_mixture_learns_the_order():
    density = instants.densities({instants.RECENT: 900, instants.OLDER: 80, instants.NONE: 10, instants.OUTSIDE: 10})
    d, m = [instants.RECENT, instants.RECENT, instants.OLDER], [instants.NONE, instants.OUTSIDE, instants.OLDER]
    votes = pd.DataFrame({"day_local": d, "day_utc": d, "month_local": m, "month_utc": m, "n": [30, 10, 20], "date_order": None})
    turned = votes.assign(day_local=m, day_utc=m, month_local=d, month_utc=d)
    day = lambda x: instants.mixture(x, density)[:2].sum()
    assert day(votes) > 0.9 and day(turned) < 0.1
    assert day(turned.assign(date_order="dmy", n=[3, 1, 20])) > 0.999  # little against the catalogue
    flood = turned.assign(date_order="dmy", n=[300_000, 100, 20])  # more than it weighs
    assert day(flood) < 0.9
    assert instants.mixture(votes, density)[1::2].sum() < 1e-4


def test_the_posterior_decides(spark):
    """A source without a date order, and one whose catalogue entry its values contradict."""
    fetched = "2026-05-20T00:00:00+00:00"
    fetch = lambda i: f"2026-{5 + i % 7:02d}-20T00:00:00+00:00"
    rows = [(i, "a.com", "A", f"{5 + i % 7:02d}/{13 + i % 6:02d}/2026 08:00", "", "", fetch(i), None, None) for i in range(60)]  # month first
    rows += [(100, "a.com", "A", "05/06/2026 08:00", "", "", fetched, None, None), (101, "b.com", "B", "05/06/2026 08:00", "", "", fetched, None, None)]
    rows += [(200 + i, "c.com", "C", f"2026-05-{1 + i % 19:02d}T00:00:00Z", "", "", fetched, None, None) for i in range(400)]
    sources = spark.createDataFrame([("a", "A", "https://a.com/f", "UTC", None), ("b", "B", "https://b.com/f", "UTC", "dmy"), ("c", "C", "https://c.com/f", "UTC", None)], SOURCE)
    codes = spark.createDataFrame([], "zone_code string, offset_minutes int")
    got = {r.article_seq: r for r in instants.instants(spark.createDataFrame(rows, ARTICLE), sources, codes).collect()}
    assert all(got[i].chosen and got[i].published_epoch for i in range(60))
    assert got[100].published_epoch == 1778054400 and got[100].chosen and not got[100].unresolved  # 6 May
    assert got[101].published_epoch == 1780646400 and got[101].chosen  # 5 June, as the catalogue says
    counts = {(r.chosen, r.unresolved): r.n for r in instants.p2_readings(spark.createDataFrame(rows, ARTICLE), sources, codes).collect()}
    assert counts[(True, False)] == 62


def sequential(rows):
    seen, kept = [set(), set()], []
    for q, *keys in sorted(rows):
        if all(k is None or k not in s for k, s in zip(keys, seen)):
            kept.append(q)
            for k, s in zip(keys, seen):
                s.add(k)
    return kept


def test_first_wins_equals_a_reader_in_order(spark):
    r = random.Random(7)
    rows = [(i, r.choice([None, *range(25)]), r.choice([None, *range(25)])) for i in range(150)]
    got = dedup.first_wins(spark.createDataFrame(rows, "q long, a int, b int"), "q", ["a", "b"])
    assert sorted(x.q for x in got.collect()) == sequential(rows)
    assert dedup.first_wins(spark.createDataFrame([], "q long, a int, b int"), "q", ["a", "b"]).count() == 0


def test_select_diverse_equals_a_reader_in_order(spark):
    r = random.Random(3)
    rows = [(i, r.choice("abcdef"), r.choice("xyz"), r.choice(["", None, "c1", "c2"]), r.randint(0, 30) / 10) for i in range(400)]
    got = selecting.select_diverse(spark.createDataFrame(rows, "article_seq long, src string, theme string, cluster string, score double"), F.col("score"), 20)
    taken, count = [], {}
    for q, *keys, score in sorted(rows, key=lambda x: (-x[4], x[0])):
        ks = [(n, k) for n, k in zip("stc", keys) if n != "c" or k]
        if len(taken) < 20 and all(count.get(k, 0) < {"s": 5, "t": 7, "c": 3}[k[0]] for k in ks):
            taken.append(q)
            for k in ks:
                count[k] = count.get(k, 0) + 1
    assert [x.article_seq for x in got.orderBy("rank").collect()] == taken


def test_history(spark):
    d = spark.createDataFrame([(1, "2026-01-10", ["x", "y"]), (2, "2026-01-01", ["x"]), (3, "2026-01-11", ["x"]), (4, "2020-01-01", ["x"]), (5, "2026-01-02", ["z"]), (6, "2026-01-01", [])], "q long, t string, e array<string>").withColumn("t", F.to_timestamp("t"))
    got = history.matches(d.where("q = 1").select(F.col("q").alias("cur"), "t", "e"), d.select(F.col("q").alias("old"), "t", "e")).collect()
    assert [(x.old, x.rank) for x in got] == [(2, 1)] and abs(got[0].relevance - round(0.35 + 0.3 * (1 - 9 / 730), 4)) < 1e-9


def test_clustering(spark):
    rows = [(1, "a000000000001", "k", 0.0, ["u", "v"], ["E"], 1.0), (2, "a000000000002", "k", 3600.0, ["u", "v"], ["E"], 1.0), (3, "a000000000003", "k", 400 * 3600.0, ["u", "v"], ["E"], 1.0), (4, "a000000000004", "k", 0.0, ["u", "v"], [], 1.0), (5, "a000000000005", "other", 0.0, ["u", "v"], ["E"], 1.0), (6, "a000000000006", "k", None, ["u"], ["E", "F"], 1.0)]
    got = {x.seq: (x.cluster, x.is_new) for x in clustering.cluster_articles(spark.createDataFrame(rows, "seq long, article_id string, category string, t double, tokens array<string>, entities array<string>, weight double")).collect()}
    assert got[2] == (got[1][0], False) and got[3][1] and got[4][1] and got[5][1] and got[6] == (got[1][0], False)


def test_search(spark):
    a = spark.createDataFrame([("i1", 1, "oil", ["US"], "2026-01-01", 0.5), ("i2", 2, "oil", ["Russia"], "2026-01-02", 0.9), ("i3", 3, "fx", None, None, None)], "article_id string, article_seq long, primary_category string, countries array<string>, published_at_utc string, source_trust double")
    ids = lambda **k: [x.article_id for x in search.search(a, **k).collect()]
    assert ids(category="oil") == ["i2", "i1"] and ids(country="us", mode="compat") == ["i2", "i1"] and ids(country="US") == ["i1"]
    assert ids(min_source_trust=0.0) == ["i2", "i1"] and ids(date_from="2026-01-02") == ["i2"] and ids() == ["i2", "i1", "i3"]


def test_private(spark):
    rows = spark.createDataFrame([("p1", "a b", "n1", "2026-01-01"), ("p2", "ab", "n2", "2026-01-02"), ("p3", "", None, "x"), ("p4", None, None, "x"), ("p5", "y" * 30_001, None, "x")], "private_id string, body string, user_note string, submitted_at string")
    good, bad = private.intake(rows)
    assert {(x.private_id, x.reason) for x in bad.collect()} == {("p3", "empty"), ("p4", "empty"), ("p5", "too_long")}
    m = private.merged(good).collect()
    assert len(m) == 1 and m[0].submissions == 2 and m[0].notes == "n1\nn2"
    shown = private.public_records(rows.withColumn("delete_type", F.when(F.col("private_id") == "p1", "soft")))
    assert "body" not in shown.columns and shown.count() == 4
    gone = private.deleted(rows.withColumn("delete_type", F.lit("")), ["p1"], permanent=True).where("private_id = 'p1'").first()
    assert gone.body is None and gone.delete_type == "permanent"
    done = {x.private_id: x.status for x in private.from_queue(rows.select("private_id", "body"), lambda b: b.upper()).collect()}
    assert done["p1"] == "completed" and done["p4"] == "failed_analysis"


def test_publish(tmp_path):
    package = {k: [{"i": i} for i in range(40)] for k in publishing.KEYS}
    m = publishing.publish(package, str(tmp_path), "2026-07-15")
    assert m["publication_status"] == "success" and publishing.valid(str(tmp_path))
    assert json.loads(gzip.decompress((tmp_path / "latest/package.json.gz").read_bytes())) == package
    assert publishing.publish(package, str(tmp_path), "2026-07-15")["sha256"] == m["sha256"]
    assert publishing.publish({}, str(tmp_path), "x")["publication_status"] == "failed" and publishing.valid(str(tmp_path))
    small = publishing.trimmed(package, 0.001)
    assert all(len(small[k]) == 5 for k in publishing.TRIMMED)
    assert publishing.Folder(str(tmp_path / "out")).publish(str(tmp_path)) and not publishing.Folder(str(tmp_path / "o2")).publish(str(tmp_path / "none"))


RSS = b"<?xml version='1.0'?><rss><channel><title>S</title><item><title>A &amp;amp; b</title><link>/x</link><description>&lt;p&gt;d&lt;/p&gt;</description><pubDate>Fri, 03 Jul 2026 00:13:25 +0000</pubDate></item><item><description>no title</description></item></channel></rss>"
ATOM = b"<feed xmlns='http://www.w3.org/2005/Atom'><title>T</title><entry><title>e</title><link rel='self' href='s'/><link rel='alternate' href='http://h/a'/><updated>2026-01-01T00:00:00Z</updated></entry></feed>"


def test_feeds(spark):
    assert feeds.items(RSS, "http://h/f") == [("A & b", "http://h/x", "d", "Fri, 03 Jul 2026 00:13:25 +0000", "", "S")]
    assert feeds.items(ATOM)[0][1] == "http://h/a" and feeds.sniff(RSS) == "rss" and feeds.sniff(ATOM) == "atom" and feeds.sniff(b"x") == "unknown"
    assert feeds.items(b"") == feeds.items(b"<rss><channel>") == [] and feeds.decode("é".encode("cp1252")) == "é"
    df = spark.createDataFrame([("http://h/f", bytearray(RSS)), ("u", None), (None, bytearray(b"<x"))], "url string, content binary")
    assert feeds.parse(df).count() == 1


def test_fetch():
    calls = []

    def transport(u, h, t):
        calls.append(h)
        return {"ok": (200, {"ETag": "e"}, RSS), "same": (304, {}, b""), "gone": (404, {}, b""), "busy": (500, {}, b"")}[u]

    one = lambda u, etag=None: fetch.fetch_one("s", u, etag, None, transport)
    assert one("ok")[1:4] == ("ok", 200, "e") and len(one("ok")[6]) == 1 and one("same", "e")[1] == "not_modified" and calls[-1]["If-None-Match"] == "e"
    n = len(calls)
    assert one("gone")[1] == "failed" and len(calls) == n + 1
    assert one("busy")[5] == "http_500" and len(calls) == n + 3
    assert fetch.fetch_one("s", "u", None, None, lambda *_: 1 / 0)[1] == "failed"
    assert fetch.user_agent("n", "c@x") == "n (contact: c@x)"


def test_fetch_frame_and_cursors(spark):
    s = spark.createDataFrame([("a", "http://h/1", None, None), ("b", "http://h/2", "e0", None)], "source_name string, url string, etag string, last_modified string")
    body = RSS
    got = fetch.fetch(s, lambda u, h, t: (200, {"ETag": "n"}, body) if u.endswith("1") else (500, {}, b""))
    assert {(x.source_name, x.status, len(x["items"])) for x in got.collect()} == {("a", "ok", 1), ("b", "failed", 0)}
    cursors = s.selectExpr("source_name", "etag", "last_modified", "200 as last_http_status", "2 as consecutive_failures", "'' as next_retry_at", "'' as last_error")
    after = {x.source_name: x for x in fetch.advance(cursors, got, "2026-07-15T00:00:00Z").collect()}
    assert after["a"].consecutive_failures == 0 and after["a"].etag == "n" and after["b"].consecutive_failures == 3 and after["b"].etag == "e0" and after["b"].next_retry_at.startswith("2026-07-15T00:30")


def test_apis(spark):
    body = json.dumps({"results": [{"docID": "d1", "filerName": "F", "edinetCode": "E1", "docTypeCode": "120", "docDescription": "", "submitDateTime": "2026-07-01 09:00"}, {"docID": "d2", "withdrawalStatus": "1"}, {"docID": ""}]})
    got = apis.edinet(spark.createDataFrame([("u", body), ("u", "not json"), ("u", None)], "url string, body string")).collect()
    assert [(x.doc_id, x.title, x.disclosure_type, x.published_at_utc) for x in got] == [("d1", "F（120", "earnings", "2026-07-01T00:00:00+00:00")]
    t = {"@id": "1", "STAT_NAME": {"$": "CPI index"}, "TITLE": {"$": "t"}}
    two = [json.dumps({"GET_STATS_LIST": {"DATALIST_INF": {"TABLE_INF": x}}}) for x in (t, [t, {"@id": "2", "STAT_NAME": {"$": "no"}}])]
    assert apis.estat(spark.createDataFrame([("u", x) for x in [*two, "{}", None]], "url string, body string"), ["CPI"]).count() == 2
    both = {"@id": "3", "STAT_NAME": "CPI plain", "TITLE": "t \"q\"", "GOV_ORG": {"$": "g"}}
    got = apis.estat(spark.createDataFrame([("u", json.dumps({"GET_STATS_LIST": {"DATALIST_INF": {"TABLE_INF": both}}}))], "url string, body string"), ["CPI"]).first()
    assert (got.series_name, got.title, got.source_metadata["category"], got.gov_org) == ('CPI plain t "q"', '[統計更新] CPI plain t "q"', "CPI", "g")


def test_api_requests(spark):
    """Keys, answers, errors and limits; a source that fails stops no other and no key gets into an error."""
    asked = []

    def transport(url, headers, timeout):
        asked.append(url)
        if "edinet" in url:
            return 200, {"results": [{"docID": f"d{i}", "docDescription": "決算短信", "submitDateTime": "2026-07-01 09:00"} for i in range(5)]}
        raise OSError("no way to " + url)

    one = lambda adapter, context, most=2: apis.ask("s", adapter, most, "2026-07-15", context, transport)
    assert one("edinet", {})[2:5] == ("failed", None, "api_key_unset") and not asked
    assert one("odd", {})[2:5] == ("failed", None, "unknown_adapter:odd")
    assert one("edinet", {"edinet_key": "k"})[2] == "ok" and "date=2026-07-15" in asked[-1] and "Subscription-Key=k" in asked[-1]
    assert one("estat", {"estat_app_id": "secret"})[2] == "failed" and "secret" not in one("estat", {"estat_app_id": "secret"})[4]
    bad = apis.ask("s", "estat", None, "d", {"estat_app_id": "k"}, lambda *_: (503, None))
    assert bad[2:5] == ("failed", 503, "http_503") and apis.ask("s", "estat", None, "d", {"estat_app_id": "k"}, lambda *_: (200, "not json"))[4] == "http_200"
    src = spark.createDataFrame([("e", "EDINET", 2), ("t", "estat", None), ("x", "other", None)], "name string, adapter string, max_items_per_fetch int")
    body = {"results": [{"docID": f"d{i}", "docDescription": "決算短信", "submitDateTime": "2026-07-01 09:00"} for i in range(5)]}
    got = apis.fetch(src, "2026-07-15", {"edinet_key": "k"}, lambda *_: (200, body))
    assert {(r.source_name, r.status) for r in got.collect()} == {("e", "ok"), ("t", "failed"), ("x", "failed")}
    raws = apis.records(got, {"edinet_key": "k"}).collect()
    assert len(raws) == 2 and {r.source_name for r in raws} == {"e"} and raws[0].url.endswith("docID=" + raws[0].source_metadata["doc_id"])


def test_catalogue(spark, tmp_path):
    (tmp_path / "more.yaml").write_text("sources:\n- {id: a, name: A two, url: 'http://a', trust: 0.7, type: rss}\n- {name: ' New One ', source_class: odd, trust_score: 140}\n")
    config = {"sources": [{"id": "a", "name": "A", "trust_score": 20}, {"id": "b", "name": "B", "url": "http://b", "enabled": False, "format": "xml"}], "sources_file": "more.yaml"}
    got = [r.asDict() for r in catalog.load_sources(spark, config, str(tmp_path)).orderBy("seq").collect()]
    assert [(r["id"], r["name"], r["trust_score"], r["trust"], r["format"], r["source_class"]) for r in got] == [("a", "A two", 70, 0.7, "rss", "unknown"), ("b", "B", 50, 0.5, "auto", "unknown"), ("new_one", " New One ", 140, 1.0, "auto", "unknown")]
    every = catalog.load_sources(spark, config, str(tmp_path))
    assert [r.id for r in catalog.enabled(every).collect()] == ["a"] and [r.id for r in catalog.to_verify(every).collect()] == ["b"]
    assert [r.id for r in catalog.in_order(every).collect()] == ["a", "b", "new_one"] and catalog.load_config(str(tmp_path / "none")) == {}
    assert catalog.load_sources(spark, {}).count() == 0


def test_private_store(spark, tmp_path):
    when = lambda h: f"2026-07-01 {h:02d}:00:00"
    rows = lambda *x: spark.createDataFrame(x, "title string, body string, at string").selectExpr("title", "body", "cast(at as timestamp) submitted_at")
    store = private.PrivateStore(spark, str(tmp_path / "p"))
    assert store.health() == {"present": False, "count": 0, "health": "not_present"}
    bad = store.submit(rows(("t", "copper  bond", when(1)), ("", "another text", when(2)), ("x", " ", when(3)), (None, "z" * 30_001, when(3))))
    assert sorted(r.reason for r in bad.collect()) == ["empty", "too_long"]
    store.submit(rows(("again", "copper bond", when(5))))
    got = {r.title: r for r in store.listed().collect()}
    assert set(got) == {"t", "無題のprivate記事（07/01 11:00保存）"} and got["t"].submissions == 2 and "body" not in store.listed().columns
    assert store.analyze(1) == 1 and store.analyze(9) == 1 and store.analyze(9) == 0 and store.read("analyses").count() == 2
    ident = got["t"].private_article_id
    store.delete([ident])
    assert store.listed().count() == 1 and store.listed(True).count() == 2 and store.read("bodies").count() == 2
    store.delete([ident], permanent=True)
    assert store.read("bodies").count() == 1 and store.read("analyses").count() == 1 and store.health()["count"] == 2
    store.submit(rows(("t", "copper bond", when(9))))
    assert {r.title: r.submissions for r in store.listed().collect()}["t"] == 1


def test_private_queue(spark):
    posts = []

    def call(method, url, payload):
        if method == "GET":
            return {"items": [{"private_article_id": "p1", "title": "t", "body": "wholly secret"}, {"private_article_id": "p2", "body": ""}, {"private_article_id": "p3", "body": "x"}]}
        if url.endswith("p3") and payload["status"] == "completed":
            raise OSError
        posts.append((url, payload))

    now = F.lit("2026-07-15T00:00:00+00:00").cast("timestamp")
    assert private.sync_queue(spark, "u", call, now) == {"fetched": 3, "analyzed": 1, "failed": 2}
    assert [(u, p["status"]) for u, p in posts] == [("u/analysis/p1", "completed"), ("u/analysis/p3", "failed_analysis")]
    assert "secret" not in json.dumps(posts[0][1]["derived"], default=str)
    assert private.sync_queue(spark, "u", lambda *_: None, now)["fetched"] == 0


def test_shards(spark, tmp_path):
    from pyspark.sql import types as T

    for day, lines in (("2026-01-01", ['{"a": "x"}', "", '{"a": "y", "b": 1, "new": 2}']), ("2026-01-02", ['{"a": "z"}', "{broken"])):
        p = tmp_path / day[:4] / day[5:7]
        p.mkdir(parents=True, exist_ok=True)
        (p / f"{day}.jsonl").write_text("\n".join(lines))
    schema = T.StructType().add("a", T.StringType()).add("b", T.IntegerType())
    rows, bad = shards.read_shards(spark, str(tmp_path), schema, defaults={"b": 7})
    assert sorted((x.a, x.b) for x in rows.collect()) == [("x", 7), ("y", 1)] and bad.count() == 1
    out = str(tmp_path / "t")
    shards.append(rows, out)
    shards.append(rows.withColumn("shard_date", F.lit("2025-01-01")), out)
    assert shards.purge(spark, out, "2025-06-01") == ["2025-01-01"] and spark.read.parquet(out).count() == 2


def test_stream_ingest_is_idempotent(spark, tmp_path):
    from newsloom.streaming.events import accept_batch

    b = spark.createDataFrame([(1, "u1", "t1"), (2, "u1", "t2"), (3, "u3", "t2"), (4, None, None)], "incoming_seq long, canonical_url string, title_original string")
    store = str(tmp_path / "store")
    assert sorted(x.incoming_seq for x in accept_batch(b, store, "incoming_seq").collect()) == [1, 3, 4]
    assert accept_batch(b, store, "incoming_seq").count() == 0 and spark.read.parquet(store).count() == 3


def test_every_query_has_a_callable():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and all(callable(f) for f in e.queries().values())


def test_reactions(spark):
    kind = "event_cluster_id string, target string, reaction_window string, value double"
    table = spark.createDataFrame([("e1", "vix", "1h", 0.5)], kind)
    rows = [("e1", "vix", "1h", -2.0), ("e2", "gold", "1d", None), ("e2", "gold", "4h", 1.0), ("e2", "gold", "4h", 0.2), ("e2", "tulips", "1d", 1.0), ("e2", None, None, 1.0)]
    after, refused = reactions.record(table, spark.createDataFrame(rows, kind))
    got = {(r.event_cluster_id, r.target, r.reaction_window): r.value for r in after.collect()}
    assert len(got) == 1 + 14 * 5 and got[("e1", "vix", "1h")] == -2.0 and got[("e2", "gold", "4h")] == 1.0 and got[("e2", "gold", "1d")] is None and refused.count() == 2
    assert reactions.start_tracking(after, after.select("event_cluster_id")).count() == len(got)


def test_saved_cursors(spark, tmp_path):
    at = str(tmp_path / "c")
    assert fetch.load_cursors(spark, at).count() == 0
    r = spark.createDataFrame([("a", "ok", 200, "e", "", "")], "source_name string, status string, http_status int, etag string, last_modified string, error string")
    for n in (1, 2):
        fetch.save_cursors(fetch.advance(fetch.load_cursors(spark, at), r, f"2026-07-1{n}T00:00:00+00:00"), at)
    got = fetch.load_cursors(spark, at).collect()
    assert [(x.source_name, x.etag, x.last_fetch_completed_at) for x in got] == [("a", "e", "2026-07-12T00:00:00+00:00")]


def test_partners(spark):
    rows = [(1, "c1", "t1", "x1", "a"), (2, "c1", "t1", "x2", "b"), (3, "c3", "t1", "x1", "b"), (4, None, "t1", "x1", "c"), (5, "c5", "t1", "x5", "a"), (6, "c6", None, None, None), (7, "c6", "t1", None, None)]
    df = spark.createDataFrame(rows, "q long, c string, t string, x string, d string")
    exact = lambda a, b: a[1] is not None and (a[1] == b[1] or (a[3] is not None and a[3] == b[3]))
    want = {a[0]: sorted(b[0] for b in rows if b[0] != a[0] and exact(a, b)) for a in rows}
    assert {r.q: (r.partners, r.first_partner) for r in dedup.exact_partners(df, "q").collect()} == {q: (len(v), v[0]) for q, v in want.items() if v}
    other = {a[0]: sum(b[2] == a[2] and (b[4] or "") != (a[4] or "") and not exact(a, b) for b in rows) for a in rows if a[2]}
    assert {r.q: r.partners for r in dedup.syndicated_partners(df, "q", "d").collect()} == {q: n for q, n in other.items() if n}
    assert dedup.exact_partners(df.limit(0), "q").count() == 0 and dedup.syndicated_partners(df.limit(0), "q", "d").count() == 0
