import hashlib

import pytest
from pyspark.sql import functions as F

from newsloom.functions import classify, moments, scoring, text, times, url
from newsloom.plans import rollups, store


def col(spark, values, f, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(f(F.col("x"))).collect()]


def test_normalize_url(spark):
    got = col(spark, ["HTTP://WWW.Example.com/a/?utm_source=x&b=2&b=1&A&c=%20x&ref=q#top", "https://example.com", "", None, "example.com/a", "https://e.com/%zz?x=1"], url.normalize_url)
    assert got == ["https://example.com/a?A=&b=2&b=1&c=+x", "https://example.com", "", "", "https:example.com/a", "https://e.com/%zz?x=1"]


def test_address_key_ignores_what_names_nothing(spark):
    same = ["http://www.e.com/a/?b=1&a=2", "https://E.COM/a?a=2&b=1&utm_x=9&fbclid=1#f", "https://e.com/a?a=2&b=1"]
    assert len(set(col(spark, same, url.address_key))) == 1
    assert col(spark, ["", None, "  "], url.address_key) == [None] * 3
    assert len(set(col(spark, ["https://e.com/A", "https://e.com/a"], url.address_key))) == 2


def test_hosts(spark):
    assert col(spark, ["https://WWW.a.b/x", "nothing", "", None], url.host_of) == ["a.b", "", "", ""]


def test_text(spark):
    assert col(spark, [" Ａ - b,　C! ", None, "日本、語"], text.normalize_text) == ["ａ  b c", "", "日本語"]
    assert col(spark, ["<b>x</b> &amp;lt; y", None], text.strip_html) == ["x < y", ""]
    assert col(spark, ["AI 米政府が a x1", "", None], lambda c: F.array_join(text.title_tokens(c), ",")) == ["ai,府が,政府,米政,x1".replace("ai,府が,政府,米政,x1", ",".join(sorted(["ai", "x1", "米政", "政府", "府が"]))), "", ""]
    assert col(spark, ["u", None], text.canonical_hash) == [hashlib.sha256(b"u").hexdigest(), hashlib.sha256(b"").hexdigest()]
    assert col(spark, ["art_00ff_ZZaa11bb22cc"], text.cluster_id) == ["evc_aa11bb22cc"]


def test_name_key(spark):
    names = ["Neil Wire — M", "neil  wire – m ", "ＮＥＩＬ　ＷＩＲＥ―Ｍ", "NeilWire-M"]
    assert len(set(col(spark, names, text.name_key))) == 1
    assert col(spark, ["", None, "　 "], text.name_key) == [None] * 3


def test_dates(spark):
    now = F.lit("2026-07-15T00:00:00+00:00").cast("timestamp")
    iso = lambda c: F.date_format(times.parse_iso(c), "yyyy-MM-dd HH:mm:ss")
    assert col(spark, ["2026-01-01T09:00:00+09:00", "2026-01-01 00:00:00", "x", "", None, "2026-13-01T00:00:00Z"], iso) == ["2026-01-01 00:00:00"] * 2 + [None] * 4
    rfc = lambda c: F.date_format(times.parse_feed_date(c), "yyyy-MM-dd HH:mm")
    assert col(spark, ["Fri, 03 Jul 2026 00:13:25 +0200", "3 Jul 2026 00:13 GMT", "soon"], rfc) == ["2026-07-02 22:13", "2026-07-03 00:13", None]
    assert col(spark, ["2026/07/01 09:00", "2026-07-01", "?"], times.jst_to_utc) == ["2026-07-01T00:00:00+00:00", "2026-06-30T15:00:00+00:00", ""]
    f = lambda c: F.round(times.freshness(times.parse_iso(c), now), 3)
    assert col(spark, ["2026-07-14T00:00:00Z", "2026-07-16T00:00:00Z", None], f) == [0.5, 1.0, 0.0]
    a = lambda c: times.sanitize_published(c, F.lit("raw"), F.lit("fetched"), now)["anomaly"]
    assert col(spark, ["2026-07-14T00:00:00Z", "2026-07-17T00:00:00Z", "1999-01-01T00:00:00Z", "2008-01-01T00:00:00Z", "bad", ""], a) == ["", "future", "too_old", "", "unparsable", "unparsable"]
    assert col(spark, ["", "x", "2026-07-14T00:00:00Z", "2026-07-16T00:00:00Z"], lambda c: times.should_retry(c, now)) == [True, True, True, False]


def test_classify(spark):
    df = spark.createDataFrame([("Iran sanctions", "oil prices and Oil Prices"), ("生成AI市場", ""), ("mermaid AIRPORT", None), (None, None)], "title_original string, description string")
    got = [r[0] for r in classify.with_text(df).select(classify.classified(classify.category_hits())).collect()]
    assert got[0].primary == "oil" or set(got[0].themes) == {"oil", "sanctions", "us_iran_middle_east"}
    assert got[1].themes == ["ai"] and got[2].primary == got[3].primary == "uncategorized"
    assert col(spark, ["Board approves share buyback", "増資のお知らせ", "hello", None], lambda c: classify.disclosure(c)["kind"]) == ["buyback", "financing", "other", "other"]


def test_scores_stay_in_bounds(spark):
    df = spark.createDataFrame([("Crash!", "oil", ["oil", "ai", "x", "y"], 5.0), (None, None, None, None), ("a", "", [], float("nan"))], "t string, c string, th array<string>, tr double")
    for r in df.select(scoring.signals(F.col("t"), F.col("c"), F.col("th"), F.col("tr")).alias("s")).select("s.*").collect():
        assert all(0 <= v <= 1 for v in r)
    assert abs(sum(scoring.WEIGHTS.values()) - 1) < 1e-9


CODES = {"EST": -300, "EDT": -240, "JST": 540, "UTC": 0, "GMT": 0, "CET": 60}


@pytest.mark.parametrize(
    ("raw", "order", "zone", "epoch"),
    [
        ("2026-03-08T02:30:00", "dmy", "America/New_York", 1772955000),  # skipped: the offset before the change
        ("2025-11-02 01:30", "dmy", "America/New_York", 1762061400),  # repeated: the earlier instant
        ("01/02/26 3:05 pm", "dmy", "UTC", 1769958300), ("01/02/26 3:05 pm", "mdy", "UTC", 1767366300),
        ("令和7年9月19日 10:02", "ymd", "Asia/Tokyo", 1758243720), ("R7.9.2 02:35", "ymd", "Asia/Tokyo", 1756748100), ("2025年8月21日 午後0時57分", "ymd", "Asia/Tokyo", 1755748620),
        ("Friday, 01-Aug-25 09:54:12 GMT", "dmy", None, 1754042052), ("Fri Apr  3 19:32:58 2026", "mdy", "UTC", 1775244778), ("12 janvier 2026 à 19h54", "dmy", "UTC", 1768247640),
        ("18 de agosto de 2025, 05:45", "dmy", "UTC", 1755495900), ("10. März 2026, 03:49 Uhr", "dmy", "UTC", 1773114540), ("15 сентября 2025 г., 19:29", "dmy", "UTC", 1757964540),
        ("2026-07-08 12:21:30 GMT-7", "dmy", None, 1783538490), ("2026-06-15 22:47:00 GMT+5:30", "dmy", None, 1781543820), ("2025-07-31 08:59:52 America/Chicago", "dmy", None, 1753970392),
        ("1741502412503969", "dmy", None, 1741502412), ("1741507902645", "dmy", None, 1741507902), ("20250330", "dmy", "UTC", 1743292800), ("20250309T071406Z", "dmy", None, 1741504446),
        ("　01 Apr 26 16:21 JST\t", "dmy", None, 1775028060), ("April 10, 2026 1:25 AM", "mdy", "UTC", 1775784300), ("2025-03-09T00:14:49-06:00[America/Chicago]", "dmy", None, 1741500889),
        ("31/02/2026", "dmy", "UTC", None), ("yesterday", "dmy", "UTC", None), ("", "dmy", "UTC", None), (None, "dmy", "UTC", None), ("2026-13-45T10:00:00Z", "dmy", "UTC", None),
        ("0000-00-00 00:00:00", "dmy", "UTC", None), ("01 Apr 2026 02:27 XYZ", "dmy", "UTC", None), ("10 April 2026, 06:25", "dmy", None, None), ("x" * 10_000, "dmy", "UTC", None),
    ],
)
def test_instants_in_text(raw, order, zone, epoch):
    assert moments.read(raw, order, zone, CODES)[1] == epoch


def test_days():
    assert moments.day_of("2026/03/01") == moments.day_of("20260301") == moments.day_of("2026-03-01T00:00:00+09:00") == 20513
    assert moments.day_of("2026-03-01T20:00:00Z") == 20514 and moments.day_of("?") is None and moments.day_of(None) is None


def test_classification_of_overlapping_keywords(spark):
    words = {"a": ["rate", "rate hike", "hike"], "b": ["利上", "利上げ"], "c": ["Rate"], "d": ["c++", "u.s."]}
    texts = ["A RATE HIKE came", "rates hikes", "大幅利上げ", "rate_hike", "Use C++, in the U.S. rate", None, ""]
    df = spark.createDataFrame([(t, None) for t in texts], "title_original string, description string")
    got = [[(-e.m, e.c) for e in r[0]] for r in classify.with_text(df).select(classify.category_hits(words)).collect()]
    assert got == [[(3, "a"), (1, "c")], [], [(2, "b")], [], [(2, "d"), (1, "a"), (1, "c")], [], []]


def test_plain_text():
    assert text.plain("<p>A&amp;B &lt;b&gt;x&lt;/b&gt; &eacute;&#8230;&nbsp;y</p>  z") == "A&B x é… y z" and text.plain(None) == ""


def test_store_status_and_health(spark):
    a = spark.createDataFrame([("2026-07-14T01:00:00+00:00", "d"), ("2026-07-01", None), (None, "")], "published_at_utc string, source_domain string")
    got = store.status_of_store(a, quarantined=2).first()
    assert (got.total_articles, got.new_articles_24h, got.source_count, got.storage_status) == (3, 1, 2, "degraded") and store.status_of_store(a.limit(0)).first().latest_article_at == ""
    runs = spark.createDataFrame([(0, 3, True, True), (1, 2, True, True), (0, 0, True, True), (0, 3, False, True), (0, 3, True, False)], "f int, s int, p boolean, o boolean")
    got = [tuple(r) for r in runs.select(*rollups.run_health(F.col("f"), F.col("s"), F.col("p"), F.col("o"))).collect()]
    assert got == [("healthy", 0), ("degraded", 0), ("degraded", 0), ("failed", 1), ("failed", 1)]
