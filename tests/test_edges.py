"""Nulls, empty tables, ties and columns with clashing names."""

from pyspark.sql import functions as F

from newsloom import pipeline
from newsloom.functions import views
from newsloom.operators import history, private, selecting
from newsloom.plans import rollups

ARTICLE = (
    "article_seq long, article_id string, event_cluster_id string, source_domain string, source_name string, canonical_url string, title_ja string, title_original string, description string, public_excerpt string, published_at_utc string, published_at_jst string, "
    "primary_category string, priced_in_status string, themes array<string>, countries array<string>, regions array<string>, companies array<string>, tickers array<string>, commodities array<string>, policies array<string>, geopolitical_entities array<string>, causal_keywords array<string>, affected_assets array<string>, "
    "importance_score double, market_impact_score double, urgency_score double, structural_score double, source_trust double, freshness_score double, source_score double, potential_risk_score double, rank string, score string, theme string, src string"
)
NAN = float("nan")


def articles(spark, *rows):
    names = [c.rsplit(" ", 1)[0] for c in ARTICLE.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ARTICLE)


def test_views_of_empty_rows(spark):
    a = articles(spark, {"article_seq": 1}, {"article_seq": 2, "title_ja": "", "title_original": "t", "published_at_jst": "2026-07-01", "importance_score": NAN, "themes": ["x", None], "description": "d" * 50_000})
    got = views.flat(a.select("article_seq", *views.article_view())).orderBy("article_seq").collect()
    assert len(got[0]) == 24 and got[0].title is None and got[0].themes == "" and got[1].title == "t" and got[1].published_at == "2026-07-01" and got[1].importance_score is None


def test_quality_of_nothing_and_of_nulls(spark):
    covered = spark.createDataFrame([(0,)], "covered long")
    none = rollups.quality(articles(spark).limit(0), covered).first()
    assert tuple(none) == (0.0, 0.0, 0.0, 0.0, 0.0)
    some = rollups.quality(articles(spark, {"source_score": NAN, "source_trust": 0.5}, {"source_score": 0.0, "source_trust": NAN, "themes": ["ai"]}), covered).first()
    assert some.source_quality_score == 0.25 and some.ai_semiconductor_share == 0.5 and some.diversity_score == 0.75


def test_package_of_nulls_and_ties(spark):
    now = F.lit("2026-07-15T00:00:00+00:00").cast("timestamp")
    a = articles(spark, *({"article_seq": i, "article_id": f"a{i}", "source_domain": f"s{i % 7}", "primary_category": f"c{i % 5}", "importance_score": NAN if i % 3 else None} for i in range(40)))
    p = pipeline.package(a, {}, now=now, hot=10)
    assert [x["article_id"] for x in p["hot_articles"]] == [f"a{i}" for i in range(10)] and "description" not in p["hot_articles"][0]
    assert pipeline.package(a.limit(0), {}, now=now)["hot_articles"] == []
    scores = selecting.retrieval_scores(a, spark.createDataFrame([], "event_cluster_id string, has_reaction boolean, magnitude double"), now)
    assert {r.score for r in scores.collect()} == {13.75}


def test_context_of_matches(spark):
    a = articles(
        spark, {"article_seq": 1, "article_id": "a", "countries": ["JP", "US", ""], "companies": ["X"]}, {"article_seq": 2, "article_id": "b", "countries": ["US", "JP"], "commodities": [None, "oil"], "public_excerpt": "", "description": "e" * 500, "event_cluster_id": ""},
    )
    found = spark.createDataFrame([(1, 2, 0.5, 1)], "cur long, old long, relevance double, rank int")
    got = history.context(found, a, "article_seq").first()
    assert got.historical_event_id == "b" and got.related_entities == ["JP", "US"] and got.short_context == "e" * 140 and got.relevance_score == 0.5 and len(got) == 11
    assert history.context(found.limit(0), a, "article_seq").count() == 0


def test_analysis_of_empty_and_long_texts(spark):
    rows = [("a", None, None), ("b", "", "緊急 " + "semiconductor " * 4000), ("c", "題", "")]
    x = private.analysis(spark.createDataFrame(rows, "k string, title string, body string"), "k")
    got = {r.k: r for r in x.collect()}
    assert got["a"].theme == "" and got["a"].summary_200.endswith("本文0字。") and got["b"].theme == "semiconductor" and got["b"].urgent and not got["c"].urgent
    brief = {r.k: r for r in private.derived_summary(x, "k", F.lit("2026-07-15").cast("timestamp")).collect()}
    assert len(brief["b"].forecast_summary) == 4 and brief["b"].forecast_summary[3].confidence == 0.15 and brief["a"].industries == []
    many = private.forecasts(x, "k", F.col("theme"), F.lit("2026-07-15").cast("timestamp"), {"article_based_hypothesis": 0.2}).collect()
    assert len(many) == 12 and len({r.forecast_id for r in many}) == 12 and {r.confidence for r in many} == {0.2, 0.15}
