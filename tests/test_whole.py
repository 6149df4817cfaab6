"""Queries that must do their whole job, against plain readers."""

import random
from datetime import datetime, timedelta, timezone

from newsloom.plans import matching, rollups, scalars


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_historical_matches_has_countries_and_undated_queries(spark, tmp_path):
    r, start = random.Random(5), datetime(2026, 7, 1, tzinfo=timezone.utc)
    pick = lambda names, n: [r.choice(names) for _ in range(r.randint(0, n))]
    rows = []
    for i in range(1200):
        t = "" if i % 80 == 0 else (start - timedelta(minutes=r.randint(0, 2000) * 7)).isoformat()
        rows.append((i, t, pick(["US", "US", "JP", ""], 2), pick("abc", 2), pick("def", 1) if i % 7 else None, [*"ghijkl"][: r.choice([0, 0, 0, 1, 6])]))
    d = write(spark, tmp_path, "articles", rows, "article_seq long, published_at_utc string, countries array<string>, companies array<string>, commodities array<string>, geopolitical_entities array<string>")
    read = [(i, datetime.fromisoformat(t) if t else None, {x for y in e for x in y or [] if x}) for i, t, *e in rows]
    want = {}
    for i, t, e in read[::20]:
        found = []
        for j, u, f in read:
            days = ((t or datetime(2026, 7, 15, tzinfo=timezone.utc)) - u).total_seconds() / 86400 if u else 0
            if j != i and e & f and 0 < days <= 730:
                found.append((-int((0.7 * len(e & f) / len(e | f) + 0.3 * (1 - days / 730)) * 1e4 + 0.5), j))
        want |= {(i, j): (k, -s) for k, (s, j) in enumerate(sorted(found)[:20], 1)}
    got = {(x.cur, x.old): (x.rank, round(x.relevance * 1e4)) for x in matching.historical_matches(spark, d).collect()}
    assert got == want and any(i % 80 == 0 for i, _ in got)


def test_event_clustering_over_all_sources(spark, tmp_path):
    r, start = random.Random(6), datetime(2026, 7, 1, tzinfo=timezone.utc)
    words = [f"w{i}" for i in range(25)]
    rows = []
    for i in range(700):
        t = "" if i % 40 == 0 else (start + timedelta(hours=r.randint(0, 900))).isoformat()
        sets = [[r.choice(names) for _ in range(r.randint(0, n))] for names, n in ((["US", "JP", "FR"], 1), (["Acme", "Bolt", "actor1"], 1), (["oil", "gold"], 2), (["actor1", "actor2"], 1))]
        rows.append((i, f"art_{i:020d}", "k" + str(i % 2), f"s{i % 5}", t, " ".join(r.sample(words, r.randint(1, 7))), *sets, r.choice([0.1, 0.5, 0.9]), 0.5))
    d = write(spark, tmp_path, "articles", rows, "article_seq long, article_id string, primary_category string, source_domain string, published_at_utc string, title_original string, countries array<string>, companies array<string>, commodities array<string>, geopolitical_entities array<string>, importance_score double, source_trust double")
    events, want = [], {}
    for i, name, category, _, t, title, countries, companies, _, actors, weight, trust in rows:
        at, tokens, best = datetime.fromisoformat(t) if t else None, set(title.split()), None
        for ev in events:
            seen = set().union(*(x[3] for x in sorted(ev["rows"], key=lambda x: x[:3])[:3]))
            like = len(tokens & seen) / len(tokens | seen)
            apart = at and ev["last"] and abs(at - ev["last"]) > timedelta(hours=72)
            if ev["category"] == category and ev["marks"] & {*countries, *companies, *actors} and not apart and like >= 0.2 and (not best or like > best[0]):
                best = like, ev
        if not best:
            events.append({"category": category, "marks": set(), "last": None, "rows": [], "name": "evc_" + name[-12:]})
        ev = best[1] if best else events[-1]
        ev["marks"] |= {*countries, *actors}
        ev["last"] = max(filter(None, (ev["last"], at)), default=None)
        ev["rows"].append((-(weight + trust), at.timestamp() if at else float("-inf"), name, tokens))
        want[i] = ev["name"], not best
    got = {x.seq: (x.cluster, x.is_new) for x in matching.event_clustering(spark, d).collect()}
    assert got == want and sum(new for _, new in want.values()) < 600


def test_feed_dates_reads_every_row(spark, tmp_path):
    at = 1753979547  # 2025-07-31T16:32:27Z
    known = {"Thu, 31 Jul 2025 16:32:27 GMT": at, " Thu, 31 Jul 2025 11:32:27 -0500": at, "Thursday, 31 Jul 2025 16:32:27 +0000": at, "31 Jul 2025 16:32:27 GMT": at, "2025-07-31T16:32:27Z": at, "2025-07-31T18:32:27.199283160+02:00": at, "20250731T163227Z": at,
             "2025-07-31 16:32:27": at, "Thursday, 31-Jul-25 16:32:27 GMT": at, "Thu Jul 31 16:32:27 2025": at, "31 Jul 25 11:32 CDT": at - 27, "yesterday": None, "1712011512304": None, "": None, None: None}
    d = write(spark, tmp_path, "articles", list(enumerate(known)), "article_seq long, raw_published_at string")
    assert {x.article_seq: x.published for x in scalars.feed_dates(spark, d).collect()} == dict(enumerate(known.values()))


def test_per_source_stats_counts_every_spelling(spark, tmp_path):
    rows = [("r1", "BBC News", "success", 5, 2), ("r2", "ＢＢＣ\u3000Ｎｅｗｓ", "failed", 7, 1), ("r3", "bbc\u2009ne\u200bws", "success", 1, None), ("r4", None, "failed", 3, 3), ("r5", "\u3000", "success", 1, 0), ("r5", "\u3000", "success", 1, 0)]
    d = write(spark, tmp_path, "source_results", rows, "run_id string, source string, status string, fetched int, new_items int")
    assert {tuple(x) for x in rollups.per_source_stats(spark, d).collect()} == {("bbcnews", 3, 13, 3, 1), ("", 2, 4, 3, 1)}
