import base64
import math
import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import components, looks, near, packing, ranking, signatures, tokens, truncated

TEXT = "article_seq long, title_original string, description string, canonical_url string, row string, id string, text string, k string"


def norm(t, d):
    return re.sub(r"\s+", " ", ((t or "") + " " + (d or "")).lower()).strip()


def alike(s, t, least=0.6):
    a, b = signatures.shingles_of(s), signatures.shingles_of(t)
    return bool(a & b) and len(a & b) / len(a | b) >= least


def corpus(seed=1, n=60):
    r = random.Random(seed)
    words = ["port", "freight", "levy", "copper", "bond", "budget", "harbour", "zinc", "rail", "sale", "quota", "tender", "ceasefire", "grid", "reserve"]
    out = []
    for _ in range(n):
        w = [r.choice(words) + str(r.randint(0, 99)) for _ in range(14)]
        out.append((" ".join(w[:6]), " ".join(w[6:])))
        for _ in range(r.randint(0, 3)):
            v = list(w)
            for _ in range(r.randint(0, 4)):
                v[r.randrange(len(v))] = r.choice(words)
            out.append((" ".join(v[:6]).upper() if r.random() < 0.3 else " ".join(v[:6]), "  ".join(v[6:])))
    return [*out, ("", ""), (None, None), ("abc", None), ("abc", ""), (None, out[0][1]), ("x" * 40_000, "y")]


def frame(spark, rows, first=1):
    return spark.createDataFrame([(i, t, d, u, "r", "i", "t", "k") for i, (t, d, u) in enumerate(rows, first)], TEXT)


def test_near_pairs_equal_brute_force(spark):
    c = [(t, d, None) for t, d in corpus()]
    want = {(i, j) for i in range(len(c)) for j in range(i + 1, len(c)) if alike(norm(*c[i][:2]), norm(*c[j][:2]))}
    got = [tuple(x) for x in near.p7_found(frame(spark, c, 0)).collect()]
    assert len(got) == len(set(got)) and set(got) <= want and len(set(got)) >= 0.99 * len(want)
    assert near.p7_found(frame(spark, []), 0.6).count() == 0


def test_near_groups(spark):
    c = [("port freight levy copper bond", "budget harbour zinc", None)] * 3 + [("entirely other words here", "nothing shared", None), ("port freight levy copper bond", "budget harbour zinc.", None)]
    got = {x.article_seq: (x.group_seq, x.links) for x in near.near_groups(frame(spark, c)).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (1, 1), 5: (1, 1)}


def test_incoming_equal_brute_force(spark):
    c = corpus(2, 40)
    store = [(t, d, f"https://e.com/{i}?utm_a=1") for i, (t, d) in enumerate(c[::2])]
    new = [(t, d, "") for t, d in c[1::2]] + [("brand new", "thing altogether", "http://www.E.com/3/#x"), ("solo", "piece", None), ("solo", "piece", None)]
    a = frame(spark, store)
    b = frame(spark, new).withColumnRenamed("article_seq", "incoming_seq")
    key = lambda u: re.sub(r"[?#].*|/$", "", re.sub(r"[?#].*", "", (u or "").lower()).replace("http://", "https://").replace("www.", "")).rstrip("/")
    want = set()
    for i, (t, d, u) in enumerate(new, 1):
        for s, e, v in [*store, *new[: i - 1]]:
            if (key(u) and key(u) == key(v)) or alike(norm(t, d), norm(s, e)) or (norm(t, d) == norm(s, e) and len(norm(t, d)) >= 5):
                want.add(i)
    got = [x.incoming_seq for x in near.p1_found(a, b).collect()]
    assert len(got) == len(set(got)) and set(got) <= want and len(got) >= 0.98 * len(want)
    assert near.p1_found(a.limit(0), b.limit(0)).count() == 0
    named = near.p1_clusters(a, b).collect()
    assert {x.incoming_seq for x in named} <= set(got) and all(x.known_as > 0 or -x.known_as < x.incoming_seq for x in named)


def test_batches_one_by_one(spark):
    """Probing batch after batch, each accepted after it, finds what one probe of all finds."""
    c = [(t, d, None) for t, d in corpus(5, 20)]
    a = frame(spark, c[::3])
    b = frame(spark, c[1::3] + c[2::3]).withColumnRenamed("article_seq", "incoming_seq")
    whole = {x.row for x in near.probe(near.History.of(near.store_rows(a)), near.incoming_rows(b)).select("row").collect()}
    history, found, rows = near.History.of(near.store_rows(a)), set(), near.incoming_rows(b)
    for lo, hi in ((1, 15), (16, 10**6)):
        part = rows.where(F.col("row").between(near.FRESH + lo, near.FRESH + hi))
        found |= {x.row for x in near.probe(history, part).select("row").collect()}
        history.accept(near.Batch(history, part))
        history = near.History.open(spark, history.path)  # as another session would
    assert found == whole


def test_a_probe_leaves_the_history_where_it_is(spark):
    """No exchange and no sort over the history's tables: only the batch's keys are shuffled, to their buckets."""
    c = [(t, d, None) for t, d in corpus(5, 20)]
    history = near.History.of(near.store_rows(frame(spark, c)))
    for few in (False, True):
        keys = history.lookup("keys", spark.range(5).toDF("k"), few)
        plan = keys._jdf.queryExecution().executedPlan().toString()
        over_keys = plan[: plan.index("Range")] if "Range" in plan else plan
        assert ("Bucketed: true" in plan or few) and "Sort" not in plan and over_keys.count("Exchange") <= (0 if few else 3)


def test_learned_score_tells_alike_pairs(spark):
    r = random.Random(3)
    x = np.array([[v, r.random(), *(float(r.random() < 0.3) for _ in near.FIELDS)] for v in (r.random() for _ in range(400))])
    y = (x[:, 0] + 0.2 * x[:, 3] > 0.6).astype(float)
    w = near.learned(x, y)
    assert w[0] > 3 and w[3] > 0.3 and abs(w[1]) < w[0] / 3
    assert not near.learned(x[:0], y[:0]).any() and not near.learned(x, np.ones(400)).any()


def test_representatives(spark):
    r = random.Random(4)
    links = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)] + [(7, 7)]
    up = {}
    find = lambda x: x if up.get(x, x) == x else find(up[x])
    for a, b in links:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    ids = {i for a, b in links for i in (a, b) if a != b}
    df = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    reps = components.representatives(df)
    assert {(x.id, x.rep) for x in reps.collect()} == {(i, find(i)) for i in ids}
    assert {(x.id, x.rep) for x in components.representatives(df, few=0).collect()} == {(i, find(i)) for i in ids}
    changed = {(x.id, x.rep) for x in components.merge_representatives(reps, spark.createDataFrame([(139, 500), (600, 601)], "a long, b long")).collect()}
    assert {(500, 100), (139, 100), (601, 600)} <= changed and (101, 100) not in changed
    assert components.representatives(df.limit(0)).count() == 0


SCORES = [0.5, 0.5, None, float("nan"), 1.5, -2.0, 0.0, -0.0, float("inf"), 0.99]


def ranked_rows(n=600):
    r = random.Random(9)
    return [(i, r.choice(["", None, " ", "hot", "hot", "hot", *"abcdef"]), r.choice(SCORES), "x", "y") for i in range(n)]


def order(row):
    s = row[2]
    real = s is not None and not math.isnan(s)
    return (not real, -(s if real else 0), row[0])


@pytest.mark.parametrize("size", [None, 8])
def test_top_of_groups(spark, size):
    rows = ranked_rows()
    df = spark.createDataFrame(rows, "q long, g string, s double, ok string, pos string")
    want = {(g, p, x[0]) for g in {x[1] for x in rows if (x[1] or "").strip()} for p, x in enumerate(sorted((y for y in rows if y[1] == g), key=order)[:3], 1)}
    path = ranking.write_clustered(df, F.col("g"), F.col("s"), F.col("q"), size)
    assert {tuple(x) for x in ranking.top_n(spark, path, 3).collect()} == want
    assert ranking.top_of_groups(df.limit(0), "g", "s", "q", 3).count() == 0


def test_row_groups_below_the_bound_are_skipped(spark):
    stats = spark.createDataFrame([("f", 0, 5, "a", "a", 9.0, 7.0), ("f", 1, 5, "a", "a", 7.0, 7.0), ("f", 2, 5, "a", "a", 6.0, 1.0), ("f", 3, 5, "a", "b", 1.0, 0.0), ("f", 4, 5, None, None, None, None)], "file string, rg int, n long, g0 string, g1 string, hi double, lo double")
    assert sorted(x.rg for x in ranking.needed_row_groups(stats, 3).collect()) == [0, 1, 3, 4]


def test_large_groups_are_skipped_in_part(spark):
    rows = [("big", float(i % 500), i) for i in range(4000)] + [(f"g{i}", 1.0, 10_000 + i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, s double, q long")
    path = ranking.write_clustered(df, F.col("g"), F.col("s"), F.col("q"), 100)
    x = ranking.top_n(spark, path, 3, counted=True).first()
    assert x.rows == 4300 and x.rows_read <= 1000 and 0 < x.row_groups_read < x.row_groups / 2
    assert sorted(r.q for r in ranking.top_n(spark, path, 3).collect() if r.g == "big") == [499, 999, 1499]


def test_a_file_is_read_in_falling_maximum(tmp_path):
    """Scores overlap between row groups, so the footers alone can't tell; the scores read so far can."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    t = pa.table({"g": ["a"] * 12, "ok": pa.array([1] * 12, pa.int32()), "s": [5.0, 4.0, 0.0, 9.0, 8.0, 1.0, 6.0, 6.0, 2.0, 4.5, 4.0, 3.0], "q": list(range(12))})
    pq.write_table(t, tmp_path / "f.parquet", row_group_size=3)
    groups = [(i, "a", "a", hi) for i, hi in enumerate((5.0, 9.0, 6.0, 4.5))]
    got = [x["q"].to_pylist() for _, x in ranking._read_file(str(tmp_path / "f.parquet"), groups, 3)]
    assert got == [[3, 4, 5], [6, 7, 8]]


def test_beyond_cap(spark):
    rows = ranked_rows(900)
    df = spark.createDataFrame([(q, g, s, None if q % 11 == 0 else "run") for q, g, s, *_ in rows], "article_seq long, source_name string, importance_score double, ingestion_run_id string")
    groups = {}
    for q, g, s, *_ in rows:
        if (g or "").strip():
            groups.setdefault((q % 11 == 0, g), []).append((q, g, s))
    want = {x[0] for v in groups.values() for x in sorted(v, key=order)[8:]}
    got = [x.article_seq for x in ranking.p3_found(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert ranking.kept_rows(df).count() == len(rows) - len(want) and ranking.p3_found(df.limit(0)).count() == 0
    share = ranking.beyond_cap(df.where("source_name = 'hot' and article_seq % 11 <> 0"), [F.col("source_name")], F.col("importance_score"), F.col("article_seq"), 10**6, 0.1).count()
    n = len(groups[(False, "hot")])
    assert share == n - int(n * 0.1)


def test_best_of_duplicates(spark):
    rows = [
        ("g1", 1, 0.9, "2026-01-02T00:00:00Z", "N/A"), ("g1", 2, 90.0, "2026-01-02T08:00:00+09:00", None), ("g1", 3, None, "2020-01-01T00:00:00Z", "real"), ("g1", 4, float("nan"), "2019-01-01T00:00:00Z", "also"),
        ("g2", 5, 0.5, None, "…"), ("g2", 6, 0.5, "2026-01-01T00:00:00Z", " no Description "), ("g3", 7, 0.1, "x", "alone"), ("", 8, 1.0, None, "a"), ("", 9, 1.0, None, "a"), (None, 10, 1.0, None, "a"), ("g4", 11, 0.3, None, "t"), ("g4", 12, 0.3, None, "t"),
    ]
    df = spark.createDataFrame([(*x, "g", "t") for x in rows], "duplicate_group_id string, article_seq long, source_trust double, first_seen_at string, description string, g string, t string")
    assert {tuple(x) for x in ranking.best_of_duplicates(df).collect()} == {("g1", 2, 4), ("g2", 6, 0), ("g4", 11, 11)}
    assert ranking.best_of_duplicates(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def encode():
    tiktoken = pytest.importorskip("tiktoken")
    e = tokens.encoder(tokens.read_ranks())
    return e, tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=e.ranks, special_tokens={})


def test_ids_equal_the_tokenizer(encode):
    e, want = encode
    r = random.Random(0)
    letters = " a1'\n\t  　漢字ー。カタàé́👩‍<|endoftext|>Яж"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    texts += ["a" * 20_000, "漢字かなABC" * 3000, " " * 5000, "<|endoftext|>", "don't  stop", "x\n\n y ", "ab" * 7000, "".join(r.choice("abc") for _ in range(20_000))]
    for t in texts:
        assert np.frombuffer(e.encode(t), np.int32).tolist() == want.encode_ordinary(t)


def test_rank_queue():
    q, r = tokens.RankQueue(50_257), random.Random(1)
    put = [(r.randrange(50_257), i) for i in range(500)]
    for rank, i in put:
        q.push(rank, i)
    out = []
    while q.top:
        rank, places = q.pop()
        out += [(rank, i) for i in places]
    assert out == sorted(put)


def test_token_ids(spark, encode):
    df = spark.createDataFrame([(1, "hello world", "x"), (2, "", "x"), (3, None, "x"), (4, "<|endoftext|>", "x"), (4, "<|endoftext|>", "x")], "doc_id long, text string, ids string")
    got = sorted((x.doc_id, x.ids) for x in tokens.token_ids(df).collect())
    assert got[0] == (1, encode[1].encode_ordinary("hello world")) and got[1:3] == [(2, []), (3, [])] and len(got) == 5
    assert base64.b64decode(tokens.read_ranks().split()[0]) and tokens.token_ids(df.limit(0)).count() == 0


@pytest.mark.parametrize("limit", ["capacity", "places", "cost"])
def test_each_constraint_alone_refuses_a_bin(limit):
    sizes = np.array([600, 500, 400, 300])
    tight = {"capacity": (1000, 99, 1e12), "places": (10**6, 2, 1e12), "cost": (10**6, 99, 600.0**2 + 300.0**2)}[limit]
    bins = packing.best_fit(sizes, *tight, (1.0, 0.05, 0.05))
    loose = packing.best_fit(sizes, 10**6, 99, 1e12, (1.0, 0.05, 0.05))
    assert set(loose) == {0} and len(set(bins)) == 2
    for b in set(bins):
        x = sizes[bins == b].astype(float)
        assert x.sum() <= tight[0] and len(x) <= tight[1] and (x**2).sum() <= tight[2]
    assert packing.best_fit(np.array([900, 100]), 1000, 9, 900.0**2 - 1, (1.0, 0.05, 0.05)).tolist() == [0, 1]


@pytest.mark.parametrize("cost", [None, 2048.0**2 / 4])
def test_containers(spark, cost):
    r = random.Random(2)
    sizes = [r.choice([0, 1, 5, 200, 700, 1024, 2048]) for _ in range(400)] + [9000, None, 2049]
    df = spark.createDataFrame(list(enumerate(sizes)), "doc_id long, n_tokens int")
    got = packing.pack(df, max_items=16, max_cost=cost, shard=150).toPandas()
    assert set(got["doc_id"]) == set(range(len(sizes))) and not got.duplicated(["doc_id", "part"]).any()
    assert got.groupby("doc_id")["n_tokens"].sum().tolist() == [x or 0 for x in sizes]
    bins = got.assign(c=got["n_tokens"].astype(float) ** 2).groupby("container").agg(t=("n_tokens", "sum"), n=("part", "size"), c=("c", "sum"))
    assert bins["t"].max() <= 2048 and bins["n"].max() <= 16 and bins[bins["n"] > 1]["c"].max() <= (cost or 0.9 * 2048.0**2)
    assert all(len(x) == 1 for _, x in got[got["doc_id"].isin([i for i, s in enumerate(sizes) if s is not None and s <= 2048])].groupby("doc_id"))
    assert cost or len(bins) <= 1.15 * max(sum(x or 0 for x in sizes) / 2048, len(got) / 16) + 3
    assert packing.pack(df.limit(0)).count() == 0


def test_looks(spark):
    plain = "The final offer for a cafe in Tokyo: Kaze 12"
    same = ["Тhе finаl оffer for a cafe in Tokyo: Kaze 12", "The ﬁnal oﬀer for a cafe in Tokyo: Kaze 12", "The final　offer for a cafe in Tok​yo: Kaze １２", plain + "﻿"]
    other = ["The final offer for a café in Tokyo: Kaze 12", plain.lower(), plain.replace("12", "13"), plain.replace(" a ", "  a "), plain.replace(":", ";")]
    rows = [plain, plain, *same, *other, "café", unicodedata.normalize("NFD", "café"), "ｶﾞ", "ガ", "ー", None, "", "x" * 40_000, "​" + "x" * 40_000]
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(rows)], "doc_id long, text string, k string, v string")
    got = {tuple(x) for x in looks.same_look(df).collect()}
    group = range(6)
    want = {(i, j) for i in group for j in group if i < j and rows[i] != rows[j]} | {(11, 12), (13, 14), (18, 19)}
    assert got == want and looks.same_look(df.limit(0)).count() == 0
    one = {x.doc_id: x.text for x in looks.canonical(df).collect()}
    assert {one[i] for i in group} == {plain} and one[16] is None and one[17] == ""
    assert {x.doc_id for x in looks.look_groups(df).collect()} == {*group, 11, 12, 13, 14, 18, 19}


def test_trie_and_table():
    s = looks.speller(tokens.read_ranks())
    for t in ("рaper", "pa​per", "ﬁnance", "Ｔｏｔａｌ", "zzqxТ", "о́", "νόμος", "αν", "ν"):
        assert s.text(t) == looks.normal(t)
    # letters with two readings: the vocabulary decides, where the table alone leaves them
    for t, word in (("νalue", "value"), ("мarket", "market"), ("vαlue,", "value,"), ("(𝐁ank)", "(Bank)")):
        assert s.text(t) == word != looks.normal(t)
    assert s.trie.spell("рaреr") == ("paper", 0.0) and s.trie.spell("paqer") is None and s.trie.spell("plain") is not None
    assert s.trie.spell("νalue") is None and s.trie.spell("νalue", 0.25) == ("value", 0.25)
    trie = looks.Trie(["νet", "vet", "ret"])  # of two words the cheaper one
    assert trie.spell("νet", 0.5) == ("νet", 0.0)


def test_cut_values(spark):
    whole = "The harbour authority at Zemboholm redrafted a ceasefire timetable from next Tuesday. Stocks kept at Veimbstad amount to 750 points"
    rows = [
        (1, "A", "t", whole + ".", whole[:60]), (2, "A", "t", whole[:100], whole[:100]), (3, "B", "t", "Markets closed…", None), (4, "B", "t", "Prices rose &am", ""), (5, "B", "t", "Prices rose. (Moldir)", "Prices rose. (Moldir)"),
        (6, "B", "A finished thought", "A finished thought", "A finished thought"), (7, None, None, None, None), (8, "B", "t", "x" * 399 + "y", "n/a"), (9, "B", "t", "Done. Continue reading →", "Done."), (10, "B", "t", "短い文。", "短い文。"),
        (11, "B", "t", "Sold [more]", "Sold"), (12, "B", "t", "none", "-"), (13, "B", "t", "z" * 50_000 + ".", "z" * 200),
    ]
    df = spark.createDataFrame([(*x, "n") for x in rows], "article_seq long, source_name string, title_original string, description string, public_excerpt string, core string")
    got = {tuple(x) for x in truncated.p6_found(df).collect()}
    d, e = "description", "public_excerpt"
    assert got == {(1, e), (2, d), (2, e), (3, d), (4, d), (8, d), (9, d), (9, e), (11, d), (11, e), (13, e)}
    assert truncated.p6_found(df.limit(0)).count() == 0
    reasons = {(x.field_name, x.reason): x.n for x in truncated.p6_reasons(df).collect()}
    assert sum(reasons.values()) == len(got) and reasons[(d, "prefix")] >= 1 and reasons[(d, "mark")] >= 2
    sources = spark.createDataFrame([("s1", "Ａ", "https://a.example"), ("s2", "B", None)], "id string, name string, url string")
    sources = sources.selectExpr("*", "'UTC' tz_name", "'dmy' date_order")
    rates = {(x.source_id, x.field_name): (x.n, x.n_cut) for x in truncated.source_rates(df.withColumn("source_domain", F.lit("")), sources).collect()}
    assert rates[("s1", d)] == (2, 1) and ("s2", d) in rates


def test_a_chain_of_prefixes(spark):
    """The next text in order differs by a full stop only; the one after it goes on."""
    s = "A beginning of some length"
    df = spark.createDataFrame([(s,), (s + ".",), (s + ". More of it",), (s + " and b",), ("z" * 30,)], "text string")
    for parts in (1, 5):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            assert {x.text for x in truncated.longer_elsewhere(df).collect()} == {s, s + "."}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_longer_elsewhere_over_many_ranges(spark):
    texts = [f"{i:04d} a text of its own number" for i in range(300)]
    more = [t + " that goes on" for t in texts[::3]] + [t + "." for t in texts[1::3]]
    df = spark.createDataFrame([(t,) for t in texts + more], "text string").repartition(7)
    assert {x.text for x in truncated.longer_elsewhere(df).collect()} == set(texts[::3])


def test_nothing_else_imports_this_subpackage():
    from pathlib import Path

    root = Path(near.__file__).parents[1]
    assert not [p for p in root.rglob("*.py") if p.parent.name != "llm" and re.search(r"newsloom\.llm|from \.+llm|import llm", p.read_text())]
