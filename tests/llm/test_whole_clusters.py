from pyspark.sql import functions as F

from newsloom.llm import near

SCHEMA = "seq long, title_original string, description string, canonical_url string"
WORDS = [f"{a}{b}" for a in ("harbour", "freight", "copper", "ceasefire", "tender") for b in ("north", "south", "east", "west")]


def variant(*places):
    """The same text with other words in some places: each changes the text a little."""
    return " ".join(w if i not in places else f"changed{i}" for i, w in enumerate(WORDS))


def frames(spark):
    far = variant(0, 1, 2, 3, 4, 5, 6)
    store = [(10, variant(), "", "http://e.com/a"), (500, far, "", "http://e.com/b"), (600, "an unrelated story of quite other things", "", "http://e.com/c"), (700, "nothing like it, but of one address", "", "http://e.com/c")]
    # 1 is alike to 10 and 500, 2 to 500 alone; 3 repeats the address of 600 and 700; 4 is new, 5 its copy; 6 repeats 700's text
    new = [(1, variant(0, 1, 2), "", "http://n.com/1"), (2, far + " update", "", "http://n.com/2"), (3, "third text of its own making", "", "http://e.com/c"), (4, "fourth item that nobody had", "", "http://n.com/4"), (5, "fourth item that nobody had", "", "http://n.com/5"), (6, store[3][1], "", "")]
    return spark.createDataFrame(store, SCHEMA).withColumnRenamed("seq", "article_seq"), spark.createDataFrame(new, SCHEMA).withColumnRenamed("seq", "incoming_seq")


def test_every_link_counts(spark):
    a, b = frames(spark)
    got = {x.incoming_seq: x.known_as for x in near.p1_clusters(a, b).collect()}
    assert got == {1: 10, 2: 10, 3: 600, 5: -4, 6: 600}


def test_clusters_are_those_of_batch_after_batch(spark):
    a, b = frames(spark)
    rows, incoming = near.store_rows(a), near.incoming_rows(b)
    history = near.History.of(rows)
    up, known = {}, set()

    def find(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    def take(links):
        for x, y in links:
            x, y = sorted((find(x), find(y)))
            up[y] = x

    near.store_clusters(history, rows)
    take([(x.id, x.rep) for x in history.table("reps").collect()])
    for lo, hi in ((1, 2), (3, 4), (5, 6)):
        batch = near.Batch(history, incoming.where(F.col("row").between(near.FRESH + lo, near.FRESH + hi)))
        first = [(x.row, x["first"]) for x in batch.by_address.unionByName(batch.by_text).collect()]
        links = [(x.a, x.b) for x in batch.links().collect()]
        known |= {x for x, _ in first} | {max(x) for x in links}
        take([*first, *links])
        history.accept(batch)
    name = lambda x: near.FRESH - x if x >= near.FRESH else x
    b = b.withColumn("batch_no", F.floor((F.col("incoming_seq") + 1) / 2).cast("int"))
    assert {x.incoming_seq: x.known_as for x in near.p1_clusters(a, b).collect()} == {x - near.FRESH: name(find(x)) for x in known}


def test_a_merge_touches_only_its_clusters(spark):
    history = near.History.create(spark)
    one = spark.createDataFrame([(2, 1), (3, 1), (11, 10), (12, 10), (21, 20)], "a long, b long")
    history.merge(one)
    before = history.table("reps").count()
    history.merge(spark.createDataFrame([(12, 3), (30, 11)], "a long, b long"))
    added = history.table("reps").count() - before
    reps = {x.id: x.rep for x in history.representatives(spark.range(40)).collect()}
    assert reps == {1: 1, 2: 1, 3: 1, 10: 1, 11: 1, 12: 1, 30: 1, 20: 20, 21: 20} and added <= 7
    small = history.compacted(buckets=2)
    assert {x.id: x.rep for x in small.representatives(spark.range(40)).collect()} == reps and small.table("members").count() == len(reps)
    small.merge(spark.createDataFrame([(21, 30)], "a long, b long"))
    assert {x.id: x.rep for x in small.representatives(spark.range(40)).collect()} == reps | {20: 1, 21: 1}
