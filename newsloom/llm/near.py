"""Near-duplicate articles: within the store, and of new batches against all history."""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import joined_text, normalize_text
from ..functions.url import address_key
from ..session import cut, discard, shared_path
from .components import merge_representatives, representatives
from .signatures import FUNCTIONS, ROW, SHINGLE, checked, forest, neighbours

ALIKE = 0.60
TREES = 24
PROBE_TREES = 24
FIT_PAIRS = 4096
FRESH = 1 << 40
FEW = 32
FIELDS = ("canonical", "content", "title", "source")  # what of a record is scored besides its text


def classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows (row, text) to their classes of equal text (h1, h2, id, text), id the smallest row, and members (row, id).

    Copies are counted once from here on, so a text that a third of all rows repeat is one class.
    """
    hashed = rows.select("row", "text", F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(1)).alias("h2"))
    table = cut(hashed.groupBy("h1", "h2").agg(F.min("row").alias("id"), F.min("text").alias("text")), "classes")
    members = hashed.select("row", "h1", "h2").join(table.select("h1", "h2", "id"), ["h1", "h2"]).select("row", "id")
    return table, members


def article_texts(articles: DataFrame, key: Column) -> DataFrame:
    return articles.select(key.cast("bigint").alias("row"), joined_text(F.col("title_original"), F.col("description")).alias("text"))


def near_links(articles: DataFrame, alike: float = ALIKE, trees: int = TREES) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between different texts that are alike, and members (row, id) of every text's class.

    Candidates come from an LSH forest, an exact check follows. A text under 5 characters is alike to none, its own
    copies included; null titles and descriptions count as empty; an empty table gives no rows.
    """
    table, members = classes(article_texts(articles, F.col("article_seq")).where(F.length("text") >= 5))
    texts = table.select("id", "text")
    return checked(neighbours(forest(texts, trees), alike), texts, alike), members


def p7_found(articles: DataFrame, alike: float = ALIKE, trees: int = TREES) -> DataFrame:
    """(seq_a, seq_b): all pairs of alike rows, equal texts included, seq_a the smaller."""
    links, members = near_links(articles, alike, trees)
    m = cut(members, "members")
    a, b = m.select(F.col("row").alias("x"), F.col("id").alias("a")), m.select(F.col("row").alias("y"), F.col("id").alias("b"))
    twice = m.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    same = a.join(twice, a.a == twice.id, "left_semi").join(b, F.col("a") == F.col("b")).where("x < y").select("x", "y")
    other = links.join(a, "a").join(b, "b").select("x", "y")
    return same.unionByName(other).select(F.least("x", "y").alias("seq_a"), F.greatest("x", "y").alias("seq_b"))


def near_groups(articles: DataFrame, alike: float = ALIKE, trees: int = TREES) -> DataFrame:
    """(article_seq, group_seq, links): of each row with an alike partner its group's smallest row and its class's
    number of links to other texts."""
    links, members = near_links(articles, alike, trees)
    links = cut(links, "links")
    reps = representatives(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("links"))
    size = members.groupBy("id").agg(F.count("*").alias("n"))
    out = members.join(size, "id").join(reps, "id", "left").join(degree, "id", "left").where("rep is not null or n > 1")
    return out.select(F.col("row").alias("article_seq"), F.coalesce("rep", "id").alias("group_seq"), F.coalesce("links", F.lit(0)).alias("links"))


# ------------------------------------------------------------------------------------------------ new batches


class History:
    """Everything accepted so far, as tables under one path, each bucketed and sorted by the key it is looked up by.

    addresses (kh, key, first), hashes (h1, h2, first) of the texts, texts (id, text and FIELDS), keys, the rows of the
    forest's trees, reps (id, rep) and members (rep, id), the clusters. `first` is the earliest delivery: a row number
    of the store, or FRESH plus the number of arrival; a text's id is 2 * first. Rows are only added: of several
    the smallest first or rep holds, and a representative that has moved is never one again.
    """

    TABLES = {
        "addresses": ("kh", "kh long, key string, first long"),
        "hashes": ("h1", "h1 long, h2 long, first long"),
        "texts": ("id", "id long, text string, " + ", ".join(f"{c} long" for c in FIELDS)),
        "keys": ("k", ROW),
        "reps": ("id", "id long, rep long"),
        "members": ("rep", "rep long, id long"),
    }

    def __init__(self, spark: SparkSession, path: str, buckets: int, trees: int):
        self.spark, self.path, self.buckets, self.trees = spark, path.rstrip("/"), buckets, trees
        self.name = f"history_{uuid.uuid4().hex}"
        for t, (key, columns) in self.TABLES.items():
            spark.sql(f"create table {self.name}_{t} ({columns}) using parquet clustered by ({key}) sorted by ({key}) into {buckets} buckets location '{self.path}/{t}'")

    @classmethod
    def create(cls, spark: SparkSession, path: str | None = None, buckets: int | None = None, trees: int = PROBE_TREES) -> History:
        """An empty one, by default in the shared folder and with as many buckets as shuffles have partitions."""
        path = (path or shared_path(spark, "history")).rstrip("/")
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.createDataFrame([(buckets, trees)], "buckets int, trees int").coalesce(1).write.json(f"{path}/kind")
        return cls(spark, path, buckets, trees)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> History:
        """One that an earlier session wrote."""
        kind = spark.read.schema("buckets int, trees int").json(f"{path.rstrip('/')}/kind").first()
        return cls(spark, path, kind["buckets"], kind["trees"])

    @classmethod
    def of(cls, rows: DataFrame, path: str | None = None, trees: int = PROBE_TREES) -> History:
        """A new one with rows (row, url, text and FIELDS, if any)."""
        history = cls.create(rows.sparkSession, path, trees=trees)
        fresh = cut(_classes(_keyed(rows)).withColumn("id", F.col("first") * 2), "classes")
        history._take(_keyed(rows), fresh, None)
        discard(fresh)
        return history

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.name}_{name}")

    def add(self, name: str, rows: DataFrame) -> None:
        key, columns = self.TABLES[name]
        columns = [c.split()[0] for c in columns.split(", ")]
        rows.select(*columns).repartition(self.buckets, key).sortWithinPartitions(key).write.insertInto(f"{self.name}_{name}")

    def lookup(self, name: str, keys: DataFrame, few: bool = False) -> DataFrame:
        """The table's rows whose key is among `keys` (one column). Only the keys are shuffled, to the table's buckets;
        few keys, of a batch of up to FEW rows, become literals that leave out buckets, row groups and pages."""
        key = self.TABLES[name][0]
        keys = keys.toDF(key).dropna().distinct()
        if few:
            return self.table(name).where(F.col(key).isin([r[0] for r in keys.collect()]))
        return self.table(name).join(keys.hint("shuffle_hash"), key, "left_semi")

    def accept(self, batch: Batch) -> None:
        """Adds a probed batch; nothing accepted before is read or written."""
        self._take(batch.rows, batch.classes.where("id is not null"), batch.sketches)

    def _take(self, rows: DataFrame, fresh: DataFrame, sketches: DataFrame | None) -> None:
        even = lambda d: d.withColumn("id", F.col("id") - F.pmod("id", F.lit(2)))
        self.add("addresses", rows.where("key is not null").groupBy("kh", "key").agg(F.min("row").alias("first")))
        self.add("hashes", fresh)
        self.add("texts", even(fresh))
        self.add("keys", even(forest(fresh.select("id", "text"), self.trees) if sketches is None else sketches))

    def merge(self, links: DataFrame) -> None:
        """Takes over new links (a, b) of deliveries: only the clusters they touch are read, and only rows of those that
        change are added."""
        links = links.select("a", "b").where("a <> b")
        ends = links.select("a").union(links.select("b"))
        roots = self.lookup("reps", ends).groupBy("id").agg(F.min("rep").alias("rep")).select("rep")
        known = cut(self.lookup("members", roots).select("id", "rep"), "known")
        changed = cut(merge_representatives(known, links), "changed")
        self.add("reps", changed)
        self.add("members", changed)

    def compacted(self, path: str | None = None, buckets: int | None = None) -> History:
        """The same history at another path with one file a bucket, and as many buckets as it needs by now; what later
        rows have made obsolete is left out. This one stays as it is."""
        new = History.create(self.spark, path, buckets, self.trees)
        new.add("addresses", self.table("addresses").groupBy("kh", "key").agg(F.min("first").alias("first")))
        for t in ("hashes", "texts", "keys"):
            new.add(t, self.table(t))
        reps = cut(self.table("reps").groupBy("id").agg(F.min("rep").alias("rep")), "reps")
        new.add("reps", reps)
        new.add("members", reps)
        discard(reps)
        return new

    def representatives(self, ids: DataFrame) -> DataFrame:
        """(id, rep) of those ids that have links."""
        return self.lookup("reps", ids).groupBy("id").agg(F.min("rep").alias("rep"))


class Batch:
    """New rows against a history: rows (row, kh, key, h1, h2), classes of equal text (h1, h2, first, id, text, FIELDS)
    and the sketches of those texts that the history doesn't have (all others have no id)."""

    def __init__(self, history: History, incoming: DataFrame, settle: bool = False):
        self.history = history
        new = cut(_keyed(incoming), "incoming")
        self.rows, self.few = new, settle and len(new.limit(FEW + 1).collect()) <= FEW
        known = history.lookup("addresses", new.where("key is not null").select("kh"))
        seen = known.select("kh", "key", "first").unionByName(new.where("key is not null").select("kh", "key", F.col("row").alias("first")))
        seen = seen.groupBy("kh", "key").agg(F.min("first").alias("first"))
        self.by_address = new.select("row", "kh", "key").join(seen, ["kh", "key"]).where("first < row").select("row", F.lit("address").alias("kind"), "first")

        mine = _classes(new).withColumnRenamed("first", "row0")
        had = history.lookup("hashes", mine.select("h1")).select("h1", "h2", "first")
        mine = mine.join(had, ["h1", "h2"], "left").join(self.by_address.select(F.col("row").alias("row0"), F.lit(True).alias("settled")), "row0", "left")
        asks = F.lit(1) if not settle else F.when(F.col("settled"), 0).otherwise(1)
        kept = ["h1", "h2", "text", *FIELDS]
        self.classes = cut(mine.select(*kept, F.coalesce("first", "row0").alias("first"), F.when(F.col("first").isNull(), F.col("row0") * 2 + asks).alias("id")), "mine")
        first = self.classes.select("h1", "h2", "first")
        self.by_text = new.select("row", "h1", "h2").join(first, ["h1", "h2"]).where("first < row").select("row", F.lit("text").alias("kind"), "first")
        self.sketches = cut(forest(self.classes.where("id is not null").select("id", "text"), history.trees), "sketches")

    def candidates(self, alike: float) -> DataFrame:
        """(a, b, m, ratio): b a text of this batch that asks for its kin, a one that came before it."""
        old = self.history.lookup("keys", self.sketches.where("id % 2 = 1").select("k"), self.few)
        return neighbours(old.unionByName(self.sketches), alike, fresh=True)

    def known_texts(self, ids: DataFrame, *columns: str) -> DataFrame:
        mine = self.classes.where("id is not null")
        return self.history.lookup("texts", ids, self.few).select("id", *columns).unionByName(mine.select("id", *columns))

    def scored(self, alike: float) -> tuple[DataFrame, np.ndarray]:
        """The candidates with their score, and its weights: a logistic regression on the sketch's matches, the ratio of
        lengths and which of FIELDS agree, fitted on at most FIT_PAIRS checked candidates."""
        found = cut(self.candidates(alike), "candidates")
        fields = cut(self.known_texts(found.select("a").union(found.select("b")), *FIELDS), "fields")
        side = lambda x: fields.select(F.col("id").alias(x), *(F.col(c).alias(x + c) for c in FIELDS))
        same = [F.coalesce(F.col("a" + c) == F.col("b" + c), F.lit(False)).cast("double").alias(f"same_{c}") for c in FIELDS]
        pairs = found.join(side("a"), "a").join(side("b"), "b").select("a", "b", (F.col("m") / FUNCTIONS).alias("m"), F.col("ratio").cast("double").alias("ratio"), *same)
        pairs = cut(pairs, "features")
        names = pairs.columns[2:]
        part = pairs.orderBy(F.xxhash64("a", "b"), "a", "b").limit(FIT_PAIRS)
        good = self.checked(part, alike).withColumn("y", F.lit(1.0))
        sample = part.join(good, ["a", "b"], "left").select(*names, F.coalesce("y", F.lit(0.0)).alias("y")).collect()
        w = learned(np.array([tuple(r)[:-1] for r in sample], float).reshape(-1, len(names)), np.array([r["y"] for r in sample], float))
        score = reduce(lambda x, y: x + y, (F.lit(float(v)) * F.col(c) for v, c in zip(w, names)), F.lit(float(w[-1])))
        return pairs.select("a", "b", (1 / (1 + F.exp(-score))).alias("score")), w

    def checked(self, pairs: DataFrame, alike: float) -> DataFrame:
        return checked(pairs, self.known_texts(pairs.select("a").union(pairs.select("b")), "text"), alike)

    def links(self, alike: float = ALIKE) -> DataFrame:
        """All links (a, b) of this batch's texts to different ones before them, as earliest deliveries."""
        return self.checked(self.candidates(alike), alike).select(_first("a").alias("a"), _first("b").alias("b"))

    def by_near(self, alike: float = ALIKE) -> DataFrame:
        """(row, kind, first): the asking texts' rows that have kin before them, and one of those.

        The likeliest candidate of each by score is checked first, the others only where that isn't alike: the
        score decides the order, the check the result. A batch of up to FEW rows has all its few candidates checked."""
        if self.few:
            links = self.links(alike)
            return links.groupBy(F.greatest("a", "b").alias("row")).agg(F.min(F.least("a", "b")).alias("first")).select("row", F.lit("near").alias("kind"), "first")
        pairs, _ = self.scored(alike)
        best = pairs.groupBy("b").agg(F.max_by("a", F.struct("score", "a")).alias("a"))
        sure = cut(self.checked(best.select("a", "b"), alike), "sure")
        rest = pairs.join(sure.select("b"), "b", "left_anti").join(best, ["a", "b"], "left_anti")
        both = sure.unionByName(self.checked(rest.select("a", "b"), alike))
        return both.groupBy("b").agg(F.min("a").alias("a")).select(_first("b").alias("row"), F.lit("near").alias("kind"), _first("a").alias("first"))


def _keyed(rows: DataFrame) -> DataFrame:
    """rows (row, url, text and FIELDS, if any) with the keys of address and text (null for none) and FIELDS as hashes."""
    key, sized = address_key(F.col("url")), F.length("text") >= SHINGLE
    hashes = [F.when(sized, F.xxhash64("text")).alias("h1"), F.when(sized, F.xxhash64("text", F.lit(1))).alias("h2")]
    fields = [F.when(F.col(c) != "", F.xxhash64(c)).alias(c) if c in rows.columns else F.lit(None).cast("bigint").alias(c) for c in FIELDS]
    return rows.select("row", key.alias("key"), F.xxhash64(key).alias("kh"), *hashes, "text", *fields)


def _classes(keyed: DataFrame) -> DataFrame:
    """(h1, h2, first, text and FIELDS of the first): the different texts."""
    return keyed.where("h1 is not null").groupBy("h1", "h2").agg(F.min("row").alias("first"), F.min("text").alias("text"), *(F.min_by(c, "row").alias(c) for c in FIELDS))


def _first(c: str) -> Column:
    return F.floor(F.col(c) / 2).cast("bigint")


def learned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the columns of x and a constant by logistic regression; zeros where all labels are equal."""
    w = np.zeros(x.shape[1] + 1)
    if len(np.unique(y)) < 2:
        return w
    x = np.concatenate((x, np.ones((len(x), 1))), 1)
    for _ in range(50):  # Newton steps, slightly damped
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (y - p) - 1e-2 * w)
    return w


def probe(history: History, incoming: DataFrame, alike: float = ALIKE) -> DataFrame:
    """incoming (row, url, text and FIELDS), row at least FRESH and rising with arrival, to (row, kind, first): rows
    that are known and an earlier delivery that shows it, of the history or incoming: by address (the earliest), by
    text (the earliest) or, where neither address nor text is known, near (an alike one). The cost follows the batch."""
    batch = Batch(history, incoming, settle=True)
    return reduce(DataFrame.unionByName, (batch.by_address, batch.by_text, batch.by_near(alike)))


def store_copies(history: History, rows: DataFrame) -> DataFrame:
    """Links (a, b) of the store's rows (row, url, text) to the earliest of the same address and of the same text."""
    url = rows.select("row", address_key(F.col("url")).alias("key")).join(history.table("addresses"), "key")
    text = rows.where(F.length("text") >= SHINGLE).select("row", F.xxhash64("text").alias("h1"), F.xxhash64("text", F.lit(1)).alias("h2")).join(history.table("hashes"), ["h1", "h2"])
    return url.select("row", "first").unionByName(text.select("row", "first")).where("first < row").select(F.col("row").alias("a"), F.col("first").alias("b"))


def store_clusters(history: History, rows: DataFrame, alike: float = ALIKE) -> None:
    """The clusters of a store that was accepted at once, as the history's first."""
    texts = history.table("texts").select("id", "text")
    near = checked(neighbours(history.table("keys"), alike), texts, alike).select(_first("a").alias("a"), _first("b").alias("b"))
    every = cut(representatives(store_copies(history, rows).unionByName(near)), "known")
    history.add("reps", every)
    history.add("members", every)


def _rows(articles: DataFrame, row: Column) -> DataFrame:
    fields = [F.col("canonical_hash").alias("canonical"), F.col("content_hash").alias("content"), normalize_text(F.col("title_original")).alias("title"), F.col("source_domain").alias("source")]
    have = set(articles.columns)
    needs = ["canonical_hash", "content_hash", "title_original", "source_domain"]
    fields = [f if n in have else F.lit(None).cast("string").alias(c) for f, n, c in zip(fields, needs, FIELDS)]
    return articles.select(row.alias("row"), F.col("canonical_url").alias("url"), joined_text(F.col("title_original"), F.col("description")).alias("text"), *fields)


def store_rows(articles: DataFrame) -> DataFrame:
    return _rows(articles, F.col("article_seq").cast("bigint"))


def incoming_rows(incoming: DataFrame) -> DataFrame:
    return _rows(incoming, F.col("incoming_seq").cast("bigint") + FRESH)


def p1_links(articles: DataFrame, incoming: DataFrame) -> DataFrame:
    return probe(History.of(store_rows(articles)), incoming_rows(incoming))


def p1_found(articles: DataFrame, incoming: DataFrame) -> DataFrame:
    """(incoming_seq): incoming rows already known, by address or by text alike, from the store or from an earlier
    incoming row. Empty addresses and texts under 5 characters equal none; empty tables give no rows."""
    return p1_links(articles, incoming).select((F.col("row") - FRESH).alias("incoming_seq")).distinct()


def p1_clusters(articles: DataFrame, incoming: DataFrame) -> DataFrame:
    """(incoming_seq, known_as): each known incoming row's representative, as its earliest delivery reached by links:
    the row number in the store, or minus the number of arrival.

    The batches go one after another: each is probed against all before it, its links are merged into the clusters they
    touch, and it is accepted. Without a column batch_no, or where it is null, all rows are one batch.
    """
    rows = store_rows(articles)
    history = History.of(rows)
    store_clusters(history, rows)
    number = F.coalesce("batch_no", F.lit(0)) if "batch_no" in incoming.columns else F.lit(0)
    incoming = incoming.withColumn("batch_no", number)
    known = []
    for (n,) in incoming.select("batch_no").distinct().orderBy("batch_no").toLocalIterator():
        batch = Batch(history, incoming_rows(incoming.where(F.col("batch_no") == n)))
        copies = batch.by_address.unionByName(batch.by_text).select(F.col("row").alias("a"), F.col("first").alias("b"))
        links = cut(copies.unionByName(batch.links()), "links")
        history.merge(links)
        history.accept(batch)
        later = F.greatest("a", "b")
        known.append(links.select(later.alias("id")).where(F.col("id") >= FRESH).distinct())
    if not known:
        return articles.sparkSession.createDataFrame([], "incoming_seq long, known_as long")
    ids = reduce(DataFrame.unionByName, known).distinct()
    named = F.when(F.col("rep") >= FRESH, FRESH - F.col("rep")).otherwise(F.col("rep"))
    return history.representatives(ids).select((F.col("id") - FRESH).alias("incoming_seq"), named.alias("known_as"))
