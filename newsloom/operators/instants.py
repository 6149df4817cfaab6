"""Mixed timestamp notations and zones to one instant."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.moments import day_of, read, ways
from ..functions.text import name_key
from ..functions.url import host_of
from ..session import cut

DAY = 86_400
OLDEST, NEWEST = 7_300 * DAY, DAY
PRIOR = 1e6  # how many values the catalogue's word on a source weighs
CODES = 100_000
FORMATS = ("day_local", "day_utc", "month_local", "month_utc")
# Classes of a reading by its lag before the fetch, and how many days each spans: no instant, outside the window, after
# the fetch, within a month before it, older, and no time of fetch known.
NONE, OUTSIDE, AHEAD, RECENT, OLDER, UNKNOWN = range(6)
SPAN = np.array([7300.0, 7300.0, 1.0, 31.0, 7269.0, 7300.0])


def lag_class(epoch: Column, fetched: Column) -> Column:
    lag = fetched - epoch
    known = F.when(lag < -NEWEST, OUTSIDE).when(lag < 0, AHEAD).when(lag <= 31 * DAY, RECENT).when(lag <= OLDEST, OLDER).otherwise(OUTSIDE)
    return F.when(epoch.isNull(), NONE).when(fetched.isNull(), UNKNOWN).otherwise(known)


def densities(counts: dict[int, int]) -> np.ndarray:
    """The density per day of a right reading's lag in each class, from values that have one reading only."""
    n = np.array([counts.get(i, 0) + 1.0 for i in range(6)])
    return n / n.sum() / SPAN


def mixture(counts: pd.DataFrame, density: np.ndarray, rounds: int = 200) -> np.ndarray:
    """The shares of one source's FORMATS by expectation and maximisation over (FORMATS' classes, n).

    Every value contributes its likelihood under each format that it can be read in; the catalogue's order of day and
    month and its zone weigh as much as PRIOR values, so only more evidence than that is worth overrules them."""
    day = {"dmy": (PRIOR, 0.0), "mdy": (0.0, PRIOR)}.get(counts["date_order"].iloc[0], (1.0, 1.0))
    priors = np.array([day, (PRIOR, 0.0)]) + 0.5  # of day or month first, and of wall time or UTC
    like, n = density[counts[list(FORMATS)].to_numpy()].reshape(-1, 2, 2), counts["n"].to_numpy(float)
    order, zone = priors / priors.sum(1, keepdims=True)
    for _ in range(rounds):
        p = order[:, None] * zone * like
        p *= (n / np.maximum(p.sum((1, 2)), 1e-300))[:, None, None]
        seen = p.sum(0)
        new = priors + np.array([seen.sum(1), seen.sum(0)])
        new /= new.sum(1, keepdims=True)
        moved = max(np.abs(new[0] - order).max(), np.abs(new[1] - zone).max())
        order, zone = new
        if moved < 1e-12:
            break
    return (order[:, None] * zone).ravel()


def with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds src, tz and date_order of each row's source: by the host of its domain, else by its name in any spelling."""
    table = sources.select("id", "tz_name", "date_order", host_of(F.col("url")).alias("host"), name_key(F.col("name")).alias("nk"))
    pick = lambda key: table.where(F.length(key) > 0).groupBy(key).agg(F.min_by(F.struct("id", "tz_name", "date_order"), "id").alias(f"by_{key}"))
    x = rows.withColumn("host", F.regexp_replace(F.lower(F.trim(F.coalesce("source_domain", F.lit("")))), "^www\\.", "")).withColumn("nk", F.coalesce(name_key(F.col("source_name")), F.lit("")))
    x = x.join(pick("host"), "host", "left").join(pick("nk"), "nk", "left").withColumn("s", F.coalesce("by_host", "by_nk"))
    return x.drop("host", "nk", "by_host", "by_nk").withColumns({"src": F.col("s.id"), "tz": F.col("s.tz_name"), "date_order": F.col("s.date_order")}).drop("s")


def readings(articles: DataFrame, sources: DataFrame, zone_codes: DataFrame) -> DataFrame:
    """One row per article: the instants of raw_published_at by each of FORMATS, its form, and what the derived columns
    name. The catalogue of zone letters travels with the function; one of more than CODES rows is an error."""
    known = zone_codes.dropna().select(F.upper("zone_code"), F.col("offset_minutes").cast("int")).distinct().limit(CODES + 1).collect()
    if len(known) > CODES:
        raise ValueError(f"more than {CODES} zone codes")
    codes = {r[0]: r[1] for r in known}
    rows = articles.select("article_seq", "source_domain", "source_name", "raw_published_at", "published_at_utc", "published_at_jst", "fetched_at_utc")
    rows = with_source(rows, sources).select("article_seq", "src", "tz", "date_order", "raw_published_at", "published_at_utc", "published_at_jst", "fetched_at_utc")

    def run(batches):
        for b in batches:
            seq, src, tz, order, raw, utc, jst, fetched = (b.column(i).to_pylist() for i in range(8))
            got = [ways(t, z, codes) for t, z in zip(raw, tz)]
            utc, fetched = ([read(t, "ymd", "UTC", codes)[1] for t in x] for x in (utc, fetched))
            cols = [seq, src, order, [g[0] for g in got], [g[1] for g in got], *zip(*(g[2] for g in got))] if got else [[]] * 9
            cols += [utc, [day_of(t) for t in jst], fetched]
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), *[pa.int64()] * 7]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["article_seq", "src", "date_order", "form", "zoned", *FORMATS, "utc", "jst_day", "fetched"])

    kinds = ", ".join(f"{c} long" for c in (*FORMATS, "utc", "jst_day", "fetched"))
    return rows.mapInArrow(run, f"article_seq long, src string, date_order string, form string, zoned boolean, {kinds}")


def _one_way(x: DataFrame) -> Column:
    first, *others = (F.col(c) for c in FORMATS)
    same = F.lit(True)
    for c in others:
        same = same & first.eqNullSafe(c)
    return same


def lag_counts(read_rows: DataFrame) -> dict[int, int]:
    """How many values with one reading and an offset of their own fall into each class."""
    one = read_rows.where(_one_way(read_rows) & F.col("zoned") & ~F.col("form").isin("none", "words"))
    return {r["c"]: r["n"] for r in one.groupBy(lag_class(F.col("day_local"), F.col("fetched")).alias("c")).agg(F.count("*").alias("n")).collect()}


def format_shares(read_rows: DataFrame, density: np.ndarray) -> DataFrame:
    """(src, shares): each source's shares of FORMATS, from its values that have several readings."""
    n = read_rows.where(~_one_way(read_rows) & F.col("src").isNotNull())
    n = n.groupBy("src", "date_order", *(lag_class(F.col(c), F.col("fetched")).alias(c) for c in FORMATS)).agg(F.count("*").alias("n"))
    return n.groupBy("src").applyInPandas(lambda x: pd.DataFrame({"src": x["src"].iloc[:1], "shares": [mixture(x, density)]}), "src string, shares array<double>")


def instants(articles: DataFrame, sources: DataFrame, zone_codes: DataFrame, sure: float = 0.95) -> DataFrame:
    """(article_seq, published_epoch, certainty, unresolved, chosen, utc, jst_day, fetched) of every row.

    A value that its formats read differently gets the reading of the highest posterior: the source's share of each
    format, found by expectation and maximisation, times the density of its lag before the fetch; "no instant" is
    a reading, too, so a date that is impossible in its source's format mostly stays so. `chosen` says that the
    posterior had to decide. A value whose best reading stays under `sure` is marked unresolved; so is wall time of an
    unknown source. Null, empty and worded values have no instant. An empty table gives no rows.
    """
    rows = cut(readings(articles, sources, zone_codes), "readings")
    density = densities(lag_counts(rows))
    rows = rows.join(format_shares(rows, density), "src", "left")
    like = F.array(*(F.lit(float(x)) for x in density))
    shares = F.coalesce("shares", F.array(*[F.lit(0.25)] * 4))
    classes = F.array(*(lag_class(F.col(c), F.col("fetched")) for c in FORMATS))
    rows = rows.withColumn("one", _one_way(rows)).withColumn("e", F.array(*FORMATS))
    rows = rows.withColumn("w", F.when(~F.col("one"), F.zip_with(shares, classes, lambda s, c: s * F.element_at(like, c + 1))))
    total = lambda w: F.aggregate(w, F.lit(0.0), lambda a, b: a + b)
    # the weight of an instant is that of all formats that read it
    of = lambda x: total(F.zip_with("e", "w", lambda y, v: F.when(y.eqNullSafe(x), v).otherwise(0.0)))
    best = F.array_max(F.transform("e", lambda x, i: F.struct(of(x).alias("p"), (-i).alias("i"), x.alias("e"))))
    rows = rows.withColumn("best", F.when(~F.col("one"), best))
    epoch = F.when(F.col("one"), F.col("day_local")).otherwise(F.col("best.e"))
    certainty = F.when(F.col("one"), F.lit(1.0)).otherwise(F.col("best.p") / total(F.col("w")))
    open_ = (certainty < sure) | (F.col("src").isNull() & epoch.isNull() & ~F.col("form").isin("none", "words", "epoch"))
    return rows.select("article_seq", epoch.alias("published_epoch"), certainty.alias("certainty"), open_.alias("unresolved"), (~F.col("one")).alias("chosen"), "utc", "jst_day", "fetched")


def p2_readings(articles: DataFrame, sources: DataFrame, zone_codes: DataFrame) -> DataFrame:
    """(chosen, unresolved, n): how many values the posterior decided and how many stayed open."""
    return instants(articles, sources, zone_codes).groupBy("chosen", "unresolved").agg(F.count("*").alias("n"))


def p2_found(articles: DataFrame, sources: DataFrame, zone_codes: DataFrame) -> DataFrame:
    """(article_seq, published_epoch): rows whose raw text names an instant in the window around the fetch while a
    derived column is blank or names another."""
    x = instants(articles, sources, zone_codes)
    e = F.col("published_epoch")
    inside = e.between(F.col("fetched") - OLDEST, F.col("fetched") + NEWEST)
    right = (F.col("utc") == e) & (F.col("jst_day") == F.floor((e + 9 * 3600) / DAY))
    return x.where(inside & ~F.coalesce(right, F.lit(False))).select("article_seq", "published_epoch")
