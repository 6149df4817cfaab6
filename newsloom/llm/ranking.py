"""Caps per contributor, top rows of a group and the best representative of a group of duplicates."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank, instant, name_key
from ..session import cut, local, shared_path

LOWEST = float("-inf")
BINS = 256


def ordered_score(score: Column) -> tuple[Column, Column]:
    """(1 for a number, the number) or (0, -inf) for null and NaN, which so rank below every number."""
    number = score.isNotNull() & ~F.isnan(score)
    return number.cast("int"), F.when(number, score + F.lit(0.0)).otherwise(F.lit(LOWEST))


# ------------------------------------------------------------------------------------------------ top rows of a group


def write_clustered(df: DataFrame, group: Column, score: Column, seq: Column, row_group_rows: int | None = None, path: str | None = None) -> str:
    """Writes (g, ok, s, q) clustered by group and falling score, by default into the shared folder; the layout serves
    any number of later calls of top_n. A large group spans many row groups and files, split by score, so no task holds
    one group. Rows with a blank group are left out. Row groups have at most row_group_rows rows, by default a
    2 ** 14th of all, 256 at least, so their number has a bound and large groups span many at every size."""
    ok, s = ordered_score(score)
    rows = df.select(group.alias("g"), ok.alias("ok"), s.alias("s"), seq.alias("q")).where(~blank(F.col("g")))
    order = [F.col("g"), F.col("ok").desc(), F.col("s").desc(), F.col("q")]
    path = path or shared_path(df.sparkSession, "clustered")
    row_group_rows = row_group_rows or max(256, df.count() >> 14)
    out = rows.repartitionByRange(*order).sortWithinPartitions(*order).write.option("parquet.block.row.count.limit", row_group_rows)
    out.option("parquet.page.size.row.check.min", 64).option("parquet.page.size.check.estimate", "false").parquet(path)
    return path


def open_parquet(uri: str) -> pq.ParquetFile:
    """A file of the shared folder, wherever that is."""
    path = local(uri)
    if "://" not in path:
        return pq.ParquetFile(path)
    fs, path = FileSystem.from_uri(path)
    return pq.ParquetFile(path, filesystem=fs)


def row_group_statistics(spark, path: str) -> DataFrame:
    """One row per row group, from the files' footers: file, number, rows, first and last group, highest and lowest score."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path")

    def footers(batches):
        for b in batches:
            out = []
            for f in b.column(0).to_pylist():
                meta = open_parquet(f).metadata
                at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
                for k in range(meta.num_row_groups):
                    rg = meta.row_group(k)
                    g, s = (rg.column(at[c]).statistics for c in "gs")
                    known = g is not None and s is not None and g.has_min_max and s.has_min_max
                    out.append((f, k, rg.num_rows, *((g.min, g.max, float(s.max), float(s.min)) if known else (None,) * 4)))
            cols = list(zip(*out)) or [[]] * 7
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)], ["file", "rg", "n", "g0", "g1", "hi", "lo"])

    return files.mapInArrow(footers, "file string, rg int, n long, g0 string, g1 string, hi double, lo double")


def needed_row_groups(stats: DataFrame, n: int) -> DataFrame:
    """(file, rg, n, g0, g1, hi): leaves out each row group strictly below the n-th score that its one group already has
    in higher row groups, of whatever file.

    A row group of several groups begins at least one of them and is always read; without statistics, too.
    """
    pure = F.col("g0") == F.col("g1")
    w = Window.partitionBy("g0").orderBy(F.col("hi").desc(), F.col("lo").desc(), "file", "rg").rowsBetween(Window.unboundedPreceding, -1)
    above = stats.where(pure).withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))
    full = above.withColumn("nth", F.when(F.col("before") + F.col("n") >= n, F.col("lo")))
    bound = full.withColumn("bound", F.max("nth").over(w))
    kept = ["file", "rg", "n", "g0", "g1", "hi"]
    keep = bound.where(F.col("bound").isNull() | (F.col("hi") >= F.col("bound"))).select(*kept)
    return keep.unionByName(stats.where(~F.coalesce(pure, F.lit(False))).select(*kept))


def _best(t: pa.Table, n: int) -> pa.Table:
    """The rows of a sorted row group that are among the first n of their group in it."""
    if len(t) <= n:
        return t
    g = t.column("g").combine_chunks()  # a row goes where the n-th before it has its group
    return t.filter(pa.chunked_array([pa.array([True] * n), pc.not_equal(g[n:], g[:-n])]))


def _read_file(file: str, groups: list[tuple], n: int):
    """The best rows of a file's row groups (number, g0, g1, hi), read in falling order of their maximum.

    nth keeps the n best scores so far of each group that a row group has to itself, so a row group is skipped once its
    group's current n-th score is above all it has."""
    f, nth = open_parquet(file), {}
    for rg, g0, g1, hi in sorted(groups, key=lambda x: (-LOWEST if x[3] is None else x[3]), reverse=True):
        pure = g0 is not None and g0 == g1
        if pure and len(have := nth.get(g0, ())) == n and hi < have[-1]:
            continue
        t = f.read_row_group(rg, columns=["g", "ok", "s", "q"])
        size, t = len(t), _best(t, n)
        if pure:
            nth[g0] = sorted([*nth.get(g0, ()), *t.column("s").to_pylist()], reverse=True)[:n]
        yield size, t


def top_n(spark, path: str, n: int, counted: bool = False) -> DataFrame:
    """The n best rows of every group of a table by write_clustered: (g, pos, q), ties by the smaller q; or, counted,
    how much of it is read: (row_groups, row_groups_read, rows, rows_read).

    Statistics in the footers leave out row groups before any task reads, the scores read so far others in it.
    """
    stats = row_group_statistics(spark, path)
    need = needed_row_groups(stats, n).groupBy("file").agg(F.collect_list(F.struct("rg", "g0", "g1", "hi")).alias("groups"))
    need = need.repartition(F.col("file"))

    def parts(batches):
        for b in batches:
            for f, groups in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield from _read_file(f, [(x["rg"], x["g0"], x["g1"], x["hi"]) for x in groups], n)

    def read(batches):
        for _, t in parts(batches):
            yield from t.cast(pa.schema([("g", pa.string()), ("ok", pa.int32()), ("s", pa.float64()), ("q", pa.int64())])).to_batches()

    def count(batches):
        sizes = [size for size, _ in parts(batches)]
        yield pa.RecordBatch.from_arrays([pa.array([len(sizes)], pa.int64()), pa.array([sum(sizes)], pa.int64())], ["k", "r"])

    if counted:
        taken = need.select("file", "groups").mapInArrow(count, "k long, r long").agg(F.coalesce(F.sum("k"), F.lit(0)).alias("row_groups_read"), F.coalesce(F.sum("r"), F.lit(0)).alias("rows_read"))
        every = stats.agg(F.count("*").alias("row_groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
        return every.select(F.lit(1).alias("one"), "*").join(taken.withColumn("one", F.lit(1)), "one").drop("one")
    w = Window.partitionBy("g").orderBy(F.col("ok").desc(), F.col("s").desc(), "q")
    best = need.select("file", "groups").mapInArrow(read, "g string, ok int, s double, q long")
    return best.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= n).select("g", "pos", "q")


def top_of_groups(df: DataFrame, group: str, score: str, seq: str, n: int) -> DataFrame:
    """The n best rows of every group by higher score, then smaller seq: (group, pos, seq).

    Null and NaN scores rank below every number; blank groups are none; equal rows differ by seq; an empty table gives
    no rows; other columns are ignored, whatever their names.
    """
    path = write_clustered(df, F.col(group), F.col(score).cast("double"), F.col(seq).cast("bigint"))
    return top_n(df.sparkSession, path, n).select(F.col("g").alias(group), "pos", F.col("q").alias(seq))


def skipping(df: DataFrame, group: str, score: str, seq: str, n: int) -> DataFrame:
    """(row_groups, row_groups_read, rows, rows_read): how much of the clustered table top_of_groups reads."""
    path = write_clustered(df, F.col(group), F.col(score).cast("double"), F.col(seq).cast("bigint"))
    return top_n(df.sparkSession, path, n, counted=True)


# ------------------------------------------------------------------------------------------------ best representative


VOID = ["n/a", "none", "null", "no description"]  # fixed values


def void(text: Column) -> Column:
    """No description: null, no letter or digit, or a filler word."""
    bare = F.lower(F.regexp_replace(text, "(?U)^\\s+|\\s+$", ""))
    return F.coalesce(~text.rlike("[\\p{L}\\p{N}]") | bare.isin(*VOID), F.lit(True))


def trust_of(trust: Column) -> Column:
    """0 to 1; values above 1 are hundredths; NaN is null."""
    known = F.when(~F.isnan(trust), trust)
    return F.when(known > 1, known / 100).otherwise(known)


def best_of_duplicates(df: DataFrame, group: str = "duplicate_group_id", seq: str = "article_seq", trust: str = "source_trust", seen: str = "first_seen_at", fields: tuple[str, ...] = ("description",)) -> DataFrame:
    """One row per non-blank group of at least two rows: (group, survivor_seq, <field>_seq of each field).

    The survivor is first by higher trust (null last), earlier instant (null last) and smaller seq; each field comes
    from the first row in that order whose value isn't void, 0 if there is none. A partial window limit prunes every
    (group, field) to two rows before the shuffle, so a group of any size costs a task no more than a small one.
    """
    kinds = [F.lit(0), *(F.when(~void(F.col(f)), F.lit(i)) for i, f in enumerate(fields, 1))]
    rows = df.where(~blank(F.col(group))).select(
        F.col(group).alias("g"), trust_of(F.col(trust)).alias("t"), instant(F.col(seen)).alias("at"), F.col(seq).alias("q"), F.array_compact(F.array(*kinds)).alias("kinds")
    )
    rows = rows.select("g", "t", "at", "q", F.explode("kinds").alias("kind"))
    w = Window.partitionBy("g", "kind").orderBy(F.col("t").desc_nulls_last(), F.col("at").asc_nulls_last(), "q")
    best = rows.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= 2)
    pick = lambda i: F.max(F.when((F.col("kind") == i) & (F.col("pos") == 1), F.col("q")))
    out = best.groupBy("g").agg(
        F.max(F.when(F.col("kind") == 0, F.col("pos"))).alias("n"),
        pick(0).alias("survivor_seq"),
        *(F.coalesce(pick(i), F.lit(0)).cast("bigint").alias(f"{f}_seq") for i, f in enumerate(fields, 1)),
    )
    return out.where(F.col("n") == 2).select(F.col("g").alias(group), "survivor_seq", *(f"{f}_seq" for f in fields))


# ------------------------------------------------------------------------------------------------ caps per contributor


def score_bin(ok: Column, score: Column, bins: int = BINS) -> Column:
    """0 for no number, else 1 to bins, rising with the score; scores outside 0 to 1 fall into the end bins."""
    return F.when(ok == 1, 1 + F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(score * bins))).cast("int")).otherwise(0)


def beyond_cap(df: DataFrame, keys: list[Column], score: Column, seq: Column, max_count: int, max_share: float | None = None) -> DataFrame:
    """(q): the rows beyond the best max_count (and, if given, max_share of all) of their contributor, better being the
    higher score, then the smaller seq; null and NaN rank below every number. Rows with a null key have no contributor.

    Histograms of every contributor, merged from partial ones, give the bin in which its cap falls; whole bins below
    it go, those above it stay, and only the rows of that bin are ranked, by a window limit that prunes before it
    gathers. An empty table gives no rows.
    """
    ok, s = ordered_score(score.cast("double"))
    rows = df.select(*(k.alias(f"k{i}") for i, k in enumerate(keys)), ok.alias("ok"), s.alias("s"), seq.cast("bigint").alias("q"))
    names = [f"k{i}" for i in range(len(keys))]
    rows = cut(rows.dropna(subset=names).withColumn("bin", score_bin(F.col("ok"), F.col("s"))), "scored")
    hist = rows.groupBy(*names, "bin").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*names)
    down = hist.withColumn("upto", F.sum("n").over(w.orderBy(F.col("bin").desc()))).withColumn("total", F.sum("n").over(w))
    cap = F.lit(max_count).cast("bigint")
    if max_share is not None:
        cap = F.least(cap, F.greatest(F.lit(1), F.floor(F.col("total") * max_share)).cast("bigint"))
    down = down.withColumn("cap", cap)
    # the bin that the cap's last row lies in; need: how many of its rows stay
    edge = down.where((F.col("total") > F.col("cap")) & (F.col("upto") >= F.col("cap")) & (F.col("upto") - F.col("n") < F.col("cap")))
    edge = edge.select(*names, F.col("bin").alias("edge"), (F.col("cap") - F.col("upto") + F.col("n")).alias("need"))
    met = rows.join(edge, names)
    border = met.where(F.col("bin") == F.col("edge"))
    r = Window.partitionBy(*names).orderBy(F.col("ok").desc(), F.col("s").desc(), "q")
    last = border.withColumn("r", F.row_number().over(r)).where(F.col("r") <= max_count).where(F.col("r") == F.col("need"))
    last = last.select(*names, F.col("ok").alias("ok_"), F.col("s").alias("s_"), F.col("q").alias("q_"))
    later = (F.col("ok") < F.col("ok_")) | ((F.col("ok") == F.col("ok_")) & ((F.col("s") < F.col("s_")) | ((F.col("s") == F.col("s_")) & (F.col("q") > F.col("q_")))))
    return met.where(F.col("bin") < F.col("edge")).select("q").unionByName(border.join(last, names).where(later).select("q"))


def p3_found(articles: DataFrame, max_count: int = 8) -> DataFrame:
    run = F.coalesce(F.col("ingestion_run_id"), F.lit(""))
    return beyond_cap(articles, [run, name_key(F.col("source_name"))], F.col("importance_score"), F.col("article_seq"), max_count).select(F.col("q").alias("article_seq"))


def kept_rows(articles: DataFrame, max_count: int = 8) -> DataFrame:
    """The rows that stay: all without those of p3_found."""
    return articles.select("article_seq").join(p3_found(articles, max_count), "article_seq", "left_anti")
