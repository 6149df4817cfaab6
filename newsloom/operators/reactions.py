"""Market reactions of events: a long table of (event_cluster_id, target, reaction_window, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What reactions are measured on, and over how long.
TARGETS = ["nikkei225", "topix", "sp500", "nasdaq", "sox", "vix", "usdjpy", "dxy", "us10y", "wti", "gold", "bitcoin", "related_sectors", "related_stocks"]
WINDOWS = ["1h", "4h", "1d", "5d", "20d"]
KEY = ["event_cluster_id", "target", "reaction_window"]


def stub(ids: DataFrame) -> DataFrame:
    """The empty grid of every event in `ids` (event_cluster_id); both axes are closed vocabularies."""
    grid = ids.select("event_cluster_id").distinct().withColumn("target", F.explode(F.array(*map(F.lit, TARGETS))))
    return grid.withColumn("reaction_window", F.explode(F.array(*map(F.lit, WINDOWS)))).withColumn("value", F.lit(None).cast("double"))


def start_tracking(table: DataFrame, ids: DataFrame) -> DataFrame:
    """The table with an empty grid for those events that it doesn't have yet."""
    new = ids.select("event_cluster_id").join(table.select("event_cluster_id").distinct(), "event_cluster_id", "left_anti")
    return table.select(*KEY, "value").unionByName(stub(new))


def record(table: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the table with `rows` (KEY, value) in place of its cells, refused rows): an unknown target or window is refused;
    of several rows for a cell the greatest value holds. An event that is new gets its whole grid."""
    known = F.coalesce(F.col("target").isin(*TARGETS) & F.col("reaction_window").isin(*WINDOWS), F.lit(False))
    good = rows.where(known).groupBy(*KEY).agg(F.max("value").alias("value"))
    every = start_tracking(table, good)
    cells = every.join(good.withColumnRenamed("value", "_new").withColumn("_hit", F.lit(True)), KEY, "left")
    return cells.select(*KEY, F.when(F.col("_hit"), F.col("_new")).otherwise(F.col("value")).alias("value")), rows.where(~known)
