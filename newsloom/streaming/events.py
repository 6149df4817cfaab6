"""Streams over the event and article tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import canonical_hash, title_hash
from ..operators import dedup
from ..session import shared_path


def read_stream(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int = 4) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path + "*")


def run_to_table(stream: DataFrame, mode: str) -> DataFrame:
    """Runs what is there as a stream and gives the result as a table; each batch writes its own folder, so a batch
    that runs twice writes the same."""
    spark = stream.sparkSession
    out = shared_path(spark, "stream")
    each = lambda df, n: df.write.mode("overwrite").parquet(f"{out}/" + ("result" if mode == "complete" else f"batch={n}"))
    stream.writeStream.outputMode(mode).option("checkpointLocation", shared_path(spark, "offsets")).trigger(availableNow=True).foreachBatch(each).start().awaitTermination()
    schema = stream.schema
    got = spark.read.schema(schema.add("batch", "long") if mode == "update" else schema).parquet(f"{out}/result" if mode == "complete" else out)
    return got if mode == "update" else got.select(*stream.columns)


def last_updates(updates: DataFrame, *keys: str) -> DataFrame:
    """Of a table of updates by batch each key's last row."""
    others = [c for c in updates.columns if c not in (*keys, "batch")]
    return updates.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch").alias("_last")).select(*keys, "_last.*")


def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling days of event time, two days of lateness allowed: days that the watermark has passed leave the state, so
    each batch writes only the days it changes."""
    x = read_stream(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", "48 hours")
    x = x.groupBy(F.window("at", "1 day"), "event_type").agg(F.count("*").alias("n"))
    x = x.select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n")
    return last_updates(run_to_table(x, "update"), "day", "event_type")


def first_of_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users and kinds of event that occurred, each once however often and however late it comes, so all of them stay
    in the state."""
    x = read_stream(spark, sf_dir, "events").select("user_id", "event_type").dropDuplicates(["user_id", "event_type"])
    return run_to_table(x, "append")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of a user with gaps of up to 72 hours, those that are still open included, which only the complete mode
    gives; a stream without an end would take append, whose state the watermark clears."""
    x = read_stream(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", "48 hours")
    x = x.groupBy(F.session_window("at", "72 hours"), "user_id").agg(F.count("*").alias("n"))
    return run_to_table(x.select("user_id", F.unix_seconds("session_window.start").alias("started"), "n"), "complete")


def accept_batch(batch: DataFrame, store: str, seq: str) -> DataFrame:
    """One micro-batch of raw articles: keys, first delivery of the batch, nothing that the store has; appended.

    Running a batch again appends nothing, as its keys are in the store by then.
    """
    spark = batch.sparkSession
    keys = ["canonical_hash", "title_hash"]
    made = batch.withColumn("canonical_hash", canonical_hash(F.col("canonical_url"))).withColumn("title_hash", title_hash(F.col("title_original")))
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(store)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        made = dedup.known(made, spark.read.parquet(store).select(*keys), keys)
    kept = dedup.first_wins(made.select(seq, *keys), seq, keys)
    new = made.join(kept, seq, "left_semi")
    path = shared_path(spark, "accepted")
    new.write.parquet(path)
    new = spark.read.schema(new.schema).parquet(path)
    new.write.mode("append").parquet(store)
    return new


def ingest(spark: SparkSession, sf_dir: str, store: str | None = None) -> DataFrame:
    """The incoming table as a stream of micro-batches into a store; gives the store's keys."""
    store = store or shared_path(spark, "store")
    x = read_stream(spark, sf_dir, "incoming_articles").select("incoming_seq", "article_id", "canonical_url", "title_original", "description")
    x.writeStream.option("checkpointLocation", shared_path(spark, "offsets")).trigger(availableNow=True).foreachBatch(lambda df, _: accept_batch(df, store, "incoming_seq") and None).start().awaitTermination()
    return spark.read.parquet(store).select("incoming_seq", "canonical_hash", "title_hash")
