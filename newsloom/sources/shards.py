"""JSON-lines shards with quarantine, and Parquet tables by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut


def read_shards(spark: SparkSession, path: str, schema: T.StructType, date_from: str | None = None, date_to: str | None = None, defaults: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantined files): a file with one bad line gives no row at all. Missing fields take their defaults,
    unknown ones are dropped, blank lines skipped; the bounds on the file's date are inclusive."""
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    raw = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").json(path)
    raw = raw.withColumn("shard", F.col("_metadata.file_path")).withColumn("shard_date", F.regexp_extract("shard", "(\\d{4}-\\d{2}-\\d{2})\\.jsonl$", 1))
    if date_from:
        raw = raw.where(F.col("shard_date") >= date_from)
    if date_to:
        raw = raw.where(F.col("shard_date") <= date_to)
    raw = cut(raw, "shards")
    bad = raw.where("_bad is not null").groupBy("shard").agg(F.count("*").alias("bad_lines"), F.min("_bad").alias("example"))
    rows = raw.join(bad.select("shard"), "shard", "left_anti").drop("_bad", "shard")
    for c, v in (defaults or {}).items():
        rows = rows.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(schema[c].dataType)))
    return rows, bad


def append(df: DataFrame, path: str, day: str = "shard_date") -> None:
    df.write.mode("append").partitionBy(day).parquet(path)


def purge(spark: SparkSession, path: str, cutoff: str, day: str = "shard_date") -> list[str]:
    """Deletes the partitions of days before the cutoff; their days, sorted."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for st in fs.listStatus(fs_path):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(f"{day}=") and name[len(day) + 1 :] < cutoff:
            fs.delete(st.getPath(), True)
            gone.append(name[len(day) + 1 :])
    return sorted(gone)


def upsert(spark: SparkSession, path: str, new: DataFrame, key: str, seq: str) -> DataFrame:
    """The table with new rows in place of those of the same key: the last by seq of each key."""
    old = spark.read.parquet(path)
    last = old.unionByName(new, allowMissingColumns=True)
    best = last.groupBy(key).agg(F.max(seq).alias(seq))
    return last.join(best, [key, seq], "left_semi")


def manifest(df: DataFrame, day: str = "shard_date") -> DataFrame:
    return df.agg(F.count_distinct(day).alias("shard_count"), F.count("*").alias("total"), F.min(day).alias("oldest"), F.max(day).alias("newest"))
