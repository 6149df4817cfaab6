"""Session defaults and the shared folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "newsloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; the cluster's own settings win where given."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    for k, v in {**base, **conf}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where that is unset a local session gets a temporary
    one; on a cluster, whose machines don't share such a folder, that is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        at = spark.sparkContext._jsc.sc().getCheckpointDir()
        at = at.get() if at.isDefined() else None
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="newsloom-")
        _made.append(at)
        spark.conf.set("spark.checkpoint.dir", at) if spark.conf.isModifiable("spark.checkpoint.dir") else None
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


_made: list[str] = []  # what this process wrote to the shared folder


def clear() -> None:
    """Deletes what this process wrote to the shared folder. Results that are still to be read need it, so this is for
    the end; it runs at the end of the process by itself."""
    while _made:
        path = _made.pop()
        if path.startswith("file:"):
            shutil.rmtree(local(path), ignore_errors=True)
        elif (gateway := SparkContext._gateway) is not None:
            try:
                p = gateway.jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(gateway.jvm.org.apache.hadoop.conf.Configuration()).delete(p, True)
            except Exception:  # the JVM is gone; the folder's own retention holds
                pass


atexit.register(clear)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh place in the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """The same rows read back from a table in the shared folder: the lineage ends and lost executors cost nothing."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes the table of a frame made by cut, which nothing reads any more."""
    path = getattr(df, "_cut_path", None)
    if path is not None:
        p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)
        if path in _made:
            _made.remove(path)


def local(path: str) -> str:
    """A file: URI as a plain path for Python readers; other URIs are unchanged."""
    return path[5:].replace("//", "/", 1) if path.startswith("file:") and os.path.sep == "/" else path
