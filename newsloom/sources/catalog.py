"""The catalogue of sources: configuration, defaults and the union of its parts."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

try:
    import yaml
except ImportError:  # JSON is read without it
    yaml = None

# Formats and classes that a source may name.
FORMATS = ["auto", "rss", "atom"]
CLASSES = ["primary_official", "official_corporate", "international_institution", "major_news", "specialist_media", "aggregator", "unknown"]
FIELDS = "id string, name string, url string, format string, source_class string, country string, region string, language string, primary_category string, adapter string, enabled boolean, trust_score double, trust double, max_items_per_fetch int, fetch_interval_minutes int"


def load_config(path: str) -> dict:
    """A YAML or JSON file; {} for one that is missing or empty."""
    p = Path(path)
    if not p.exists():
        return {}
    text = p.read_text(encoding="utf-8")
    return (yaml.safe_load(text) if yaml is not None else json.loads(text or "{}")) or {}


def raw_sources(spark: SparkSession, config: dict, base: str = ".", key: str = "sources_file") -> DataFrame:
    """The entries written in the configuration, then those of the file it names, numbered in that order; a file that
    is missing has none, unknown keys are dropped."""
    entries = list(config.get("sources") or [])
    if config.get(key):
        entries += load_config(str(Path(base) / config[key])).get("sources") or []
    names = [f.split()[0] for f in FIELDS.split(", ")]
    kinds = dict(f.split() for f in FIELDS.split(", "))
    take = {"string": str, "boolean": bool, "double": float, "int": int}
    rows = []
    for i, e in enumerate(entries):
        e = {"format": e.get("type"), **e}
        rows.append((i, *(None if e.get(n) is None else take[kinds[n]](e[n]) for n in names)))
    return spark.createDataFrame(rows, "seq int, " + FIELDS)


def normalized(raw: DataFrame) -> DataFrame:
    """Defaults filled in: an id made of the name, a known format and class, a score of 0 to 100 and trust as its hundredth."""
    slug = F.replace(F.lower(F.trim(F.coalesce("name", F.lit("")))), F.lit(" "), F.lit("_"))
    ident = F.coalesce("id", F.when(slug != "", slug), F.lit("unknown"))
    score = F.coalesce(F.col("trust_score").cast("int"), F.rint(F.col("trust") * 100).cast("int"), F.lit(50))
    known = lambda c, xs, other: F.when(F.col(c).isin(*xs), F.col(c)).otherwise(other).alias(c)
    plain = {"url": "", "country": "", "region": "", "language": "en", "primary_category": "", "adapter": "rss"}
    return raw.select(
        "seq", ident.alias("id"), F.coalesce("name", ident).alias("name"), F.coalesce("enabled", F.lit(True)).alias("enabled"), known("format", FORMATS, "auto"), known("source_class", CLASSES, "unknown"), *(F.coalesce(c, F.lit(v)).alias(c) for c, v in plain.items()),
        score.alias("trust_score"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), score / 100.0)).alias("trust"), F.coalesce("max_items_per_fetch", F.lit(200)).alias("max_items_per_fetch"), F.coalesce("fetch_interval_minutes", F.lit(60)).alias("fetch_interval_minutes"),
    )


def keep_last(rows: DataFrame, key: str = "id", seq: str = "seq") -> DataFrame:
    """Of each key the last row, at the place (seq) of its first."""
    others = [c for c in rows.columns if c not in (key, seq)]
    x = rows.groupBy(key).agg(F.max_by(F.struct(*others), seq).alias("_last"), F.min(seq).alias(seq))
    return x.select(seq, key, "_last.*")


def load_sources(spark: SparkSession, config: dict, base: str = ".") -> DataFrame:
    """All sources, normalised; an id that comes again replaces the one before it."""
    return keep_last(normalized(raw_sources(spark, config, base)))


def enabled(sources: DataFrame) -> DataFrame:
    return sources.where(F.coalesce("enabled", F.lit(True)) & (F.coalesce("url", F.lit("")) != ""))


def to_verify(sources: DataFrame) -> DataFrame:
    """Candidates: what isn't enabled."""
    return sources.where(~F.coalesce("enabled", F.lit(True)))


def in_order(sources: DataFrame) -> DataFrame:
    """One order for every run: by id, or by name without one."""
    return sources.orderBy(F.coalesce(F.when(F.col("id") != "", F.col("id")), F.col("name")))
