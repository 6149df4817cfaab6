"""The published package: bounded lists, one compressed file and its manifest."""

from __future__ import annotations

import gzip
import hashlib
import json
import os
import shutil
from abc import ABC, abstractmethod
from pathlib import Path

from pyspark.sql import DataFrame

KEYS = ("store_status", "hot_articles", "global_drivers", "risk_radar", "theme_summary", "market_reactions", "event_clusters", "historical_matches", "source_health", "quality_metrics")
TRIMMED = ("hot_articles", "theme_summary", "historical_matches", "event_clusters")


def rows(df: DataFrame, limit: int) -> list[dict]:
    """At most `limit` rows, which the plan has ordered and limited already."""
    return [json.loads(x) for x in df.limit(limit).toJSON().collect()]


def size_mb(package: dict) -> float:
    return len(json.dumps(package, ensure_ascii=False).encode()) / 1e6


def trimmed(package: dict, max_mb: float) -> dict:
    """Ten entries at a time go from the ends of the long lists, in turn, none below five, until it fits."""
    out = {k: list(v) if isinstance(v, list) else v for k, v in package.items()}
    for k in TRIMMED:
        while size_mb(out) > max_mb and len(out.get(k) or []) > 5:
            out[k] = out[k][: max(5, len(out[k]) - 10)]
    return out


def publish(package: dict, folder: str, now: str) -> dict:
    """Writes package and manifest by renaming, the same bytes for the same content, and keeps the last good pair; an
    incomplete package writes nothing."""
    if not set(KEYS) <= package.keys():
        return {"publication_status": "failed", "missing": sorted(set(KEYS) - package.keys())}
    to, raw = Path(folder) / "latest", json.dumps(package, ensure_ascii=False, sort_keys=True).encode()
    packed = gzip.compress(raw, mtime=0)
    manifest = {"publication_status": "success", "generated_at": now, "sha256": hashlib.sha256(packed).hexdigest(), "bytes": len(packed), "raw_bytes": len(raw), "counts": {k: len(v) for k, v in package.items() if isinstance(v, list)}}
    to.mkdir(parents=True, exist_ok=True)
    for name, content in (("package.json.gz", packed), ("manifest.json", json.dumps(manifest).encode())):
        part = to / f".{name}.part"
        part.write_bytes(content)
        os.replace(part, to / name)
    good = Path(folder) / "last_known_good"
    good.mkdir(exist_ok=True)
    shutil.copy2(to / "package.json.gz", good)
    (good / "manifest.json").write_text(json.dumps(manifest | {"role": "last_known_good"}))
    return manifest


def valid(folder: str) -> bool:
    try:
        m = json.loads((Path(folder) / "latest/manifest.json").read_text())
        packed = (Path(folder) / "latest/package.json.gz").read_bytes()
        json.loads(gzip.decompress(packed))
        return m["publication_status"] == "success" and m["sha256"] == hashlib.sha256(packed).hexdigest()
    except (OSError, ValueError, KeyError):
        return False


class Target(ABC):
    """Where a package is carried to."""

    @abstractmethod
    def publish(self, folder: str) -> bool: ...


class Folder(Target):
    def __init__(self, to: str):
        self.to = Path(to)

    def publish(self, folder: str) -> bool:
        if not valid(folder):
            return False
        self.to.mkdir(parents=True, exist_ok=True)
        for f in ("package.json.gz", "manifest.json"):
            shutil.copy2(Path(folder) / "latest" / f, self.to)
        return True


BADGES = {"healthy": "🟢 HEALTHY", "degraded": "🟡 DEGRADED", "failed": "🔴 FAILED"}
SECTIONS = {
    "Ingestion": ("configured_sources", "enabled_sources", "successful_sources", "unchanged_sources", "failed_sources", "fetched_items", "new_unique_articles", "exact_duplicates", "date_anomalies"),
    "Store": ("stored_articles", "total_articles", "clusters_created", "clusters_updated", "retention_deleted_shards", "quarantine_count"),
    "Package": ("package_items", "package_size"),
    "Run": ("run_id", "started_at", "completed_at", "total_seconds", "warning_count", "error_count"),
}


def summary(stats: dict | None) -> str:
    """A run's figures in Markdown: its health, then tables by section, then what is left."""
    if not stats:
        return "- ⚠️ no run statistics"
    status, left = stats.get("run_status", "unknown"), dict(stats)
    out = [f"**Run status: {BADGES.get(status, str(status).upper())}**"]
    left.pop("run_status", None)
    for title, keys in (*SECTIONS.items(), ("Other", None)):
        rows = [(k, left.pop(k)) for k in (sorted(left) if keys is None else keys) if k in left]
        if rows:
            out += ["", f"#### {title}", "", "| Metric | Value |", "| --- | --- |", *(f"| {k} | {v} |" for k, v in rows)]
    return "\n".join(out)
