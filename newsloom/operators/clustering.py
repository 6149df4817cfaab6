"""Online clustering of articles into events."""

from __future__ import annotations

import math
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "seq long, cluster string, is_new boolean"


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a and b else 0.0


def cluster_name(article: str) -> str:
    return "evc_" + "".join(c for c in article[-12:] if c in "abcdefghijklmnopqrstuvwxyz0123456789")


class Events:
    """The events of one scope, as they grow.

    An index by mark, title token and stretch of time, as long as the window, leaves out only events that can't match:
    of a title's n tokens at least threshold * n are shared, so any n - threshold * n + 1 of them, the rarest, hold
    one. What an event no longer has stays in the index; every candidate is checked.
    """

    def __init__(self, window: float, threshold: float, representatives: int = 3):
        self.window, self.threshold, self.representatives = window, threshold, representatives
        self.events: list[dict] = []
        self.index: dict[int | None, dict[tuple[str, str], set[int]]] = defaultdict(lambda: defaultdict(set))
        self.common: dict[str, int] = defaultdict(int)

    def stretch(self, at: float | None) -> int | None:
        return None if at is None else int(at // max(self.window, 1))

    def candidates(self, at: float | None, tokens: set, entities: set) -> list[int]:
        rare = sorted(tokens, key=lambda t: self.common.get(t, 0))[: len(tokens) - math.ceil(self.threshold * len(tokens) - 1e-9) + 1]
        keys = [(e, t) for e in entities for t in rare]
        near = list(self.index) if at is None else [None, *range(self.stretch(at) - 1, self.stretch(at) + 2)]
        found = set()
        for part in (self.index[n] for n in near if n in self.index):
            for k in keys:
                if k in part:
                    found |= part[k]
        return sorted(found)

    def add(self, article: str, at: float | None, tokens: set, entities: set, weight: float, marks: set | None = None) -> tuple[int, bool]:
        """(number of the event, whether it is new): the likest event in time that has one of the entities among its
        marks, the first of equals. marks: what the article adds to its event's, by default the entities."""
        marks = entities if marks is None else marks
        best, number = self.threshold, None
        for i in self.candidates(at, tokens, entities):
            ev = self.events[i]
            if at is not None and ev["last"] is not None and abs(at - ev["last"]) > self.window:
                continue
            like = jaccard(tokens, ev["tokens"])
            if like > best or (number is None and like == best):
                best, number = like, i
        new = number is None
        if new:
            number = len(self.events)
            self.events.append({"last": at, "top": [], "name": article, "marks": set(), "tokens": set(), "at": None})
        ev = self.events[number]
        if at is not None and (ev["last"] is None or at > ev["last"]):
            ev["last"] = at
        ev["top"] = sorted([*ev["top"], (-weight, float("-inf") if at is None else at, article, tokens)], key=lambda x: x[:3])[: self.representatives]
        self.enter(number, ev, marks)
        return number, new

    def enter(self, number: int, ev: dict, marks: set) -> None:
        """Takes over the event's new marks, tokens and time, and puts what is new into the index."""
        tokens, at = set().union(*(t for *_, t in ev["top"])), self.stretch(ev["last"])
        fresh = tokens - ev["tokens"]
        for t in fresh:
            self.common[t] += 1
        part, moved = self.index[at], at != ev["at"]
        for e in ev["marks"] | marks:
            for t in tokens if moved or e not in ev["marks"] else fresh:
                part[e, t].add(number)
        ev["marks"] |= marks
        ev["tokens"], ev["at"] = tokens, at


def cluster_articles(rows: DataFrame, window_hours: float = 72, threshold: float = 0.2, scope: list[str] | None = None) -> DataFrame:
    """rows (seq, article_id, category, source, t seconds, tokens, entities, weight) to (seq, cluster, is_new).

    Order matters, so each category (with scope=["category", "source"], each source's) is one ordered fold; an event
    needs one of a row's entities among its marks, and only events within the window are compared. An event has its
    rows' marks, where the column `marks` is given, else their entities. A row without entities meets none and is an
    event of its own, outside the fold.
    """

    keys = scope or ["category"]
    rows = rows if "marks" in rows.columns else rows.withColumn("marks", F.col("entities"))

    def fold(batches):
        at = events = None
        for p in batches:
            out = []
            for r in p.itertuples(index=False):
                if (k := tuple(getattr(r, c) for c in keys)) != at:
                    at, events = k, Events(window_hours * 3600, threshold)
                n, new = events.add(r.article_id, None if pd.isna(r.t) else float(r.t), set(r.tokens), set(r.entities), r.weight, set(r.marks))
                out.append((r.seq, cluster_name(events.events[n]["name"]), new))
            yield pd.DataFrame(out, columns=["seq", "cluster", "is_new"])

    met = F.size("entities") > 0
    alone = rows.where(~met).select("seq", F.concat(F.lit("evc_"), F.regexp_replace(F.right("article_id", F.lit(12)), "[^a-z0-9]", "")).alias("cluster"), F.lit(True).alias("is_new"))
    # sorted rows stream through a task, which keeps the events but never a group's rows
    return rows.where(met).repartition(*keys).sortWithinPartitions(*keys, "seq").mapInPandas(fold, SCHEMA).unionByName(alone)
