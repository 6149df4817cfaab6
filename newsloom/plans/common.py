"""Registering queries beside the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NOW = "2026-07-15 00:00:00"


def now_column():
    return F.lit("2026-07-15T00:00:00+00:00").cast("timestamp")


Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def put(f: Query) -> Query:
            self.queries[name] = f
            if sql:
                self.oracles[name] = sql
            return f

        return put
