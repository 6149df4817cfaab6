"""Queries of the core operators and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .operators import instants
from .plans import matching, moments_sql, rollups, scalars, services, store, streams
from .tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": lambda s, d: instants.p2_found(load(s, d, "articles"), load(s, d, "sources"), load(s, d, "zone_codes")),
    "p2_readings": lambda s, d: instants.p2_readings(load(s, d, "articles"), load(s, d, "sources"), load(s, d, "zone_codes")),
}
ORACLES: dict[str, str] = {"p2_found": moments_sql.SQL_FOUND}
for area in (scalars, store, rollups, matching, services, streams):
    QUERIES |= area.query.queries
    ORACLES |= area.query.oracles
