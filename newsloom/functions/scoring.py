"""Scores between 0 and 1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights and vocabularies.
WEIGHTS = {"relevance": 0.25, "market_reaction": 0.25, "freshness": 0.15, "source_trust": 0.10, "urgency": 0.10, "structural": 0.10, "independent_source_confirmation": 0.05}
STRUCTURAL = ["monetary_policy", "fiscal_policy", "geopolitics", "diplomacy_war", "us_china", "us_iran_middle_east", "taiwan", "ukraine", "north_korea", "sanctions", "tariffs", "semiconductor", "ai", "defense", "electric_power", "rare_earth", "regulation"]
HIGH_IMPACT = ["monetary_policy", "rates", "fx", "inflation", "employment", "gdp", "oil", "natural_gas", "gold", "semiconductor", "ai", "earnings", "banking", "tariffs", "sanctions", "mna"]
URGENT = ["急落", "急騰", "暴落", "緊急", "破綻", "利上げ", "利下げ", "介入", "攻撃", "侵攻", "crash", "plunge", "surge", "emergency", "collapse", "default", "bankruptcy", "rate hike", "rate cut", "attack", "invasion", "strike"]


def number(c: Column, default: float = 0.0) -> Column:
    return F.coalesce(F.when(~F.isnan(c), c), F.lit(default))


def signals(title: Column, category: Column, themes: Column, trust: Column) -> Column:
    """struct(urgency, impact, structural, importance)."""
    first = F.coalesce(category, F.lit(""))
    names = F.coalesce(themes, F.array().cast("array<string>"))
    urgent = F.lower(F.coalesce(title, F.lit(""))).rlike("|".join(URGENT))
    urgency = F.when(urgent, 0.7).otherwise(0.2)
    impact = F.when(first.isin(*HIGH_IMPACT), 0.6).when(~first.isin("", "uncategorized"), 0.35).otherwise(0.1)
    impact = F.least(F.lit(1.0), impact + F.when(urgent, 0.2).otherwise(0.0))
    structural = F.when(first.isin(*STRUCTURAL), 1.0).when(F.arrays_overlap(names, F.array(*map(F.lit, STRUCTURAL))), 0.5).otherwise(0.0)
    breadth = F.least(F.lit(1.0), F.size(names) / 3.0)
    importance = F.round(F.least(F.lit(1.0), 0.35 * impact + 0.25 * structural + 0.2 * number(trust) + 0.1 * breadth + 0.1 * urgency), 4)
    return F.struct(urgency.alias("urgency"), F.round(impact, 4).alias("impact"), structural.alias("structural"), importance.alias("importance"))


def confirmation(n: Column, cap: int = 4) -> Column:
    return F.least(F.lit(1.0), n / F.lit(float(cap)))


def reaction(has: Column, magnitude: Column) -> Column:
    return F.when(has, F.greatest(F.lit(0.3), F.least(F.lit(1.0), magnitude))).otherwise(0.0)


def retrieval(parts: dict[str, Column], weights: dict[str, float] | None = None, digits: int = 2) -> Column:
    """The weighted sum of the parts, 0 to 100."""
    total = F.lit(0.0)
    for k, w in (weights or WEIGHTS).items():
        total = total + parts[k] * w
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), total)) * 100, digits)
