"""Time expressions on the JVM side, and a reader of feeds' dates; every `now` is a parameter."""

from __future__ import annotations

import math
import re
from datetime import datetime, timezone
from email.utils import parsedate_to_datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = re.compile(r"\d{4}(-\d{2}-\d{2}|\d{4})([T ]|$)")


def parse_iso(c: Column) -> Column:
    """ISO 8601 text as a timestamp, UTC where it names no offset; null where it is none."""
    x = F.trim(c)
    full = x.rlike("^\\d{4}-\\d{2}-\\d{2}[T ]\\d{2}:\\d{2}")
    zoned = F.when(x.rlike("([Zz]|[+-]\\d{2}:?\\d{2})$"), x).otherwise(F.concat(x, F.lit("+00:00")))
    return F.when(full, zoned.try_cast("timestamp"))


def epoch(ts: Column) -> Column:
    return F.unix_seconds(ts)


def jst_date(ts: Column) -> Column:
    return F.date_format(ts + F.expr("interval 9 hours"), "yyyy-MM-dd")


def jst_to_utc(c: Column) -> Column:
    """Japanese wall time with - or / as ISO text in UTC, '' where it is none."""
    x = F.regexp_replace(F.trim(c), "/", "-")
    t = F.coalesce(*(F.try_to_timestamp(x, F.lit(p)) for p in ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd")))
    return F.coalesce(F.date_format(t - F.expr("interval 9 hours"), "yyyy-MM-dd'T'HH:mm:ss'+00:00'"), F.lit(""))


def parse_feed_date(c: Column) -> Column:
    """ISO, else RFC 822, as a timestamp; null where it is neither."""
    x = F.regexp_replace(F.trim(c), "^[A-Za-z]{3,9},?\\s+", "")
    x = F.regexp_replace(x, "\\s(GMT|UTC|Z)$", " +0000")
    return F.coalesce(parse_iso(c), F.try_to_timestamp(x, F.lit("d MMM yyyy HH:mm:ss xx")), F.try_to_timestamp(x, F.lit("d MMM yyyy HH:mm xx")))


def read_feed_date(value: str | None) -> int | None:
    """ISO, else RFC 822 with whatever feeds make of it, in seconds, UTC where it names no zone; None where it is neither."""
    x = (value or "").strip()
    try:
        t = datetime.fromisoformat(x.replace("Z", "+00:00").replace("z", "+00:00")) if ISO.match(x) else parsedate_to_datetime(x)
        return math.floor((t if t.tzinfo else t.replace(tzinfo=timezone.utc)).timestamp())
    except (TypeError, ValueError, IndexError, OverflowError):
        return None


def sanitize_published(parsed: Column, raw: Column, fetched: Column, now: Column, max_future_hours: int = 24, max_age_years: int = 20) -> Column:
    """struct(published, inferred, raw, anomaly): a missing, unreadable, future or too old time gives way to the fetch."""
    t = parse_iso(parsed)
    empty = F.coalesce(F.trim(parsed), F.lit("")) == ""
    anomaly = (
        F.when(empty & (F.coalesce(F.trim(raw), F.lit("")) == ""), "missing").when(t.isNull(), "unparsable")
        .when(t > now + F.expr(f"interval {max_future_hours} hours"), "future").when(t < now - F.expr(f"interval {365 * max_age_years} days"), "too_old").otherwise("")
    )
    return F.struct(F.when(anomaly == "", parsed).otherwise(fetched).alias("published"), (anomaly != "").alias("inferred"), F.when(anomaly == "", F.lit("")).otherwise(F.coalesce(raw, F.lit(""))).alias("raw"), anomaly.alias("anomaly"))


def freshness(published: Column, now: Column, half_life: float = 24.0) -> Column:
    """1 for what isn't past, halved each half-life, 0 without a time."""
    hours = (F.unix_micros(now) - F.unix_micros(published)) / 3.6e9
    return F.when(published.isNull(), 0.0).when(hours <= 0, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.pow(F.lit(0.5), hours / half_life))))


def should_retry(next_retry: Column, now: Column) -> Column:
    t = parse_iso(next_retry)
    return F.when(t.isNull(), True).otherwise(now >= t)


def fetch_from(latest: Column, overlap_hours: int = 48) -> Column:
    return parse_iso(latest) - F.expr(f"interval {overlap_hours} hours")
