"""Address expressions on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tracking parameters that never name another resource.
TRACKING = ["fbclid", "gclid", "gclsrc", "dclid", "msclkid", "yclid", "igshid", "mc_cid", "mc_eid", "ref", "ref_src", "ref_url", "spm", "cmpid", "ito", "src", "from", "amp"]
TRACKING_PREFIX = "utm_"

_PARTS = "^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\\?([^#]*))?"


def _part(url: Column, n: int) -> Column:
    return F.regexp_extract(F.trim(url), _PARTS, n)


def is_tracking(key: Column) -> Column:
    low = F.lower(key)
    return low.isin(*TRACKING) | low.startswith(TRACKING_PREFIX)


def host_of(url: Column) -> Column:
    """Lower-cased host without a leading www., '' where there is none."""
    return F.coalesce(F.regexp_replace(F.lower(_part(url, 2)), "^www\\.", ""), F.lit(""))


def _decoded(s: Column) -> Column:
    return F.coalesce(F.try_url_decode(s), s)


def _pairs(url: Column) -> Column:
    raw = F.filter(F.split(_part(url, 4), "&"), lambda p: p != "")
    pairs = F.transform(
        raw,
        lambda p, i: F.struct(
            _decoded(F.substring_index(p, "=", 1)).alias("k"),
            i.alias("i"),
            F.when(p.contains("="), _decoded(F.regexp_replace(p, "^[^=]*=", ""))).otherwise(F.lit("")).alias("v"),
        ),
    )
    return F.filter(pairs, lambda p: ~is_tracking(p["k"]))


def _encoded(pairs: Column) -> Column:
    return F.array_join(F.transform(pairs, lambda p: F.concat(F.url_encode(p["k"]), F.lit("="), F.url_encode(p["v"]))), "&")


def normalize_url(url: Column) -> Column:
    """The address in its normal form: https, lower-case host without www., no trailing slash, tracking parameters
    or fragment, the other parameters in stable order of their names. Empty and null give ''."""
    scheme = F.lower(_part(url, 1))
    scheme = F.when(scheme.isin("", "http", "https"), "https").otherwise(scheme)
    query = _encoded(F.array_sort(_pairs(url)))
    host = host_of(url)
    out = F.concat(
        scheme, F.lit(":"), F.when(host != "", F.concat(F.lit("//"), host)).otherwise(F.lit("")),
        F.regexp_replace(_part(url, 3), "/+$", ""), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
    )
    return F.when(F.coalesce(F.trim(url), F.lit("")) == "", F.lit("")).otherwise(out)


def address_key(url: Column) -> Column:
    """What two spellings of one address share, whatever their scheme and order of parameters; null for an empty one."""
    query = F.array_join(F.array_sort(F.transform(_pairs(url), lambda p: F.concat(p["k"], F.lit("="), p["v"]))), "&")
    key = F.concat(host_of(url), F.lit("|"), F.regexp_replace(_part(url, 3), "/+$", ""), F.lit("?"), query)
    return F.when(F.coalesce(F.trim(url), F.lit("")) != "", key)
