"""Text expressions on the JVM side."""

from __future__ import annotations

import html
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))
ASCII = "".join(map(chr, range(0x21, 0x7F)))
DASHES = "‐‑‒–—―−﹘﹣"
INVISIBLE = "[\\u00AD\\u200B-\\u200F\\u2060\\uFEFF]"


def name_key(name: Column) -> Column:
    """A name regardless of letter case, white space, width of characters and kind of dash; null for a blank one."""
    x = F.translate(name, WIDE + DASHES, ASCII + "-" * len(DASHES))
    x = F.lower(F.regexp_replace(x, "(?U)[\\s\\p{Z}]+|" + INVISIBLE, ""))
    return F.when(F.length(x) > 0, x)


def blank(c: Column) -> Column:
    """Null or nothing but white space."""
    return F.coalesce(~c.rlike("(?U)[^\\s\\p{Z}]"), F.lit(True))


def joined_text(title: Column, description: Column) -> Column:
    """Title, a blank and description, null as empty, lower-cased, each run of white space one blank, ends trimmed."""
    both = F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(description, F.lit("")))
    return F.trim(F.regexp_replace(F.lower(both), "(?U)\\s+", " "))


def instant(text: Column) -> Column:
    """ISO 8601 text with an offset as a timestamp; null where it names none."""
    return F.trim(text).try_cast("timestamp")


WORD_GAP = "(?U)[\\s\\x1C-\\x1F]+"  # every Unicode blank


def normalize_text(c: Column) -> Column:
    """Lower case, runs of white space one blank, everything but letters, digits, underscores and blanks removed."""
    x = F.lower(F.coalesce(c, F.lit("")))
    x = F.regexp_replace(x, WORD_GAP, " ")
    return F.trim(F.regexp_replace(x, "[^\\p{L}\\p{N}_ ]", ""))


def canonical_hash(url: Column) -> Column:
    return F.sha2(F.coalesce(url, F.lit("")), 256)


def title_hash(title: Column) -> Column:
    return F.sha2(normalize_text(title), 256)


def content_hash(title: Column, description: Column) -> Column:
    return F.sha2(F.concat(normalize_text(title), F.lit("|"), normalize_text(description)), 256)


def article_id(url: Column) -> Column:
    return F.concat(F.lit("art_"), F.substring(canonical_hash(url), 1, 24))


def cluster_id(article: Column) -> Column:
    """evc_ and the letters and digits among the last 12 characters."""
    return F.concat(F.lit("evc_"), F.regexp_replace(F.right(article, F.lit(12)), "[^a-z0-9]", ""))


def body_hash(body: Column) -> Column:
    """White space doesn't count."""
    return F.sha2(F.regexp_replace(F.coalesce(body, F.lit("")), WORD_GAP, ""), 256)


TAG = re.compile("<[^>]+>")


def plain(text: str | None) -> str:
    """Text without tags: all entities resolved, tags a blank, entities resolved again, runs of white space one blank."""
    return " ".join(html.unescape(TAG.sub(" ", html.unescape(text or ""))).split())


def strip_html(c: Column) -> Column:
    """plain, in Arrow batches: there are over two thousand entities, some without a semicolon."""
    return F.pandas_udf(lambda x: x.map(plain, na_action=None), "string")(c)


# Particles that say nothing about a headline.
STOPWORDS = ["の", "を", "に", "は", "が", "と", "で", "た", "し", "て", "も", "な", "する", "した"]


def title_tokens(title: Column) -> Column:
    """ASCII words of two characters or more, lower-cased, and the pairs of neighbours of each CJK run; sorted, distinct."""
    words = F.transform(F.regexp_extract_all(F.coalesce(title, F.lit("")), F.lit("[A-Za-z0-9]+"), 0), F.lower)
    runs = F.filter(F.regexp_extract_all(F.coalesce(title, F.lit("")), F.lit("[一-龯ぁ-んァ-ヶ]+"), 0), lambda r: F.length(r) > 1)
    pairs = F.flatten(F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: r.substr(i, F.lit(2)))))
    every = F.concat(F.filter(words, lambda w: F.length(w) > 1), pairs)
    return F.array_sort(F.array_distinct(F.filter(every, lambda t: ~t.isin(*STOPWORDS))))
