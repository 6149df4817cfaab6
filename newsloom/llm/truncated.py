"""Values cut off before the end of their text."""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import name_key
from ..operators.instants import with_source
from ..session import cut
from .ranking import VOID

# What feeds put where they stop, and what may follow a finished text.
MARK = re.compile(r"(?:…|\.\.\.|\. \. \.|\[\s*…\s*\]|\(\s*…\s*\)|\[more\]|\(more\)|…\s*more|\.\.\.\s*more|(?:Continue reading|Read more|More|続きを読む)\s*(?:→|»)?|(?:…|\.\.\.)\s*[^\s.!?。][^.!?。]{0,24}|→|&hellip;|&#8230;|&#x2026;)$", re.I)
BROKEN = re.compile("(?:&#?[A-Za-z0-9]{0,7}|<[^<>]{0,200}|�+)$")
TAIL = re.compile(r"(?:\s*(?:■|\[[^\[\]]{1,60}\]|\(\w[\w .]{1,30}\)|©\s?\w+|#\w+|https?://\S+|[—–-]\s+[^.!?。—–]{2,30}\bDesk))+$")
ENDED = re.compile(r"[.!?。！？]['\"”’»)\]」』]*$")
LEAST = 12
LIMIT = 400
RARELY = 0.05
SEEN = 20
_CJK = re.compile("[぀-ヿ㐀-鿿]")


def bare(text: str | None) -> str:
    return (text or "").strip()


def is_void(text: str) -> bool:
    return text.lower() in VOID or not any(c.isalnum() for c in text)


def shape(word: str) -> str:
    """A word for counting: numbers are one, names are one."""
    if any(c.isdigit() for c in word):
        return "0"
    return "Xx" if word[:1].isupper() else word


def ends(text: str, keys: Counter, final: Counter) -> None:
    """Counts the contexts of every place of a text, and of those where a sentence ends."""
    if _CJK.search(text):
        for i in range(1, len(text)):
            k = "\t" + text[i - 1 : i + 1]
            keys[k] += 1
            if text[i + 1 : i + 2] in ("。", "！", "？"):
                final[k] += 1
        return
    p = q = ""
    for w in text.split():
        x = w.rstrip(".!?,;:…")
        s = shape(x)
        stop = ENDED.search(w) is not None
        for k in (f"{q} {s}", f"{p} {q} {s}"):
            keys[k] += 1
            if stop:
                final[k] += 1
        p, q = q, s


def last_contexts(text: str) -> tuple[str, str]:
    """The wider and the narrower context in which a text stops."""
    if _CJK.search(text[-LEAST:]):
        return ("\t" + text[-2:],) * 2
    w = [shape(x.rstrip(".!?,;:…")) for x in text.split()[-3:]]
    w = [""] * (3 - len(w)) + w
    return f"{w[0]} {w[1]} {w[2]}", f"{w[1]} {w[2]}"


NO, MARKED, BEGINS, FILLED, OPEN, STOPPED = range(6)
REASONS = {MARKED: "mark", BEGINS: "own", FILLED: "limit"}


def verdict(text: str, title: str, limit: int) -> tuple[int, str]:
    """What the value itself tells, and what of it is looked for in longer copies elsewhere ('' for nothing)."""
    if not text or is_void(text):
        return NO, ""
    if MARK.search(text) or BROKEN.search(text):
        return MARKED, BROKEN.sub("", MARK.sub("", text)).rstrip()
    core = TAIL.sub("", text) or text
    if core == title:
        return NO, ""
    if ENDED.search(core):
        return STOPPED, text  # with its tail, else it would continue in itself
    if MARK.search(core):
        return MARKED, MARK.sub("", core).rstrip()
    if len(text) >= limit:
        return FILLED, core
    if len(core) >= LEAST and title.startswith(core):
        return BEGINS, core
    return OPEN, core


def judged(articles: DataFrame) -> DataFrame:
    """(article_seq, src, field, state, core, k3, k2, n, copy) of every value; copy: an excerpt that repeats its
    description, or a description that its excerpt repeats."""

    def run(batches):
        for b in batches:
            rows = []
            for seq, src, title, d, e in zip(*(b.column(i).to_pylist() for i in range(5))):
                t, d, e = bare(title), bare(d), bare(e)
                state, core = verdict(d, t, LIMIT)
                if d:
                    rows.append((seq, src, "description", state, core, len(d), e == d))
                if not e:
                    continue
                if e == d:
                    rows.append((seq, src, "public_excerpt", state, core, len(d), True))
                    continue
                stop = MARK.sub("", e).rstrip()
                if stop and not is_void(d) and d.startswith(stop):
                    rows.append((seq, src, "public_excerpt", BEGINS, stop, len(e), False))
                else:
                    rows.append((seq, src, "public_excerpt", *verdict(e, t, LIMIT), len(e), False))
            k = [last_contexts(r[4]) if r[3] == OPEN else (None, None) for r in rows]
            c = list(zip(*rows)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[0], pa.int64()), pa.array(c[1], pa.string()), pa.array(c[2], pa.string()), pa.array(c[3], pa.int32()), pa.array(c[4], pa.string()),
                 pa.array([x[0] for x in k], pa.string()), pa.array([x[1] for x in k], pa.string()), pa.array(c[5], pa.int32()), pa.array(c[6], pa.bool_())],
                ["article_seq", "src", "field_name", "state", "core", "k3", "k2", "n", "copy"],
            )

    rows = articles.select(F.col("article_seq").cast("bigint"), F.coalesce(name_key(F.col("source_name")), F.lit("")).alias("src"), "title_original", "description", "public_excerpt")
    return rows.mapInArrow(run, "article_seq long, src string, field_name string, state int, core string, k3 string, k2 string, n int, copy boolean")


def goes_on(longer: str, text: str) -> bool:
    """Whether `longer` begins with the text and has more than sentence marks after it."""
    return longer.startswith(text) and bool(longer[len(text) :].strip(".!?。 "))


def longer_elsewhere(values: DataFrame) -> DataFrame:
    """The texts (text) of `values` that are strict prefixes of another one, more than a sentence mark being missing.

    In sorted order a text's extensions follow it at once, so a task that streams a range keeps only the chain of
    prefixes that the current text has. The sort is by ranges of the text, so copies of one beginning spread over
    tasks; what a range leaves open meets the beginnings of the next ranges, a few texts of each.
    """
    spread = values.select("text").where(F.length("text") >= LEAST).distinct().repartitionByRange("text").sortWithinPartitions("text")

    def run(batches):
        part, chain, head, first = TaskContext.get().partitionId(), [], 0, None
        for b in batches:
            out = []
            for t in b.column(0).to_pylist():
                if head >= 0:  # the first text, those that differ from it by sentence marks only, and one more
                    out.append((part, head, "first", t))
                    stem = t.rstrip(".!?。 ")
                    first, head = (stem, 1) if head == 0 else (first, head + 1 if stem == first else -1)
                while chain and not t.startswith(chain[-1][0]):
                    chain.pop()
                for c in chain:
                    if not c[1] and goes_on(t, c[0]):
                        c[1] = True
                        out.append((part, 0, "hit", c[0]))
                chain.append([t, False])
            yield rows(out)
        yield rows([(part, i, "last", s) for i, (s, hit) in enumerate(chain) if not hit])

    def rows(out):
        c = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(c, (pa.int32(), pa.int32(), pa.string(), pa.string()))], ["part", "ord", "kind", "text"])

    def join(batches):
        waiting: list[str] = []
        for b in batches:
            hits = []
            for kind, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if kind == "last":
                    waiting.append(t)
                else:
                    hits += [s for s in waiting if goes_on(t, s)]
                    waiting = [s for s in waiting if t.startswith(s) and not goes_on(t, s)]
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.string())], ["text"])

    seen = cut(spread.mapInArrow(run, "part int, ord int, kind string, text string"), "prefixes")
    seams = seen.where("kind <> 'hit'").repartition(1).sortWithinPartitions("part", "kind", "ord").select("kind", "text")
    return seen.where("kind = 'hit'").select("text").unionByName(seams.mapInArrow(join, "text string")).distinct()


def context_counts(texts: DataFrame) -> DataFrame:
    """(k, total, final): how often each context occurs in the different texts, and ends a sentence."""

    def run(batches):
        keys, final = Counter(), Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(keys), pa.string()), pa.array(list(keys.values()), pa.int64()), pa.array([final[k] for k in keys], pa.int64())], ["k", "total", "final"])
            keys.clear(), final.clear()
            return out

        for b in batches:
            for t in b.column(0).to_pylist():
                ends(t, keys, final)
                if len(keys) > 200_000:
                    yield flush()
        yield flush()

    parts = texts.mapInArrow(run, "k string, total long, final long")
    return parts.groupBy("k").agg(F.sum("total").alias("total"), F.sum("final").alias("final"))


def cut_values(articles: DataFrame) -> DataFrame:
    """(article_seq, field_name, reason) of every value that isn't null or empty; reason null: it isn't cut.

    First every value, without a mark of the cut, is looked for among the beginnings of all values: a strict prefix of
    a longer copy elsewhere is cut, even at an end of sentence ("prefix"). Of those without a longer copy a value
    is cut that bears a mark of it or ends within an entity, tag or character ("mark"), is the beginning of its row's
    description or title ("own"), fills the field's limit without an end ("limit"), or stops, without an end of
    sentence, at a length at which its source's or all values pile up ("pile") or where sentences of the corpus go on
    ("context"). Short texts, fillers, repeated titles and texts that only lack a full stop are none. An excerpt
    that repeats its description is cut where, and why, that is.
    """
    rows = cut(judged(articles), "judged")
    follows = F.col("copy") & (F.col("field_name") == "public_excerpt")
    texts = articles.select(F.trim("description").alias("text")).where(F.length("text") > 0)
    values = texts.unionByName(articles.select(F.trim("public_excerpt").alias("text"))).unionByName(rows.select(F.col("core").alias("text")))
    longer = cut(longer_elsewhere(values).withColumn("longer", F.lit(True)), "longer").withColumnRenamed("text", "core")
    judge = rows.where(~follows).join(longer, "core", "left").withColumn("longer", F.coalesce("longer", F.lit(False)))

    open_ = rows.where(F.col("state") == OPEN)
    counts = cut(context_counts(texts.distinct()), "contexts")
    wide = counts.select(F.col("k").alias("k3"), F.col("total").alias("t3"), F.col("final").alias("f3"))
    narrow = counts.select(F.col("k").alias("k2"), F.col("total").alias("t2"), F.col("final").alias("f2"))
    every = open_.unionByName(open_.withColumn("src", F.lit(None).cast("string")))  # a source alone, and all
    piles = every.groupBy("src", "field_name", "n").agg(F.count_distinct("core").alias("here"))
    near = Window.partitionBy("src", "field_name").orderBy("n").rangeBetween(-6, 6)
    piles = piles.withColumn("around", F.sum("here").over(near) - F.col("here")).where((F.col("here") >= 5) & (F.col("here") > F.col("around")))
    own = piles.where("src is not null").select("src", "field_name", "n", F.lit(True).alias("own_pile"))
    all_ = piles.where("src is null").select("field_name", "n", F.lit(True).alias("pile"))

    kept = ["article_seq", "field_name", "copy"]
    settled = F.col("longer") | (F.col("state") != OPEN)
    told = F.when(F.col("longer"), "prefix")
    for state, name in REASONS.items():
        told = told.when(F.col("state") == state, name)
    out = judge.where(settled).select(*kept, told.alias("reason"))
    x = judge.where(~settled).join(wide, "k3", "left").join(narrow, "k2", "left")
    x = x.join(own, ["src", "field_name", "n"], "left").join(all_, ["field_name", "n"], "left")
    known3, known2 = F.coalesce("t3", F.lit(0)), F.coalesce("t2", F.lit(0))
    rate = F.when(known3 >= SEEN, F.col("f3") / F.col("t3")).when(known2 > 0, F.coalesce("f2", F.lit(0)) / F.col("t2")).otherwise(0.0)
    guess = F.when(F.length("core") < LEAST, None).when(F.coalesce("own_pile", "pile"), "pile").when(rate < RARELY, "context")
    out = out.unionByName(x.select(*kept, guess.alias("reason")))
    fields = F.when(F.col("copy"), F.array(F.lit("description"), F.lit("public_excerpt"))).otherwise(F.array("field_name"))
    return out.select("article_seq", F.explode(fields).alias("field_name"), "reason")


def p6_found(articles: DataFrame) -> DataFrame:
    return cut_values(articles).where("reason is not null").select("article_seq", "field_name")


def p6_reasons(articles: DataFrame) -> DataFrame:
    """(field_name, reason, n): by what the cut values were found."""
    return cut_values(articles).where("reason is not null").groupBy("field_name", "reason").agg(F.count("*").alias("n"))


def source_rates(articles: DataFrame, sources: DataFrame) -> DataFrame:
    """(source_id, field_name, n, n_cut, share): how often the values of each source of the catalogue are cut; rows
    whose source the catalogue doesn't have count under ''."""
    src = with_source(articles.select("article_seq", "source_domain", "source_name"), sources).select(F.col("article_seq").cast("bigint").alias("article_seq"), F.coalesce("src", F.lit("")).alias("source_id"))
    g = cut_values(articles).join(src, "article_seq").groupBy("source_id", "field_name").agg(F.count("*").alias("n"), F.count("reason").alias("n_cut"))
    return g.withColumn("share", F.round(F.col("n_cut") / F.col("n"), 6))
