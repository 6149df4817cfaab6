"""Private texts: intake, rule-based analysis, forecasts, what may be shown of them, and where they are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify
from ..functions.text import WORD_GAP, blank, body_hash
from ..session import cut

MAX_BODY = 30_000
# Caps of confidence by kind of evidence, hints of urgency, the playbook (indicators, what invalidates, sectors
# with and against the wind) and the scenarios (type, title, probability, confidence, horizon).
CAPS = {"article_based_hypothesis": 0.60, "market_confirmed": 0.85, "historically_supported": 0.75, "speculative": 0.40}
HYPOTHESIS = "article_based_hypothesis"
URGENT_HINTS = ["急落", "急騰", "緊急", "破綻", "制裁", "利上げ", "利下げ", "急拡大", "急増"]
PLAYBOOK = {
    "electric_power": (["電力会社の設備投資計画", "変圧器受注", "電線価格", "データセンター建設計画"], ["データセンター投資計画の縮小・延期の公表", "電力設備投資額の前年割れ"], ["電力・インフラ", "電機・電線・素材"], []),
    "semiconductor": (["SOX指数", "半導体製造装置受注", "主要ファウンドリの設備投資計画"], ["主要メーカーの設備投資下方修正", "在庫調整の長期化"], ["半導体・電子部品"], []),
    "ai": (["大手クラウドの設備投資額", "AI関連受注・決算コメント", "SOX指数"], ["AI投資計画の縮小公表", "AI関連収益化の失望決算の連続"], ["情報通信・生成AI", "半導体・電子部品"], []),
    "monetary_policy": (["政策金利", "中央銀行の声明文・議事要旨", "国債利回り"], ["想定と逆方向の政策決定", "金利の逆方向への持続的な動き"], ["金融"], ["情報通信・生成AI"]),
    "oil": (["WTI原油価格", "OPEC減産・増産決定", "原油在庫統計"], ["原油価格の持続的な逆方向トレンド"], ["資源・エネルギー"], ["自動車"]),
    "defense": (["防衛予算の審議・成立", "防衛関連の受注公表"], ["防衛予算の削減・計画撤回"], ["重工業・防衛"], []),
    "fx": (["ドル円レート", "日米金利差", "為替介入の有無"], ["為替の持続的な逆方向トレンド"], ["自動車"], []),
}
DEFAULT_PLAY = (["関連企業の決算・設備投資計画", "関連する政策・規制の動向", "関連市場指数"], ["記事が示唆する動きと逆方向の公式発表・統計"], [], [])
INDICATORS, INVALIDATION, WITH_WIND, AGAINST_WIND = range(4)
SCENARIOS = [
    ("base", "%s関連の動きが緩やかに継続", "40-60%", 0.55, "1m"), ("upside", "%s関連の投資・需要が加速", "15-30%", 0.35, "3m"),
    ("downside", "%s関連の期待が剥落・調整", "15-30%", 0.35, "3m"), ("tail_risk", "%sを取り巻く前提が急変（規制・地政学等）", "1-10%", 0.15, "1y"),
]
MARKETS = ["日本株", "関連コモディティ/為替"]
UNTITLED = "無題のprivate記事（%s保存）"
PENDING = ["stored", "queued", "needs_review", "failed"]
REVIEW_DAYS = 30


def _strings(xs: list[str]) -> Column:
    return F.array(*map(F.lit, xs)) if xs else F.array().cast("array<string>")


def intake(rows: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with a reason): empty and overlong bodies are refused; a body's hash takes no white space."""
    reason = F.when(blank(F.col(body)), "empty").when(F.length(body) > MAX_BODY, "too_long")
    x = rows.withColumn("reason", reason)
    return x.where("reason is null").drop("reason").withColumn("body_hash", body_hash(F.col(body))), x.where("reason is not null")


def merged(accepted: DataFrame, key: str = "private_id", note: str = "user_note", at: str = "submitted_at") -> DataFrame:
    """One record per body: first and last submission, how many, and the different notes in order of time."""
    each = accepted.groupBy("body_hash", F.when(~blank(F.col(note)), F.col(note)).alias("note")).agg(F.min(key).alias(key), F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("n"))
    notes = F.array_sort(F.collect_list(F.when(F.col("note").isNotNull(), F.struct(F.coalesce("first", F.lit("0001-01-01").cast("timestamp")).alias("at"), "note"))))
    return each.groupBy("body_hash").agg(F.min(key).alias(key), F.min("first").alias("first_at"), F.max("last").alias("last_at"), F.sum("n").alias("submissions"), F.array_join(F.transform(notes, lambda x: x["note"]), "\n").alias("notes"))


def records(accepted: DataFrame, at: str = "submitted_at") -> DataFrame:
    """One metadata record per body of intake's accepted rows (title, body, body_hash and `at`), never with the body:
    a text without a title gets a neutral one, so nothing of a body gets into it."""
    first = F.min_by(F.struct(F.coalesce("title", F.lit("")).alias("title"), F.length(F.regexp_replace("body", f"^{WORD_GAP}|{WORD_GAP}$", "")).alias("n")), at)
    x = accepted.groupBy("body_hash").agg(first.alias("f"), F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count("*").alias("submissions"))
    jst = F.date_format(F.col("first_at") + F.expr("interval 9 hours"), "MM/dd HH:mm")
    return x.select(
        F.concat(F.lit("pai_"), F.substring("body_hash", 1, 20)).alias("private_article_id"), "body_hash", F.when(F.col("f.title") != "", F.col("f.title")).otherwise(F.format_string(UNTITLED, jst)).alias("title"),
        F.col("f.n").alias("character_count"), F.lit("private").alias("visibility"), F.lit("user_private_paid_article").alias("rights_classification"), "first_at", "last_at", "submissions", F.lit("stored").alias("status"), F.lit("").alias("delete_type"),
    )


def capped(confidence: Column, evidence: Column, caps: dict[str, float] | None = None) -> Column:
    """At most the cap of its evidence (of a hypothesis for an unknown kind); what is no number is 0."""
    every = CAPS | (caps or {})
    table = F.create_map(*(F.lit(x) for kv in every.items() for x in kv))
    limit = F.coalesce(F.try_element_at(table, evidence), F.lit(every[HYPOTHESIS]))
    return F.round(F.least(F.coalesce(confidence.try_cast("double"), F.lit(0.0)), limit), 2)


def play(theme: Column, part: int) -> Column:
    """A part of the theme's entry in the playbook."""
    out = _strings(DEFAULT_PLAY[part])
    for k, v in PLAYBOOK.items():
        out = F.when(theme == k, _strings(v[part])).otherwise(out)
    return out


def forecasts(rows: DataFrame, key: str, theme: Column, now: Column, caps: dict[str, float] | None = None) -> DataFrame:
    """Four scenarios of each row, with all their fields. A forecast of one text alone is a hypothesis, capped as such;
    its id follows from the row and the scenario."""
    each = F.explode(F.array(*(F.struct(*(F.lit(v).alias(n) for v, n in zip(s, ("type", "title", "probability", "base", "horizon")))) for s in SCENARIOS)))
    x = rows.select(F.col(key).alias("key"), theme.alias("theme"), now.alias("now"), each.alias("s")).withColumn("label", F.when(F.coalesce("theme", F.lit("")) != "", F.col("theme")).otherwise("記事テーマ"))
    x = x.withColumn("title", F.replace(F.col("s.title"), F.lit("%s"), F.col("label"))).withColumn("indicators", play(F.col("theme"), INDICATORS))
    return x.select(
        F.concat(F.lit("fc_"), F.substring(F.sha2(F.concat_ws("|", F.col("key").cast("string"), "s.type"), 256), 1, 12)).alias("forecast_id"), F.col("key").alias(key), F.date_format("now", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("created_at"),
        F.col("s.horizon").alias("horizon"), F.col("s.type").alias("scenario_type"), F.col("title").alias("scenario_title"), F.col("s.probability").alias("probability_range"), F.concat("title", F.lit("する可能性（記事ベースの仮説であり断定ではない）")).alias("prediction"),
        F.array(F.concat("label", F.lit("関連の発表・受注・投資計画の増減"))).alias("expected_developments"), _strings(MARKETS).alias("affected_markets"), F.concat(play(F.col("theme"), WITH_WIND), play(F.col("theme"), AGAINST_WIND)).alias("affected_sectors"),
        F.col("indicators").alias("leading_indicators"), F.transform(F.slice("indicators", 1, 2), lambda i: F.concat(i, F.lit("の記事方向への変化"))).alias("confirmation_triggers"), play(F.col("theme"), INVALIDATION).alias("invalidation_triggers"),
        F.date_format(F.date_add(F.to_date("now"), REVIEW_DAYS), "yyyy-MM-dd").alias("next_review_date"), capped(F.col("s.base"), F.lit(HYPOTHESIS), caps).alias("confidence"), F.lit(HYPOTHESIS).alias("evidence_level"), F.lit("pending").alias("validation_status"),
    )


def analysis(rows: DataFrame, key: str, title: str = "title", body: str = "body", keywords: dict | None = None) -> DataFrame:
    """The rule-based analysis of each text: its theme by the dictionaries over title (or the body's first 80 characters)
    and the body's first 2,000, and what follows from that mechanically. Nothing of a body comes out."""
    name, text = F.coalesce(F.col(title), F.lit("")), F.coalesce(F.col(body), F.lit(""))
    x = rows.select(F.col(key), name.alias("_title"), F.length(text).alias("_n"), F.when(name != "", name).otherwise(F.substring(text, 1, 80)).alias("title_original"), F.substring(text, 1, 2000).alias("description"), F.concat(name, F.substring(text, 1, 500)).rlike("|".join(URGENT_HINTS)).alias("urgent"))
    x = classify.with_text(x).withColumn("c", classify.classified(classify.category_hits(keywords)))
    x = x.withColumn("theme", F.when(F.col("c.primary") != "uncategorized", F.col("c.primary")).otherwise("")).withColumn("label", F.when(F.col("theme") != "", F.col("theme")).otherwise("特定テーマなし"))
    summary = F.concat(F.lit("「"), "_title", F.lit("」に関するprivate保存記事。主テーマは"), "label", F.lit("。本文"), F.col("_n").cast("string"), F.lit("字。"), F.when(F.col("urgent"), "緊急性の高い語を含む。").otherwise(""))
    return x.select(
        key, "theme", "label", F.lit("v1").alias("analysis_version"), F.lit("rule_based").alias("model_provider"), F.substring(summary, 1, 200).alias("summary_200"), F.col("c.primary").alias("primary_category"), F.col("c.secondary").alias("secondary_categories"), F.col("c.themes").alias("themes"), "urgent",
        play(F.col("theme"), WITH_WIND).alias("beneficiary_sectors"), play(F.col("theme"), AGAINST_WIND).alias("headwind_sectors"), F.array(F.col("label"), F.lit("関連業種の受注・投資"), F.lit("関連銘柄の業績期待")).alias("causal_chain"),
        F.concat("label", F.lit("関連の投資・受注動向に波及する可能性")).alias("mid_term_impact"), F.concat(F.lit("主テーマ"), "label", F.lit("は保存時点でユーザーが注目した領域であり、テーマ蓄積の材料になる")).alias("why_important"), F.concat(F.lit("「"), "label", F.lit("」関連の顧客会話の切り口として利用可能")).alias("sales_hint"),
    )


def derived_summary(analyses: DataFrame, key: str, now: Column) -> DataFrame:
    """What may be shown of a private text: of its analysis the summary, themes and sectors, of its forecasts up to four
    in brief with up to four indicators, never its body, note or storage. One row per row of analyses."""
    brief = lambda s: F.struct(F.lit(s[0]).alias("scenario_type"), F.replace(F.lit(s[1]), F.lit("%s"), F.when(F.col("theme") != "", F.col("theme")).otherwise("記事テーマ")).alias("scenario_title"), F.lit(s[4]).alias("horizon"), capped(F.lit(s[3]), F.lit(HYPOTHESIS)).alias("confidence"), F.slice(play(F.col("theme"), INDICATORS), 1, 4).alias("leading_indicators"), F.lit("pending").alias("validation_status"))
    review = F.date_format(F.date_add(F.to_date(now), REVIEW_DAYS), "yyyy-MM-dd")
    return analyses.select(
        key, F.col("summary_200").alias("short_summary"), "themes", F.col("beneficiary_sectors").alias("industries"), F.col("beneficiary_sectors").alias("sectors"), F.slice(_strings(MARKETS), 1, 5).alias("related_assets"), F.lit(0.5).alias("importance_score"), F.lit(0.5).alias("structural_score"),
        F.col("why_important").alias("impression_hint"), F.array(*map(brief, SCENARIOS[:4])).alias("forecast_summary"), capped(F.lit(SCENARIOS[0][3]), F.lit(HYPOTHESIS)).alias("confidence"), review.alias("next_review_date"),
    )


def public_records(records: DataFrame) -> DataFrame:
    """Records without body or note, deleted ones left out; rows have no order, so callers sort by submission."""
    gone = F.coalesce("delete_type", F.lit("")) != ""
    return records.where(~gone).drop("body", "user_note")


def private_articles(rows: DataFrame) -> DataFrame:
    """rows (canonical_url, title, body, source_name) as private articles, their id by address, else by title."""
    named = F.when(F.coalesce("canonical_url", F.lit("")) != "", F.col("canonical_url")).otherwise(F.coalesce("title", F.lit("")))
    return rows.select(F.concat(F.lit("art_"), F.substring(F.sha2(named, 256), 1, 24)).alias("article_id"), "canonical_url", F.col("title").alias("title_original"), F.col("body").alias("full_body"), "source_name", F.lit("private").alias("rights_classification"))


def article_public_view(articles: DataFrame) -> DataFrame:
    """Private articles as the store shows them: no body and no excerpt of it."""
    return articles.select("article_id", "canonical_url", "title_original", "source_name", F.lit("private").alias("body_storage_type"), F.lit(False).alias("body_available"), "rights_classification", F.lit("").alias("public_excerpt"))


def deleted(records: DataFrame, ids: list[str], permanent: bool = False) -> DataFrame:
    """Soft: hidden, the body stays. Permanent: body, note and analysis go, a tombstone stays."""
    hit = F.col("private_id").isin(*ids)
    out = records.withColumn("delete_type", F.when(hit, "permanent" if permanent else "soft").otherwise(F.col("delete_type")))
    if permanent:
        for c in {"body", "user_note", "analysis"} & set(records.columns):
            out = out.withColumn(c, F.when(~hit, F.col(c)))
    return out


class PrivateStore:
    """Metadata, bodies and analyses in three tables under one folder, which no public query reads.

    Tables are replaced whole: a new version is written, then named by a pointer file, so a reader finds one or the
    other. A body is in `bodies` alone."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), self.spark._jvm.org.apache.hadoop.fs.Path

    def _versions(self, name: str) -> list[str]:
        fs, path = self._fs()
        at = path(f"{self.folder}/{name}")
        return sorted(s.getPath().getName() for s in fs.listStatus(at) if fs.exists(path(f"{self.folder}/{name}/{s.getPath().getName()}/_SUCCESS"))) if fs.exists(at) else []

    def read(self, name: str) -> DataFrame | None:
        """A table's last whole version; None where there is none yet."""
        v = self._versions(name)
        return self.spark.read.parquet(f"{self.folder}/{name}/{v[-1]}") if v else None

    def _replace(self, name: str, df: DataFrame) -> None:
        v = self._versions(name)
        df.write.parquet(f"{self.folder}/{name}/v{int(v[-1][1:]) + 1 if v else 0:09d}")
        fs, path = self._fs()
        for old in v:
            fs.delete(path(f"{self.folder}/{name}/{old}"), True)

    def submit(self, rows: DataFrame) -> DataFrame:
        """Takes in rows (title, body, submitted_at); a body that is here already counts as submitted again, one deleted
        for good comes back as new. Returns the rejected rows with a reason."""
        good, bad = intake(rows)
        good = cut(good, "intake")
        new, old, bodies = records(good), self.read("records"), self.read("bodies")
        texts = good.groupBy("body_hash").agg(F.min("body").alias("body"))
        if old is not None:
            live = old.where("delete_type <> 'permanent'").join(new.select("body_hash", F.col("last_at").alias("_l"), F.col("submissions").alias("_n")), "body_hash", "left")
            again = live.withColumn("last_at", F.greatest("last_at", "_l")).withColumn("submissions", F.col("submissions") + F.coalesce("_n", F.lit(0))).drop("_l", "_n")
            gone = old.where("delete_type = 'permanent'").join(new.select("body_hash"), "body_hash", "left_anti")
            new = again.unionByName(gone).unionByName(new.join(live.select("body_hash"), "body_hash", "left_anti"))
            texts = bodies.unionByName(texts.join(bodies.select("body_hash"), "body_hash", "left_anti"))
        self._replace("bodies", texts)
        self._replace("records", new)
        return bad

    def listed(self, include_deleted: bool = False) -> DataFrame:
        r = self.read("records")
        return (r if include_deleted else r.where("delete_type = ''")).orderBy(F.col("first_at").desc(), "private_article_id")

    def pending(self, limit: int) -> DataFrame:
        """Texts without an analysis, with their bodies, the oldest first."""
        x = self.read("records").where(F.col("status").isin(*PENDING) & (F.col("delete_type") == "")).orderBy("first_at", "private_article_id").limit(limit)
        return x.join(self.read("bodies"), "body_hash")

    def analyze(self, limit: int = 20) -> int:
        """Analyses up to `limit` pending texts by rule and stores the results; how many."""
        made = cut(analysis(self.pending(limit), "private_article_id"), "analyses")
        had = self.read("analyses")
        self._replace("analyses", made if had is None else had.join(made.select("private_article_id"), "private_article_id", "left_anti").unionByName(made))
        done = made.select("private_article_id", F.lit(True).alias("_done"))
        r = self.read("records").join(done, "private_article_id", "left")
        self._replace("records", r.withColumn("status", F.when(F.col("_done"), "completed").otherwise(F.col("status"))).drop("_done"))
        return made.count()

    def delete(self, ids: list[str], permanent: bool = False) -> None:
        """Soft: hidden from lists. Permanent: body and analysis go, a tombstone stays."""
        r = self.read("records")
        hit = F.col("private_article_id").isin(*ids)
        if permanent:
            gone = r.where(hit)
            for name, key in (("bodies", "body_hash"), ("analyses", "private_article_id")):
                if (t := self.read(name)) is not None:
                    self._replace(name, t.join(gone.select(key), key, "left_anti"))
        self._replace("records", r.withColumn("delete_type", F.when(hit, "permanent" if permanent else "soft").otherwise(F.col("delete_type"))))

    def health(self) -> dict:
        """Whether there is a store and how many records it has; no body is read."""
        r = self.read("records")
        return {"present": r is not None, "count": 0 if r is None else r.count(), "health": "not_present" if r is None else "ok"}


Call = Callable[[str, str, dict | None], dict | None]


def from_queue(items: DataFrame, analyze) -> DataFrame:
    """items (private_id, body) to (private_id, status, summary): analyze(body) runs row by row, and one that fails
    is failed_analysis and stops no other."""

    def run(batches):
        for p in batches:
            status, text = [], []
            for b in p["body"]:
                try:
                    text.append(str(analyze(b)))
                    status.append("completed")
                except Exception as x:
                    text.append(f"{type(x).__name__}")
                    status.append("failed_analysis")
            yield p[["private_id"]].assign(status=status, summary=text)

    return items.select("private_id", "body").mapInPandas(run, "private_id string, status string, summary string")


def sync_queue(spark: SparkSession, api: str, call: Call, now: Column, max_items: int = 20) -> dict:
    """Reads up to max_items texts from a queue, analyses them by rule and posts each result; bodies go nowhere else.

    call(method, url, payload) is injected. An item without a body, or whose post fails, counts as failed, is reported
    as failed_analysis where that can be posted, and stops no other."""
    items = ((call("GET", f"{api}/queue?limit={max_items}", None) or {}).get("items") or [])[:max_items]
    whole = [i for i in items if i.get("private_article_id") and i.get("body")]
    made: dict[str, tuple[dict, dict]] = {}
    if whole:
        rows = spark.createDataFrame([(i["private_article_id"], i.get("title") or "", i["body"]) for i in whole], "private_article_id string, title string, body string")
        a = analysis(rows, "private_article_id")
        shown = {r["private_article_id"]: r.asDict(True) for r in derived_summary(a, "private_article_id", now).collect()}  # max_items at most
        made = {r["private_article_id"]: (r.asDict(True), shown[r["private_article_id"]]) for r in a.collect()}
    done = 0
    for i in whole:
        url = f"{api}/analysis/{i['private_article_id']}"
        try:
            full, brief = made[i["private_article_id"]]
            call("POST", url, {"analysis": full, "derived": brief, "status": "completed"})
            done += 1
        except Exception:
            try:
                call("POST", url, {"status": "failed_analysis"})
            except Exception:  # the queue will offer it again
                pass
    return {"fetched": len(items), "analyzed": done, "failed": len(items) - done}
