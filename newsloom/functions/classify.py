"""Dictionaries and their matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The default dictionary of categories.
CATEGORY_KEYWORDS = {
    "geopolitics": ["地政学", "紛争", "軍事", "衝突", "geopolitical", "geopolitics"],
    "diplomacy_war": ["戦争", "外交", "停戦", "侵攻", "diplomacy", "ceasefire", "invasion", "warfare"],
    "us_china": ["米中", "中国", "台湾海峡", "US-China", "Sino-US", "China"],
    "us_iran_middle_east": ["イラン", "中東", "ホルムズ海峡", "イスラエル", "Iran", "Middle East", "Strait of Hormuz", "Israel"],
    "taiwan": ["台湾", "Taiwan"],
    "ukraine": ["ウクライナ", "Ukraine"],
    "north_korea": ["北朝鮮", "North Korea"],
    "sanctions": ["制裁", "sanctions"],
    "tariffs": ["関税", "tariff", "tariffs"],
    "elections": ["選挙", "大統領選", "election", "presidential election"],
    "monetary_policy": ["金融政策", "FOMC", "FRB", "日銀", "利上げ", "利下げ", "central bank", "rate hike", "rate cut", "interest rate decision"],
    "fiscal_policy": ["財政政策", "予算案", "歳出", "fiscal policy", "budget deficit", "government spending"],
    "rates": ["金利", "国債利回り", "interest rate", "bond yield", "Treasury yield"],
    "fx": ["為替", "ドル円", "円安", "円高", "exchange rate", "currency", "yen", "dollar"],
    "inflation": ["インフレ", "物価", "CPI", "inflation", "consumer prices"],
    "employment": ["雇用統計", "失業率", "jobs report", "unemployment", "payrolls"],
    "gdp": ["GDP", "国内総生産", "economic growth"],
    "consumption": ["消費", "個人消費", "consumer spending", "retail sales"],
    "manufacturing": ["製造業", "PMI", "factory activity", "manufacturing sector"],
    "real_estate": ["不動産", "住宅", "real estate", "housing market"],
    "banking": ["銀行", "金融機関", "banking sector", "lender"],
    "insurance": ["保険", "insurer", "insurance"],
    "oil": ["原油", "OPEC", "WTI", "crude oil", "oil prices"],
    "natural_gas": ["天然ガス", "LNG", "natural gas"],
    "gold": ["金価格", "金相場", "gold prices"],
    "copper": ["銅", "copper"],
    "rare_earth": ["レアアース", "希土類", "rare earth"],
    "chemicals": ["化学", "石油化学", "chemical", "petrochemical"],
    "materials": ["素材", "鉄鋼", "steel", "raw materials"],
    "auto": ["自動車", "EV", "automaker", "automotive", "electric vehicle", "carmaker"],
    "semiconductor": ["半導体", "SOX", "chip", "chipmaker", "semiconductor"],
    "ai": ["AI", "人工知能", "生成AI", "artificial intelligence", "generative AI"],
    "software": ["ソフトウェア", "クラウド", "software", "cloud computing"],
    "telecom": ["通信", "5G", "telecom", "5G network"],
    "electric_power": ["電力", "発電", "electricity", "power grid", "power generation"],
    "infrastructure": ["インフラ", "infrastructure"],
    "shipping": ["海運", "コンテナ船", "shipping", "container ship"],
    "logistics": ["物流", "logistics", "supply chain"],
    "retail": ["小売", "retailer", "retail sector"],
    "food": ["食品", "food prices", "agriculture"],
    "healthcare": ["医療", "healthcare", "hospital"],
    "biotech": ["バイオ", "創薬", "biotech", "drug development"],
    "defense": ["防衛", "国防", "defense spending", "military"],
    "space": ["宇宙", "衛星", "space launch", "satellite"],
    "cyber": ["サイバー", "サイバー攻撃", "cyberattack", "cybersecurity"],
    "mna": ["M&A", "買収", "合併", "acquisition", "merger"],
    "earnings": ["決算", "業績", "earnings report", "quarterly results"],
    "regulation": ["規制", "当局", "regulator", "regulatory"],
}

# Kinds of disclosure in the order in which they are tried, and those of high weight.
DISCLOSURES = [
    ("guidance_revision", ["業績予想", "guidance", "revised outlook", "revises", "forecast revision"]),
    ("earnings", ["決算", "earnings", "quarterly results", "10-q", "10-k", "6-k", "financial results"]),
    ("buyback", ["自己株式", "自社株買い", "buyback", "share repurchase", "repurchase"]),
    ("dividend", ["配当", "dividend"]),
    ("M&A", ["買収", "合併", "acquisition", "merger", "takeover", "tender offer"]),
    ("major_contract", ["大型受注", "受注", "major contract", "awarded", "order"]),
    ("capex", ["設備投資", "capital expenditure", "capex", "plant investment"]),
    ("executive_change", ["役員", "代表取締役", "代表者", "異動", "ceo", "cfo", "executive change", "appoint"]),
    ("litigation", ["訴訟", "提訴", "lawsuit", "litigation", "settlement"]),
    ("regulatory_action", ["行政処分", "regulatory", "sanction", "penalty", "enforcement"]),
    ("financing", ["増資", "社債", "financing", "offering", "notes due", "loan"]),
    ("restructuring", ["リストラ", "restructuring", "reorganization", "spin-off", "divestiture"]),
    ("bankruptcy", ["破綻", "民事再生", "会社更生", "bankruptcy", "chapter 11", "insolvency"]),
]
HIGH = ["guidance_revision", "M&A", "buyback", "major_contract", "litigation", "regulatory_action", "bankruptcy", "executive_change", "capex", "dividend"]


def pattern(keyword: str) -> str:
    special = "\\.[]{}()*+-?^$|&"
    return "".join("\\" + c if c in special else c for c in keyword)


def _hits(text: Column, words: list[str], before: str, after: str) -> Column:
    """The longest of the words at each place of the text where one stands. Every word at a place is a beginning of the
    longest, so `_pairs` knows the others."""
    if not words:
        return F.array().cast("array<string>")
    first = [w[0] for w in words]
    starts = f"\\x{{{ord(min(first)):x}}}-\\x{{{ord(max(first)):x}}}"  # a range is one comparison at each place
    one = "|".join(pattern(w) for w in sorted(words, key=lambda w: (-len(w), w)))
    return F.regexp_extract_all(text, F.lit(f"{before}(?=[{starts}])(?=({one}){after})"), F.lit(1))


def _map(entries: dict[str, list[int]]) -> Column:
    if not entries:
        return F.create_map().cast("map<string,array<int>>")
    return F.create_map(*(x for k, v in entries.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))


def with_text(df: DataFrame, title: str = "title_original", description: str = "description") -> DataFrame:
    """Adds text and lowered, made once for all keywords."""
    text = F.concat(F.coalesce(F.col(title), F.lit("")), F.lit(" "), F.coalesce(F.col(description), F.lit("")))
    return df.withColumn("text", text).withColumn("lowered", F.lower("text"))


def category_hits(keywords: dict[str, list[str]] | None = None) -> Column:
    """array(struct(minus hits, category)) over the columns of with_text, best first: the different keywords of each
    category that occur, ASCII ones as whole words in any case, others as they stand anywhere.

    Two patterns, one for each kind, find all keywords in one pass over the text each.
    """
    pairs = [(c, w) for c, words in (keywords or CATEGORY_KEYWORDS).items() for w in dict.fromkeys(words) if w]
    ascii_ = {w.lower() for _, w in pairs if w.isascii()}
    other = {w for _, w in pairs if not w.isascii()}
    ends = lambda w, x: w.startswith(x) and (len(w) == len(x) or not (w[len(x)].isalnum() or w[len(x)] == "_"))
    found = {}  # a found word to the numbers of the pairs that it proves
    for w in ascii_:
        found["a" + w] = [i for i, (_, x) in enumerate(pairs) if x.isascii() and ends(w, x.lower())]
    for w in other:
        found["o" + w] = [i for i, (_, x) in enumerate(pairs) if not x.isascii() and w.startswith(x)]
    edge = "[\\p{L}\\p{N}_]"
    tagged = lambda tag, hits: F.transform(hits, lambda h: F.concat(F.lit(tag), h))
    hits = F.concat(tagged("a", _hits(F.col("lowered"), sorted(ascii_), f"(?<!{edge})", f"(?!{edge})")), tagged("o", _hits(F.col("text"), sorted(other), "", "")))
    table, names = _map(found), F.array(*(F.lit(c) for c, _ in pairs)) if pairs else F.array().cast("array<string>")
    proved = F.array_distinct(F.flatten(F.transform(F.array_distinct(hits), lambda h: F.element_at(table, h))))
    categories = F.transform(proved, lambda i: F.element_at(names, i + 1))
    count = F.aggregate(categories, F.create_map().cast("map<string,int>"), lambda m, c: F.map_concat(F.map_filter(m, lambda k, _: k != c), F.create_map(c, F.coalesce(F.try_element_at(m, c), F.lit(0)) - 1)))
    return F.array_sort(F.transform(F.map_entries(count), lambda e: F.struct(e["value"].alias("m"), e["key"].alias("c"))))


def classified(hits: Column) -> Column:
    """struct(primary, secondary, themes): the first, the second to sixth and the first six categories."""
    names = F.transform(hits, lambda e: e["c"])
    return F.struct(F.coalesce(F.try_element_at(names, F.lit(1)), F.lit("uncategorized")).alias("primary"), F.slice(names, 2, 5).alias("secondary"), F.slice(names, 1, 6).alias("themes"))


def disclosure(title: Column, filing: Column | None = None) -> Column:
    """struct(kind, materiality) of a disclosure by the first rule with a keyword anywhere in its title or form."""
    text = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(filing, F.lit("")) if filing is not None else F.lit("")))
    kind = F.lit("other")
    for name, words in reversed(DISCLOSURES):
        kind = F.when(text.rlike("|".join(pattern(w) for w in words)), name).otherwise(kind)
    weight = F.when(kind == "other", "low").when(kind.isin(*HIGH), "high").otherwise("medium")
    return F.struct(kind.alias("kind"), weight.alias("materiality"))
