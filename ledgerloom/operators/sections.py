"""Headings matched to an ontology of sections, chapters held against templates, keywords of focus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import strip
from ledgerloom.operators.lines import lines

#: Keywords of section concepts by market; a tie goes to the concept that stands first.
ONTOLOGY = {
    "ashare": {
        "cover": ["重要提示", "目录", "释义"],
        "company_profile": ["公司简介", "主要财务指标"],
        "business_overview": ["公司业务概要"],
        "mda": ["管理层讨论与分析", "经营情况讨论与分析", "董事会报告", "公司业务概要"],
        "governance": ["公司治理", "公司治理、环境和社会"],
        "esg": ["环境和社会", "环境与社会", "社会责任"],
        "material_events": ["重要事项"],
        "shareholders": ["股份变动及股东情况", "股份变动", "股东情况"],
        "bonds": ["债券相关情况", "公司债券相关情况"],
        "financial_report": ["财务报告"],
        "financial_statements": ["财务报告", "财务报表", "合并资产负债表", "合并利润表", "合并现金流量表"],
        "notes": ["财务报表附注", "附注"],
        "audit_report": ["审计报告", "审计意见"],
        "risk": ["风险因素", "风险"],
    },
    "jpx": {
        "company_profile": ["企業の概況", "設備の状況"],
        "mda": ["経営成績", "事業の状況", "経営に関する分析", "財政状態"],
        "material_events": ["提出会社の状況"],
        "shareholders": ["株式事務の概要", "大株主の状況"],
        "governance": ["コーポレート・ガバナンス", "企業統治"],
        "financial_report": ["経理の状況"],
        "financial_statements": ["財務諸表", "連結貸借対照表", "連結損益計算書", "連結キャッシュ・フロー計算書"],
        "notes": ["注記", "注記事項"],
        "audit_report": ["監査報告書", "独立監査人"],
        "risk": ["事業等のリスク", "リスク"],
    },
    "twse": {
        "cover": ["封面", "目錄", "目次", "財務報表索引"],
        "company_profile": ["公司概況", "公司沿革"],
        "mda": ["營運概況", "經營狀況", "營運之檢討與分析"],
        "governance": ["公司治理", "公司治理情形"],
        "financial_statements": ["資產負債表", "綜合損益表", "現金流量表", "權益變動表", "財務報表"],
        "notes": ["財務報表附註", "附註"],
        "audit_report": ["會計師查核報告", "會計師核閱報告"],
        "risk": ["風險", "風險管理"],
    },
    "kr": {
        "mda": ["경영진의 논의", "사업의 내용", "이사의 경영진단"],
        "governance": ["지배구조", "기업지배구조"],
        "financial_statements": ["재무제표", "연결 재무상태표", "연결 손익계산서", "연결 현금흐름표"],
        "notes": ["주석", "재무제표 주석"],
        "audit_report": ["감사보고서", "감사의견"],
        "risk": ["위험요소", "리스크 관리"],
    },
    "us": {
        "mda": ["Management's Discussion and Analysis", "Management Discussion and Analysis", "Discussion and Analysis of Financial Condition"],
        "financial_statements": [
            "Balance Sheets", "Statements of Earnings", "Statements of Operations", "Statements of Income",
            "Statements of Comprehensive Income", "Statements of Cash Flows", "Statements of Changes", "Financial Statements",
        ],
        "notes": ["Notes to Consolidated Financial Statements", "Notes to Financial Statements", "Notes to the Financial Statements"],
        "audit_report": ["Report of Independent Registered Public Accounting Firm", "Independent Auditor"],
        "risk": ["Risk Factors"],
        "governance": ["Corporate Governance", "Directors, Executive Officers and Corporate Governance"],
    },
}
#: The section markets of exchanges, the concepts of focus, and the keywords that an exchange has of its own.
EXCHANGES = {
    "ashare": ["sse", "szse", "bj"],
    "jpx": ["jpx"],
    "twse": ["twse", "tpex"],
    "kr": ["ksc", "koe", "knx"],
    "us": ["nyse", "nasdaq", "otc"],
}
FOCUS = ["mda", "financial_statements", "notes", "audit_report", "risk", "governance"]
OVERRIDES = {
    "bj": {
        "mda": ["管理层讨论与分析", "经营情况讨论与分析"],
        "financial_statements": ["财务报告", "财务报表"],
        "audit_report": ["审计报告"],
        "risk": ["风险因素"],
        "governance": ["公司治理"],
    },
    "knx": {
        "mda": ["경영진의 논의", "사업의 내용"],
        "financial_statements": ["재무제표"],
        "notes": ["주석"],
        "audit_report": ["감사보고서"],
        "risk": ["위험요소"],
        "governance": ["지배구조"],
    },
}
#: Chapters of annual reports by version of the disclosure rules, and the first year of each version.
ANNUAL = {
    "2025": ["重要提示、目录和释义", "公司简介和主要财务指标", "管理层讨论与分析", "公司治理、环境和社会", "重要事项", "股份变动及股东情况", "债券相关情况", "财务报告"],
    "2021": [
        "重要提示、目录和释义", "公司简介和主要财务指标", "管理层讨论与分析", "公司治理", "环境和社会责任", "重要事项", "股份变动及股东情况",
        "优先股相关情况", "债券相关情况", "财务报告",
    ],
    "2017": [
        "重要提示、目录和释义", "公司简介和主要财务指标", "公司业务概要", "经营情况讨论与分析", "重要事项", "股份变动及股东情况", "优先股相关情况",
        "董事、监事、高级管理人员和员工情况", "公司治理", "公司债券相关情况", "财务报告", "备查文件目录",
    ],
    "2015": [
        "重要提示、目录和释义", "公司简介和主要财务指标", "公司业务概要", "管理层讨论与分析", "重要事项", "股份变动及股东情况", "优先股相关情况",
        "董事、监事、高级管理人员和员工情况", "公司治理", "财务报告", "备查文件目录",
    ],
    "2014": [
        "重要提示、目录和释义", "公司简介", "会计数据和财务指标摘要", "董事会报告", "重要事项", "股份变动及股东情况", "优先股相关情况",
        "董事、监事、高级管理人员和员工情况", "公司治理", "内部控制", "财务报告", "备查文件目录",
    ],
    "2012": [
        "重要提示、目录和释义", "公司简介", "会计数据和财务指标摘要", "董事会报告", "重要事项", "股份变动及股东情况",
        "董事、监事、高级管理人员和员工情况", "公司治理", "内部控制", "财务报告", "备查文件目录",
    ],
}
ANNUAL["2016"] = ANNUAL["2017"]
#: Chapters of half-year reports: those of the annual report, in one version without the governance chapter.
SEMIANNUAL = {"2025": ANNUAL["2025"], "2021": ANNUAL["2021"], "2017": [x for x in ANNUAL["2017"] if x != "公司治理"]}
FROM_YEAR = ((2025, "2025"), (2021, "2021"), (2018, "2017"), (2016, "2016"), (2015, "2015"), (2013, "2014"), (0, "2012"))
#: Words of issuers outside the templates.
OFF_TEMPLATE = ("致股东", "企业管治", "监事会报告", "董事会报告")
#: A chapter's line and what marks a line of the contents.
BLANK = r"[\s\x{3000}\x{A0}&&[^\n]]"
CHAPTER = rf"#{{0,3}}{BLANK}*第[一二三四五六七八九十百0-9]+[节章節]{BLANK}*([^\n]{{0,40}})"
CONTENTS = rf"[^\n]*(?:[.．·]{{4,}}|[0-9]{{1,4}}{BLANK}*$)"


def heading_form(c: Column) -> Column:
    """Headings without blanks and dot leaders, with one word for `and`."""
    return F.translate(F.regexp_replace(c, r"[\s\x{3000}]|\.{2,}|[·．]{2,}", ""), "与", "和")


def chapter_form(c: Column) -> Column:
    """heading_form() without the mention of the contents."""
    return F.regexp_replace(heading_form(c), "、?目录和", "")


def ontology(spark: SparkSession) -> DataFrame:
    """market, concept, ord (of the concept within its market), keyword."""
    rows = [(m, c, i, k) for m, concepts in ONTOLOGY.items() for i, (c, ks) in enumerate(concepts.items()) for k in ks]
    return spark.createDataFrame(rows, "market string, concept string, ord int, keyword string")


def headings(docs: DataFrame) -> DataFrame:
    s = F.regexp_replace(strip(F.col("line")), r"^#+\s*(?:[0-9]+[.．]\s*)?[【]?|[】]$", "")
    rows = lines(docs.where("md IS NOT NULL")).where(F.col("line").rlike(r"^#{1,4}\s+\S"))
    return rows.join(docs.select("doc_id", "market"), "doc_id").select("doc_id", "market", "line_no", s.alias("heading"))


def map_sections(docs: DataFrame) -> DataFrame:
    """Each heading's concept: the longest keyword of its market that it contains; ties by the concept's order.

    The ontology is a fixed list, so it is broadcast; the market is the join's key.
    """
    o = F.broadcast(ontology(docs.sparkSession).withColumn("kf", heading_form(F.col("keyword"))))
    j = headings(docs).join(o, "market").where(F.contains(heading_form(F.col("heading")), F.col("kf")))
    best = F.max_by("concept", F.struct(F.char_length("kf"), -F.col("ord"))).alias("concept")
    return j.groupBy("doc_id", "line_no", "heading").agg(best)


def version_of(period: Column) -> Column:
    y = F.coalesce(F.substring(period, 1, 4).try_cast("int"), F.lit(0))
    out = F.lit("2012")
    for lo, v in reversed(FROM_YEAR):
        out = F.when(y >= lo, v).otherwise(out)
    return out


def check_templates(docs: DataFrame) -> DataFrame:
    """Chapters of a report held against those that a report of its type and year should have.

    status is ok, or skip with a reason: an amendment, a quarterly report, no template for its
    version, or an issuer outside the templates (a word of theirs that is no chapter of the report's
    own template). Empty chapter names match nothing. The chapters come out of each text by one
    expression, so nothing is exploded or shuffled.
    """
    spark = docs.sparkSession
    rows = [(v, t, xs) for t, per in (("annual", ANNUAL), ("semiannual", SEMIANNUAL)) for v, xs in per.items()]
    want = spark.createDataFrame(rows, "version string, doc_type string, want array<string>")
    lines_ = F.regexp_extract_all("md", F.lit(rf"(?md)^(?!{CONTENTS}){CHAPTER}"), 1)
    names = F.filter(F.transform(lines_, lambda n: F.substring(F.regexp_replace(n, r"[\s\x{3000}\x{A0}]+", ""), 1, 30)), lambda n: n != "")
    d = docs.where("md IS NOT NULL").select("doc_id", "doc_type", version_of(F.col("report_period")).alias("version"), names.alias("names"))
    want = want.withColumn("wanted", F.transform("want", lambda t: F.struct(t.alias("t"), chapter_form(t).alias("f"))))
    d = d.withColumn("named", F.transform("names", lambda n: F.struct(n.alias("n"), chapter_form(n).alias("f"))))
    j = d.join(F.broadcast(want), ["version", "doc_type"], "left")  # a fixed list
    like = lambda a, b: F.contains(a["f"], b["f"]) | F.contains(b["f"], a["f"])
    joined = F.array_join("names", "")
    off = F.exists(F.array(*map(F.lit, OFF_TEMPLATE)), lambda w: F.contains(joined, w) & ~F.array_contains("want", w))
    reason = (
        F.when(F.col("doc_type") == "amendment", "amendment").when(F.col("doc_type").isin("q1", "q3"), "quarterly")
        .when(F.col("want").isNull(), "no_template").when(off, "off_template")
    )
    j = j.withColumn("reason", reason)
    ok = F.col("reason").isNull()
    missing = F.transform(F.filter("wanted", lambda t: ~F.exists("named", lambda n: like(n, t))), lambda t: t["t"])
    extra = F.transform(F.filter("named", lambda n: (F.char_length(n["n"]) > 3) & ~F.exists("wanted", lambda t: like(n, t))), lambda n: n["n"])
    j = j.select("doc_id", "doc_type", "version", "reason", F.size("want").alias("n"), F.when(ok, missing).alias("missing"), F.when(ok, extra).alias("extra"))
    found = F.col("n") - F.size("missing")
    return j.select(
        "doc_id", "doc_type", "version", F.when(ok, "ok").otherwise("skip").alias("status"), "reason", F.when(ok, F.col("n")).alias("expected"),
        F.when(ok, found).alias("found"), F.when(ok, F.round(found / F.col("n"), 6)).alias("ratio"), "missing", "extra",
    )


def template_report(checked: DataFrame) -> DataFrame:
    """By type and version: reports, median share of chapters, and how many have every chapter."""
    ok = checked.where("status = 'ok'")
    full = F.count_if(F.col("ratio") == 1.0)
    return ok.groupBy("doc_type", "version").agg(
        F.count("*").alias("reports"), F.round(F.median("ratio"), 6).alias("median_ratio"), full.alias("whole"), F.round(full / F.count("*"), 6).alias("whole_share")
    )


def exchange_markets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(e, m) for m, es in EXCHANGES.items() for e in es], "exchange string, market string")


def override_keywords(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(e, c, k) for e, cs in OVERRIDES.items() for c, ks in cs.items() for k in ks], "exchange string, concept string, keyword string")


def focus_keywords(exchanges: DataFrame, overrides: DataFrame) -> DataFrame:
    """Keywords of the focus concepts by exchange: the exchange's own list where it has any, else its market's."""
    spark = exchanges.sparkSession
    market = ontology(spark).where(F.col("concept").isin(*FOCUS)).groupBy("market", "concept").agg(F.array_join(F.sort_array(F.collect_set("keyword")), "|").alias("ks"))
    own = overrides.groupBy("exchange", "concept").agg(F.array_join(F.sort_array(F.collect_set("keyword")), "|").alias("own"))
    grid = exchanges.join(F.broadcast(market), "market")  # a fixed list
    return grid.join(own, ["exchange", "concept"], "left").select("exchange", "concept", F.coalesce(F.nullif("own", F.lit("")), "ks").alias("keywords"))
