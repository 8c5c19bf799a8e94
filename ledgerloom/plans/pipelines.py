"""Queries of facts, truth, sections, layout, sources and incremental work, and their SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import filings as Fi
from ledgerloom.operators import layout as Lo
from ledgerloom.operators import referee as R
from ledgerloom.operators import sections as S
from ledgerloom.operators import tables as Tb
from ledgerloom.operators import xbrl as Xb
from ledgerloom.plans import fixtures as X
from ledgerloom.session import table
from ledgerloom.sources import markup as M
from ledgerloom.sources import sinks
from ledgerloom.streaming import incremental as I


def _facts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "edinet_xbrl").dropDuplicates(["fact_id"])


def xbrl_facts(spark: SparkSession, d: str) -> DataFrame:
    f = Xb.inline_facts(_facts(spark, d).where("kind = 'num'"), "fact_id")
    return f.select("fact_id", "concept", "context_ref", "unit_ref", "scale", "text")


def facts_with_context(spark: SparkSession, d: str) -> DataFrame:
    f = _facts(spark, d).where("context_ref <> ''")
    return Xb.with_context(f.select("fact_id", "doc_id", "context_ref"), f).select("fact_id", "doc_id", "context_ref", "ctx_end")


def scope_counts(spark: SparkSession, d: str) -> DataFrame:
    f = _facts(spark, d).select(Xb.scope_of(F.col("context_ref"), F.col("dims")).alias("scope"))
    return f.groupBy("scope").agg(F.count("*").alias("n"))


def concept_rollup(spark: SparkSession, d: str) -> DataFrame:
    return Xb.concept_rollup(_facts(spark, d).where("kind = 'num'"))


def concept_frequency(spark: SparkSession, d: str) -> DataFrame:
    return Xb.top_concepts(_facts(spark, d))


def _truth(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", F.round("l_quantity"), X.cents("l_extendedprice")))
    return li.select(F.col("l_orderkey").alias("doc_id"), n.alias("fact_no"), F.concat(F.lit("item "), "l_linenumber").alias("label"), X.cents("l_extendedprice").cast("double").alias("value"))


def _perturbed(spark: SparkSession, d: str) -> DataFrame:
    """Ledgers with faults: key % 3 = 1 amounts gone, 2 labels gone."""
    k = F.col("doc_id") % 3
    md = F.when(k == 1, F.regexp_replace("md", r"\| [0-9]+ \|(\n|$)", "| 1 |$1")).when(k == 2, F.regexp_replace("md", "item ", "row ")).otherwise(F.col("md"))
    return X.ledgers(spark, d).select("doc_id", md.alias("md"))


def value_recall(spark: SparkSession, d: str) -> DataFrame:
    return R.value_recall(_perturbed(spark, d), _truth(spark, d))


def pairing(spark: SparkSession, d: str) -> DataFrame:
    return R.pairing(_perturbed(spark, d), _truth(spark, d))


def pairing_report(spark: SparkSession, d: str) -> DataFrame:
    rates = R.attribution(pairing(spark, d)).withColumn("market", (F.col("doc_id") % 4).cast("string"))
    return R.positional(rates, "rate", "market")


def control_pairing(spark: SparkSession, d: str) -> DataFrame:
    a = R.attribution(R.pairing(X.ledgers(spark, d), _truth(spark, d)))
    return a.agg(F.sum("tested").alias("tested"), F.sum("hit").alias("hits"))


def variant_compare(spark: SparkSession, d: str) -> DataFrame:
    t = _truth(spark, d)
    return R.compare_variants(R.attribution(R.pairing(X.ledgers(spark, d), t)), R.attribution(R.pairing(_perturbed(spark, d), t))).drop("mean_base", "mean_other")


def quarters(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.groupBy(F.col("o_custkey").alias("symbol"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter")).agg(F.sum(X.cents("o_totalprice")).cast("double").alias("value"))


def q3q4_jump(spark: SparkSession, d: str) -> DataFrame:
    return R.cliff(quarters(spark, d)).select("symbol", "year", "q3", "q4", "excluded")


def truth_align(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "orders").select(F.col("o_custkey").alias("symbol"), F.to_date("o_orderdate").alias("date"), F.lit("total").alias("field"), X.cents("o_totalprice").alias("value"))
    months = F.sequence(F.to_date(F.lit("1992-03-01")), F.to_date(F.lit("2000-12-01")), F.expr("interval 3 months"))
    reports = table(spark, d, "customer").select(F.col("c_custkey").alias("symbol"), F.explode(F.transform(months, F.last_day)).alias("date"))
    return R.aligned(v, reports)


def vendor_rows(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("doc_id"), F.abs(X.cents("c_acctbal")).alias("a"))
    k = F.col("doc_id")
    rows = c.select("doc_id", (F.col("a") * 3 + F.when(k % 4 == 1, F.col("a")).otherwise(0)).alias("assets"), F.col("a").alias("liabilities"), F.when(k % 9 == 2, F.lit(None)).otherwise(F.col("a") * 2).alias("equity"))
    return R.consistency(rows)


def vendor_consistency(spark: SparkSession, d: str) -> DataFrame:
    return vendor_rows(spark, d).groupBy("skip_reason").agg(F.count("*").alias("n"))


def bench_rollup(spark: SparkSession, d: str) -> DataFrame:
    s = Tb.identity(X.statements(spark, d)).join(X.statements(spark, d).select("doc_id", "market", (F.col("doc_id") * 37 % 1009).alias("chars")), "doc_id")
    return R.bench_summary(s)


#: Headings that a report of each market may have, by hand.
HEADINGS = {
    "ashare": "第三节 管理层讨论与分析|第四节 公司治理|第八节 财务报告|十二、财务报表附注|合并资产负债表|环境与社会责任|公司 业务概要|其他",
    "jpx": "第2【事業の状況】|第5【経理の状況】|監査報告書|事業等のリスク|注記 事項|連結損益計算書|沿革",
    "twse": "資產負債表|會計師查核報告|財務報表附註|財務報表索引|風險管理|其他",
    "kr": "재무제표|재무제표 주석|연결 재무 상태표|위험요소|기업지배구조",
    "us": "Item 7. Management's Discussion and Analysis|Item 1A. Risk Factors|Notes to Financial Statements|Consolidated Balance Sheets|risk factors",
}


def map_section(spark: SparkSession, d: str) -> DataFrame:
    """Headings of all filings by their market's ontology, and a page of headings by hand for each customer."""
    market = F.element_at(F.create_map(*[F.lit(x) for kv in (("jp", "jpx"), ("cn", "ashare"), ("tw", "twse"), ("kr", "kr")) for x in kv]), F.col("market"))
    real = X.filings(spark, d).select("doc_id", F.coalesce(market, F.lit("us")).alias("market"), "md")
    kinds = F.array(*[F.struct(F.lit(m).alias("market"), F.lit("".join(f"## {h}\n" for h in hs.split("|"))).alias("md")) for m, hs in HEADINGS.items()])
    made = table(spark, d, "customer").select((-F.col("c_custkey")).alias("doc_id"), F.element_at(kinds, (F.col("c_custkey") % 5 + 1).cast("int")).alias("k"))
    return S.map_sections(real.unionByName(made.select("doc_id", "k.market", "k.md")))


def _reports(spark: SparkSession, d: str) -> DataFrame:
    """A report per order: chapters of its year's template but every sixth, with a line of contents; key % 7 = 2 a chapter too many, key % 11 = 4 one of other issuers."""
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"))
    k = F.col("doc_id")
    period = F.concat((F.lit(2012) + k % 15).cast("string"), F.lit("-12-31"))
    names = F.element_at(F.create_map(*[x for v, ns in S.ANNUAL.items() for x in (F.lit(v), F.array(*map(F.lit, ns)))]), S.version_of(period))
    kept = F.filter(names, lambda x, i: (i + k) % 6 != 1)
    kept = F.concat(kept, F.when(k % 7 == 2, F.array(F.lit("企业文化建设"))).otherwise(F.array().cast("array<string>")), F.when(k % 11 == 4, F.array(F.lit("致股东"))).otherwise(F.array().cast("array<string>")))
    body = F.array_join(F.transform(kept, lambda x, i: F.concat(F.lit("## 第"), i + 1, F.lit("节 "), x, F.lit("\n文"))), "\n")
    kind = F.when(k % 8 == 3, "q1").when(k % 8 == 5, "semiannual").when(k % 8 == 6, "amendment").otherwise("annual")
    return o.select("doc_id", kind.alias("doc_type"), period.alias("report_period"), F.concat(F.lit("第一节 致股东......3\n"), body).alias("md"))


def template_check(spark: SparkSession, d: str) -> DataFrame:
    checked = S.check_templates(_reports(spark, d))
    return checked.withColumns({c: F.array_join(c, "|") for c in ("missing", "extra")})


def template_report(spark: SparkSession, d: str) -> DataFrame:
    return S.template_report(template_check(spark, d))


def focus_keywords(spark: SparkSession, d: str) -> DataFrame:
    """By the exchanges of the lists, and by those of the issuers that have a market of their own."""
    mine = table(spark, d, "issuers").where("exchange = 'nse'").select("exchange", F.lit("us").alias("market")).distinct()
    return S.focus_keywords(S.exchange_markets(spark).unionByName(mine), S.override_keywords(spark))


def words(spark: SparkSession, d: str) -> DataFrame:
    """Two columns of words a page: 24 words a page, the lines of an order in turn left and right."""
    n = F.row_number().over(Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")) - 1
    w = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("doc_id"), n.alias("seq"), F.col("l_partkey").alias("p"))
    i, side = F.col("seq") % 24, F.col("seq") % 2
    x0 = (side * 300 + 50 + (F.col("p") % 3)).cast("double")
    y0 = (F.floor(i / 2) * 15 + 60).cast("double")
    return w.select("doc_id", (F.floor(F.col("seq") / 24) + 1).alias("page_no"), "seq", x0.alias("x0"), y0.alias("y0"), (x0 + 40).alias("x1"), (y0 + 10).alias("y1"), F.concat(F.lit("w"), F.col("p") % 50).alias("text"))


def rules(spark: SparkSession, d: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_quantity", "l_extendedprice"))
    return table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page_no"), (F.col("l_linenumber") * 2 + F.when(F.col("l_partkey") % 4 == 0, 100).otherwise(0)).cast("double").alias("y"), n.alias("seq"))


def row_clusters(spark: SparkSession, d: str) -> DataFrame:
    return Lo.row_clusters(rules(spark, d))


def table_blocks(spark: SparkSession, d: str) -> DataFrame:
    return Lo.table_blocks(rules(spark, d).select("doc_id", "page_no", "y").distinct())


def col_bands(spark: SparkSession, d: str) -> DataFrame:
    return Lo.column_bands(words(spark, d))


def row_bands(spark: SparkSession, d: str) -> DataFrame:
    return Lo.row_bands(words(spark, d))


def word_to_cell(spark: SparkSession, d: str) -> DataFrame:
    w = words(spark, d)
    ys = w.select("doc_id", "page_no").distinct().select("doc_id", "page_no", F.explode(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: (i * 15 + 57).cast("double"))).alias("y"))
    return Lo.words_to_cells(w, Lo.column_bands(w), ys).drop("text")


def column_split(spark: SparkSession, d: str) -> DataFrame:
    return Lo.column_split(words(spark, d))


def reading_order(spark: SparkSession, d: str) -> DataFrame:
    w = words(spark, d)
    k = F.col("doc_id") % 2
    pos = F.row_number().over(Window.partitionBy("doc_id").orderBy("page_no", F.when(k == 0, F.col("seq") % 2).otherwise(0), "seq"))
    return Lo.reading_order(w, w.select("doc_id", pos.alias("pos"), F.col("text").alias("word")))


def page_stitch(spark: SparkSession, d: str) -> DataFrame:
    """One table a page, as many pages as an order has lines; every third order breaks at each change of the column count."""
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_quantity", "l_extendedprice"))
    t = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), n.alias("page_no"), F.col("l_linenumber").alias("nrows"))
    t = t.withColumns({"ncols": F.when(F.col("doc_id") % 3 == 0, F.col("page_no") % 2 + 2).otherwise(3), "y0": F.lit(20.0), "y1": F.lit(790.0), "height": F.lit(800.0)})
    return Lo.stitched(t).groupBy("doc_id", "chain").agg(F.count("*").alias("pages"), F.sum("nrows").alias("nrows"))


def table_dedup(spark: SparkSession, d: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_quantity", "l_extendedprice")).cast("int")
    t = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page_no"), n.alias("seq"), (F.col("l_linenumber") * 10).cast("double").alias("x0"), F.lit(0.0).alias("y0"), (F.col("l_linenumber") * 10 + F.col("l_partkey") % 40).cast("double").alias("x1"), F.lit(10.0).alias("y1"), (F.col("l_suppkey") % 5).cast("int").alias("ncols"))
    return Lo.kept_candidates(t)


def merge_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    w = words(spark, d)
    b = w.select("doc_id", "page_no", F.col("seq").cast("int").alias("seq"), "y0", F.lit("p").alias("kind"), F.concat("text", F.when(F.col("seq") % 7 == 0, ".").otherwise("")).alias("text"))
    return Lo.merged_lines(b)


def captions(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("doc_id"))
    k = F.col("doc_id")
    t = o.select("doc_id", F.lit(1).alias("page_no"), F.lit(0).alias("table_no"), F.lit(100.0).alias("y0"))
    text = lambda y, x: F.struct(y.alias("y0"), F.lit(x).alias("text"))
    x = o.select("doc_id", F.lit(1).alias("page_no"), F.explode(F.array(text(F.lit(95.0) - k % 40, "Table 1"), text(F.lit(60.0) + k % 60, "表2"), text(F.lit(99.0), "It ends."))).alias("s"))
    return Lo.captions(t, x.select("doc_id", "page_no", "s.y0", "s.text"))


def balance_sheet_lines(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("doc_id"), F.abs(X.cents("c_acctbal")).alias("a"))
    k = F.col("doc_id")
    ls = F.array(F.lit("头"), F.lit("1100"), F.lit("现金"), F.when(k % 3 == 0, F.lit("附注")).otherwise(F.lit("备注")), (F.col("a") + 10000).cast("string"), F.lit("2100"), F.lit("借款"), F.when(k % 4 == 1, F.lit("-")).otherwise((F.col("a") + 20000).cast("string")))
    return Lo.balance_rows(c.select("doc_id", F.posexplode(ls).alias("line_no", "line")))


def disclosure_class(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "dart_fetch").select("rcept_no", "report_nm").distinct()
    return r.select("rcept_no", "report_nm", Fi.disclosure_type(F.col("report_nm")).alias("doc_type"), Fi.period_of(F.col("report_nm")).alias("period"))


def dispatch(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "issuers").select("stock_code", "exchange", Fi.format_of(F.col("exchange")).alias("format"))


def xml_sane(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "dart_fetch").select("rcept_no", "body").distinct().where("body IS NOT NULL")
    return r.select("rcept_no", F.char_length(Fi.sane_xml(F.col("body"))).alias("chars"))


def latest_receipts(spark: SparkSession, d: str) -> DataFrame:
    return Xb.latest(table(spark, d, "dart_fetch"), ["rcept_no"], "fetched_at").select("rcept_no", "fetched_at")


def xml_blocks(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "dart_fetch").dropDuplicates(["rcept_no", "body"])
    return M.filing_blocks(r, "rcept_no", "body")


def dart_markdown(spark: SparkSession, d: str) -> DataFrame:
    """The latest body of each receipt as Markdown."""
    r = Xb.latest(table(spark, d, "dart_fetch").select("rcept_no", "fetched_at", "body").where("body IS NOT NULL"), ["rcept_no"], "fetched_at")
    return r.select("rcept_no", M.filing_to_markdown(F.col("body")).alias("md"))


def html_cells(spark: SparkSession, d: str) -> DataFrame:
    return M.html_cells(_facts(spark, d), "fact_id")


def html_table_markdown(spark: SparkSession, d: str) -> DataFrame:
    c = M.html_cells(_facts(spark, d), "fact_id")
    c = c.withColumn("text", F.when((F.col("row_no") == F.col("origin_row")) & (F.col("col_no") == F.col("origin_col")), F.col("text")).otherwise(""))
    return Tb.pipe_markdown(c, ["fact_id", "table_no"])


@F.pandas_udf(T.BinaryType())
def _korean_bytes(s: pd.Series) -> pd.Series:
    def one(t: str) -> bytes:
        try:
            return t.encode("cp949")
        except UnicodeEncodeError:
            return t.encode()

    return s.map(one)


def decode_sniff(spark: SparkSession, d: str) -> DataFrame:
    """Texts as UTF-8, and as CP949 where they can be, back from their bytes."""
    r = table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", F.encode("text", "UTF-8").alias("content"), _korean_bytes(F.col("text")).alias("korean"), "text")
    return r.select("doc_id", (M.decoded(F.col("content")) == F.col("text")).alias("same"), (M.decoded(F.col("korean")) == F.col("text")).alias("same_korean"))


def front_matter(spark: SparkSession, d: str) -> DataFrame:
    docs = X.filings(spark, d).select("doc_id", "stock_code", "report_period", F.lit(None).cast("string").alias("title"), F.lit("x").alias("md"))
    return sinks.with_front_matter(docs, ["stock_code", "title", "report_period"])


def resume_todo(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return I.todo(e.select("event_id"), e.where("event_type = 'view' OR event_id % 3 = 0").select("event_id"), "event_id")


def version_stale(spark: SparkSession, d: str) -> DataFrame:
    return I.stale(X.filings(spark, d), 20).select("doc_id", F.col("converter_version").cast("int").alias("converter_version"))


NAMES = (
    xbrl_facts, facts_with_context, scope_counts, concept_rollup, concept_frequency, value_recall, pairing, pairing_report, control_pairing, variant_compare, q3q4_jump, truth_align, vendor_consistency,
    bench_rollup, map_section, template_check, template_report, focus_keywords, row_clusters, table_blocks, col_bands, row_bands, word_to_cell, column_split, reading_order, page_stitch, table_dedup, merge_paragraphs, captions,
    balance_sheet_lines, disclosure_class, dispatch, xml_sane, latest_receipts, xml_blocks, dart_markdown, html_cells, html_table_markdown, decode_sniff, front_matter, resume_todo, version_stale,
)
QUERIES = {f.__name__: f for f in NAMES}

FACTS = "f AS (SELECT DISTINCT ON (fact_id) * FROM edinet_xbrl)"
C = "round({} * 100)::BIGINT"
ITEMS = f"""i AS (SELECT l_orderkey AS doc_id, l_linenumber AS ln, round(l_quantity)::BIGINT AS q, {C.format('l_extendedprice')} AS a,
   row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, round(l_quantity)::BIGINT, {C.format('l_extendedprice')}) AS n FROM lineitem)"""
#: Every number of a perturbed ledger, with the label of its line as far as it is still there.
NUMS = f"""{ITEMS}, tot AS (SELECT doc_id, sum(q) AS tq, sum(a) AS ta FROM i GROUP BY doc_id),
   line AS (SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN '' ELSE 'item' || ln END AS lab, ln, q, CASE WHEN doc_id % 3 = 1 THEN 1 ELSE a END AS a FROM i
     UNION ALL SELECT doc_id, 'total', NULL, tq, CASE WHEN doc_id % 3 = 1 AND doc_id % 5 <> 2 THEN 1 ELSE ta + CASE WHEN doc_id % 5 = 1 THEN ta + 1000 ELSE 0 END END FROM tot WHERE doc_id % 5 <> 3),
   nums AS (SELECT doc_id, lab, unnest([ln, q, a]) AS x FROM line)"""
HIT = "abs(x - v) <= 1e-6 * v OR abs(x - v / 1e3) <= 1e-6 * v / 1e3 OR abs(x - v / 1e6) <= 1e-6 * v / 1e6 OR (v >= 1e8 AND abs(x - v / 1e8) <= 1e-6 * v / 1e8)"
PAIRS = f"""{NUMS}, t AS (SELECT doc_id, n AS fact_no, 'item' || ln AS key, a::DOUBLE AS v FROM i WHERE a >= 1e6),
   j AS (SELECT t.doc_id, fact_no, bool_or(lab = key AND ({HIT})) AS hit, bool_or(lab = key) AS lb, bool_or({HIT}) AS vl FROM t JOIN nums USING (doc_id) GROUP BY ALL),
   pairs AS (SELECT doc_id, fact_no, CASE WHEN hit THEN 'hit' WHEN NOT lb THEN 'label_missing' WHEN vl THEN 'value_elsewhere' ELSE 'value_absent' END AS status FROM j),
   att AS (SELECT doc_id, count(*) AS tested, count(*) FILTER (status = 'hit') AS hit, round(count(*) FILTER (status = 'hit') / count(*), 6) AS rate FROM pairs GROUP BY doc_id)"""
WORDS = """w0 AS (SELECT l_suppkey AS doc_id, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice) - 1 AS seq, l_partkey AS p FROM lineitem),
   w AS (SELECT doc_id, seq // 24 + 1 AS page_no, seq, (seq % 2 * 300 + 50 + p % 3)::DOUBLE AS x0, (seq % 24 // 2 * 15 + 60)::DOUBLE AS y0, 'w' || (p % 50) AS text FROM w0)"""
#: The ontology and the templates again, by hand, as the SQL's own values.
ONTO = """('ashare','cover',0,'重要提示 目录 释义'),('ashare','company_profile',1,'公司简介 主要财务指标'),('ashare','business_overview',2,'公司业务概要'),
      ('ashare','mda',3,'管理层讨论与分析 经营情况讨论与分析 董事会报告 公司业务概要'),('ashare','governance',4,'公司治理 公司治理、环境和社会'),('ashare','esg',5,'环境和社会 环境与社会 社会责任'),
      ('ashare','material_events',6,'重要事项'),('ashare','shareholders',7,'股份变动及股东情况 股份变动 股东情况'),('ashare','bonds',8,'债券相关情况 公司债券相关情况'),
      ('ashare','financial_report',9,'财务报告'),('ashare','financial_statements',10,'财务报告 财务报表 合并资产负债表 合并利润表 合并现金流量表'),('ashare','notes',11,'财务报表附注 附注'),
      ('ashare','audit_report',12,'审计报告 审计意见'),('ashare','risk',13,'风险因素 风险'),
      ('jpx','company_profile',0,'企業の概況 設備の状況'),('jpx','mda',1,'経営成績 事業の状況 経営に関する分析 財政状態'),('jpx','material_events',2,'提出会社の状況'),
      ('jpx','shareholders',3,'株式事務の概要 大株主の状況'),('jpx','governance',4,'コーポレート・ガバナンス 企業統治'),('jpx','financial_report',5,'経理の状況'),
      ('jpx','financial_statements',6,'財務諸表 連結貸借対照表 連結損益計算書 連結キャッシュ・フロー計算書'),('jpx','notes',7,'注記 注記事項'),('jpx','audit_report',8,'監査報告書 独立監査人'),('jpx','risk',9,'事業等のリスク リスク'),
      ('twse','cover',0,'封面 目錄 目次 財務報表索引'),('twse','company_profile',1,'公司概況 公司沿革'),('twse','mda',2,'營運概況 經營狀況 營運之檢討與分析'),('twse','governance',3,'公司治理 公司治理情形'),
      ('twse','financial_statements',4,'資產負債表 綜合損益表 現金流量表 權益變動表 財務報表'),('twse','notes',5,'財務報表附註 附註'),('twse','audit_report',6,'會計師查核報告 會計師核閱報告'),('twse','risk',7,'風險 風險管理'),
      ('kr','mda',0,'경영진의_논의 사업의_내용 이사의_경영진단'),('kr','governance',1,'지배구조 기업지배구조'),('kr','financial_statements',2,'재무제표 연결_재무상태표 연결_손익계산서 연결_현금흐름표'),
      ('kr','notes',3,'주석 재무제표_주석'),('kr','audit_report',4,'감사보고서 감사의견'),('kr','risk',5,'위험요소 리스크_관리'),
      ('us','mda',0,'Management''s_Discussion_and_Analysis Management_Discussion_and_Analysis Discussion_and_Analysis_of_Financial_Condition'),
      ('us','financial_statements',1,'Balance_Sheets Statements_of_Earnings Statements_of_Operations Statements_of_Income Statements_of_Comprehensive_Income Statements_of_Cash_Flows Statements_of_Changes Financial_Statements'),
      ('us','notes',2,'Notes_to_Consolidated_Financial_Statements Notes_to_Financial_Statements Notes_to_the_Financial_Statements'),
      ('us','audit_report',3,'Report_of_Independent_Registered_Public_Accounting_Firm Independent_Auditor'),('us','risk',4,'Risk_Factors'),('us','governance',5,'Corporate_Governance Directors,_Executive_Officers_and_Corporate_Governance')"""
ONTOLOGY_SQL = f"o0(market, concept, ord, ks) AS (VALUES {ONTO}), o AS (SELECT market, concept, ord, replace(unnest(string_split(ks, ' ')), '_', ' ') AS keyword FROM o0)"
HF = lambda c: f"translate(regexp_replace({c}, '[\\s\\x{{3000}}]|\\.{{2,}}|[·．]{{2,}}', '', 'g'), '与', '和')"
TPL = """('2025', ['重要提示、目录和释义','公司简介和主要财务指标','管理层讨论与分析','公司治理、环境和社会','重要事项','股份变动及股东情况','债券相关情况','财务报告']),
      ('2021', ['重要提示、目录和释义','公司简介和主要财务指标','管理层讨论与分析','公司治理','环境和社会责任','重要事项','股份变动及股东情况','优先股相关情况','债券相关情况','财务报告']),
      ('2017', ['重要提示、目录和释义','公司简介和主要财务指标','公司业务概要','经营情况讨论与分析','重要事项','股份变动及股东情况','优先股相关情况','董事、监事、高级管理人员和员工情况','公司治理','公司债券相关情况','财务报告','备查文件目录']),
      ('2016', ['重要提示、目录和释义','公司简介和主要财务指标','公司业务概要','经营情况讨论与分析','重要事项','股份变动及股东情况','优先股相关情况','董事、监事、高级管理人员和员工情况','公司治理','公司债券相关情况','财务报告','备查文件目录']),
      ('2015', ['重要提示、目录和释义','公司简介和主要财务指标','公司业务概要','管理层讨论与分析','重要事项','股份变动及股东情况','优先股相关情况','董事、监事、高级管理人员和员工情况','公司治理','财务报告','备查文件目录']),
      ('2014', ['重要提示、目录和释义','公司简介','会计数据和财务指标摘要','董事会报告','重要事项','股份变动及股东情况','优先股相关情况','董事、监事、高级管理人员和员工情况','公司治理','内部控制','财务报告','备查文件目录']),
      ('2012', ['重要提示、目录和释义','公司简介','会计数据和财务指标摘要','董事会报告','重要事项','股份变动及股东情况','董事、监事、高级管理人员和员工情况','公司治理','内部控制','财务报告','备查文件目录'])"""
_CF = lambda x: f"replace(replace({x}, '与', '和'), '、目录和', '')"
_LIKE = f"(contains({_CF('x')}, {_CF('g')}) OR contains({_CF('g')}, {_CF('x')}))"
CHECKED = f"""t(version, names) AS (VALUES {TPL}),
      r AS (SELECT o_orderkey AS doc_id, 2012 + o_orderkey % 15 AS y, CASE o_orderkey % 8 WHEN 3 THEN 'q1' WHEN 5 THEN 'semiannual' WHEN 6 THEN 'amendment' ELSE 'annual' END AS doc_type FROM orders),
      v AS (SELECT *, CASE WHEN y >= 2025 THEN '2025' WHEN y >= 2021 THEN '2021' WHEN y >= 2018 THEN '2017' WHEN y >= 2016 THEN '2016' WHEN y = 2015 THEN '2015' WHEN y >= 2013 THEN '2014' ELSE '2012' END AS version FROM r),
      a AS (SELECT v.*, names, CASE WHEN doc_type = 'annual' THEN names WHEN doc_type = 'semiannual' AND version IN ('2025', '2021') THEN names WHEN doc_type = 'semiannual' AND version = '2017' THEN list_filter(names, lambda x: x <> '公司治理') END AS want FROM v JOIN t USING (version)),
      f AS (SELECT *, [names[k] FOR k IN range(1, len(names) + 1) IF (k - 1 + doc_id) % 6 <> 1] || CASE WHEN doc_id % 7 = 2 THEN ['企业文化建设'] ELSE [] END || CASE WHEN doc_id % 11 = 4 THEN ['致股东'] ELSE [] END AS got,
          CASE WHEN doc_type = 'amendment' THEN 'amendment' WHEN doc_type = 'q1' THEN 'quarterly' WHEN want IS NULL THEN 'no_template' WHEN doc_id % 11 = 4 OR (list_contains(names, '董事会报告') AND NOT list_contains(want, '董事会报告')) THEN 'off_template' END AS reason FROM a),
      g AS (SELECT *, list_filter(want, lambda x: len(list_filter(got, lambda g: {_LIKE})) = 0) AS lost FROM f),
      checked AS (SELECT doc_id, doc_type, version, CASE WHEN reason IS NULL THEN 'ok' ELSE 'skip' END AS status, reason, CASE WHEN reason IS NULL THEN len(want)::INT END AS expected,
          CASE WHEN reason IS NULL THEN (len(want) - len(lost))::INT END AS found, CASE WHEN reason IS NULL THEN round((len(want) - len(lost)) / len(want), 6) END AS ratio, CASE WHEN reason IS NULL THEN lost END AS missing,
          CASE WHEN reason IS NULL THEN list_filter(got, lambda x: length(x) > 3 AND len(list_filter(want, lambda g: {_LIKE})) = 0) END AS extra FROM g)"""
RULES = "r AS (SELECT DISTINCT l_orderkey AS doc_id, (l_linenumber * 2 + CASE WHEN l_partkey % 4 = 0 THEN 100 ELSE 0 END)::DOUBLE AS y FROM lineitem)"
#: The cells of the tables in facts' markup, which has no spanned rows and no nested tables.
CELLS = r"""h AS (SELECT DISTINCT fact_id, html FROM edinet_xbrl WHERE html LIKE '%<table%'), t AS (SELECT fact_id, unnest(string_split(html, '<table')[2:]) AS t, generate_subscripts(string_split(html, '<table')[2:], 1) - 1 AS table_no FROM h),
   r AS (SELECT fact_id, table_no::INT AS table_no, unnest(string_split(t, '<tr>')[2:]) AS r, (generate_subscripts(string_split(t, '<tr>')[2:], 1) - 1)::INT AS row_no FROM t),
   d AS (SELECT fact_id, table_no, row_no, unnest(regexp_extract_all(r, '<t[dh]([^>]*)>[^<]*</t[dh]>', 1)) AS attrs, unnest(regexp_extract_all(r, '<t[dh][^>]*>([^<]*)</t[dh]>', 1)) AS text, generate_subscripts(regexp_extract_all(r, '<t[dh][^>]*>[^<]*</t[dh]>'), 1) AS i FROM r),
   s AS (SELECT *, coalesce(try_cast(regexp_extract(attrs, 'colspan="([0-9]+)"', 1) AS INT), 1) AS span FROM d), o AS (SELECT *, (sum(span) OVER (PARTITION BY fact_id, table_no, row_no ORDER BY i) - span)::INT AS origin_col FROM s),
   cells AS (SELECT fact_id, table_no, row_no, (origin_col + unnest(range(span)))::INT AS col_no, text, origin_col FROM o)"""
ORACLES = {
    "xbrl_facts": f"WITH {FACTS} SELECT fact_id, concept, nullif(context_ref, '') AS context_ref, nullif(unit_ref, '') AS unit_ref, scale, text FROM f WHERE kind = 'num' AND contains(html, '<ix:non')",
    "facts_with_context": f"WITH {FACTS}, c AS (SELECT doc_id, context_ref, arg_max(ctx_end, file) AS ctx_end FROM (SELECT * REPLACE (coalesce(ctx_end, DATE '0001-01-01') AS ctx_end) FROM f) WHERE context_ref <> '' GROUP BY ALL) SELECT fact_id, doc_id, context_ref, nullif(c.ctx_end, DATE '0001-01-01') AS ctx_end FROM f JOIN c USING (doc_id, context_ref)",
    "scope_counts": f"WITH {FACTS} SELECT CASE WHEN coalesce(context_ref, '') = '' THEN 'unknown' WHEN contains(coalesce(dims, ''), 'NonConsolidatedMember') OR contains(context_ref, 'NonConsolidatedMember') THEN 'individual' ELSE 'consolidated' END AS scope, count(*) AS n FROM f GROUP BY 1",
    "concept_rollup": f"WITH {FACTS}, g AS (SELECT doc_id, concept, text, min(fact_id) AS p, count(*) AS c FROM f WHERE kind = 'num' AND text <> '' GROUP BY ALL) SELECT doc_id, concept, sum(c)::BIGINT AS n, substr(string_agg(text, ' / ' ORDER BY p), 1, 200) AS values FROM g GROUP BY ALL",
    "concept_frequency": f"WITH {FACTS} SELECT concept, count(*) AS n FROM f GROUP BY 1 ORDER BY n DESC, concept LIMIT 12",
    "value_recall": f"WITH {NUMS}, t AS (SELECT doc_id, n, a::DOUBLE AS v FROM i WHERE a >= 1e6), j AS (SELECT t.doc_id, n, bool_or({HIT}) AS hit FROM t JOIN nums USING (doc_id) GROUP BY ALL) SELECT doc_id, count(*) AS tested, count(*) FILTER (hit) AS hits, round(count(*) FILTER (hit) / count(*), 6) AS recall FROM j GROUP BY doc_id",
    "pairing": f"WITH {PAIRS} SELECT doc_id, fact_no::INT AS fact_no, status FROM pairs",
    "pairing_report": f"WITH {PAIRS}, o AS (SELECT (doc_id % 4)::VARCHAR AS market, rate, row_number() OVER (PARTITION BY doc_id % 4 ORDER BY rate) - 1 AS i, count(*) OVER (PARTITION BY doc_id % 4) AS n FROM att) SELECT market, count(*) AS docs, max(rate) FILTER (i = n // 2) AS median, max(rate) FILTER (i = n // 10) AS p10, max(rate) FILTER (i = n * 9 // 10) AS p90, min(rate) AS least, count(*) FILTER (rate < 0.5) AS below_half, count(*) FILTER (rate < 0.8) AS below_08 FROM o GROUP BY market",
    "control_pairing": f"WITH {ITEMS} SELECT count(*) AS tested, count(*) AS hits FROM i WHERE a >= 1e6",
    "variant_compare": f"WITH {PAIRS} SELECT count(*) AS docs, 0::BIGINT AS wins, count(*) FILTER (rate < 1) AS losses FROM att",
    "q3q4_jump": f"WITH q AS (SELECT o_custkey AS symbol, year(o_orderdate)::INT AS year, quarter(o_orderdate) AS k, sum({C.format('o_totalprice')})::DOUBLE AS v FROM orders GROUP BY ALL), p AS (SELECT symbol, year, sum(v) FILTER (k = 3) AS q3, sum(v) FILTER (k = 4) AS q4 FROM q GROUP BY ALL) SELECT *, coalesce(abs(q4 - q3) / abs(q3) > 0.3, false) AS excluded FROM p",
    "truth_align": f"SELECT o_custkey AS symbol, o_orderdate::DATE AS date, 'total' AS field, {C.format('o_totalprice')} AS value FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderdate::DATE = last_day(o_orderdate::DATE) AND month(o_orderdate) % 3 = 0 AND o_orderdate::DATE BETWEEN DATE '1992-03-01' AND DATE '2000-12-31'",
    "vendor_consistency": f"WITH c AS (SELECT c_custkey AS k, abs({C.format('c_acctbal')}) AS a FROM customer) SELECT CASE WHEN k % 9 = 2 OR a = 0 THEN 'incomplete' WHEN k % 4 = 1 THEN 'inconsistent' END AS skip_reason, count(*) AS n FROM c GROUP BY 1",
    "bench_rollup": """WITH s AS (SELECT c_custkey % 3 AS m, c_custkey % 7 AS k, c_custkey * 37 % 1009 AS chars FROM customer), t AS (SELECT CASE m WHEN 0 THEN 'cn' WHEN 1 THEN 'jp' ELSE 'tw' END AS market, k, chars FROM s)
      SELECT coalesce(market, 'ALL') AS market, count(*) AS n, count(*) FILTER (k NOT IN (3, 5)) AS pass, count(*) FILTER (k = 3) AS fail, count(*) FILTER (k = 5) AS skip, round(count(*) FILTER (k NOT IN (3, 5)) / count(*), 6) AS pass_rate, min(chars) AS min_chars, max(chars) AS max_chars FROM t GROUP BY ROLLUP (market)""",
    "map_section": rf"""WITH docs AS (SELECT DISTINCT ON (doc_id) * FROM filing_md), {ONTOLOGY_SQL},
      mk(k, market, hs) AS (VALUES (0, 'ashare', '第三节 管理层讨论与分析|第四节 公司治理|第八节 财务报告|十二、财务报表附注|合并资产负债表|环境与社会责任|公司 业务概要|其他'), (1, 'jpx', '第2【事業の状況】|第5【経理の状況】|監査報告書|事業等のリスク|注記 事項|連結損益計算書|沿革'),
        (2, 'twse', '資產負債表|會計師查核報告|財務報表附註|財務報表索引|風險管理|其他'), (3, 'kr', '재무제표|재무제표 주석|연결 재무 상태표|위험요소|기업지배구조'),
        (4, 'us', 'Item 7. Management''s Discussion and Analysis|Item 1A. Risk Factors|Notes to Financial Statements|Consolidated Balance Sheets|risk factors')),
      every AS (SELECT doc_id, CASE market WHEN 'jp' THEN 'jpx' WHEN 'cn' THEN 'ashare' WHEN 'tw' THEN 'twse' WHEN 'kr' THEN 'kr' ELSE 'us' END AS market, md FROM docs WHERE md IS NOT NULL
        UNION ALL SELECT -c_custkey, mk.market, '## ' || replace(hs, '|', chr(10) || '## ') FROM customer JOIN mk ON c_custkey % 5 = k),
      ls AS (SELECT doc_id, market, unnest(string_split(md, chr(10))) AS line, generate_subscripts(string_split(md, chr(10)), 1) - 1 AS line_no FROM every),
      h AS (SELECT doc_id, market, line_no::INT AS line_no, regexp_replace(regexp_replace(line, '^[\s\x{{A0}}\x{{3000}}]+|[\s\x{{A0}}\x{{3000}}]+$', '', 'g'), '^#+\s*(?:[0-9]+[.．]\s*)?[【]?|[】]$', '', 'g') AS heading FROM ls WHERE regexp_matches(line, '^#{{1,4}}\s+\S')),
      j AS (SELECT doc_id, line_no, heading, concept, row_number() OVER (PARTITION BY doc_id, line_no ORDER BY length({HF('keyword')}) DESC, ord) AS rn FROM h JOIN o USING (market) WHERE contains({HF('heading')}, {HF('keyword')}))
      SELECT doc_id, line_no, heading, concept FROM j WHERE rn = 1""",
    "template_check": f"WITH {CHECKED} SELECT * REPLACE (array_to_string(missing, '|') AS missing, array_to_string(extra, '|') AS extra) FROM checked",
    "template_report": f"WITH {CHECKED} SELECT doc_type, version, count(*) AS reports, round(median(ratio), 6) AS median_ratio, count(*) FILTER (ratio = 1) AS whole, round(count(*) FILTER (ratio = 1) / count(*), 6) AS whole_share FROM checked WHERE status = 'ok' GROUP BY doc_type, version",
    "focus_keywords": f"""WITH {ONTOLOGY_SQL}, e(exchange, market) AS (VALUES ('sse', 'ashare'), ('szse', 'ashare'), ('bj', 'ashare'), ('jpx', 'jpx'), ('twse', 'twse'), ('tpex', 'twse'), ('ksc', 'kr'), ('koe', 'kr'), ('knx', 'kr'), ('nyse', 'us'), ('nasdaq', 'us'), ('otc', 'us'), ('nse', 'us')),
      own(exchange, concept, ks) AS (VALUES ('bj', 'mda', '管理层讨论与分析|经营情况讨论与分析'), ('bj', 'financial_statements', '财务报告|财务报表'), ('bj', 'audit_report', '审计报告'), ('bj', 'risk', '风险因素'), ('bj', 'governance', '公司治理'),
        ('knx', 'mda', '경영진의 논의|사업의 내용'), ('knx', 'financial_statements', '재무제표'), ('knx', 'notes', '주석'), ('knx', 'audit_report', '감사보고서'), ('knx', 'risk', '위험요소'), ('knx', 'governance', '지배구조')),
      k AS (SELECT exchange, concept, string_agg(DISTINCT keyword, '|' ORDER BY keyword) AS ks FROM e JOIN o USING (market) WHERE concept IN ('mda', 'financial_statements', 'notes', 'audit_report', 'risk', 'governance') GROUP BY ALL)
      SELECT k.exchange, k.concept, coalesce(own.ks, k.ks) AS keywords FROM k LEFT JOIN own USING (exchange, concept)""",
    "row_clusters": f"""WITH RECURSIVE {RULES}, k AS (SELECT doc_id, min(y) AS y, 0 AS row_no FROM r GROUP BY doc_id UNION ALL SELECT k.doc_id, (SELECT min(r.y) FROM r WHERE r.doc_id = k.doc_id AND r.y - k.y >= 3), row_no + 1 FROM k WHERE EXISTS (SELECT 1 FROM r WHERE r.doc_id = k.doc_id AND r.y - k.y >= 3)) SELECT doc_id, 1 AS page_no, row_no, y FROM k""",
    "table_blocks": f"WITH {RULES}, b AS (SELECT *, coalesce((y - lag(y) OVER (PARTITION BY doc_id ORDER BY y) >= 80)::INT, 0) AS brk FROM r), g AS (SELECT doc_id, y, sum(brk) OVER (PARTITION BY doc_id ORDER BY y) AS block_no FROM b) SELECT doc_id, 1 AS page_no, block_no::BIGINT AS block_no, count(*) AS n_rows, min(y) AS top, max(y) AS bottom FROM g GROUP BY doc_id, block_no HAVING count(*) >= 2",
    "col_bands": f"WITH {WORDS} SELECT doc_id, page_no, (dense_rank() OVER (PARTITION BY doc_id, page_no ORDER BY side) - 1)::BIGINT AS band_no, x0, x1, words FROM (SELECT doc_id, page_no, seq % 2 AS side, min(x0) AS x0, max(x0) + 40 AS x1, count(*) AS words FROM w GROUP BY ALL)",
    "row_bands": f"WITH {WORDS}, c AS (SELECT DISTINCT doc_id, page_no, y0 + 5 AS c FROM w), l AS (SELECT *, lead(c) OVER (PARTITION BY doc_id, page_no ORDER BY c) AS nx FROM c) SELECT doc_id, page_no, (c + nx) / 2 AS border FROM l WHERE nx IS NOT NULL",
    "word_to_cell": f"WITH {WORDS}, k AS (SELECT *, min(seq % 2) OVER (PARTITION BY doc_id, page_no) AS lo FROM w) SELECT doc_id, page_no, seq, CASE WHEN (y0 - 60) / 15 < 9 THEN ((y0 - 60) // 15)::INT END AS row_no, (seq % 2 - lo)::INT AS col_no, false AS outside_x, (y0 - 60) / 15 >= 9 AS outside_y FROM k",
    "column_split": f"WITH {WORDS}, g AS (SELECT *, lead(x0) OVER (PARTITION BY doc_id, page_no ORDER BY x0) - x0 AS gap FROM w), p AS (SELECT doc_id, page_no, max(gap) AS mg, count(*) AS n, max(x0) - min(x0) AS span FROM g GROUP BY ALL), b AS (SELECT g.doc_id, g.page_no, max(x0) AS bx, any_value(mg) AS mg FROM g JOIN p ON g.doc_id = p.doc_id AND g.page_no = p.page_no AND gap = mg WHERE n >= 4 AND span > 0 AND mg >= 0.15 * span GROUP BY g.doc_id, g.page_no) SELECT doc_id, page_no, bx + mg / 2 AS mid FROM b",
    "reading_order": f"""WITH {WORDS}, c AS (SELECT *, CASE WHEN count(*) OVER (PARTITION BY doc_id, page_no) >= 4 THEN seq % 2 ELSE 0 END AS side FROM w),
      g AS (SELECT doc_id, text, row_number() OVER (PARTITION BY doc_id ORDER BY page_no, side, y0, x0, seq) AS gpos FROM c), gk AS (SELECT *, row_number() OVER (PARTITION BY doc_id, text ORDER BY gpos) AS k FROM g),
      o AS (SELECT doc_id, text, row_number() OVER (PARTITION BY doc_id ORDER BY page_no, CASE WHEN doc_id % 2 = 0 THEN seq % 2 ELSE 0 END, seq) AS pos FROM w), p AS (SELECT *, row_number() OVER (PARTITION BY doc_id, text ORDER BY pos) AS k FROM o),
      m AS (SELECT p.doc_id AS doc_id, gpos > lag(gpos) OVER (PARTITION BY p.doc_id ORDER BY pos) AS good FROM p JOIN gk USING (doc_id, text, k))
      SELECT doc_id, CASE WHEN count(*) >= 50 THEN 'ok' ELSE 'skip' END AS status, count(*) AS matched, CASE WHEN count(*) >= 50 THEN round(count(*) FILTER (good) / (count(*) - 1), 6) END AS accuracy FROM m GROUP BY doc_id""",
    "merge_paragraphs": f"WITH {WORDS} SELECT doc_id, page_no, 0 AS par_no, 'p' AS kind, string_agg(text || CASE WHEN seq % 7 = 0 THEN '.' ELSE '' END, ' ' ORDER BY seq) AS text FROM w GROUP BY doc_id, page_no",
    "table_dedup": """WITH RECURSIVE t AS (SELECT l_orderkey AS doc_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_extendedprice) AS seq, {'seq': row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_extendedprice), 'x0': l_linenumber * 10, 'x1': l_linenumber * 10 + l_partkey % 40, 'ncols': l_suppkey % 5} AS c FROM lineitem),
      f AS (SELECT doc_id, seq, [c] AS kept FROM t WHERE seq = 1 UNION ALL SELECT f.doc_id, t.seq, CASE WHEN len(list_filter(kept, lambda k: greatest(0, least(k.x1, c.x1) - greatest(k.x0, c.x0)) > 0.5 * (c.x1 - c.x0))) > 0 THEN kept ELSE list_append(kept, c) END FROM f JOIN t ON t.doc_id = f.doc_id AND t.seq = f.seq + 1),
      z AS (SELECT doc_id, arg_max(kept, seq) AS kept FROM f GROUP BY doc_id), u AS (SELECT doc_id, kept, unnest(kept) AS c FROM z)
      SELECT doc_id, 1 AS page_no, c.seq::INT AS seq, c.ncols::INT AS ncols FROM u WHERE len(list_filter(kept, lambda o: o.seq <> c.seq AND o.x0 <= c.x0 AND o.x1 >= c.x1 AND o.ncols > c.ncols)) = 0""",
    "html_cells": f"WITH {CELLS} SELECT fact_id, table_no, row_no, col_no, text, row_no AS origin_row, origin_col FROM cells",
    "html_table_markdown": f"""WITH {CELLS}, x AS (SELECT fact_id, table_no, row_no, col_no, CASE WHEN col_no = origin_col THEN replace(text, '|', '\\|') ELSE '' END AS t FROM cells),
      cols AS (SELECT fact_id, table_no, col_no FROM x GROUP BY ALL HAVING max(t) <> ''), y AS (SELECT x.* FROM x JOIN cols USING (fact_id, table_no, col_no)),
      ls AS (SELECT fact_id, table_no, row_no, '| ' || string_agg(t, ' | ' ORDER BY col_no) || ' |' AS line, '|' || repeat(' --- |', count(*)::INT) AS rule FROM y GROUP BY ALL HAVING max(t) <> ''),
      n AS (SELECT *, row_number() OVER (PARTITION BY fact_id, table_no ORDER BY row_no) AS i FROM ls)
      SELECT fact_id, table_no, string_agg(CASE WHEN i = 1 THEN line || chr(10) || rule ELSE line END, chr(10) ORDER BY i) AS md FROM n GROUP BY ALL HAVING count(*) >= 2""",
    "page_stitch": f"WITH {ITEMS}, s AS (SELECT doc_id, n AS page_no, ln, CASE WHEN doc_id % 3 = 0 THEN n ELSE 1 END AS chain FROM i) SELECT doc_id, chain::BIGINT AS chain, count(*) AS pages, sum(ln)::BIGINT AS nrows FROM s GROUP BY ALL",
    "captions": "WITH x AS (SELECT o_orderkey AS doc_id, unnest([95.0 - o_orderkey % 40, 60.0 + o_orderkey % 60]) AS y0, unnest(['Table 1', '表2']) AS text FROM orders) SELECT doc_id, 1 AS page_no, 0 AS table_no, arg_min(text, (100 - y0, text)) AS caption FROM x WHERE y0 < 100 AND 100 - y0 <= 30 GROUP BY doc_id",
    "balance_sheet_lines": f"WITH c AS (SELECT c_custkey AS doc_id, abs({C.format('c_acctbal')}) AS a FROM customer) SELECT doc_id, '1100' AS code, '现金' AS name, (a + 10000)::DOUBLE AS amount FROM c UNION ALL SELECT doc_id, '2100', '借款', (a + 20000)::DOUBLE FROM c WHERE doc_id % 4 <> 1",
    "disclosure_class": r"""WITH r AS (SELECT DISTINCT rcept_no, report_nm, regexp_extract(report_nm, '\(([0-9]{4})\.[0-9]{2}\)', 1) AS y, regexp_extract(report_nm, '\([0-9]{4}\.([0-9]{2})\)', 1) AS m FROM dart_fetch)
      SELECT rcept_no, report_nm, CASE WHEN regexp_matches(report_nm, '정정|訂正') THEN NULL WHEN contains(report_nm, '증권신고서') THEN 'prospectus' WHEN contains(report_nm, '사업보고서') THEN 'annual' WHEN contains(report_nm, '반기보고서') THEN 'semiannual' WHEN contains(report_nm, '분기보고서') THEN CASE WHEN m IN ('', '03') THEN 'q1' ELSE 'q3' END END AS doc_type,
        CASE WHEN m IN ('03', '06', '09', '12') THEN last_day(make_date(y::INT, m::INT, 1)) END AS period FROM r""",
    "dispatch": "SELECT stock_code, exchange, CASE " + " ".join(f"WHEN exchange = '{e}' THEN '{f}'" for e, f in Fi.FORMATS.items()) + f" WHEN exchange IN ({', '.join(repr(x) for x in Fi.ESEF)}) THEN 'esef' ELSE 'unsupported' END AS format FROM issuers",
    "xml_sane": r"""SELECT rcept_no, length(regexp_replace(b, '[\x00-\x08\x0b\x0c\x0e-\x1f]', '', 'g')) + 4 * (length(b) - length(replace(b, '&', '')) - len(regexp_extract_all(b, '&(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);'))) + 3 * (len(regexp_extract_all(b || ' ', '<')) - len(regexp_extract_all(b, '<[A-Za-z/!?]'))) AS chars
      FROM (SELECT DISTINCT rcept_no, body AS b FROM dart_fetch WHERE body IS NOT NULL)""",
    "latest_receipts": "SELECT rcept_no, max(fetched_at) AS fetched_at FROM dart_fetch GROUP BY 1",
    "decode_sniff": "SELECT doc_id, true AS same, true AS same_korean FROM documents WHERE text IS NOT NULL",
    "front_matter": "WITH docs AS (SELECT DISTINCT ON (doc_id) * FROM filing_md) SELECT doc_id, '---' || chr(10) || concat_ws(chr(10), 'stock_code: \"' || nullif(stock_code, '') || '\"', 'report_period: \"' || nullif(report_period, '') || '\"') || chr(10) || '---' || chr(10) || 'x' AS md FROM docs",
    "resume_todo": "SELECT event_id FROM events WHERE NOT (event_type = 'view' OR event_id % 3 = 0)",
    "version_stale": "SELECT DISTINCT ON (doc_id) doc_id, converter_version::INT AS converter_version FROM filing_md WHERE converter_version IS DISTINCT FROM 20",
}
