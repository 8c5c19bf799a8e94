"""Queries of the converters, sources and evaluations, and their SQL."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.filings import disclosure_type
from ledgerloom.operators import convert as C
from ledgerloom.operators import referee as R
from ledgerloom.operators import tables as Tb
from ledgerloom.operators import xbrl as Xb
from ledgerloom.plans import fixtures as X
from ledgerloom.plans import metrics as Me
from ledgerloom.plans import pipelines as P
from ledgerloom.session import table
from ledgerloom.sources import markup as M


def scorecard(spark: SparkSession, d: str) -> DataFrame:
    return C.scorecard(X.filings(spark, d))


def identity_scorecard(spark: SparkSession, d: str) -> DataFrame:
    s = X.statements(spark, d)
    return Tb.identity(s).select("doc_id", F.col("status").alias("identity")).join(Tb.articulation(s).select("doc_id", F.col("ratio").alias("articulation")), "doc_id").join(Tb.alignment(s).select("doc_id", "tables", "misaligned"), "doc_id")


def document_suite(spark: SparkSession, d: str) -> DataFrame:
    """All twelve metrics over the statements, with their own words as the source's layout, ten a line, backwards for every fourth key."""
    s = X.statements(spark, d)
    w = s.select("doc_id", F.posexplode(F.filter(F.split("md", r"\s+"), lambda x: x != "")).alias("seq", "text"))
    n = F.when(F.col("doc_id") % 4 == 1, 1000 - F.col("seq")).otherwise(F.col("seq"))
    w = w.select("doc_id", F.lit(1).alias("page_no"), "seq", (n % 10 * 10).cast("double").alias("x0"), (F.floor(n / 10) * 20).cast("double").alias("y0"), "text")
    every = C.scorecard(s, C.METRICS | C.source_metrics(w, s.select("doc_id", (F.char_length("md") * 2).alias("source_chars"))))
    return every.select("doc_id", "market", "identity", "articulation", "misaligned_ratio", "section_count", "coverage", "order_status", (F.col("order_accuracy") == 1.0).alias("in_order"))


def precheck(spark: SparkSession, d: str) -> DataFrame:
    return C.precheck(X.statements(spark, d).unionByName(table(spark, d, "filing_md").select("doc_id", "market", "md").dropDuplicates(["doc_id"])))


def vendor_symbols(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "issuers").select("stock_code", "exchange", C.vendor_symbol(F.col("stock_code"), F.col("exchange")).alias("symbol"))


def company_exchange(spark: SparkSession, d: str) -> DataFrame:
    """Listed companies of the fetched list with the exchange of their class; other classes are dropped."""
    c = table(spark, d, "dart_fetch").where("stock_code <> '' AND corp_cls IN ('Y', 'K', 'N')").select("corp_code", "stock_code", F.when(F.col("corp_cls") == "Y", "ksc").when(F.col("corp_cls") == "K", "koe").otherwise("knx").alias("exchange"))
    return c.where("corp_code IS NOT NULL").distinct()


def archive_sample(spark: SparkSession, d: str) -> DataFrame:
    """A seeded sample of 50 filings: the same ones every time, whatever the order of rows."""
    f = table(spark, d, "filing_md").select("doc_id").distinct()
    return f.orderBy(F.md5(F.concat(F.lit("seed0:"), "doc_id")), "doc_id").limit(50)


def receipt_sample(spark: SparkSession, d: str) -> DataFrame:
    """A seeded sample of 10 receipts of each market, corrections and other reports skipped."""
    r = table(spark, d, "dart_fetch").where(disclosure_type(F.col("report_nm")).isNotNull()).select(F.coalesce(F.nullif("corp_cls", F.lit("")), F.lit("?")).alias("market"), "rcept_no").distinct()
    w = Window.partitionBy("market").orderBy(F.md5(F.concat(F.lit("seed0:"), "rcept_no")), "rcept_no")
    return r.withColumn("place", F.row_number().over(w)).where("place <= 10")


def truth_eval(spark: SparkSession, d: str) -> DataFrame:
    """Vendor fields, each under any of its labels, against the statements that pass the three filters; fields the filing leaves out are missing."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("doc_id"), (F.abs(X.cents("c_acctbal")) + 1000).cast("double").alias("liab"), (F.abs(X.cents("c_acctbal")) * 2 + 7).cast("double").alias("eq"))
    item = lambda n, v, *labels: F.struct(F.lit(n).alias("fact_no"), v.alias("value"), F.array(*map(F.lit, labels)).alias("labels"))
    t = c.select("doc_id", F.explode(F.array(item(1, F.col("liab"), "负债合计", "負債の部合計", "負債總計"), item(2, F.col("eq"), "所有者权益合计", "純資産の部合計", "權益總計"))).alias("i"))
    t = t.select("doc_id", "i.fact_no", "i.value", F.posexplode("i.labels").alias("k", "label"))
    vendor = P.vendor_rows(spark, d)
    jump = F.when(F.col("doc_id") % 8 == 6, 2.0).otherwise(1.1)
    said = c.select(F.col("doc_id").alias("symbol"), F.lit(1995).alias("year"), F.explode(F.array(F.struct(F.lit(3).alias("quarter"), F.col("liab").alias("value")), F.struct(F.lit(4).alias("quarter"), (F.col("liab") * jump).alias("value")))).alias("q"))
    cliffs = R.cliff(said.select("symbol", "year", "q.quarter", "q.value")).select(F.col("symbol").alias("doc_id"), "excluded")
    fit = R.eligible(C.precheck(X.statements(spark, d)), vendor, cliffs).where("skip_reason IS NULL")
    p = R.pairing(X.statements(spark, d).join(fit, "doc_id", "left_semi"), t.join(fit, "doc_id", "left_semi").withColumn("fact_no", F.col("fact_no") * 10 + F.col("k")))
    per = p.groupBy("doc_id", F.floor(F.col("fact_no") / 10).alias("field")).agg(F.bool_or(F.col("status") == "hit").alias("hit"), F.bool_and(F.col("status") == "label_missing").alias("missing"))
    return per.groupBy("field").agg(F.count("*").alias("tested"), F.count_if("hit").alias("hits"), F.count_if("missing").alias("missing"))


def cvm_statements(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("doc_id"), F.abs(X.cents("s_acctbal")).cast("string").alias("a"))
    conta = lambda code, name, *vs: F.concat(F.lit(f"<Conta><CodigoConta>{code}</CodigoConta><DescricaoConta>{name}</DescricaoConta>"), *vs, F.lit("</Conta>"))
    val = lambda n, v: F.concat(F.lit(f"<{n}>"), v, F.lit(f"</{n}>"))
    xml = F.concat(
        F.lit("<Doc><DfConsolidadas><BalancoPatrimonialAtivo>\n"), conta("1", "Ativo Total", val("UltimoExercicio", F.col("a")), val("Penultimo", F.lit("7"))), conta("1.01", "", val("UltimoExercicio", F.lit(" "))),
        F.lit("</BalancoPatrimonialAtivo></DfConsolidadas><DfIndividuais><DemonstracaoResultado>"), conta("3.01", "Receita", val("UltimoExercicio", F.lit("5"))), F.lit("</DemonstracaoResultado></DfIndividuais></Doc>"),
    )
    return C.cvm_accounts(s.select("doc_id", xml.alias("xml")), "doc_id", "xml").drop("pos")


def generic_xbrl(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    v = X.cents("o_totalprice").cast("string")
    xml = F.concat(F.lit('<x:xbrl><x:context id="c">k</x:context><in:Revenue contextRef="c" unitRef="u">'), v, F.lit('</in:Revenue><in:Note contextRef="c">n</in:Note><in:Revenue contextRef="d" >'), v, F.lit("</in:Revenue><in:Bare>z</in:Bare></x:xbrl>"))
    return Xb.generic_facts(o.select("o_orderkey", xml.alias("xml")), "o_orderkey", "xml")


def xbrl_contexts(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    html = F.concat(F.lit('<xbrli:context id="A"><xbrli:period><xbrli:instant>'), "day", F.lit('</xbrli:instant></xbrli:period></xbrli:context><p/><xbrli:context x="1" id="B"><xbrli:period><xbrli:startDate>2001-01-01</xbrli:startDate><xbrli:endDate>'), "day", F.lit('</xbrli:endDate></xbrli:period><xbrldi:explicitMember dimension="ax">NonConsolidatedMember</xbrldi:explicitMember></xbrli:context>'))
    c = Xb.inline_contexts(o.select("o_orderkey", html.alias("html")), "o_orderkey")
    return c.select("o_orderkey", "context_ref", "instant", "start", "end", F.array_join(F.map_values("dims"), ",").alias("members"))


def merge_signs(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    q = F.round("l_quantity").cast("bigint").cast("string")
    cells = F.array(F.lit("cash"), F.lit("$"), q, F.lit("$"), F.lit(""), F.when(F.col("l_linenumber") % 2 == 0, F.lit("¥")).otherwise(F.lit("x")), q)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", F.array_join(C.merged_signs(cells), "¦").alias("row"))


def font_map(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", F.concat(F.lit("<style>.a{color:red;font-size:"), "p_size", F.lit("px}\n.b-1 { font-size: 9.5 pt; } .c{x:y}</style>")).alias("css"))
    m = C.font_sizes(F.col("css"))
    return p.select("p_partkey", F.try_element_at(m, F.lit("a")).alias("a"), F.try_element_at(m, F.lit("b-1")).alias("b"), F.size(m).alias("n"))


def _spans(spark: SparkSession, d: str) -> DataFrame:
    w = P.words(spark, d)
    big = F.col("seq") % 11 == 0
    return w.select("doc_id", "page_no", F.col("seq").cast("int").alias("seq"), (F.floor((F.col("seq") % 24) / 3) * 30 + F.col("seq") % 3 * 10).cast("double").alias("y0"), F.when(big, 14.0).otherwise(9.0).alias("size"), F.when(big & (F.col("seq") % 2 == 0), F.concat(F.lit("Head "), "seq")).when(big, F.lit("Running head")).otherwise(F.col("text")).alias("text"))


def tagged_headings(spark: SparkSession, d: str) -> DataFrame:
    return C.tagged_headings(_spans(spark, d))


def flow_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return C.flow_paragraphs(_spans(spark, d)).groupBy("doc_id").agg(F.count("*").alias("paragraphs"), F.max(F.char_length("text")).alias("longest"))


def page_order(spark: SparkSession, d: str) -> DataFrame:
    return C.in_order(P.words(spark, d), "column").select("doc_id", "seq", "pos")


def page_order_y(spark: SparkSession, d: str) -> DataFrame:
    w = P.words(spark, d)
    y = C.in_order(w, "y").select("doc_id", "seq", F.col("pos").alias("by_y"))
    return y.join(C.in_order(w, "natural").select("doc_id", "seq", F.col("pos").alias("natural")), ["doc_id", "seq"])


def page_body(spark: SparkSession, d: str) -> DataFrame:
    w = P.words(spark, d).withColumns({"height": F.lit(300.0), "text": F.when(F.col("seq") % 5 == 0, (F.col("seq") % 100).cast("string")).otherwise(F.col("text"))})
    box = w.select("doc_id", "page_no").distinct().select("doc_id", "page_no", F.lit(300.0).alias("x0"), F.lit(70.0).alias("y0"), F.lit(420.0).alias("x1"), F.lit(120.0).alias("y1"))
    return C.page_body(w, box).select("doc_id", "seq")


def layout_markdown(spark: SparkSession, d: str) -> DataFrame:
    w = P.words(spark, d)
    kind = C.block_kind(F.col("text"), F.when(F.col("seq") % 9 == 0, 14.0).otherwise(9.0), F.lit("Times-Bold"))
    return C.layout_markdown(w.select("doc_id", "page_no", F.col("seq").cast("int").alias("seq"), "x0", "y0", kind.alias("kind"), "text"))


def rules_in_blocks(spark: SparkSession, d: str) -> DataFrame:
    b = P.table_blocks(spark, d).select("doc_id", "page_no", "block_no", "top", "bottom")
    v = P.rules(spark, d).select("doc_id", "page_no", "seq", (F.col("y") - 1).alias("y0"), (F.col("y") + 3).alias("y1"))
    return C.rules_in_blocks(v, b)


def next_pages(spark: SparkSession, d: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_quantity", "l_extendedprice"))
    p = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), n.alias("page_no"), F.concat(F.lit("p"), "l_linenumber").alias("text"))
    return C.with_next_pages(p, F.col("page_no") % 3 == 1)


def html_markdown(spark: SparkSession, d: str) -> DataFrame:
    """The markup of every fact as Markdown, tables in place."""
    f = table(spark, d, "edinet_xbrl").where("html IS NOT NULL").select("fact_id", "html").distinct()
    return f.select("fact_id", M.html_to_markdown(F.col("html")).alias("md"))


@F.pandas_udf(T.BinaryType())
def _zipped(name: pd.Series) -> pd.Series:
    def one(n: str) -> bytes:
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as z:
            for m, t in (("x/0000000_header.htm", "header"), ("x/0102010_b.htm", f"two {n}"), ("x/0101010_a.htm", f"one {n}"), ("x/readme.txt", "no")):
                z.writestr(m, t)
        return buf.getvalue()

    return name.map(one)


def zip_chapters(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "part").select("p_partkey", _zipped(F.col("p_name")).alias("content"))
    return M.chapters(M.zip_members(files, "p_partkey"), "p_partkey")


NAMES = (
    scorecard, document_suite, identity_scorecard, precheck, vendor_symbols, company_exchange, archive_sample, receipt_sample, truth_eval, cvm_statements, generic_xbrl, xbrl_contexts, merge_signs, font_map, tagged_headings, flow_paragraphs,
    page_order, page_order_y, page_body, layout_markdown, rules_in_blocks, next_pages, html_markdown, zip_chapters,
)
QUERIES = {f.__name__: f for f in NAMES}
W = P.WORDS
SPANS = f"{W}, s AS (SELECT doc_id, page_no, seq, seq % 24 // 3 * 30 + seq % 3 * 10 AS y0, CASE WHEN seq % 11 = 0 THEN 14.0 ELSE 9.0 END AS size, CASE WHEN seq % 22 = 0 THEN 'Head ' || seq WHEN seq % 11 = 0 THEN 'Running head' ELSE text END AS text FROM w)"
_PART = lambda name, *columns: f"(SELECT doc_id, {', '.join(columns)} FROM ({Me.ORACLES[name]}))"
SCORECARD = f"""WITH {Me.ROWS}, fil AS (SELECT DISTINCT ON (doc_id) doc_id, market FROM filing_md WHERE md IS NOT NULL),
      lab AS (SELECT doc_id, table_no, coalesce(list_filter(cells[1:2], lambda z: regexp_matches(z, '{Tb.CJK}'))[1], cells[1], '') AS lab, unnest(cells[2:]) AS cell FROM rows_),
      val AS (SELECT *, {Me.LENIENT.replace('XX', 'cell')} AS v FROM lab),
      cand AS (SELECT doc_id, v, CASE WHEN regexp_matches(lab, '{Tb.ASSET}') THEN 'a' WHEN regexp_matches(lab, '{Tb.LIABILITY}') THEN 'l' WHEN regexp_matches(lab, '{Tb.EQUITY}') AND NOT regexp_matches(lab, '{Tb.NOT_EQUITY}') THEN 'e' END AS k FROM val WHERE v <> 0),
      diff AS (SELECT a.doc_id AS doc_id, min(abs(a.v - l.v - e.v)) AS d FROM cand a JOIN cand l ON a.doc_id = l.doc_id AND l.k = 'l' JOIN cand e ON a.doc_id = e.doc_id AND e.k = 'e' WHERE a.k = 'a' GROUP BY a.doc_id),
      grp AS (SELECT doc_id, table_no, v, CASE WHEN regexp_matches(lab, '{Tb.NET_INCOME}') THEN 'n' WHEN regexp_matches(lab, '{Tb.CASH}') THEN 'c' END AS g FROM val WHERE v IS NOT NULL AND NOT regexp_matches(lab, '{Tb.NOT_SHARED}')),
      hit AS (SELECT doc_id, g, bool_or(EXISTS (SELECT 1 FROM grp o WHERE o.doc_id = grp.doc_id AND o.g = grp.g AND o.table_no <> grp.table_no AND abs(o.v - grp.v) <= 2)) AS h FROM grp WHERE g IS NOT NULL GROUP BY doc_id, g),
      art AS (SELECT doc_id, round(count(*) FILTER (h) / count(*), 6) AS articulation FROM hit GROUP BY doc_id),
      wide AS (SELECT doc_id, table_no, arg_min(len(cells), row_no) AS w, list(len(cells)) AS ws FROM rows_ GROUP BY ALL), ali AS (SELECT doc_id, round(count(*) FILTER (len(list_filter(ws, lambda x: x <> w)) > 0) / count(*), 6) AS misaligned_ratio FROM wide GROUP BY doc_id)
      SELECT doc_id, market, CASE WHEN d IS NULL THEN 'skip' WHEN d <= 1 THEN 'pass' ELSE 'fail' END AS identity, CASE WHEN labeled_tested > 0 THEN round(labeled_passed / labeled_tested, 6) END AS footing, articulation, misaligned_ratio, dup_ratio, ratio AS garbled_ratio, section_count, fragment_ratio, fake_ratio, suspicious
      FROM fil LEFT JOIN diff USING (doc_id) LEFT JOIN {_PART('filing_footing', 'labeled_tested', 'labeled_passed')} USING (doc_id) LEFT JOIN art USING (doc_id) LEFT JOIN ali USING (doc_id) LEFT JOIN {_PART('dup_lines', 'dup_ratio')} USING (doc_id)
      LEFT JOIN {_PART('garbled_profile', 'ratio')} USING (doc_id) LEFT JOIN {_PART('section_count', 'section_count')} USING (doc_id) LEFT JOIN {_PART('fragmentation', 'fragment_ratio')} USING (doc_id) LEFT JOIN {_PART('fake_headings', 'fake_ratio')} USING (doc_id)
      LEFT JOIN {_PART('script_profile', 'suspicious')} USING (doc_id)"""
ORACLES = {
    "scorecard": SCORECARD,
    "identity_scorecard": "SELECT c_custkey AS doc_id, CASE WHEN c_custkey % 7 = 5 THEN 'skip' WHEN c_custkey % 7 = 3 THEN 'fail' ELSE 'pass' END AS identity, (c_custkey % 5 <> 2)::INT / 2.0 AS articulation, 3::BIGINT AS tables, 0::BIGINT AS misaligned FROM customer",
    "document_suite": """SELECT c_custkey AS doc_id, CASE c_custkey % 3 WHEN 0 THEN 'cn' WHEN 1 THEN 'jp' ELSE 'tw' END AS market, CASE WHEN c_custkey % 7 = 5 THEN 'skip' WHEN c_custkey % 7 = 3 THEN 'fail' ELSE 'pass' END AS identity,
      (c_custkey % 5 <> 2)::INT / 2.0::DOUBLE AS articulation, 0::DOUBLE AS misaligned_ratio, 0::BIGINT AS section_count, 0.5::DOUBLE AS coverage, 'ok' AS order_status, c_custkey % 4 <> 1 AS in_order FROM customer""",
    "precheck": f"WITH d AS (SELECT DISTINCT ON (doc_id) doc_id, md FROM filing_md), r AS (SELECT doc_id, CASE WHEN length(trim(coalesce(md, ''), ' ')) < 50 THEN 'no_text' WHEN NOT regexp_matches(md, '{C.BALANCE}') THEN 'no_balance_sheet' END AS reason FROM d UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 3 = 1 THEN 'no_balance_sheet' END FROM customer) SELECT doc_id, reason IS NULL AS ok, reason FROM r",
    "vendor_symbols": "SELECT stock_code, exchange, CASE lower(exchange) " + " ".join(f"WHEN '{e}' THEN stock_code || '.{s}'" for e, s in C.SUFFIX.items()) + " END AS symbol FROM issuers",
    "company_exchange": "SELECT DISTINCT corp_code, stock_code, CASE corp_cls WHEN 'Y' THEN 'ksc' WHEN 'K' THEN 'koe' ELSE 'knx' END AS exchange FROM dart_fetch WHERE stock_code <> '' AND corp_cls IN ('Y', 'K', 'N') AND corp_code IS NOT NULL",
    "archive_sample": "SELECT doc_id FROM (SELECT DISTINCT doc_id FROM filing_md) ORDER BY md5('seed0:' || doc_id), doc_id LIMIT 50",
    "cvm_statements": "WITH s AS (SELECT s_suppkey AS doc_id, abs(round(s_acctbal * 100)::BIGINT)::VARCHAR AS a FROM supplier) SELECT doc_id, 'DfConsolidadas' AS scope, 'BalancoPatrimonialAtivo' AS statement, '1' AS code, 'Ativo Total' AS name, 'UltimoExercicio' AS field, a AS value FROM s UNION ALL SELECT doc_id, 'DfConsolidadas', 'BalancoPatrimonialAtivo', '1', 'Ativo Total', 'Penultimo', '7' FROM s UNION ALL SELECT doc_id, 'DfIndividuais', 'DemonstracaoResultado', '3.01', 'Receita', 'UltimoExercicio', '5' FROM s",
    "generic_xbrl": "SELECT o_orderkey AS doc_id, 'Revenue' AS concept, 2::BIGINT AS n, (round(o_totalprice * 100)::BIGINT)::VARCHAR AS values FROM orders UNION ALL SELECT o_orderkey, 'Note', 1, 'n' FROM orders",
    "xbrl_contexts": "SELECT o_orderkey, 'A' AS context_ref, o_orderdate::DATE AS instant, NULL::DATE AS start, NULL::DATE AS end, '' AS members FROM orders UNION ALL SELECT o_orderkey, 'B', NULL, DATE '2001-01-01', o_orderdate::DATE, 'NonConsolidatedMember' FROM orders",
    "merge_signs": "WITH i AS (SELECT l_orderkey, l_linenumber, l_partkey, (round(l_quantity)::BIGINT)::VARCHAR AS q FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, 'cash¦$' || q || '¦¦$¦¦' || CASE WHEN l_linenumber % 2 = 0 THEN '¥' || q || '¦' ELSE 'x¦' || q END AS row FROM i",
    "font_map": "SELECT p_partkey, p_size::DOUBLE AS a, 9.5::DOUBLE AS b, 2 AS n FROM part",
    "tagged_headings": f"WITH {SPANS}, t AS (SELECT *, count(*) OVER (PARTITION BY doc_id, text) AS times FROM s) SELECT doc_id, page_no, seq::INT AS seq, text, 9.0::DOUBLE AS body FROM t WHERE size = 14.0 AND times <= 2",
    "flow_paragraphs": f"WITH {SPANS}, b AS (SELECT *, coalesce(y0 - lag(y0) OVER o > 20 OR page_no <> lag(page_no) OVER o, true)::INT AS brk FROM s WINDOW o AS (PARTITION BY doc_id ORDER BY page_no, y0, seq)), p AS (SELECT *, sum(brk) OVER (PARTITION BY doc_id ORDER BY page_no, y0, seq) AS par FROM b), t AS (SELECT doc_id, par, string_agg(text, ' ' ORDER BY page_no, y0, seq) AS text FROM p GROUP BY ALL) SELECT doc_id, count(*) AS paragraphs, max(length(text)) AS longest FROM t GROUP BY doc_id",
    "page_order": f"WITH {W}, k AS (SELECT *, count(*) OVER (PARTITION BY doc_id, page_no) AS n, max(seq % 2) OVER (PARTITION BY doc_id, page_no) AS m FROM w) SELECT doc_id, seq, row_number() OVER (PARTITION BY doc_id ORDER BY page_no, CASE WHEN n >= 4 THEN seq % 2 ELSE 0 END, y0, x0, seq)::INT AS pos FROM k",
    "page_order_y": f"WITH {W} SELECT doc_id, seq, (row_number() OVER (PARTITION BY doc_id ORDER BY page_no, y0, seq))::INT AS by_y, (row_number() OVER (PARTITION BY doc_id ORDER BY page_no, seq))::INT AS natural FROM w",
    "page_body": f"WITH {W} SELECT doc_id, seq FROM w WHERE y0 >= 55 AND y0 <= 240 AND NOT (y0 > 225 AND seq % 5 = 0) AND NOT (seq % 2 = 1 AND y0 >= 68 AND y0 + 10 <= 122)",
    "layout_markdown": f"""WITH {W}, h AS (SELECT *, seq % 9 = 0 AS head, sum((seq % 9 = 0)::INT) OVER (PARTITION BY doc_id, page_no ORDER BY seq) AS part FROM w),
      p AS (SELECT doc_id, page_no, part, head, min(seq) AS first_seq, CASE WHEN head THEN chr(10) || '## ' || min(text) ELSE string_agg(text, ' ' ORDER BY seq) END AS line FROM h GROUP BY doc_id, page_no, part, head)
      SELECT doc_id, regexp_replace(string_agg(line, chr(10) ORDER BY first_seq), chr(10) || '{{3,}}', chr(10) || chr(10), 'g') AS md FROM p GROUP BY doc_id""",
    "rules_in_blocks": f"""WITH {P.RULES}, b AS (SELECT *, coalesce((y - lag(y) OVER (PARTITION BY doc_id ORDER BY y) >= 80)::INT, 0) AS brk FROM r), g AS (SELECT doc_id, y, sum(brk) OVER (PARTITION BY doc_id ORDER BY y) AS block_no FROM b), t AS (SELECT doc_id, block_no, min(y) AS top, max(y) AS bottom FROM g GROUP BY ALL HAVING count(*) >= 2),
      v AS (SELECT l_orderkey AS doc_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_extendedprice)::INT AS seq, l_linenumber * 2 + CASE WHEN l_partkey % 4 = 0 THEN 100 ELSE 0 END AS y FROM lineitem)
      SELECT doc_id, 1 AS page_no, block_no::BIGINT AS block_no, seq FROM v JOIN t USING (doc_id) WHERE y - 1 <= bottom AND y + 3 >= top""",
    "next_pages": "WITH p AS (SELECT l_orderkey AS doc_id, row_number() OVER w AS page_no, l_linenumber AS k FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_extendedprice)), t AS (SELECT doc_id, page_no, concat_ws(chr(10), 'p' || k, 'p' || lead(k) OVER (PARTITION BY doc_id ORDER BY page_no), 'p' || lead(k, 2) OVER (PARTITION BY doc_id ORDER BY page_no)) AS text FROM p) SELECT doc_id, page_no::INT AS page_no, text FROM t WHERE page_no % 3 = 1",
    "zip_chapters": "SELECT p_partkey, 'one ' || p_name || chr(10) || 'two ' || p_name AS html FROM part",
    "receipt_sample": """WITH r AS (SELECT DISTINCT coalesce(nullif(corp_cls, ''), '?') AS market, rcept_no FROM dart_fetch WHERE NOT regexp_matches(report_nm, '정정|訂正') AND regexp_matches(report_nm, '증권신고서|證券申告書|사업보고서|事業報告書|반기보고서|半期報告書|분기보고서|四半期報告書')),
      o AS (SELECT *, row_number() OVER (PARTITION BY market ORDER BY md5('seed0:' || rcept_no), rcept_no) AS place FROM r) SELECT market, rcept_no, place::INT AS place FROM o WHERE place <= 10""",
    "truth_eval": """WITH f AS (SELECT * FROM (SELECT c_custkey AS k, abs(round(c_acctbal * 100)::BIGINT) AS a FROM customer) WHERE a > 0 AND k % 3 <> 1 AND k % 4 <> 1 AND k % 9 <> 2 AND k % 8 <> 6)
      SELECT 1::BIGINT AS field, count(*) AS tested, count(*) FILTER (k % 7 <> 5) AS hits, count(*) FILTER (k % 7 = 5) AS missing FROM f WHERE a + 1000 >= 1000000 HAVING count(*) > 0 UNION ALL SELECT 2, count(*), count(*), 0 FROM f WHERE a * 2 + 7 >= 1000000 HAVING count(*) > 0""",
}
