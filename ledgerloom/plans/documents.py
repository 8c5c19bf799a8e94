"""Queries of whole conversions and what they are made of, over documents built from the tables, and their SQL by hand."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import filings as Fi
from ledgerloom.functions import numbers as N
from ledgerloom.operators import convert as C
from ledgerloom.operators import layout as Lo
from ledgerloom.operators import referee as R
from ledgerloom.operators import xbrl as Xb
from ledgerloom.plans import fixtures as X
from ledgerloom.session import table
from ledgerloom.sources import markup as M
from ledgerloom.sources import tagged as Tg


def _customers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_custkey").alias("doc_id"), F.abs(X.cents("c_acctbal")).cast("string").alias("a"))


def _say(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _page(k, a):
    """A page with contents, anchors of three kinds, a repeated bold title, a table of spans and signs, and a table of one row."""
    return _say(
        '<html><head><title>t</title></head><body><meta name="x"><a href="#c1">Chapter one</a><a href="#c1">12</a><a href="#p1">Item</a><h1>Report ', k.cast("string"),
        '</h1><div id="c1"></div><p>text <b>bold</b> here</p><a name="c1"></a><p><b>Chapter one again</b></p><p>after<br>it</p><table><tr><th colspan=2>Item</th><th>x|y</th></tr><tr><td>cash</td><td>$</td><td>', a,
        '</td></tr><tr><td></td></tr></table><table><tr><td>alone</td></tr></table><p id="p1">Item 1. Own</p><script>var t="</p>"</script><li>last</li></body></html>',
    )


def page_markdown(spark: SparkSession, d: str) -> DataFrame:
    return _customers(spark, d).select("doc_id", M.html_to_markdown(_page(F.col("doc_id"), F.col("a"))).alias("md"))


def _layout(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Two pages a document: heading, a row of two, a wrapped line, a caption, a table that runs over the page, header and footer, a unit line."""
    c = _customers(spark, d)
    k = F.col("doc_id").cast("string")
    block = lambda page, seq, x0, y0, text: F.struct(F.lit(page).alias("page_no"), F.lit(seq).alias("seq"), F.lit(float(x0)).alias("x0"), F.lit(float(y0)).alias("y0"), (F.lit(text) if isinstance(text, str) else text).alias("text"))
    rows = F.array(
        block(1, 0, 50, 10, "running head"), block(1, 1, 50, 60, "第一节 概况"), block(1, 2, 50, 100, "alpha"), block(1, 3, 200, 102, F.concat(F.lit("beta"), k)), block(1, 4, 50, 118, "続く"),
        block(1, 5, 50, 180, "表一 明細"), block(1, 6, 60, 300, "inside"), block(1, 7, 50, 760, "1 / 2"), block(1, 8, 50, 730, "12"), block(2, 0, 50, 200, "単位：千円 "), block(2, 1, 50, 230, "End."),
    )
    b = c.select("doc_id", F.explode(rows).alias("b")).select("doc_id", "b.*")
    b = b.withColumns({"x1": F.col("x0") + 40, "y1": F.col("y0") + 10, "height": F.lit(800.0), "size": F.lit(9.0), "font": F.lit("Mincho")})
    row = lambda *cells: F.array(*[F.lit(x) if isinstance(x, str) else x for x in cells])
    part = lambda page, y0, y1, grid: F.struct(F.lit(page).alias("page_no"), F.lit(y0).alias("y0"), F.lit(y1).alias("y1"), grid.alias("grid"))
    again = F.when(F.col("doc_id") % 3 == 0, row("項目", "金額")).otherwise(row("続", "1"))
    parts = F.array(part(1, 200.0, 790.0, F.array(row("項目", "金額"), row("a", F.col("a")), row("", ""))), part(2, 10.0, 100.0, F.array(again, row("b", "2"))))
    t = c.select("doc_id", F.explode(parts).alias("t")).select("doc_id", "t.*")
    return b, t.withColumns({"table_no": F.lit(0), "x0": F.lit(40.0), "x1": F.lit(500.0), "height": F.lit(800.0)})


def layout_document(spark: SparkSession, d: str) -> DataFrame:
    return C.layout_document(*_layout(spark, d))


MARKS = ("12", "３ / 15", "- 12 -", "第3頁", "表一 明細", "It ends.", "金额单位：元，其中包括以下各项目在内的全部金额以及其他各项说明文字部分内容", "単位：千円", " 单位: 万元 ", "见单位：元", "x", "long " * 12)


def text_marks(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").where(F.col("n_nationkey") < len(MARKS)).select(F.col("n_nationkey").cast("int").alias("i"))
    t = n.withColumn("text", F.get(F.array(*map(F.lit, MARKS)), F.col("i")))
    last = F.get(F.array(*map(F.lit, MARKS)), (F.col("i") + 1) % len(MARKS))
    return t.select("i", Fi.is_page_number(F.col("text")).alias("page_number"), Fi.is_caption(F.col("text")).alias("caption"), Fi.quoted_units(F.col("text")).alias("quoted"), Fi.needs_space(F.col("text"), last).alias("space"))


def cell_amounts(spark: SparkSession, d: str) -> DataFrame:
    """The cell parsers of iXBRL tables and balance sheets, and the writer of whole numbers, over every order's price in several spellings."""
    o = table(spark, d, "orders").select("o_orderkey", X.cents("o_totalprice").alias("t"))
    k, t = F.col("o_orderkey"), F.col("t")
    grouped = F.format_number("t", 0)
    text = F.when(k % 4 == 0, F.concat(F.lit("△"), grouped)).when(k % 4 == 1, F.concat(F.lit("("), grouped, F.lit(")"))).when(k % 4 == 2, F.concat(F.lit("$ "), grouped)).otherwise(t.cast("string"))
    sign, scale = F.when(k % 5 == 0, "-"), F.when(k % 3 == 0, "3").when(k % 3 == 1, "x")
    return o.select("o_orderkey", N.num_ixbrl_cell(text, scale, sign).alias("ixbrl"), N.amount_bs(text).alias("sheet"), N.num_xbrl_fact(text, scale, sign).alias("fact"), N.fmt_int(text).alias("written"))


@F.pandas_udf(T.BinaryType())
def _bundle(name: pd.Series) -> pd.Series:
    def one(n: str) -> bytes:
        if n.startswith("0"):
            return b"PK\x03\x04 broken " + n.encode()
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as z:
            for m, t in (("x/0000000_header.htm", "head"), ("x/0102010_b.htm", f"<p>two {n}</p>"), (f"{n}.xml", "main"), ("x/0101010_a.htm", f"<p>one {n}</p>")):
                z.writestr(m, t)
        return buf.getvalue()

    return name.map(one)


def zip_choice(spark: SparkSession, d: str) -> DataFrame:
    """Members, the largest page, the main member and the error of bundles; every seventh is broken, every fifth is no archive."""
    p = table(spark, d, "part").select("p_partkey")
    k = F.col("p_partkey")
    files = p.select("p_partkey", F.when(k % 5 == 0, F.lit("plain").cast("binary")).otherwise(_bundle(F.concat(F.when(k % 7 == 0, "0").otherwise(""), k.cast("string")))).alias("content"))
    m = M.zip_members(files, "p_partkey")
    n = m.groupBy("p_partkey").agg(F.count_if(F.col("error").isNull()).alias("members"), F.max(F.col("error").isNotNull()).alias("broken"))
    big = M.largest_page(m, "p_partkey").withColumnRenamed("name", "largest")
    return n.join(big, "p_partkey", "left").join(M.main_or_first(m, "p_partkey").withColumnRenamed("name", "main"), "p_partkey", "left").select("p_partkey", "members", "broken", "largest", "bytes", "main")


def convert_files(spark: SparkSession, d: str) -> DataFrame:
    """A file of each issuer in the format of its exchange, converted by one union of plans."""
    i = table(spark, d, "issuers").select(F.xxhash64("stock_code").alias("doc_id"), "stock_code", "exchange")
    code = F.col("stock_code")
    html = _say("<html><body><h2>", code, "</h2><p>x</p></body></html>")
    xml = _say("<DOCUMENT><SECTION-1><TITLE>T ", code, "</TITLE><P>p</P><TABLE><TR><TD>a</TD><TE>1</TE></TR></TABLE></SECTION-1></DOCUMENT>")
    cvm = _say("<Doc><DfConsolidadas><DemonstracaoResultado><Conta><CodigoConta>3</CodigoConta><DescricaoConta>R</DescricaoConta><Ultimo>", code, "</Ultimo></Conta></DemonstracaoResultado></DfConsolidadas></Doc>")
    xb = _say('<x:xbrl><in:Revenue contextRef="c">', code, "</in:Revenue></x:xbrl>")
    kind = Fi.format_of(F.col("exchange"))
    content = F.when(kind == "ixbrl_zip", _bundle(code)).otherwise(F.when(kind.isin("ixbrl", "esef"), html).when(kind == "dart_xml", xml).when(kind == "cvm_xml", cvm).when(kind == "xbrl", xb).otherwise("?").cast("binary"))
    files = i.withColumn("content", content)
    return C.convert_files(files).join(i.select("doc_id", "stock_code"), "doc_id").select("stock_code", "format", "md", F.col("error").isNotNull().alias("failed"))


def evaluation(spark: SparkSession, d: str) -> DataFrame:
    """Statements as two conversions and a control; key % 5 = 0 has no labelled fact, key % 5 = 1 far too many for its text."""
    s = X.statements(spark, d).select("doc_id", "md")
    k = F.col("doc_id")
    value = table(spark, d, "customer").select(F.col("c_custkey").alias("doc_id"), (F.abs(X.cents("c_acctbal")) * 2 + 7).cast("double").alias("value"))
    label = F.when(k % 3 == 0, "所有者权益合计").when(k % 3 == 1, "純資産の部合計").otherwise("權益總計")
    some = F.when(k % 5 == 1, 60).otherwise(1)
    truth = value.where(k % 5 != 0).select("doc_id", F.explode(F.sequence(F.lit(1), some)).alias("fact_no"), label.alias("label"), "value")
    docs = {"pdf": s.withColumn("md", F.when(k % 2 == 0, F.regexp_replace("md", "权益合计|の部合計|權益總計", "?")).otherwise(F.col("md"))), "ixbrl": s, "control": truth.where("fact_no = 1").select("doc_id", F.concat("label", F.lit(" "), F.col("value").cast("bigint")).alias("md"))}
    return R.evaluation(docs, truth).drop("md_chars")


def company_list(spark: SparkSession, d: str) -> DataFrame:
    """The companies of a fetched list, with the exchange of the class looked up for each; unlisted ones and other classes go."""
    f = table(spark, d, "issuers").where("corp_code IS NOT NULL").select("corp_code", "corp_name", "stock_code", "corp_cls")
    item = _say("<list><corp_code> ", F.col("corp_code"), " </corp_code><corp_name>", F.col("corp_name"), "</corp_name><stock_code>", F.when(F.col("corp_cls") == "N", " ").otherwise(F.col("stock_code")), "</stock_code></list>")
    lists = f.groupBy(F.substring("corp_code", -1, 1).alias("part")).agg(F.concat(F.lit("<result><status>000</status>"), F.array_join(F.collect_list(item), ""), F.lit("</result>")).alias("xml"))
    refused = spark.createDataFrame([("x", "<result><status>020</status><list><corp_code>1</corp_code><stock_code>2</stock_code></list></result>")], "part string, xml string")
    return M.companies(lists.unionByName(refused), "xml", f.select("corp_code", "corp_cls"))


def sheet_totals(spark: SparkSession, d: str) -> DataFrame:
    """The totals of a frameless balance sheet: by label, by code where the label is torn, none where another code comes first."""
    c = _customers(spark, d).withColumn("v", F.col("a").cast("bigint") + 10000)
    k = F.col("doc_id")
    amount = F.format_number("v", 0)
    ls = F.array(
        F.lit("流動資產合計"), F.lit("99,999"), F.when(k % 3 == 0, F.lit("資 產 總 計")).otherwise(F.lit("1xxx")), F.lit(""), F.lit("$"), amount, F.lit("0.77 2xxx 負債總計"), F.lit("附註"), F.format_number(F.col("v") + 1, 0),
        F.lit("負債及權益總計"), F.lit("88,888"), F.lit("股東權益淨額"), F.when(k % 4 == 1, F.lit("3100")).otherwise(F.lit("-")), F.format_number(F.col("v") + 2, 0),
    )
    return Lo.balance_totals(c.select("doc_id", F.posexplode(ls).alias("line_no", "line")))


def _grids(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("table_no"), F.col("l_partkey").alias("p"))
    cell = lambda i: F.when((F.col("p") + i) % 3 > 0, "x").otherwise(" ")
    one = li.groupBy("doc_id", "table_no").agg(F.min("p").alias("p"))
    return one.select("doc_id", "table_no", F.array(F.array(cell(0), cell(1), cell(4)), F.array(F.lit(""), F.lit(""), F.lit("")), F.array(cell(2), F.when(F.col("p") % 5 > 1, "y").otherwise(""), F.lit(None).cast("string"))).alias("grid"))


def text_tables(spark: SparkSession, d: str) -> DataFrame:
    return Lo.accepted_text_tables(_grids(spark, d)).select("doc_id", "table_no", F.size("grid").alias("n_rows"))


def largest_tables(spark: SparkSession, d: str) -> DataFrame:
    """Of the lines of an order as tables of quantity % 5 + 1 rows and tax % 4 + 1 columns, the three with most cells."""
    li = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("table_no")).agg(F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"))
    cells = li.select("doc_id", "table_no", F.explode(F.sequence(F.lit(0), (F.col("p") % 5).cast("int"))).alias("row_no"), (F.col("s") % 4).alias("col_no"))
    return Lo.largest_tables(cells)


def inline_facts(spark: SparkSession, d: str) -> DataFrame:
    """Numeric and text facts of a page for each order: a self-closing one, signs that toggle, nested markup, a fact without unit."""
    o = table(spark, d, "orders").select("o_orderkey", X.cents("o_totalprice").cast("string").alias("t"))
    html = _say(
        '<p><ix:nonFraction name="p:Nil" contextRef="c0"/><ix:nonFraction name="p:Cash" contextRef="c1" unitRef="JPY" scale="3" sign="-">△', F.col("t"), '</ix:nonFraction>',
        '<ix:nonFraction name="p:Debt" contextRef="c1" sign="-">', F.col("t"), '</ix:nonFraction><ix:nonNumeric name="q:Policy" contextRef="c2"><b>Policy</b> <i>', F.col("o_orderkey").cast("string"), "</i></ix:nonNumeric></p>",
    )
    f = Xb.inline_facts(o.select("o_orderkey", html.alias("html")), "o_orderkey")
    return f.select("o_orderkey", "pos", "kind", "concept", "context_ref", "unit_ref", "text", "value")


def _lined(spark: SparkSession, d: str) -> DataFrame:
    """A page for each supplier: five rules and three words in each of four rows, a rule far below; every fourth page has too few rules."""
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("doc_id"))
    k = F.col("doc_id")
    ys = F.when(k % 4 == 0, F.array(*[F.lit(float(y)) for y in (100, 120, 140)])).otherwise(F.array(*[F.lit(float(y)) for y in (100, 120, 121, 140, 160, 180, 600)]))
    rules = s.select("doc_id", F.lit(1).alias("page_no"), F.explode(ys).alias("y"))
    word = lambda r, c, part: F.struct(F.lit(r * 10 + c * 2 + part).alias("seq"), F.lit(50.0 + 100 * c + 22 * part).alias("x0"), F.lit(105.0 + 20 * r).alias("y0"), F.lit(f"r{r}c{c}" if part == 0 else "x").alias("text"))
    words = s.select("doc_id", F.lit(1).alias("page_no"), F.explode(F.array(*[word(r, c, p) for r in range(4) for c in range(3) for p in range(2) if c < 2 or r != 1])).alias("w")).select("doc_id", "page_no", "w.*")
    words = words.withColumns({"x1": F.col("x0") + 20, "y1": F.col("y0") + 10})
    return Lo.lined_tables(rules, words)


def lined_tables(spark: SparkSession, d: str) -> DataFrame:
    return _lined(spark, d).select("doc_id", "page_no", "block_no", "top", "bottom", Lo.grid_text(F.col("grid")).alias("md"))


def detected_tables(spark: SparkSession, d: str) -> DataFrame:
    """Lined tables with candidates by text: one over the same place, one above, one too empty to be a table."""
    first = _lined(spark, d).select("doc_id", "page_no", "x0", F.col("top").alias("y0"), "x1", F.col("bottom").alias("y1"), "grid")
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("doc_id"))
    grid = lambda *rows: F.array(*[F.array(*map(F.lit, r)) for r in rows])
    cand = lambda y0, y1, g: F.struct(F.lit(y0).alias("y0"), F.lit(y1).alias("y1"), g.alias("grid"))
    cands = F.array(cand(110.0, 170.0, grid("ab", "cd")), cand(20.0, 60.0, grid("pq", "rs")), cand(300.0, 400.0, grid("xy    ", "w     ")))
    text = s.select("doc_id", F.lit(1).alias("page_no"), F.lit(0).alias("table_no"), F.lit(60.0).alias("x0"), F.lit(200.0).alias("x1"), F.explode(cands).alias("c")).select("*", "c.*").drop("c")
    found = Lo.detected_tables(first, Lo.accepted_text_tables(text))
    return found.select("doc_id", "page_no", "table_no", "y0", "y1", F.size("grid").alias("n_rows"))


def rule_lines(spark: SparkSession, d: str) -> DataFrame:
    """Drawings that count as table rules, and the clusters of the left edges of a page's horizontal ones."""
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.lit(1).alias("page_no"), (F.col("l_linenumber") * 2).cast("double").alias("x0"), (F.col("l_partkey") % 100).cast("double").alias("long"), (F.col("l_suppkey") % 3).cast("double").alias("width"))
    rule = Lo.is_rule(F.lit("h"), F.col("x0"), F.lit(0.0), F.col("x0") + F.col("long"), F.lit(1.0), F.col("width"))
    kept = li.where(rule)
    x = Lo.row_clusters(kept.select("doc_id", "page_no", F.col("x0").alias("y"))).groupBy("doc_id").agg(F.count("*").alias("edges"))
    return kept.groupBy("doc_id").agg(F.count("*").alias("rules")).join(x, "doc_id")


def tagged_reports(spark: SparkSession, d: str) -> DataFrame:
    """A report of each supplier in one of the three ways: key % 3 = 0 positional, 1 sized, 2 strong."""
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("doc_id"))
    k = F.col("doc_id").cast("string")
    head = "<html><head><style>.big{font-size:20px} .n{color:red;font-size:9.5pt}</style><title>t</title></head><body><ix:header>noise</ix:header><img src=x>"
    line = lambda y, fs, ff, text: f'<div class="t m0 x1 h2 y{y:x} ff{ff} fs{fs:x}">{text}</div>'
    running = "".join(line(60 + 100 * i, 1, 1, "Running") for i in range(3))
    positional = _say(head, line(130, 3, 1, "second"), line(100, 3, 1, 'fi<div class="_ _1"></div><div class="ff1 ls0">rst</div>'), line(10, 1, 1, "Title"), line(30, 3, 2, _MARK), line(110, 3, 1, "line"), line(112, 3, 1, "extra"), running, "<p>outside</p></body></html>")
    positional = F.replace(positional, F.lit(_MARK), F.concat(F.lit("Font "), k))
    sized = _say(head, '<div class="n">body one</div><div class="n"><span class="big">Heading ', k, '</span></div><div class="n">body &amp; two</div><table><tr><td>a</td><td>b</td></tr><tr><td>1</td><td>', k, "</td></tr></table>bare</body></html>")
    strong = _say(head, "<p><strong>Part ", k, "</strong></p><p>text</p><div>more</div></body></html>")
    return s.select("doc_id", Tg.tagged_to_markdown(F.when(F.col("doc_id") % 3 == 0, positional).when(F.col("doc_id") % 3 == 1, sized).otherwise(strong)).alias("md"))


_MARK = "@@"
NAMES = (tagged_reports, inline_facts, lined_tables, detected_tables, rule_lines, page_markdown, layout_document, text_marks, cell_amounts, zip_choice, convert_files, evaluation, company_list, sheet_totals, text_tables, largest_tables)
QUERIES = {f.__name__: f for f in NAMES}

CUST = "c AS (SELECT c_custkey AS doc_id, abs(round(c_acctbal * 100)::BIGINT) AS a FROM customer)"
ORACLES = {
    "tagged_reports": """SELECT s_suppkey AS doc_id, CASE s_suppkey % 3 WHEN 0 THEN concat_ws(chr(10), '## Title', '## Font ' || s_suppkey, 'Running', 'first line extra second', 'Running', 'Running', 'outside')
      WHEN 1 THEN concat_ws(chr(10), 'body one', '## Heading ' || s_suppkey, 'body & two', '| a | b |', '|---|---|', '| 1 | ' || s_suppkey || ' |', 'bare') ELSE concat_ws(chr(10), '## Part ' || s_suppkey, 'text', 'more') END AS md FROM supplier""",
    "inline_facts": """WITH o AS (SELECT o_orderkey, round(o_totalprice * 100)::BIGINT AS t FROM orders) SELECT o_orderkey, 0 AS pos, 'num' AS kind, 'Nil' AS concept, 'c0' AS context_ref, NULL AS unit_ref, '' AS text, NULL::DOUBLE AS value FROM o
      UNION ALL SELECT o_orderkey, 1, 'num', 'Cash', 'c1', 'JPY', '△' || t, t * 1000::DOUBLE FROM o UNION ALL SELECT o_orderkey, 2, 'num', 'Debt', 'c1', NULL, t::VARCHAR, -t::DOUBLE FROM o UNION ALL SELECT o_orderkey, 3, 'text', 'Policy', 'c2', NULL, 'Policy ' || o_orderkey, NULL FROM o""",
    "lined_tables": """SELECT s_suppkey AS doc_id, 1 AS page_no, 0::BIGINT AS block_no, 100::DOUBLE AS top, 180::DOUBLE AS bottom,
      concat_ws(chr(10), '| r0c0 x | r0c1 x | r0c2 x |', '| --- | --- | --- |', '| r1c0 x | r1c1 x |  |', '| r2c0 x | r2c1 x | r2c2 x |', '| r3c0 x | r3c1 x | r3c2 x |') AS md FROM supplier WHERE s_suppkey % 4 <> 0""",
    "detected_tables": """WITH t AS (SELECT s_suppkey AS doc_id, s_suppkey % 4 <> 0 AS lined FROM supplier), c AS (SELECT doc_id, lined, 20.0 AS y0, 60.0 AS y1, 2 AS n FROM t UNION ALL SELECT doc_id, lined, 100.0, 180.0, 4 FROM t WHERE lined UNION ALL SELECT doc_id, lined, 110.0, 170.0, 2 FROM t WHERE NOT lined)
      SELECT doc_id, 1 AS page_no, (row_number() OVER (PARTITION BY doc_id ORDER BY y0) - 1)::INT AS table_no, y0::DOUBLE AS y0, y1::DOUBLE AS y1, n AS n_rows FROM c""",
    "rule_lines": """WITH RECURSIVE r AS (SELECT l_orderkey AS doc_id, l_linenumber * 2 AS x FROM lineitem WHERE l_partkey % 100 > 50 AND l_suppkey % 3 < 1.5), k AS (SELECT doc_id, min(x) AS x FROM r GROUP BY doc_id
      UNION ALL SELECT k.doc_id, (SELECT min(r.x) FROM r WHERE r.doc_id = k.doc_id AND r.x - k.x >= 3) FROM k WHERE EXISTS (SELECT 1 FROM r WHERE r.doc_id = k.doc_id AND r.x - k.x >= 3))
      SELECT doc_id, a.rules, b.edges FROM (SELECT doc_id, count(*) AS rules FROM r GROUP BY doc_id) a JOIN (SELECT doc_id, count(*) AS edges FROM k GROUP BY doc_id) b USING (doc_id)""",
    "page_markdown": rf"""WITH {CUST} SELECT doc_id, concat_ws(chr(10) || chr(10), 'Chapter one12Item', '# Report ' || doc_id, '## Chapter one', 'text bold here', '## Chapter one', 'after' || chr(10) || 'it',
      '| Item |  | x\|y |' || chr(10) || '|---|---|---|' || chr(10) || '| cash | $' || a || ' |  |', '## Item 1. Own', 'last') AS md FROM c""",
    "layout_document": f"""WITH {CUST} SELECT doc_id, chr(10) || concat_ws(chr(10), '## 第一节 概况', 'alpha beta' || doc_id || '続く', '表一 明細', '**表一 明細**', '| 項目 | 金額 |', '| --- | --- |', '| a | ' || a || ' |',
      CASE WHEN doc_id % 3 <> 0 THEN '| 続 | 1 |' END, '| b | 2 |', '', '> 単位：千円', 'End.') AS md FROM c""",
    "text_marks": f"""WITH v(i, page_number, caption, quoted, space) AS (VALUES (0, true, true, '12', false), (1, true, true, '３ / 15', true), (2, false, true, '- 12 -', false), (3, false, true, '第3頁', false), (4, false, true, '表一 明細', false),
      (5, false, false, 'It ends.', false), (6, false, true, '{MARKS[6]}', false), (7, false, true, '> 単位：千円', false), (8, false, true, '> 单位: 万元', false), (9, false, true, '见单位：元', false), (10, false, true, 'x', true), (11, false, false, '{MARKS[11]}', true))
      SELECT v.* FROM v JOIN nation ON n_nationkey = i""",
    "cell_amounts": """WITH o AS (SELECT o_orderkey, o_orderkey AS k, round(o_totalprice * 100)::BIGINT AS t FROM orders), s AS (SELECT *, format('{:,}', t) AS g, CASE WHEN k % 3 = 0 THEN 1000::DOUBLE ELSE 1 END AS f, CASE WHEN k % 5 = 0 THEN -1::DOUBLE ELSE 1 END AS sg FROM o)
      SELECT o_orderkey, t * f * sg AS ixbrl, CASE WHEN k % 4 >= 2 AND t BETWEEN 10000 AND 999999999999 THEN t::DOUBLE END AS sheet, CASE WHEN k % 4 IN (0, 1) THEN -t ELSE t END * f * sg AS fact,
        CASE k % 4 WHEN 0 THEN '△' || g WHEN 1 THEN '(' || g || ')' WHEN 2 THEN '$ ' || g ELSE g END AS written FROM s""",
    "zip_choice": """SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 1 WHEN p_partkey % 7 = 0 THEN 0 ELSE 4 END AS members, p_partkey % 5 <> 0 AND p_partkey % 7 = 0 AS broken,
      CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 THEN 'x/0102010_b.htm' END AS largest, CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 7 <> 0 THEN 11 + length(p_partkey::VARCHAR) END AS bytes,
      CASE WHEN p_partkey % 5 = 0 THEN '' WHEN p_partkey % 7 <> 0 THEN p_partkey || '.xml' END AS main FROM part""",
    "convert_files": """WITH f AS (SELECT stock_code AS c, CASE WHEN exchange IN ('ksc', 'koe', 'knx') THEN 'dart_xml' WHEN exchange = 'jpx' THEN 'ixbrl_zip' WHEN exchange IN ('twse', 'tpex') THEN 'ixbrl' WHEN exchange = 'nse' THEN 'xbrl' WHEN exchange = 'br' THEN 'cvm_xml' ELSE 'unsupported' END AS format FROM issuers)
      SELECT c AS stock_code, format, CASE format WHEN 'dart_xml' THEN '# T ' || c || chr(10) || 'p' || chr(10) || '| a | 1 |' WHEN 'ixbrl' THEN '## ' || c || chr(10) || chr(10) || 'x' WHEN 'ixbrl_zip' THEN CASE WHEN c NOT LIKE '0%' THEN 'one ' || c || chr(10) || chr(10) || 'two ' || c END
        WHEN 'xbrl' THEN '- Revenue: ' || c WHEN 'cvm_xml' THEN '| DfConsolidadas | DemonstracaoResultado | 3 | R | Ultimo | ' || c || ' |' END AS md, format = 'unsupported' OR (format = 'ixbrl_zip' AND c LIKE '0%') AS failed FROM f""",
    "evaluation": f"""WITH {CUST}, t AS (SELECT doc_id, a * 2 + 7 >= 1000000 AS big, CASE doc_id % 5 WHEN 0 THEN 0 WHEN 1 THEN 60 ELSE 1 END AS n FROM c)
      SELECT doc_id, n::BIGINT AS n_labeled, CASE WHEN big AND n > 0 THEN (doc_id % 2)::DOUBLE END AS pdf_rate, CASE WHEN big AND n > 0 THEN n::BIGINT END AS pdf_tested, CASE WHEN big AND n > 0 THEN 1::DOUBLE END AS ixbrl_rate, CASE WHEN big AND n > 0 THEN n::BIGINT END AS ixbrl_tested,
        CASE WHEN big AND n > 0 THEN 1::DOUBLE END AS control_rate, CASE WHEN big AND n > 0 THEN n::BIGINT END AS control_tested, n = 60 AS suspect_input_mismatch, n = 0 AS not_measurable FROM t""",
    "company_list": "SELECT corp_code, corp_name, stock_code, corp_cls, CASE corp_cls WHEN 'Y' THEN 'ksc' ELSE 'koe' END AS exchange FROM issuers WHERE corp_code IS NOT NULL AND corp_cls IN ('Y', 'K')",
    "sheet_totals": f"""WITH {CUST} SELECT doc_id, 'assets' AS kind, '資產總計' AS name, (a + 10000)::DOUBLE AS amount FROM c UNION ALL SELECT doc_id, 'liab', '0.772xxx負債總計', (a + 10001)::DOUBLE FROM c
      UNION ALL SELECT doc_id, 'equity', '股東權益淨額', (a + 10002)::DOUBLE FROM c WHERE doc_id % 4 <> 1""",
    "text_tables": """WITH g AS (SELECT l_orderkey AS doc_id, l_linenumber AS table_no, min(l_partkey) AS p FROM lineitem GROUP BY ALL),
      x AS (SELECT *, (p % 3 > 0)::INT + ((p + 1) % 3 > 0)::INT + ((p + 4) % 3 > 0)::INT AS n1, ((p + 2) % 3 > 0)::INT + (p % 5 > 1)::INT AS n2 FROM g)
      SELECT doc_id, table_no, 2 AS n_rows FROM x WHERE n1 > 0 AND n2 > 0 AND greatest(n1, n2) >= 2 AND (n1 + n2) / 6 >= 0.5""",
    "largest_tables": """WITH t AS (SELECT l_orderkey AS doc_id, l_linenumber AS table_no, (min(l_partkey) % 5 + 1) * (min(l_suppkey) % 4 + 1) AS area FROM lineitem GROUP BY ALL), o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY area DESC, table_no) - 1 AS place FROM t)
      SELECT doc_id, place::INT AS place, table_no, area FROM o WHERE place < 3""",
}
