import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import filings, numbers
from ledgerloom.operators import layout, lines, referee, sections, tables, xbrl
from ledgerloom.sources import markup, sinks
from ledgerloom.streaming import incremental


def one(spark, col, **values):
    return spark.createDataFrame([tuple(values.values())], list(values)).select(col).first()[0]


@pytest.mark.parametrize(
    ("text", "lenient", "strict"),
    [("1,939,113,415.03", 1939113415.03, 1939113415.03), ("(219,132)", -219132.0, -219132.0), ("$29,915,841", 29915841.0, 29915841.0), ("-", None, None), ("△5", 5.0, None), ("12,34", 1234.0, None), ("", None, None), ("−7", -7.0, -7.0), ("n/a", None, None)],
)
def test_cell_numbers(spark, text, lenient, strict):
    assert one(spark, numbers.num_lenient(F.col("t")), t=text) == lenient
    assert one(spark, numbers.num_strict_cell(F.col("t")), t=text) == strict


def test_fact_numbers(spark):
    f = lambda t, s, g: one(spark, numbers.num_xbrl_fact(F.col("t"), F.col("s"), F.col("g")), t=t, s=s, g=g)
    assert f("(1,000)", "3", "") == -1e6 and f("△５", "0", "-") == 5.0 and f("1 2a", "0", "") is None
    assert one(spark, numbers.num_ixbrl_cell(F.col("t"), F.lit("3"), F.lit("-")), t="(12)") == -12000.0
    assert one(spark, numbers.amount_bs(F.col("t")), t="$12,345") == 12345.0 and one(spark, numbers.amount_bs(F.col("t")), t="1234") is None
    assert one(spark, numbers.fmt_int(F.col("t")), t="1234567") == "1,234,567" and one(spark, numbers.fmt_int(F.col("t")), t="1.5") == "1.5"
    assert one(spark, numbers.numbers_in(F.col("t")), t="損失△1,200 と 3.5% (７)") == [-1200.0, 3.5, -7.0]
    assert one(spark, numbers.numeric_hit(F.array(F.lit(5.0), F.lit(-2000.0)), F.col("v"), F.lit("x")), v=2e6)


DOC = "doc_id bigint, market string, doc_type string, report_period string, md string, extra string"


def docs(spark, *mds):
    return spark.createDataFrame([(i, "cn", "annual", "2021-12-31", m, "x") for i, m in enumerate(mds)], DOC)


def test_tables_keep_escaped_pipes_and_skip_rules(spark):
    md = "t\n| a | b |\n| --- | --- |\n| x\\|y | 1 |\n\n| lone |\n"
    got = [(r["row_no"], r["cells"]) for r in tables.table_rows(docs(spark, md, None, "")).orderBy("row_no").collect()]
    assert got == [(0, ["a", "b"]), (1, ["x\\|y", "1"])]


def test_metrics_skip_where_nothing_is_measured(spark):
    d = docs(spark, "", "no tables here", None)
    assert {r["status"] for r in tables.identity(d).collect()} == {"skip"}
    assert tables.footing(d).count() == 0 and tables.articulation(d).count() == 0
    assert {r["status"] for r in lines.fragmentation(d).collect()} == {"skip"}
    assert {r["status"] for r in lines.script_profile(d.where("md IS NOT NULL")).collect()} == {"skip"}


def test_footing_ignores_the_order_of_addends(spark):
    rows = ["| a | 10 |", "| b | 20 |", "| c | 12 |"]
    random.Random(2).shuffle(rows)
    ok = tables.footing(docs(spark, "\n".join(["| 项目 | 额 |", *rows, "| 合计 | 42 |"]), "\n".join(["| 项目 | 额 |", *rows, "| 合计 | 60 |"]))).orderBy("doc_id").collect()
    assert (ok[0]["labeled_tested"], ok[0]["labeled_passed"], ok[1]["labeled_passed"], ok[1]["worst_residual"]) == (1, 1, 0, 18.0)


def test_markdown_fixpoint(spark):
    md = "| a | b |\n| --- | --- |\n| x | 1 |\n| y | 2 |"
    r = tables.table_rows(docs(spark, md))
    cells = r.select("doc_id", "row_no", F.posexplode("cells").alias("col_no", "text"))
    assert tables.pipe_markdown(cells, ["doc_id"]).first()["md"] == md


def test_more_documents_leave_a_document_alone(spark):
    a = lines.duplication(docs(spark, "a line of some twenty characters\n" * 3)).first()
    b = {r["doc_id"]: r for r in lines.duplication(docs(spark, "a line of some twenty characters\n" * 3, "a line of some twenty characters\n" * 3)).collect()}
    assert (a["lines"], a["repeated"]) == (3, 2) == (b[0]["lines"], b[0]["repeated"]) == (b[1]["lines"], b[1]["repeated"])


def test_private_use_beyond_the_first_plane(spark):
    r = lines.garbled(docs(spark, "a\U000f0001�\x07\n")).first()
    assert (r["private_use"], r["replacement"], r["control"]) == (2, 1, 1)


def test_row_clusters_are_anchored(spark):
    r = random.Random(5)
    data = [(i, 1, float(r.randint(0, 40))) for i in range(20) for _ in range(12)]
    got = {}
    for x in layout.row_clusters(spark.createDataFrame(data, "doc_id int, page_no int, y double")).collect():
        got.setdefault(x["doc_id"], []).append(x["y"])
    for i in range(20):
        want = []
        for y in sorted(v for d, _, v in data if d == i):
            if not want or y - want[-1] >= 3:
                want.append(y)
        assert sorted(got[i]) == want


def test_paragraphs_and_candidates(spark):
    b = spark.createDataFrame([(1, 1, 0, 10.0, "p", "one"), (1, 1, 1, 12.0, "p", "two"), (1, 1, 2, 25.0, "p", "three."), (1, 1, 3, 40.0, "p", "four"), (1, 1, 4, 45.0, "h2", "Head")], "doc_id int, page_no int, seq int, y0 double, kind string, text string")
    assert [r["text"] for r in layout.merged_lines(b).orderBy("par_no").collect()] == ["one two three. four", "Head"]
    c = spark.createDataFrame([(1, 1, 0, 0.0, 0.0, 10.0, 10.0, 3), (1, 1, 1, 1.0, 0.0, 10.0, 10.0, 2), (1, 1, 2, 20.0, 0.0, 30.0, 10.0, 2)], "doc_id int, page_no int, seq int, x0 double, y0 double, x1 double, y1 double, ncols int")
    assert [r["seq"] for r in layout.kept_candidates(c).orderBy("seq").collect()] == [0, 2]


def test_three_page_table_is_one_chain(spark):
    t = spark.createDataFrame([(1, p, 10.0, 790.0, 3, 2, 800.0) for p in (1, 2, 3)] + [(1, 5, 10.0, 790.0, 3, 2, 800.0)], "doc_id int, page_no int, y0 double, y1 double, ncols int, nrows int, height double")
    assert sorted(r["count"] for r in layout.stitched(t).groupBy("chain").count().collect()) == [1, 3]


def test_html_grid_spans_and_nesting():
    g = markup.html_grid("<table><tr><td rowspan=2>a</td><td>b<table><tr><td>in</td></tr></table></td></tr><tr><td colspan='2'>c</td></tr></table>")
    assert {(t, r, c): x for t, r, c, x, *_ in g} == {(0, 0, 0): "a", (0, 0, 1): "b", (0, 1, 0): "a", (0, 1, 1): "c", (0, 1, 2): "c", (1, 0, 0): "in"}
    assert markup.html_grid("<table><tr><td>open") == [(0, 0, 0, "open", 0, 0)]
    assert markup.html_grid("<meta><p>no table</p>") == []


def test_malformed_xml_keeps_its_text():
    b = markup.xml_blocks("<DOCUMENT><SECTION-1><TITLE>T</TITLE>\n<P>< note > R&D</P><TABLE><TR><TD>a</TD><TE>1</TE></TR></TABLE>")
    assert [(k, lv, t) for _, k, lv, t in b] == [("heading", 1, "T"), ("p", 0, "< note > R&D"), ("row", 0, "a | 1")]
    assert markup.xml_blocks(None) == markup.xml_blocks("") == []


def test_zip_sources_and_charsets(spark):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for n, t in (("a/0000000_h.htm", "head"), ("a/0101010_x.htm", "one"), ("a/0102010_y.html", "two"), ("7.xml", "main"), ("big.xhtml", "b" * 99)):
            z.writestr(n, t)
    files = spark.createDataFrame([(7, buf.getvalue()), (8, b"plain"), (9, b"PKbroken"), (10, None)], "key bigint, content binary")
    m = markup.zip_members(files, "key")
    assert {r["key"]: r["error"] is not None for r in m.where("error IS NOT NULL OR name = ''").collect()} == {8: False, 9: True}
    assert {r["key"]: r["html"] for r in markup.chapters(m, "key").collect()} == {7: "one\ntwo"}
    assert markup.largest_page(m, "key").first()["name"] == "big.xhtml"
    assert {r["key"]: r["name"] for r in markup.main_or_first(m, "key").collect()} == {7: "7.xml", 8: ""}
    raw = spark.createDataFrame([(1, "한글 é".encode()), (2, "한글 문서".encode("cp949")), (3, None)], "id int, c binary")
    assert [r[0] for r in raw.orderBy("id").select(markup.decoded(F.col("c"))).collect()] == ["한글 é", "한글 문서", None]


def test_filing_functions(spark):
    f = lambda c, v: one(spark, c(F.col("v")), v=v)
    assert f(filings.disclosure_type, "[첨부정정]사업보고서 (2019.12)") is None and f(filings.disclosure_type, "분기보고서 (2007.09)") == "q3"
    assert str(f(filings.period_of, "사업보고서 (2020.06)")) == "2020-06-30" and f(filings.period_of, "x (2020.07)") is None
    assert f(filings.sane_xml, "R&D < 5 &amp; <P>\x01") == "R&amp;D &lt; 5 &amp; <P>"
    assert f(filings.format_of, "lse") == "esef" and f(filings.format_of, "otc") == "unsupported"
    assert f(filings.front_matter, "---\na: 1\n---\nbody") == "body"
    assert f(filings.is_page_number, "12 / 30") and not f(filings.is_page_number, "- 12 -") and not f(filings.is_page_number, "12 items")
    d = spark.createDataFrame([(1, 'a"b', None, "x\n\n\n\ny")], "doc_id int, code string, title string, md string")
    assert sinks.with_front_matter(d, ["code", "title"]).first()["md"] == '---\ncode: "a\\"b"\n---\nx\n\ny'


def test_inline_facts_and_contexts(spark):
    h = '<ix:nonFraction name="p:A" contextRef="c1" scale="3" sign="-"/><ix:nonFraction name="p:B" contextRef="c1" unitRef="JPY">1,<b>2</b></ix:nonFraction><xbrli:context id="c1"><xbrli:period><xbrli:instant>2021-03-31</xbrli:instant></xbrli:period><xbrldi:explicitMember dimension="ax">mem</xbrldi:explicitMember></xbrli:context>'
    d = spark.createDataFrame([(1, h), (2, None)], "id int, html string")
    assert [(r["concept"], r["text"], r["value"]) for r in xbrl.inline_facts(d, "id").orderBy("pos").collect()] == [("A", "", None), ("B", "1,2", 12.0)]
    c = xbrl.inline_contexts(d.where("html IS NOT NULL"), "id").first()
    assert str(c["instant"]) == "2021-03-31" and c["dims"] == {"ax": "mem"}


def test_pairing_statuses_and_scale(spark):
    d = docs(spark, "| 現金 | 5,000 |\n| 他 | 77 |\n| 売掛金 | 9 |")
    t = spark.createDataFrame([(0, 1, "現金", 5e6), (0, 2, "売掛金", 77e6), (0, 3, "無し", 5e6), (0, 4, "売掛金", 123e6), (0, 5, "現金", 10.0)], "doc_id bigint, fact_no int, label string, value double")
    assert {r["fact_no"]: r["status"] for r in referee.pairing(d, t).collect()} == {1: "hit", 2: "value_elsewhere", 3: "label_missing", 4: "value_absent"}
    assert referee.value_recall(d, t).first()["hits"] == 3


def test_section_ties_and_templates(spark):
    d = docs(spark, "## 公司治理\n## 公司业务概要\n", "第一节 重要提示、目录和释义\n## 第二节 财务报告......12\n第三节\n### 第四节 企业文化 建设\r\n", "第一节 致股东\n", "").withColumn("market", F.when(F.col("market").isNotNull(), "ashare"))
    assert [r["concept"] for r in sections.map_sections(d).where("doc_id = 0").orderBy("line_no").collect()] == ["governance", "business_overview"]
    got = {r["doc_id"]: r for r in sections.check_templates(d).collect()}
    assert (got[1]["version"], got[1]["expected"], got[1]["found"], got[1]["extra"]) == ("2021", 10, 1, ["企业文化建设"]) and len(got[1]["missing"]) == 9
    assert got[2]["reason"] == "off_template" and got[2]["ratio"] is None and got[3]["found"] == 0 and len(got[3]["missing"]) == 10
    half = sections.check_templates(d.withColumn("doc_type", F.lit("semiannual")).withColumn("report_period", F.lit("2016-06-30"))).first()
    assert half["reason"] == "no_template" and sections.check_templates(d.limit(0)).count() == 0


def test_incremental(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "a")], "doc_id int, md string").write.parquet(src)
    run = lambda: incremental.ingest(spark, src, "doc_id int, md string", str(tmp_path / "out"), str(tmp_path / "ck"), lambda b: b)
    run()
    spark.createDataFrame([(2, "b")], "doc_id int, md string").write.mode("append").parquet(src)
    run()
    run()
    assert sorted(r["doc_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]
    v = spark.createDataFrame([(1, 20), (2, None), (3, 19)], "doc_id int, converter_version int")
    assert sorted(r["doc_id"] for r in incremental.stale(v, 20).collect()) == [2, 3]
    assert [r["doc_id"] for r in incremental.todo(v, v.where("doc_id < 3"), "doc_id").collect()] == [3]


def test_bytes_and_results_are_kept_once(spark, tmp_path):
    f = spark.createDataFrame([(1, "jpx", b"a"), (1, "jpx", b"a"), (2, "twse", b"b"), (3, "twse", None)], "doc_id int, exchange string, content binary")
    for d in (f, f, f.limit(0), spark.createDataFrame([(1, "jpx", b"new")], f.schema)):
        incremental.keep_bytes(d, str(tmp_path / "bronze"))
    assert sorted((r["doc_id"], bytes(r["content"]), r["exchange"], r["bytes"]) for r in spark.read.parquet(str(tmp_path / "bronze")).collect()) == [(1, b"a", "jpx", 1), (1, b"new", "jpx", 3), (2, b"b", "twse", 1)]
    r = spark.createDataFrame([(1, "x", None), (2, None, "failed")], "doc_id int, md string, error string")
    sinks.append_good(r, str(tmp_path / "good"))
    assert [tuple(x) for x in spark.read.parquet(str(tmp_path / "good")).collect()] == [(1, "x")]
    sinks.append_json(r, str(tmp_path / "json"), "y")
    assert {x["doc_id"]: x["variant"] for x in spark.read.json(str(tmp_path / "json")).collect()} == {1: "y", 2: "y"}


def test_lined_tables_from_rules_and_words(spark):
    rules = spark.createDataFrame([(1, 1, float(y)) for y in (10, 30, 50, 70)] + [(2, 1, 10.0), (2, 1, 30.0)], "doc_id int, page_no int, y double")
    words = [(1, 1, i, x, y, x + 20, y + 10, t) for i, (x, y, t) in enumerate([(10.0, 15.0, "a"), (200.0, 15.0, "b"), (10.0, 35.0, "c|d"), (10.0, 500.0, "far")])] + [(2, 1, 9, 10.0, 15.0, 30.0, 25.0, "few")]
    w = spark.createDataFrame(words, "doc_id int, page_no int, seq int, x0 double, y0 double, x1 double, y1 double, text string")
    got = layout.lined_tables(rules, w).select("doc_id", "grid", layout.grid_text(F.col("grid")).alias("md")).collect()
    assert [(r["doc_id"], r["grid"], r["md"]) for r in got] == [(1, [["a", "b"], ["c|d", ""]], "| a | b |\n| --- | --- |\n| c\\|d |  |")]
    assert layout.lined_tables(rules.limit(0), w).count() == 0


def test_eligible_gives_the_first_reason(spark):
    a = spark.createDataFrame([(1, None), (2, "no_text"), (3, None), (4, None)], "doc_id int, reason string")
    v = spark.createDataFrame([(2, "incomplete"), (3, "inconsistent"), (4, None)], "doc_id int, skip_reason string")
    c = spark.createDataFrame([(4, True), (4, False), (1, False)], "doc_id int, excluded boolean")
    assert {r["doc_id"]: r["skip_reason"] for r in referee.eligible(a, v, c).collect()} == {1: None, 2: "no_text", 3: "inconsistent", 4: "restatement_cliff"}
