from pyspark.sql import functions as F

from ledgerloom.operators import convert, layout
from ledgerloom.sources import markup, pages, tagged


def test_headings_are_short_and_end_without_a_mark(spark):
    rows = [("第1【企業の概況】", 9.0, "Mincho"), ("第三节 公司业务", 9.0, ""), ("Bold heading", 14.0, "Times-Bold"), ("Bold sentence.", 14.0, "Times-Bold"), ("一、子目", 12.0, "Song"), ("x" * 41, 14.0, "Bold"), ("plain", 9.0, None)]
    d = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, text string, size double, font string")
    got = [r[0] for r in d.orderBy("i").select(convert.block_kind(F.col("text"), F.col("size"), F.col("font"))).collect()]
    assert got == ["h2", "h2", "h2", "p", "h3", "p", "p"]


def test_signs_join_their_amounts_in_place(spark):
    d = spark.createDataFrame([(["a", "$", "5", "$", "", "¥", "¥", "7"],), ([],), (["$"],)], "c array<string>")
    assert [r[0] for r in d.select(convert.merged_signs(F.col("c"))).collect()] == [["a", "$5", "", "$", "", "¥", "¥7", ""], [], ["$"]]


def test_cvm_and_fonts(spark):
    x = "<DfConsolidadas><DemonstracaoResultado><Conta><CodigoConta>3</CodigoConta><DescricaoConta>R</DescricaoConta><Ultimo>5</Ultimo><Outro> </Outro></Conta></DemonstracaoResultado></DfConsolidadas>"
    d = spark.createDataFrame([(1, x), (2, None), (3, "<broken")], "id int, xml string")
    assert [tuple(r) for r in convert.cvm_accounts(d, "id", "xml").collect()] == [(1, "DfConsolidadas", "DemonstracaoResultado", 0, "3", "R", "Ultimo", "5")]
    assert convert.cvm_accounts(d.limit(0), "id", "xml").count() == 0


def test_html_pages_survive_void_elements_and_contents(spark):
    page = '<html><head><title>t</title></head><body><meta name="x"><link rel="y"><a href="#c1">Chapter one</a><a href="#c1">12</a><div id="c1"><p>text</p><script>var t="</p>"</script><ul><li>item</li></ul><table><tr><td>1</td></tr></table><table><tr><td rowspan=2>a</td><td>$</td><td>5</td></tr><tr><td>b<table><tr><td>in</td></tr><tr><td>ner</td></tr></table></td></tr></table><h3>H</h3></div><p>open'
    assert [(k, lv, t) for _, k, lv, t in markup.page_blocks(page)] == [("p", 0, "Chapter one12"), ("h", 2, "Chapter one"), ("p", 0, "text"), ("li", 0, "item"), ("table", 0, "| a | $5 |  |\n|---|---|---|\n| a | b |  |"), ("table", 0, "| in |\n|---|\n| ner |"), ("h", 3, "H"), ("p", 0, "open")]


def test_page_body_keeps_text_beside_tables(spark):
    cols = "doc_id int, page_no int, seq int, x0 double, y0 double, x1 double, y1 double, text string, height double"
    b = spark.createDataFrame([(1, 1, 0, 10.0, 10.0, 50.0, 20.0, "running head", 800.0), (1, 1, 1, 10.0, 12.0, 50.0, 20.0, "第1【概況】", 800.0), (1, 1, 2, 10.0, 100.0, 50.0, 110.0, "in", 800.0), (1, 1, 3, 200.0, 100.0, 250.0, 110.0, "beside", 800.0), (1, 1, 4, 10.0, 730.0, 20.0, 738.0, "12", 800.0)], cols)
    t = spark.createDataFrame([(1, 1, 0.0, 90.0, 100.0, 200.0)], "doc_id int, page_no int, x0 double, y0 double, x1 double, y1 double")
    assert sorted(r["seq"] for r in convert.page_body(b, t).collect()) == [1, 3]
    assert sorted(r["seq"] for r in convert.page_body(b, t.limit(0)).collect()) == [1, 2, 3]


def test_scorecard_has_every_document(spark):
    d = spark.createDataFrame([(1, "jp", "text"), (2, "jp", ""), (3, "kr", None)], "doc_id int, market string, md string")
    got = {r["doc_id"]: r for r in convert.scorecard(d).collect()}
    assert set(got) == {1, 2} and got[1]["identity"] == "skip" and got[1]["footing"] is None


def test_anchors_name_headings_whatever_their_place(spark):
    page = '<a id="x"></a><p><b>Title again</b></p><p><strong>and again</strong></p><p>body</p><p id="y">Item 1. Full</p><p>z<table><tr><td>open<a href="#x">Contents title</a><a href="#y">short</a>'
    assert [(k, lv, t) for _, k, lv, t in markup.page_blocks(page)] == [("h", 2, "Contents title"), ("p", 0, "body"), ("h", 2, "Item 1. Full"), ("p", 0, "z")]
    assert markup.page_markdown(None) is None and markup.page_markdown("") == ""
    assert markup.contents_titles('<a href="#a">' + "<b>" * 3000) == {} and markup.contents_titles("<a href='#q'>7</a><a href='#q'>Seven &amp; eight</a>") == {"q": "Seven & eight"}


def test_files_go_to_their_converters(spark, tmp_path):
    for folder, name, data in (("twse", "a.html", b"<p>one</p>"), ("ksc", "b.xml", "<P>한글</P>".encode("cp949")), ("jpx", "c.zip", b"PKbroken"), ("sse", "d.pdf", b"%PDF"), ("br", "e.xml", b"<x/>")):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / name).write_bytes(data)
    got = {r["format"]: (r["md"], r["error"]) for r in convert.convert_files(convert.files_of(spark, str(tmp_path))).collect()}
    assert got["ixbrl"] == ("one", None) and got["dart_xml"] == ("한글", None) and got["layout"] == (None, "no converter: layout") and got["cvm_xml"] == (None, "nothing to read")
    assert got["ixbrl_zip"][0] is None and "BadZipFile" in got["ixbrl_zip"][1]
    more = convert.CONVERTERS | {"layout": lambda f: f.select("doc_id", F.lit("mine").alias("md"))}
    assert {r["format"]: r["md"] for r in convert.convert_files(convert.files_of(spark, str(tmp_path)), more).collect()}["layout"] == "mine"


def test_a_broken_metric_hinders_no_other(spark):
    d = spark.createDataFrame([(1, "jp", "text\ntext\n")], "doc_id int, market string, md string")
    r = convert.scorecard(d, convert.METRICS | {"wrong": lambda x: x.select("doc_id", "no_such_column")}).first()
    assert r["errors"].startswith("wrong: ") and r["identity"] == "skip" and r["section_count"] is not None


def test_text_tables_need_half_of_their_cells(spark):
    g = "doc_id int, table_no int, grid array<array<string>>"
    d = spark.createDataFrame([(1, 0, [["a", "b"], [None, "c"]]), (2, 0, [["a", "", "", ""], ["b", "c", "", ""], ["d", "", "", ""]]), (3, 0, [["a", "b"], ["", " "]]), (4, 0, []), (5, 0, None)], g)
    assert [r["doc_id"] for r in layout.accepted_text_tables(d).collect()] == [1]


def test_totals_end_at_the_next_code(spark):
    rows = lambda *ls: spark.createDataFrame(list(enumerate(ls)), "line_no int, line string").withColumn("doc_id", F.lit(1))
    got = layout.balance_totals(rows("非流動資產合計", "11,111", "資產總額", "$ 22,222", "2XXX", "33,333", "權益總計", "1100", "44,444"))
    assert {r["kind"]: (r["name"], r["amount"]) for r in got.collect()} == {"assets": ("資產總額", 22222.0), "liab": ("負債總計", 33333.0)}


def test_tagged_reports_of_odd_shape():
    f = tagged.tagged_markdown
    assert f(None) is None and f("") == "" and f("plain") == "plain" and f("<table><tr><td>x") == ""
    assert f("<strong>A</strong>b") == "## A\nb" and f('<div class="charStyle-1"><strong>A</strong></div>b') == "A\nb"
    page = "<style>.h{font-size:12pt}.b{font-size:9px}</style>" + '<div class="b">x</div>' * 3 + f'<div class="h">{"long " * 20}</div><div class="h">Head</div>'
    assert f(page).split("\n") == ["x", "x", "x", ("long " * 20).strip(), "## Head"]
    assert f("<ix:hidden><div>no</div></ix:hidden><div>yes</div><ix:nonFraction>1</ix:nonFraction>") == "yes\n1"


def test_stored_layout_becomes_a_document(spark, tmp_path):
    b = spark.createDataFrame([(1, 1, 0, 50.0, 100.0, 90.0, 110.0, "text", 800.0, 9.0, "Mincho", "x")], "doc_id bigint, page_no int, seq int, x0 double, y0 double, x1 double, y1 double, text string, height double, size double, font string, more string")
    b.write.parquet(str(tmp_path / "blocks"))
    t = spark.createDataFrame([(1, 1, 0, 40.0, 200.0, 400.0, 300.0, 800.0, [["a", "b"], ["c", None]])], pages.RELATIONS["tables"])
    t.write.json(str(tmp_path / "tables"))
    read = lambda n, f: pages.layout_relation(spark, str(tmp_path), n, f)
    assert convert.layout_document(read("blocks", "parquet"), read("tables", "json")).first()["md"] == "text\n| a | b |\n| --- | --- |\n| c |  |\n"
    spark.createDataFrame([(1, "w")], "doc_id int, text string").write.parquet(str(tmp_path / "words"))
    assert read("words", "parquet").dtypes == [tuple(c.split()) for c in pages.RELATIONS["words"].split(", ")] and read("words", "parquet").first()["x0"] is None
