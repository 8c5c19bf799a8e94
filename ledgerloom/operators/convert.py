"""Converters as plans: layout pages, tagged layout (ESEF), statements in CVM XML, generic XBRL, HTML pages; and the scorecard over their output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.filings import format_of, is_page_number, quoted_units
from ledgerloom.operators import layout, lines, tables, xbrl
from ledgerloom.session import merged
from ledgerloom.sources import markup, tagged

#: Enumerations and chapter marks that make a heading.
CHAPTER_MARK = r"^第[^【]{1,5}【|^第[一二三四五六七八九十0-9]+[节章]"
SUB_MARK = r"^[\s　]*(?:[一二三四五六七八九十]+、|（[一二三四五六七八九十]+）|[0-9]+、)\s*\S"
BOLD = r"黑|[Hh]ei|Goth|ゴ|[Bb]old"
SENTENCE_END = r"[。；，、．.,;]$"
#: Labels of total assets that a balance sheet must show.
BALANCE = "资产总计|资产合计|资产总额|資産合計|資產總計|자산총계"
#: Suffixes of vendor symbols; exchanges without one have no symbol.
SUFFIX = {"sse": "SS", "szse": "SZ", "jpx": "T", "ksc": "KS", "koe": "KQ", "twse": "TW", "tpex": "TWO"}


def block_kind(text: Column, size: Column, font: Column) -> Column:
    """h2 for chapter headings, h3 for enumerated ones, else p."""
    short = (F.char_length(text) <= 40) & ~text.rlike(SENTENCE_END)
    head = short & (F.trim(text).rlike(CHAPTER_MARK) | ((size >= 12.0) & F.coalesce(font, F.lit("")).rlike(BOLD)))
    return F.when(head, "h2").when((F.char_length(text) <= 40) & text.rlike(SUB_MARK) & (size >= 12.0), "h3").otherwise("p")


def page_body(blocks: DataFrame, table_boxes: DataFrame, header: float = 55.0, footer: float = 60.0, number: float = 75.0, slack: float = 2.0) -> DataFrame:
    """Blocks outside the header and footer bands (unless they are chapter headings), without page numbers at the foot and without those inside a table."""
    mark = F.col("text").rlike(CHAPTER_MARK)
    kept = blocks.where(mark | ((F.col("y0") >= header) & (F.col("y0") <= F.col("height") - footer)) | F.col("y0").isNull())
    kept = kept.where(~((F.col("y0") > F.col("height") - number) & is_page_number(F.col("text"))))
    b, t = kept.alias("b"), table_boxes.alias("t")
    inside = (F.col("b.x0") >= F.col("t.x0") - slack) & (F.col("b.y0") >= F.col("t.y0") - slack) & (F.col("b.x1") <= F.col("t.x1") + slack) & (F.col("b.y1") <= F.col("t.y1") + slack)
    return b.join(t, (F.col("b.doc_id") == F.col("t.doc_id")) & (F.col("b.page_no") == F.col("t.page_no")) & inside, "left_anti")


def in_order(blocks: DataFrame, strategy: str = "natural") -> DataFrame:
    """Blocks numbered in reading order: y, natural (as the layout gives them) or column (left column first, then y)."""
    if strategy == "column":
        blocks = blocks.join(layout.column_split(blocks), ["doc_id", "page_no"], "left")
        keys = [F.when(F.col("mid").isNull() | (F.col("x0") < F.col("mid")), 0).otherwise(1), "y0", "x0", "seq"]
    else:
        keys = ["y0", "seq"] if strategy == "y" else ["seq"]
    return blocks.withColumn("pos", F.row_number().over(Window.partitionBy("doc_id").orderBy("page_no", *keys)))


def layout_markdown(blocks: DataFrame, strategy: str = "natural") -> DataFrame:
    """Markdown of layout blocks (doc_id, page_no, seq, x0, y0, kind, text): ordered, merged to paragraphs and rendered. Blocks of kind table stay as they are."""
    o = in_order(blocks, strategy).select("doc_id", "page_no", F.col("pos").cast("int").alias("seq"), "y0", "kind", "text")
    m = layout.merged_lines(o)
    line = F.concat(F.when(F.col("kind") == "h2", "\n## ").when(F.col("kind") == "h3", "\n### ").otherwise(""), "text", F.when(F.col("kind") == "table", "\n").otherwise(""))
    per = m.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_no", "par_no", line.alias("line")))).alias("ls"))
    return per.select("doc_id", quoted_units(F.regexp_replace(F.array_join(F.transform("ls", lambda x: x["line"]), "\n"), r"\n{3,}", "\n\n")).alias("md"))


def layout_document(blocks: DataFrame, tables_: DataFrame, strategy: str = "y") -> DataFrame:
    """Markdown of whole layout documents.

    blocks: doc_id, page_no, seq, x0, y0, x1, y1, height, size, font, text. tables_: doc_id, page_no,
    table_no, x0, y0, x1, y1, height, grid (rows of cells). Headers, footers, page numbers and text
    inside tables go; tables that run over pages are one, under the caption above their first part.
    """
    body = page_body(blocks, tables_)
    body = body.withColumn("kind", block_kind(F.col("text"), F.col("size"), F.col("font")))
    whole = layout.stitched_grids(tables_).join(layout.captions(tables_, body), ["doc_id", "page_no", "table_no"], "left")
    said = F.regexp_replace("caption", r"\s+", " ")
    said = F.when(F.char_length(said) > 80, F.concat(F.substring(said, 1, 80), F.lit("…"))).otherwise(said)
    text = F.concat(F.coalesce(F.concat(F.lit("**"), said, F.lit("**\n")), F.lit("")), layout.grid_text(F.col("grid")))
    boxes = tables_.select("doc_id", "page_no", "table_no", "x0")
    t = whole.join(boxes, ["doc_id", "page_no", "table_no"]).select("doc_id", "page_no", (F.lit(1_000_000) + F.col("table_no")).cast("int").alias("seq"), "x0", "y0", F.lit("table").alias("kind"), text.alias("text"))
    return layout_markdown(body.select("doc_id", "page_no", F.col("seq").cast("int").alias("seq"), "x0", "y0", "kind", "text").unionByName(t), strategy)


def tagged_headings(spans: DataFrame) -> DataFrame:
    """Headings of tagged layout: another size than the document's most frequent, at most 80 characters, no bare number, and not repeated on page after page."""
    doc = Window.partitionBy("doc_id")
    size = spans.groupBy("doc_id", "size").agg(F.count("*").alias("c"), F.min(F.struct("page_no", "seq")).alias("first"))
    body = size.groupBy("doc_id").agg(F.max_by("size", F.struct("c", (-F.col("first.page_no")).alias("p"), (-F.col("first.seq")).alias("s"))).alias("body"))
    s = spans.withColumn("times", F.count("*").over(Window.partitionBy("doc_id", "text"))).join(body, "doc_id")
    head = (F.col("size") > F.col("body")) & (F.col("times") <= 2) & (F.char_length("text") <= 80) & ~F.col("text").rlike("^[0-9]+$")
    return s.withColumn("n", F.count("*").over(doc)).where(head).select("doc_id", "page_no", "seq", "text", "body")


def flow_paragraphs(spans: DataFrame, gap: float = 20.0) -> DataFrame:
    """Spans joined to paragraphs: a gap of more than `gap` in height, or a new page, starts one."""
    w = Window.partitionBy("doc_id").orderBy("page_no", "y0", "seq")
    brk = F.coalesce(((F.col("y0") - F.lag("y0").over(w)) > gap) | (F.col("page_no") != F.lag("page_no").over(w)), F.lit(True)).cast("int")
    s = spans.withColumn("brk", brk).withColumn("par", F.sum("brk").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    per = s.groupBy("doc_id", "par").agg(F.array_sort(F.collect_list(F.struct("page_no", "y0", "seq", "text"))).alias("ts"))
    return per.select("doc_id", "par", F.array_join(F.transform("ts", lambda t: t["text"]), " ").alias("text"))


def font_sizes(css: Column) -> Column:
    """Font size by class of a style sheet."""
    rule = r"\.([\w-]+)\s*\{[^}]*?font-size:\s*([0-9.]+)\s*(?:px|pt)"
    return F.map_from_entries(F.array_distinct(F.transform(F.arrays_zip(F.regexp_extract_all(css, F.lit(rule), 1).alias("k"), F.regexp_extract_all(css, F.lit(rule), 2).alias("v")), lambda x: F.struct(x["k"], x["v"].try_cast("double")))))


def merged_signs(cells: Column) -> Column:
    """Currency signs in cells of their own joined with the amount beside them; the amount's cell stays, empty, so columns keep their place."""
    lead = lambda i: F.coalesce(F.get(cells, i + 1), F.lit(""))
    sign = lambda c: F.trim(c).isin("$", "¥")
    back = lambda i: F.coalesce(F.get(cells, i - 1), F.lit(""))
    return F.transform(cells, lambda c, i: F.when(sign(c) & ~sign(lead(i)) & (F.trim(lead(i)) != ""), F.concat(c, lead(i))).when((i > 0) & sign(back(i)) & ~sign(c), F.lit("")).otherwise(c))


#: Statements of a CVM filing.
STATEMENTS = ("BalancoPatrimonialAtivo", "BalancoPatrimonialPassivo", "DemonstracaoResultado", "DemonstracaoResultadoAbrangente", "DemonstracaoFluxoCaixa", "DemonstracaoMutacoesPatrimonioLiquido", "DemonstracaoValorAdicionado")
SCOPES = ("DfIndividuais", "DfConsolidadas")


def cvm_accounts(df: DataFrame, key: str, xml: str) -> DataFrame:
    """Accounts in long form: key, scope, statement, pos, code, name, field, value. Value columns are whatever an account holds; empty ones give no row."""
    parts = [F.struct(F.lit(s).alias("scope"), F.lit(t).alias("statement"), F.regexp_extract(F.regexp_extract(xml, rf"(?s)<{s}>(.*?)</{s}>", 1), rf"(?s)<{t}>(.*?)</{t}>", 1).alias("body")) for s in SCOPES for t in STATEMENTS]
    p = df.select(key, F.explode(F.array(*parts)).alias("p")).where("p.body <> ''").select(key, "p.scope", "p.statement", F.posexplode(F.regexp_extract_all("p.body", F.lit(r"(?s)<Conta>(.*?)</Conta>"), 1)).alias("pos", "c"))
    get = lambda t: F.trim(F.regexp_extract("c", rf"(?s)<{t}>(.*?)</{t}>", 1))
    leaf = r"(?s)<(\w+)>([^<]*)</"
    vals = F.arrays_zip(F.regexp_extract_all("c", F.lit(leaf), 1).alias("field"), F.regexp_extract_all("c", F.lit(leaf), 2).alias("value"))
    p = p.select(key, "scope", "statement", "pos", get("CodigoConta").alias("code"), get("DescricaoConta").alias("name"), F.explode(vals).alias("v"))
    return p.where(~F.col("v.field").isin("ContaFixa", "CodigoConta", "DescricaoConta") & (F.trim("v.value") != "")).select(key, "scope", "statement", "pos", "code", "name", "v.field", F.trim("v.value").alias("value"))


def precheck(docs: DataFrame) -> DataFrame:
    """Whether a text is worth evaluating: enough of it, and a balance sheet in it."""
    reason = F.when(F.char_length(F.trim(F.coalesce("md", F.lit("")))) < 50, "no_text").when(~F.col("md").rlike(BALANCE), "no_balance_sheet")
    return docs.select("doc_id", reason.isNull().alias("ok"), reason.alias("reason"))


def vendor_symbol(code: Column, exchange: Column) -> Column:
    out: Column = F.lit(None).cast("string")
    for e, s in SUFFIX.items():
        out = F.when(F.lower(exchange) == e, F.concat(code, F.lit(f".{s}"))).otherwise(out)
    return out


def rules_in_blocks(rules: DataFrame, blocks: DataFrame) -> DataFrame:
    """Vertical rules that reach into a table block, on the page's key."""
    j = rules.join(blocks, ["doc_id", "page_no"])
    return j.where((F.col("y0") <= F.col("bottom")) & (F.col("y1") >= F.col("top"))).select("doc_id", "page_no", "block_no", "seq")


def with_next_pages(pages: DataFrame, hit: Column, more: int = 2) -> DataFrame:
    """Text of pages that `hit` marks, joined with that of the pages after; those pages stay pages of their own."""
    w = Window.partitionBy("doc_id").orderBy("page_no")
    text = F.concat_ws("\n", "text", *[F.lead("text", k).over(w) for k in range(1, more + 1)])
    return pages.withColumn("long", text).withColumn("hit", hit).where("hit").select("doc_id", "page_no", F.col("long").alias("text"))


#: The metrics of a scorecard: name -> plan over (doc_id, market, md). Another is added by putting it in.
METRICS = {
    "identity": lambda d: tables.identity(d).select("doc_id", F.col("status").alias("identity")),
    "footing": lambda d: tables.footing(d).select("doc_id", F.when(F.col("labeled_tested") > 0, F.round(F.col("labeled_passed") / F.col("labeled_tested"), 6)).alias("footing")),
    "articulation": lambda d: tables.articulation(d).select("doc_id", F.col("ratio").alias("articulation")),
    "alignment": lambda d: tables.alignment(d).select("doc_id", "misaligned_ratio"),
    "duplication": lambda d: lines.duplication(d).select("doc_id", "dup_ratio"),
    "garbled": lambda d: lines.garbled(d.where("md IS NOT NULL")).select("doc_id", F.col("ratio").alias("garbled_ratio")),
    "sections": lambda d: lines.sections(d).select("doc_id", "section_count"),
    "fragmentation": lambda d: lines.fragmentation(d).select("doc_id", "fragment_ratio"),
    "fake_headings": lambda d: lines.fake_headings(d).select("doc_id", "fake_ratio"),
    "script_profile": lambda d: lines.script_profile(d.where("md IS NOT NULL")).select("doc_id", "suspicious"),
}


def source_metrics(words: DataFrame, sources: DataFrame) -> dict:
    """The two metrics that need the source, for METRICS: the share of its characters in the text, and its reading order.

    words: layout words; sources: doc_id, source_chars.
    """
    said = lambda d: d.where("md IS NOT NULL").select("doc_id", F.posexplode(F.filter(F.split("md", r"\s+"), lambda w: w != "")).alias("pos", "word"))
    return {
        "coverage": lambda d: lines.coverage(d, sources).select("doc_id", "coverage"),
        "reading_order": lambda d: layout.reading_order(words, said(d)).select("doc_id", F.col("status").alias("order_status"), F.col("accuracy").alias("order_accuracy")),
    }


def scorecard(docs: DataFrame, metrics=None) -> DataFrame:
    """One row per document with the figure of every metric; a metric that measures nothing is null or skip and hinders no other.

    A metric whose plan cannot be made leaves its message in `errors` and the others their figures.
    Each metric is aggregated by document first, and the joins share the document's hash partitioning.
    """
    base = docs.where("md IS NOT NULL").select("doc_id", "market")
    errors = []
    for name, plan in (METRICS if metrics is None else metrics).items():
        try:
            part = plan(docs)
            part.schema  # noqa: B018  # resolves the plan
        except Exception as e:  # noqa: BLE001
            errors.append(f"{name}: {type(e).__name__}")
            continue
        base = base.join(merged(part), "doc_id", "left")
    return base.withColumn("errors", F.lit("; ".join(errors))) if errors else base


def xbrl_markdown(files: DataFrame) -> DataFrame:
    f = xbrl.generic_facts(files.select("doc_id", markup.decoded(F.col("content")).alias("xml")), "doc_id", "xml")
    line = F.concat(F.lit("- "), "concept", F.lit(": "), "values")
    per = f.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("md"))
    return per


def cvm_markdown(files: DataFrame) -> DataFrame:
    a = cvm_accounts(files.select("doc_id", markup.decoded(F.col("content")).alias("xml")), "doc_id", "xml")
    line = F.concat(F.lit("| "), F.concat_ws(" | ", "scope", "statement", "code", "name", "field", "value"), F.lit(" |"))
    return a.groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("md"))


def zip_markdown(files: DataFrame) -> DataFrame:
    m = markup.zip_members(files, "doc_id")
    good = markup.chapters(m, "doc_id").select("doc_id", markup.html_to_markdown(F.col("html")).alias("md"), F.lit(None).cast("string").alias("error"))
    return good.unionByName(m.where("error IS NOT NULL").select("doc_id", F.lit(None).cast("string").alias("md"), "error"))


def tagged_markdown(files: DataFrame) -> DataFrame:
    """The largest page of each bundle, or the page itself."""
    m = markup.zip_members(files, "doc_id")
    page = m.where((F.col("name") == "") | F.col("name").rlike(r"(?i)\.x?html?$"))
    main = page.groupBy("doc_id").agg(F.max_by("data", F.struct(F.octet_length("data"), -F.col("pos"))).alias("data"))
    good = main.select("doc_id", tagged.tagged_to_markdown(markup.decoded(F.col("data"))).alias("md"), F.lit(None).cast("string").alias("error"))
    return good.unionByName(m.where("error IS NOT NULL").select("doc_id", F.lit(None).cast("string").alias("md"), "error"))


#: Converters by format: plan over (doc_id, content) with doc_id, md and, where it can tell, error. Another is added by putting it in.
CONVERTERS = {
    "ixbrl": lambda f: f.select("doc_id", markup.html_to_markdown(markup.decoded(F.col("content"))).alias("md")),
    "esef": lambda f: tagged_markdown(f),
    "ixbrl_zip": zip_markdown,
    "dart_xml": lambda f: f.select("doc_id", markup.filing_to_markdown(markup.decoded(F.col("content"))).alias("md")),
    "xbrl": xbrl_markdown,
    "cvm_xml": cvm_markdown,
}


def convert_files(files: DataFrame, converters=None) -> DataFrame:
    """doc_id, format, md, error of files (doc_id, exchange, content): each goes to the converter of its exchange's format.

    The plans of the formats are a union over one read each with a filter. A format without a
    converter (layout needs the relations of layout_document) and a file that gives no text have an error.
    """
    by = CONVERTERS if converters is None else converters
    f = files.select("doc_id", format_of(F.col("exchange")).alias("format"), "content")
    none = F.lit(None).cast("string")
    rest = f.where(~F.col("format").isin(*by) | F.col("content").isNull()).select("doc_id", "format", none.alias("md"), F.when(F.col("content").isNull(), "no content").otherwise(F.concat(F.lit("no converter: "), "format")).alias("error"))
    for name, plan in by.items():
        mine = f.where((F.col("format") == name) & F.col("content").isNotNull())
        got = plan(mine.select("doc_id", "content"))
        got = got if "error" in got.columns else got.withColumn("error", none)
        every = mine.select("doc_id", "format").join(got, "doc_id", "left")
        rest = rest.unionByName(every.select("doc_id", "format", "md", F.coalesce("error", F.when(F.coalesce("md", F.lit("")) == "", "nothing to read")).alias("error")))
    return rest


def files_of(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, exchange, content of the files under path/<exchange>/: read as bytes, whatever they are."""
    b = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return b.select(F.xxhash64("path").alias("doc_id"), F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1).alias("exchange"), "content", "path")
