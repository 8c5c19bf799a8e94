"""Sources that need a tokenizer: HTML tables, filing XML, ZIP members, bytes of unknown encoding. Arrow batches, no shuffle."""

from __future__ import annotations

import html as html_lib
import io
import re
import zipfile
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class _Tables(HTMLParser):
    """Cells of all tables of a page, nested ones by a stack: (table_no, row_no, cell_no, text, rowspan, colspan)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.done: list[tuple] = []
        self.open: list[dict] = []
        self.n = 0

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "table":
            self.open.append({"no": self.n, "row": -1, "cell": None, "k": 0})
            self.n += 1
        elif self.open:
            t = self.open[-1]
            if tag == "tr":
                self._close(t)
                t["row"] += 1
                t["k"] = 0
            elif tag in ("td", "th", "te", "tu"):
                self._close(t)
                a = dict(attrs)
                span = lambda k: max(1, min(1000, int(a.get(k) or 1))) if str(a.get(k) or 1).isdigit() else 1
                t["row"] = max(t["row"], 0)
                t["cell"] = ["", span("rowspan"), span("colspan")]
            elif tag == "br" and t["cell"] is not None:
                t["cell"][0] += " "

    def _close(self, t: dict) -> None:
        if t["cell"] is not None:
            text, rs, cs = t["cell"]
            self.done.append((t["no"], t["row"], t["k"], re.sub(r"\s+", " ", text).strip(), rs, cs))
            t["k"] += 1
            t["cell"] = None

    def handle_endtag(self, tag: str) -> None:
        if self.open:
            if tag in ("td", "th", "te", "tu", "tr"):
                self._close(self.open[-1])
            elif tag == "table":
                self._close(self.open.pop())

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1]["cell"] is not None:
            self.open[-1]["cell"][0] += data


def placed(cells: list[tuple]) -> list[tuple[int, int, int, str, int, int]]:
    """(table_no, row_no, col_no, text, origin_row, origin_col): spanned slots hold their cell's text, under its origin."""
    out, taken = [], {}
    for no, row, _, text, rs, cs in cells:
        busy = taken.setdefault(no, set())
        col = 0
        while (row, col) in busy:
            col += 1
        for r in range(row, row + rs):
            for c in range(col, col + cs):
                if (r, c) not in busy:
                    busy.add((r, c))
                    out.append((no, r, c, text, row, col))
    rows = {}
    for no, row, *_ in cells:
        rows[no] = max(rows.get(no, 0), row)
    return [x for x in out if x[1] <= rows[x[0]]]


def html_grid(html: str) -> list[tuple]:
    p = _Tables()
    p.feed(html)
    p.close()
    while p.open:
        p._close(p.open.pop())
    return placed(sorted(p.done))


GRID = "key bigint, table_no int, row_no int, col_no int, text string, origin_row int, origin_col int"


def html_cells(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """The grid of each page's tables, one row per slot."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, *c) for k, h in zip(b["key"], b["html"], strict=True) for c in html_grid(h)]
            yield pd.DataFrame(rows, columns=["key", "table_no", "row_no", "col_no", "text", "origin_row", "origin_col"])

    two = pages.select(F.col(key).cast("bigint").alias("key"), F.col(html).alias("html")).where(F.col("html").rlike("(?i)<table"))
    return two.mapInPandas(run, GRID).withColumnRenamed("key", key)


def xml_blocks(text: str | None) -> list[tuple[int, str, int, str]]:
    """(seq, kind, level, text) of a filing's XML: titles by section depth, paragraphs, table rows. Malformed text loses its tags and is one paragraph each line."""
    out, depth, kind, buf, row = [], 0, "", [], None
    if not text:
        return []

    def flush() -> None:
        nonlocal buf
        t = re.sub(r"\s+", " ", "".join(buf)).strip()
        buf = []
        if t and row is not None and kind == "cell":
            row[-1] = (row[-1] + " " + t).strip() if row else t
        elif t:
            out.append((len(out), "heading" if kind == "title" else "p", depth if kind == "title" else 0, t))

    for m in re.finditer(r"<(/?)([A-Za-z][\w.-]*)[^<>]*?(/?)>|(<(?![A-Za-z/!?])|[^<]+|<)", text):
        if m.group(4) is not None:
            buf.append(m.group(4))
            continue
        end, name = m.group(1), m.group(2).upper()
        flush()
        if name.startswith("SECTION-"):
            depth += -1 if end else 1
        elif name == "TITLE":
            kind = "" if end else "title"
        elif name == "TR":
            if end:
                if row:
                    out.append((len(out), "row", 0, " | ".join(row)))
                row = None
            else:
                row = []
        elif name in ("TD", "TH", "TE", "TU"):
            kind = "" if end else "cell"
            if not end:
                row = [] if row is None else row
                row.append("")
        elif name == "P":
            kind = "" if end else "p"
    flush()
    return out


def filing_blocks(df: DataFrame, key: str, xml: str) -> DataFrame:
    """key, seq, kind, level, text of each filing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, *x) for k, t in zip(b["key"], b["xml"], strict=True) for x in xml_blocks(t)]
            yield pd.DataFrame(rows, columns=["key", "seq", "kind", "level", "text"])

    two = df.select(F.col(key).alias("key"), F.col(xml).alias("xml")).where("xml IS NOT NULL")
    return two.mapInPandas(run, "key string, seq int, kind string, level int, text string").withColumnRenamed("key", key)


def blocks_markdown(blocks: DataFrame, key: str) -> DataFrame:
    """Blocks in order as Markdown."""
    line = F.when(F.col("kind") == "heading", F.concat(F.repeat(F.lit("#"), F.least(F.greatest("level", F.lit(1)), F.lit(3))), F.lit(" "), "text")).when(F.col("kind") == "row", F.concat(F.lit("| "), "text", F.lit(" |"))).otherwise(F.col("text"))
    per = blocks.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("seq", line.alias("line")))).alias("ls"))
    return per.select(key, F.regexp_replace(F.array_join(F.transform("ls", lambda x: x["line"]), "\n"), r"\n{3,}", "\n\n").alias("md"))


def _members(raw: bytes) -> list[tuple[str | None, int, bytes | None, str | None]]:
    if raw[:2] != b"PK":
        return [("", 0, raw, None)]
    try:
        with zipfile.ZipFile(io.BytesIO(raw)) as z:
            return [(i.filename, n, z.read(i), None) for n, i in enumerate(z.infolist()) if not i.is_dir()]
    except (zipfile.BadZipFile, zlib.error, RuntimeError, EOFError, NotImplementedError) as e:
        return [(None, 0, None, f"{type(e).__name__}: {e}")]


def zip_members(files: DataFrame, key: str, content: str = "content") -> DataFrame:
    """key, name, pos, data, error of each member; what is no archive passes through as one nameless member, a broken archive as one row with its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, *m) for k, c in zip(b["key"], b["content"], strict=True) if c is not None for m in _members(bytes(c))]
            yield pd.DataFrame(rows, columns=["key", "name", "pos", "data", "error"])

    two = files.select(F.col(key).cast("bigint").alias("key"), F.col(content).alias("content"))
    return two.mapInPandas(run, "key bigint, name string, pos int, data binary, error string").withColumnRenamed("key", key)


def chapters(members: DataFrame, key: str) -> DataFrame:
    """Numbered chapters but the header, in order of name, as one text."""
    base = F.regexp_replace("name", "^.*/", "")
    m = members.where(base.rlike(r"(?i)^[0-9]{7}.*\.html?$") & ~base.startswith("0000000"))
    per = m.where("error IS NULL").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("name", F.decode("data", "UTF-8").alias("t")))).alias("ms"))
    return per.select(key, F.array_join(F.transform("ms", lambda x: x["t"]), "\n").alias("html"))


def largest_page(members: DataFrame, key: str) -> DataFrame:
    m = members.where(F.col("name").rlike(r"(?i)\.x?html?$"))
    return m.groupBy(key).agg(F.max_by("name", F.struct(F.octet_length("data"), -F.col("pos"))).alias("name"), F.max(F.octet_length("data")).alias("bytes"))


#: Exchanges of company classes.
CLASS_EXCHANGE = {"Y": "ksc", "K": "koe", "N": "knx"}


def companies(lists: DataFrame, xml: str, classes: DataFrame) -> DataFrame:
    """corp_code, corp_name, stock_code, corp_cls, exchange: the listed companies of fetched lists whose class has an exchange.

    A list that came with an error status gives none. classes: corp_code, corp_cls, looked up by an equality join.
    """
    status = F.regexp_extract(xml, r"(?s)<status>(.*?)</status>", 1)
    good = lists.where(F.trim(status).isin("", "000"))
    rows = good.select(F.explode(F.regexp_extract_all(xml, F.lit(r"(?s)<list>(.*?)</list>"), 1)).alias("c"))
    get = lambda t: F.trim(F.regexp_extract("c", rf"(?s)<{t}>(.*?)</{t}>", 1)).alias(t)
    known = classes.select("corp_code", "corp_cls").dropDuplicates(["corp_code"])
    c = rows.select(get("corp_code"), get("corp_name"), get("stock_code")).where("stock_code <> ''").distinct().join(known, "corp_code")
    exchange = F.element_at(F.create_map(*[F.lit(x) for kv in CLASS_EXCHANGE.items() for x in kv]), F.col("corp_cls"))
    return c.where(F.col("corp_cls").isin(*CLASS_EXCHANGE)).withColumn("exchange", exchange)


def main_or_first(members: DataFrame, key: str) -> DataFrame:
    """The member named after the receipt, else the first."""
    mine = F.col("name") == F.concat(F.col(key).cast("string"), F.lit(".xml"))
    return members.where("error IS NULL").groupBy(key).agg(F.min_by("name", F.struct((~mine).cast("int"), "pos")).alias("name"))


@F.pandas_udf(T.StringType())
def _sniff(s: pd.Series) -> pd.Series:
    def one(raw):
        if raw is None:
            return None
        a = bytes(raw).decode("utf-8", "replace")
        if "�" not in a:
            return a
        b = bytes(raw).decode("cp949", "replace")
        return b if b.count("�") < a.count("�") else a

    return s.map(one)


def decoded(content: Column) -> Column:
    """Bytes as UTF-8, unless CP949 breaks fewer characters. Valid UTF-8 never leaves the JVM."""
    return F.when(F.is_valid_utf8(content.cast("string")), F.try_validate_utf8(content.cast("string"))).otherwise(_sniff(content))


LINK = re.compile(r"<a\b[^>]*?\bhref\s*=\s*[\"']#([^\"'>]+)[\"'][^>]*>((?:(?!</?a\b).)*)", re.S | re.I)


def contents_titles(page: str) -> dict[str, str]:
    """The first title of each anchor that the page links to; bare page numbers and texts of more than 200 characters are no titles."""
    out: dict[str, str] = {}
    for m in LINK.finditer(page):
        t = " ".join(html_lib.unescape(re.sub(r"<[^>]*>", "", m.group(2))).split())
        if t and not t.isdigit() and len(t) <= 200:
            out.setdefault(m.group(1), t)
    return out


def joined_signs(cells: list[str]) -> list[str]:
    """A currency sign in a cell of its own goes before the amount beside it, whose cell stays, empty."""
    out = list(cells)
    for i in range(len(out) - 1):
        if out[i].strip() in ("$", "¥") and out[i + 1].strip():
            out[i], out[i + 1] = out[i] + out[i + 1], ""
    return out


def pipe_tables(slots: list[tuple]) -> list[str]:
    """A grid's tables as pipe tables: a cell that spans columns stands once, empty rows go, tables of one row give none."""
    tables: dict[int, dict[int, dict[int, tuple]]] = {}
    for no, r, c, text, r0, c0 in slots:
        tables.setdefault(no, {}).setdefault(r, {})[c] = (text, (r0, c0))
    out = []
    for _, rows in sorted(tables.items()):
        width = max(max(cells) for cells in rows.values()) + 1
        lines = []
        for _, cells in sorted(rows.items()):
            line, left = [], None
            for c in range(width):
                text, origin = cells.get(c, ("", None))
                line.append("" if origin is not None and origin == left else text.replace("|", "\\|"))
                left = origin
            if any(line):
                lines.append(joined_signs(line))
        if len(lines) > 1:
            out.append("\n".join(["| " + " | ".join(lines[0]) + " |", "|" + "---|" * width, *("| " + " | ".join(x) + " |" for x in lines[1:])]))
    return out


class _Page(HTMLParser):
    """Blocks of an HTML page in order: headings, paragraphs, list items, and tables in their place.

    Headings are h1-h6, and elements that the page's contents link to: an empty anchor or a division
    gives the title of the contents, another element its own text. Bold blocks right after an
    anchor's heading repeat it and are left out.
    """

    DROPPED = frozenset("script style head ix:header ix:hidden ix:references ix:resources".split())
    OPENING = frozenset("p li tr td th section".split())

    def __init__(self, titles: dict[str, str]) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[tuple[str, int, str]] = []
        self.buf: list[str] = []
        self.kind, self.level, self.lost, self.depth = "p", 0, 0, 0
        self.bold = self.repeats = False
        self.titles = titles
        self.table: _Tables | None = None

    def flush(self) -> None:
        t = re.sub(r"\n{2,}", "\n", re.sub("[ \\t\u3000\u00a0]+", " ", "".join(self.buf))).strip()
        kind, level, bold = self.kind, self.level, self.bold
        self.buf, self.kind, self.level, self.bold = [], "p", 0, False
        if not t:
            return
        if kind == "h":
            self.out.append((kind, level, t.replace("\n", " ")))
            return
        if self.repeats and bold:
            return
        self.repeats = False
        self.out.append((kind, level, t))

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in self.DROPPED:
            self.lost += 1
        if self.lost or tag in VOID and tag != "br":
            return
        if tag == "table":
            if self.table is None:
                self.flush()
                self.table = _Tables()
            self.depth += 1
        if self.table is not None:
            self.table.handle_starttag(tag, attrs)
            return
        here = next((v for k, v in attrs if k in ("id", "name") and v in self.titles), None)
        if re.fullmatch("h[1-6]", tag):
            self.flush()
            self.kind, self.level = "h", int(tag[1])
        elif tag == "br":
            self.buf.append("\n")
        elif tag == "div" or tag == "a" and here:
            self.flush()
            if here:
                self.out.append(("h", 2, self.titles[here]))
                self.repeats = tag == "a"
        elif tag in self.OPENING:
            self.flush()
            if here:
                self.kind, self.level = "h", 2
            elif tag == "li":
                self.kind = "li"
        elif tag in ("b", "strong"):
            self.bold = True

    def handle_endtag(self, tag: str) -> None:
        if tag in self.DROPPED:
            self.lost = max(0, self.lost - 1)
            return
        if self.table is not None:
            self.table.handle_endtag(tag)
            self.depth -= tag == "table"
            if not self.depth:
                self.close_table()
        elif tag in ("p", "div", "li", "section") or re.fullmatch("h[1-6]", tag):
            self.flush()

    def close_table(self) -> None:
        t, self.table, self.depth = self.table, None, 0
        while t.open:
            t._close(t.open.pop())
        self.out += [("table", 0, x) for x in pipe_tables(placed(sorted(t.done)))]

    def handle_data(self, data: str) -> None:
        if self.lost:
            return
        if self.table is not None:
            self.table.handle_data(data)
        else:
            self.buf.append(re.sub(r"\s+", " ", data))

    def finish(self) -> list[tuple[str, int, str]]:
        self.close()
        if self.table is not None:
            self.close_table()
        self.flush()
        return self.out


def page_blocks(html: str) -> list[tuple[int, str, int, str]]:
    p = _Page(contents_titles(html))
    p.feed(html)
    return [(i, *b) for i, b in enumerate(p.finish())]


def page_markdown(html: str | None) -> str | None:
    """A page with its tables in place; null for null, empty for nothing to read."""
    if html is None:
        return None
    return "\n\n".join(("#" * level + " " if kind == "h" else "") + t for _, kind, level, t in page_blocks(html))


@F.pandas_udf(T.StringType())
def _page_markdown(s: pd.Series) -> pd.Series:
    return pd.Series([page_markdown(x if isinstance(x, str) else None) for x in s], dtype=object)


def html_to_markdown(html: Column) -> Column:
    return _page_markdown(html)


@F.pandas_udf(T.StringType())
def _filing_markdown(s: pd.Series) -> pd.Series:
    def one(t: str) -> str:
        out = []
        for _, kind, level, text in xml_blocks(t):
            out.append("#" * min(max(level, 1), 3) + " " + text if kind == "heading" else f"| {text} |" if kind == "row" else text)
        return re.sub(r"\n{3,}", "\n\n", "\n".join(out))

    return pd.Series([one(x) if isinstance(x, str) else None for x in s], dtype=object)


def filing_to_markdown(xml: Column) -> Column:
    """Filing XML as Markdown in one pass: titles by depth, paragraphs, rows."""
    return _filing_markdown(xml)


def html_blocks(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """key, seq, kind (h, p, li, table), level, text of each page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, *x) for k, t in zip(b["key"], b["html"], strict=True) for x in page_blocks(t)]
            yield pd.DataFrame(rows, columns=["key", "seq", "kind", "level", "text"])

    two = pages.select(F.col(key).cast("bigint").alias("key"), F.col(html).alias("html")).where("html IS NOT NULL")
    return two.mapInPandas(run, "key bigint, seq int, kind string, level int, text string").withColumnRenamed("key", key)
