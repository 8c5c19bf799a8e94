"""Tagged European reports, whose pages say what a heading is in one of three ways, as Markdown.

positional: every line is a division placed by classes, y and size and font as hexadecimal numbers of
the file; a heading has a smaller size number than most lines, or another font. sized: classes have
font sizes in the style sheet; a heading is larger than most blocks. strong: headings are in strong.
Text that repeats on page after page, bare numbers and long texts are no headings. Tables stay in
place; images and the header of the tagging go; text outside classed divisions is kept.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.markup import VOID, _Tables, pipe_tables, placed

LONGEST_TITLE, GAP = 80, 20
SIZE = re.compile(r"\.([\w-]+)\s*\{[^}]*?font-size:\s*([0-9.]+)\s*(?:px|pt)")
STYLE = re.compile(r"<style\b[^>]*>((?:(?!</?style\b).)*)", re.S | re.I)
NUMBERED = re.compile(r"(fs|ff|y)([0-9a-f]+)")


class Block:
    """A run of text: what places it, the sizes of the classes in it, whether it is strong, or a finished table."""

    __slots__ = ("size", "strong", "table", "text", "where")

    def __init__(self, where: dict[str, int] | None = None, table: str | None = None) -> None:
        self.where, self.size, self.strong, self.table, self.text = where, 0.0, False, table, ""


class _Report(HTMLParser):
    DROPPED = frozenset("head script style ix:header ix:hidden".split())
    BREAKS = frozenset("p tr li h1 h2 h3 h4 h5 h6 section article".split())

    def __init__(self, sizes: dict[str, float]) -> None:
        super().__init__(convert_charrefs=True)
        self.sizes = sizes
        self.blocks: list[Block] = []
        self.now = Block()
        self.divs: list[bool] = []  # whether each open division is a placed line
        self.lost = self.depth = 0
        self.charstyles = False
        self.table: _Tables | None = None

    def next(self, block: Block | None = None) -> None:
        self.now.text = " ".join(self.now.text.split())
        if self.now.text:
            self.blocks.append(self.now)
        self.now = block or Block()

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in self.DROPPED:
            self.lost += 1
        if self.lost or tag in VOID and tag != "br":
            return
        if tag == "table":
            if self.table is None:
                self.next()
                self.table = _Tables()
            self.depth += 1
        if self.table is not None:
            self.table.handle_starttag(tag, attrs)
            return
        classes = (dict(attrs).get("class") or "").split()
        self.charstyles |= any(c.startswith("charStyle") for c in classes)
        placed_line = tag == "div" and classes[:2] == ["t", "m0"]
        if placed_line:
            self.next(Block({k: int(v, 16) for k, v in (m.groups() for c in classes for m in [NUMBERED.fullmatch(c)] if m)}))
        elif tag == "br" or tag in self.BREAKS or tag == "div" and not any(self.divs):
            self.next()
        if tag == "strong" and not any(self.divs):
            self.next()
            self.now.strong = True
        if tag == "div":
            self.divs.append(placed_line)
        self.now.size = max([self.now.size, *(self.sizes.get(c, 0.0) for c in classes)])

    def handle_endtag(self, tag: str) -> None:
        if tag in self.DROPPED:
            self.lost = max(0, self.lost - 1)
        elif self.table is not None:
            self.table.handle_endtag(tag)
            self.depth -= tag == "table"
            if not self.depth:
                self.close_table()
        elif tag == "div" and self.divs:
            if self.divs.pop() or not any(self.divs):
                self.next()
        elif tag in self.BREAKS or tag == "strong" and self.now.strong:
            self.next()

    def close_table(self) -> None:
        t, self.table, self.depth = self.table, None, 0
        while t.open:
            t._close(t.open.pop())
        for x in pipe_tables(placed(sorted(t.done))):
            self.blocks.append(Block(table=x))

    def handle_data(self, data: str) -> None:
        if self.lost:
            return
        if self.table is not None:
            self.table.handle_data(data)
        else:
            self.now.text += data

    def finish(self) -> list[Block]:
        self.close()
        if self.table is not None:
            self.close_table()
        self.next()
        return self.blocks


def _most(values) -> object:
    found = Counter(v for v in values if v is not None)
    return found.most_common(1)[0][0] if found else None


def _positional(blocks: list[Block]) -> list[str]:
    lines = sorted((b for b in blocks if b.where is not None), key=lambda b: b.where.get("y", 0))
    size, font = _most(b.where.get("fs") for b in lines), _most(b.where.get("ff") for b in lines)
    times = Counter(b.text for b in lines)
    out: list[str] = []
    para: list[str] = []
    last: int | None = None

    def close() -> None:
        if para:
            out.append(" ".join(para))
            para.clear()

    for b in lines:
        y, fs, ff = b.where.get("y", 0), b.where.get("fs"), b.where.get("ff")
        other = fs is not None and size is not None and (fs < size or fs == size and None not in (ff, font) and ff != font)
        if other and times[b.text] <= 2 and len(b.text) <= LONGEST_TITLE and not b.text.isdigit():
            close()
            out.append(f"## {b.text}")
        else:
            if last is None or y - last > GAP:
                close()
            para.append(b.text)
        last = y
    close()
    return out + [b.table or b.text for b in blocks if b.where is None]


def tagged_markdown(html: str | None) -> str | None:
    """A tagged report; null for null."""
    if html is None:
        return None
    style = STYLE.search(html)
    r = _Report({k: float(v) for k, v in SIZE.findall(style.group(1))} if style else {})
    r.feed(html)
    blocks = r.finish()
    if any(b.where is not None for b in blocks):
        return "\n".join(_positional(blocks))
    if any(b.strong for b in blocks) and not r.charstyles:
        return "\n".join(b.table or (f"## {b.text}" if b.strong else b.text) for b in blocks)
    body = _most(b.size for b in blocks if b.table is None) or 0.0
    return "\n".join(b.table or (f"## {b.text}" if b.size > body and len(b.text) <= LONGEST_TITLE else b.text) for b in blocks)


@F.pandas_udf(T.StringType())
def _tagged(s: pd.Series) -> pd.Series:
    return pd.Series([tagged_markdown(x if isinstance(x, str) else None) for x in s], dtype=object)


def tagged_to_markdown(html: Column) -> Column:
    return _tagged(html)
