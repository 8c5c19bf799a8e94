"""Markup residue turned into clean text, with the structure that carries meaning kept.

A site style tree: the pages of one host (here the fragments of one issuer) are read into DOM trees
and merged by the path of their nodes. The styles of an inner node are the sequences of its
children, with what presents them; the styles of a leaf are its contents. An inner node's own
importance is the entropy of its styles in units of its pages; a leaf's is one less the mean entropy
of its contents over the pages, so that what stands on every page counts nothing. The composite
importance of an inner node, from the bottom up, weighs its own with the mean of its children's by
the share of each style. A branch in which no
node has any importance says nothing about a page and is removed; the rest is written out as text.

HTML and XML elements, comments and character references, and constructs of Markdown, wiki text
and LaTeX count as markup in a text; ordinary signs (comparison, brackets, ampersands, note marks,
numbers, currency, paths of files) do not. Headings come out as `# `, lists as `- `, tables as
`| a | b |`, code in fences, formulas between `$`.

Defined results: null gives null, a text without markup is returned as it is; unclosed and
misnested elements are closed where their parent ends. Rows that come twice count once as pages.
A node that fewer than MIN_PAGES different pages have is important, whatever it holds.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import math
import re
from collections import Counter
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.session import cut

MIN_PAGES, LEAST_IMPORTANCE, GAMMA = 8, 0.15, 0.9
#: Any sign a construct needs; a text without one has no markup. A gate for speed that loses nothing.
SIGNS = r"[<>&\\\[{*_#`~|=$']|---"

#: Element names of HTML and of the filing dialects met.
ELEMENTS = frozenset(
    (
        "a abbr address article aside b base big blockquote body br button caption center cite code col colgroup dd del dfn div dl dt em embed "
        "fieldset figcaption figure font footer form frame frameset h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend "
        "li link main map mark math meta nav noscript object ol optgroup option p param pre q rb rp rt ruby s samp script section select small "
        "source span strike strong style sub summary sup svg table tbody td textarea tfoot th thead time title tr tt u ul var video wbr "
        "mi mn mo mrow mfrac msup msub msqrt mtext mtable mtr mtd te tu document section-1 section-2 section-3 pgbrk ref nowiki references gallery math noinclude includeonly"
    ).split()
)
ATTR = r"""\s+[A-Za-z_:][\w:.-]*(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'<>=]+))?"""
TAG = re.compile(rf"<(/?)([A-Za-z][\w.-]*(?::[A-Za-z][\w.-]*)?)((?:{ATTR})*)\s*(/?)>")
SPECIAL = re.compile(r"<!--(?:(?!<!--|-->).)*-->|<!--|-->|<!\[CDATA\[.*?\]\]>|<!DOCTYPE[^<>]*>|<\?xml[^<>]*\?>", re.S | re.I)
CHAR_REF = re.compile(r"&(#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")

TEXT_MARKUP = [
    ("md_fence", re.compile(r"^[ \t]*(?:```|~~~)[^\n`]*$", re.M)),
    ("md_heading", re.compile(r"^ {0,3}#{1,6}[ \t]+\S", re.M)),
    ("md_bold", re.compile(r"(?<!\*)\*\*(?!\*)(?:(?!\*\*).)+?\*\*|(?<!\w)__(?=\S)(?![a-z0-9_]+__)(?:(?!__).)+?__(?!\w)", re.S)),
    ("md_strike", re.compile(r"~~(?=\S)[^~\n]+~~")),
    ("md_code", re.compile(r"(?<!`)`[^`]+`(?!`)")),
    ("md_link", re.compile(r"!?\[[^\[\]]*\]\([^()\s]*[/.#:@?][^()\s]*(?:\s+\"[^\"]*\")?\)|!?\[[^\[\]]*\]\[[^\[\]]*\]")),
    ("md_table", re.compile(r"^[ \t]*(?:\|[ \t]*)?:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)*\|[ \t]*$|^[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+$", re.M)),
    ("wiki_quote", re.compile(r"'''.+?'''|''(?=\S)[^'\n]+''", re.S)),
    ("wiki_heading", re.compile(r"^(={2,6})[ \t]*[^\s=](?:.*[^\s=])?[ \t]*\1[ \t]*$", re.M)),
    ("wiki_link", re.compile(r"\[\[[^\[\]]+\]\]")),
    ("wiki_template", re.compile(r"\{\{[^{}]+\}\}")),
    ("wiki_table", re.compile(r"^\{\||^\|\}|^\|-[ \t]*$", re.M)),
    ("wiki_ext", re.compile(r"\[https?://[^\s\[\]]+(?:\s[^\[\]]*)?\]")),
    ("tex_env", re.compile(r"\\(?:begin|end)\{[A-Za-z*]+\}")),
    ("tex_command", re.compile(r"\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{")),
    ("tex_math", re.compile(r"\\\((?:(?!\\[()]).)+\\\)|\\\[(?:(?!\\[\[\]]).)+\\\]|\$\$.+?\$\$|\$[^$\n]*[\\^_][^$\n]*\$", re.S)),
    ("tex_symbol", re.compile(r"\\(?:times|alpha|beta|gamma|delta|sum|int|cdot|leq|geq|pm|item|ldots|dots|quad|hline|infty|approx|neq|noindent|newline|LaTeX|TeX|par)(?![A-Za-z])")),
    ("tex_escape", re.compile(r"(?<!\\)\\[%$&_#{}](?!\w*:)")),
    ("tex_break", re.compile(r"\\\\[ \t]*$", re.M)),
]

FILE_PATH = re.compile(r"\b[A-Za-z]:\\[^\s{}]*")


def tags(text: str):
    for m in TAG.finditer(text):
        name = m.group(2).lower()
        if name in ELEMENTS or ":" in name or (m.group(3).strip() and "=" in m.group(3)):
            yield m


def constructs(text: str) -> list[str]:
    out = []
    if "<" in text or "-->" in text:
        if next(tags(text), None):
            out.append("tag")
        if SPECIAL.search(text):
            out.append("special")
    if "&" in text and any(m.group(1)[0] == "#" or m.group(1) + ";" in html5 for m in CHAR_REF.finditer(text)):
        out.append("char_ref")
    if ":\\" in text:
        text = FILE_PATH.sub(" ", text)
    return out + [k for k, r in TEXT_MARKUP if r.search(text)]


DROPPED = frozenset("script style head meta link title noscript template ix:header ix:hidden".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr pgbrk".split())
HEADINGS = {f"h{i}": i for i in range(1, 7)}
CELLS = frozenset("td th te tu".split())
BLOCKS = frozenset("p div section article tr table ul ol li pre blockquote dl dt dd body document h1 h2 h3 h4 h5 h6 thead tbody tfoot caption figure header footer main form".split())


#: Before every character of a tag, so that a branch stands together when paths are sorted.
SEP = "\x01"


class _Walker(HTMLParser):
    """Leaves of a fragment in order, (path, kind, text), and its inner nodes, (path, labels of the children, their tags).

    A path is the chain of tags from the root; a label is a tag with what presents it.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str]] = []
        self.leaves: list[tuple[str, str, str]] = []
        self.nodes: list[tuple[str, list[str], list[str]]] = [("#", [], [])]
        self.open = [self.nodes[0]]
        self.lost = 0

    def _leaf(self, kind: str, text: str = "") -> None:
        path = self.open[-1][0]
        if text.strip():
            path += f"{SEP}#text"
            self.open[-1][1].append("#text")
            self.open[-1][2].append("#text")
        self.leaves.append((path, kind, text))

    def _kind(self) -> str:
        for n, label in reversed(self.stack):
            if n in HEADINGS:
                return n
            if n in CELLS:
                return "cell"
            if n == "pre":
                return "code"
            if n == "math" or "class=math" in label:
                return "math"
            if n == "li":
                return "li"
        return "inline_code" if any(n == "code" for n, _ in self.stack) else "p"

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in VOID:
            if tag == "br" and not self.lost:
                self._leaf("br")
            return
        look = ".".join(sorted(f"{k}={v}" for k, v in attrs if k in ("class", "style", "align", "border", "role")))
        label = f"{tag}[{look}]" if look else tag
        self.lost += tag in DROPPED
        node = (f"{self.open[-1][0]}{SEP}{tag}", [], [])
        if not self.lost:
            self.open[-1][1].append(label)
            self.open[-1][2].append(tag)
            self.nodes.append(node)
        self.stack.append((tag, label))
        self.open.append(node)
        if not self.lost:
            if tag in BLOCKS:
                self._leaf(f"<{tag}")
            elif tag in CELLS:
                self._leaf("<cell")
        if not self.lost and tag == "mfrac":
            self._leaf("frac")

    def handle_startendtag(self, tag: str, attrs) -> None:
        if tag == "br":
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID or all(n != tag for n, _ in self.stack):
            return
        while self.stack:
            n, _ = self.stack.pop()
            self.lost -= n in DROPPED
            if not self.lost and n in BLOCKS:
                self._leaf(f"{n}>")
            self.open.pop()
            if n == tag:
                break

    def handle_data(self, data: str) -> None:
        if not self.lost and data:
            self._leaf(self._kind(), data)


def walked(fragment: str) -> _Walker:
    w = _Walker()
    w.feed(fragment)
    w.close()
    return w


def leaves(fragment: str) -> list[tuple[str, str, str]]:
    return walked(fragment).leaves


def _squeeze(x: str) -> str:
    return re.sub("[ \\t\\r\\n\u00a0\u3000]+", " ", x)


def _fenced(code: list[str]) -> str:
    return "```\n" + "".join(code).strip("\n") + "\n```"


def written(parts: list[tuple[str, str]]) -> str:
    """Clean text of (kind, text) leaves in order."""
    out: list[str] = []
    row: list[str] | None = None
    line, lead = "", ""
    code: list[str] = []
    math: list[str] = []

    def flush() -> None:
        nonlocal line, lead
        if line.strip():
            out.append(lead + line.strip())
        line, lead = "", ""

    for kind, text in [*parts, ("end>", "")]:
        if code and kind != "code":
            out.append(_fenced(code))
            code = []
        if math and kind not in ("math", "frac"):
            line += "$" + " ".join(x.strip().strip("$") for x in math if x.strip()) + "$"
            math = []
        if kind == "frac":
            math.append("frac")
        elif kind == "math":
            math.append(text)
        elif kind == "<tr":
            flush()
            row = []
        elif kind == "<cell":
            row = [] if row is None else row
            row.append("")
        elif kind in ("tr>", "end>"):
            if row:
                out.append("| " + " | ".join(c.strip().replace("|", "\\|") for c in row) + " |")
            row = None
            if kind == "end>":
                flush()
        elif kind == "br":
            if row:
                row[-1] += " "
            elif row is None:
                flush()
        elif kind.startswith("<") or kind.endswith(">"):
            if row is None:
                flush()
        elif kind == "code":
            flush()
            code.append(text)
        elif row:
            row[-1] += _squeeze(text)
        elif kind == "inline_code":
            line += f"`{text.strip()}`"
        else:
            if not line and text.strip():
                lead = "#" * HEADINGS[kind] + " " if kind in HEADINGS else "- " if kind == "li" else ""
            line += _squeeze(text)
    return "\n".join(out)


def _wiki_row(m: re.Match) -> str:
    rows = [r.strip() for r in re.split(r"^\|-.*$", m.group(1), flags=re.M)]
    cells = [[c.strip() for c in re.split(r"\|\||!!", r.lstrip("|! \n"))] for r in rows if r]
    return "\n".join("| " + " | ".join(c) + " |" for c in cells)


def _tex_table(m: re.Match) -> str:
    rows = [r.strip() for r in re.split(r"\\\\", m.group(1).replace("\\hline", "")) if r.strip()]
    return "\n".join("| " + " | ".join(c.strip() for c in r.split("&")) + " |" for r in rows)


#: What a construct becomes. In order: blocks first, then spans.
REWRITES: list[tuple[re.Pattern, object]] = [
    (re.compile(r"^\{\|[^\n]*\n((?:(?!^\{\||^\|\}).)*)^\|\}[ \t]*$", re.M | re.S), _wiki_row),
    (re.compile(r"\\begin\{(?:tabular|array)\}(?:\{[^}]*\})?((?:(?!\\begin\{|\\end\{).)*)\\end\{(?:tabular|array)\}", re.S), _tex_table),
    (re.compile(r"\\(?:begin|end)\{[A-Za-z*]+\}"), ""),
    (re.compile(r"^(={2,6})[ \t]*([^\s=](?:.*[^\s=])?)[ \t]*\1[ \t]*$", re.M), lambda m: "#" * len(m.group(1)) + " " + m.group(2)),
    (re.compile(r"\\(?:part|chapter|section)\*?\{([^{}]*)\}"), r"# \1"),
    (re.compile(r"\\subsection\*?\{([^{}]*)\}"), r"## \1"),
    (re.compile(r"\\subsubsection\*?\{([^{}]*)\}"), r"### \1"),
    (re.compile(r"\\\(((?:(?!\\[()]).)+)\\\)", re.S), r"$\1$"),
    (re.compile(r"\\\[((?:(?!\\[\[\]]).)+)\\\]", re.S), r"$\1$"),
    (re.compile(r"\$\$(.+?)\$\$", re.S), r"$\1$"),
    (re.compile(r"\\(?:cite|ref|label|footnotemark|index)\{[^{}]*\}"), ""),
    (re.compile(r"\\(?:textbf|textit|emph|underline|texttt|textsc|mbox|text|footnote)\{([^{}]*)\}"), r"\1"),
    (re.compile(r"\{\{([^{}|]*)\|?([^{}]*)\}\}"), lambda m: "[" + m.group(2).replace("|", " ") + "]" if m.group(2) else ""),
    (re.compile(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]"), r"\1"),
    (re.compile(r"!?\[([^\[\]]*)\]\([^()\s]*[/.#:@?][^()\s]*(?:\s+\"[^\"]*\")?\)"), r"\1"),
    (re.compile(r"\[https?://[^\s\[\]]+(?:\s([^\[\]]*))?\]"), r"\1"),
    (re.compile(r"'{3}(.+?)'{3}", re.S), r"\1"),
    (re.compile(r"''(?=\S)([^'\n]+)''"), r"\1"),
    (re.compile(r"(?<!\*)\*\*(?!\*)((?:(?!\*\*).)+?)\*\*", re.S), r"\1"),
    (re.compile(r"(?<!\w)__(?=\S)(?![a-z0-9_]+__)((?:(?!__).)+?)__(?!\w)", re.S), r"\1"),
    (re.compile(r"~~(?=\S)([^~\n]+)~~"), r"\1"),
    (re.compile(r"^[ \t]*(?:\|[ \t]*)?:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)*\|?[ \t]*$\n?", re.M), ""),
]


def clean_text(text: str | None) -> str | None:
    """A text with its pieces of markup turned into plain structure; as it is where there is none."""
    if not text or not constructs(text):
        return text
    t = SPECIAL.sub("", text)
    found = list(tags(t))
    if any(m.group(2).lower() == "table" and not m.group(1) for m in found):
        t = "\n".join(written([(k, x) for _, k, x in leaves(p)]) if p.lstrip().startswith("<table") else p for p in re.split(r"(<table(?:(?!<table|</table>).)*</table>)", t, flags=re.S | re.I))
        found = list(tags(t))
    keep, at = [], 0
    for m in found:
        keep.append(t[at : m.start()] + ("\n" if m.group(2).lower() in ("br", "p", "tr") else ""))
        at = m.end()
    t = html_lib.unescape("".join(keep) + t[at:])
    for r, to in REWRITES:
        t = r.sub(to, t)
    spans = re.split(r"(\$[^$\n]*\$|```.*?```)", t, flags=re.S)
    spans[::2] = [re.sub(r"\\([%$&_#{}])", r"\1", x) for x in spans[::2]]
    return "".join(spans).strip()


NODES = "fact_id bigint, host string, kind string"


def _mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(i, h, k) for i, h, t in zip(b["fact_id"], b["host"], b["text"], strict=True) for k in constructs(t)]
        yield pd.DataFrame(rows, columns=["fact_id", "host", "kind"]).astype({"fact_id": "int64"})


def presentation_nodes(df: DataFrame, key: str, host: str, text: str) -> DataFrame:
    """fact_id, host, kind: the markup constructs of each text, by regular expressions; no tree is built. No shuffle."""
    two = df.select(F.col(key).alias("fact_id"), F.col(host).alias("host"), F.col(text).alias("text"))
    return two.where(F.col("fact_id").isNotNull() & F.col("text").rlike(SIGNS)).mapInPandas(_mark, NODES)


def with_markup(df: DataFrame, key: str = "fact_id", host: str = "edinet_code", text: str = "text") -> DataFrame:
    """Keys of texts that hold a construct of markup."""
    return presentation_nodes(df, key, host, text).select(F.col("fact_id").alias(key)).distinct()


@F.pandas_udf(T.StringType())
def _clean(s: pd.Series) -> pd.Series:
    return s.map(clean_text, na_action="ignore").astype(object).where(s.notna(), None)


def clean_column(c: Column) -> Column:
    return _clean(c)


#: Tables, formulas and code are kept or removed as a whole: their leaves go by the path of the outermost one.
WHOLE = re.compile(rf"^([^{SEP}]*(?:{SEP}(?!(?:table|math|pre|code){SEP})[^{SEP}]*)*?{SEP}(?:table|math|pre|code)){SEP}.*$")
TREE = "id bigint, host string, pos int, path string, kind string, text string, style string, kids string, n int, pages int"


def _trees(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows of two kinds for each page: its leaves in order (pos, kind, text), and the styles of each path with their numbers (style, kids, n).

    The first style of a path in a page counts the page. kids: tags of the children and their numbers.
    """
    columns = [c.split()[0] for c in TREE.split(", ")]

    def digest(x: str) -> str:
        return hashlib.blake2b(x.encode("utf-8", "replace"), digest_size=8).hexdigest()

    for b in batches:
        rows = []
        for i, h, t in zip(b["id"], b["host"], b["html"], strict=True):
            w = walked(t)
            rows += [(i, h, n, WHOLE.sub(r"\1", path), kind, text, None, None, 0, 0) for n, (path, kind, text) in enumerate(w.leaves)]
            styles: Counter = Counter()
            for path, labels, tags_ in w.nodes:
                kids = " ".join(f"{k} {n}" for k, n in sorted(Counter(tags_).items()))
                styles[path, digest("\n".join(labels)), kids] += 1
            for path, _, text in w.leaves:
                if text.strip():
                    styles[path, digest(_squeeze(text).strip()), ""] += 1
            seen: set[str] = set()
            for (path, style, kids), n in styles.items():
                rows.append((i, h, None, path, None, None, style, kids, n, int(path not in seen)))
                seen.add(path)
        out = pd.DataFrame(rows, columns=columns)
        out["pos"] = out["pos"].astype("Int32")
        yield out.astype({"id": "int64", "n": "int32", "pages": "int32"})


NODE = "host string, path string, pages bigint, styles bigint, importance double, dull boolean"


def _importance(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The nodes of merged trees from the bottom up: styles come by host, deeper paths first, so only the finished children of open nodes are held."""
    columns = [c.split()[0] for c in NODE.split(", ")]
    done: list[tuple[str, float, bool]] = []
    at: tuple[str, str] | None = None
    kids: dict[str, tuple[float, bool]] = {}
    pages = total = styles = 0
    clogc = below = spread = 0.0

    def finished() -> tuple:
        if pages < 2:
            own = 1.0
        elif at[1].endswith("#text"):
            own = 1 - spread / styles / math.log(pages)
        else:
            own = min(1.0, (math.log(total) - clogc / total) / math.log(pages))
        if not at[1].endswith("#text"):
            keep = GAMMA**styles
            own = (1 - keep) * own + keep * below / total
        dull = pages >= MIN_PAGES and own < LEAST_IMPORTANCE and all(d for _, d in kids.values())
        done.append((at[1], own, dull))
        return (*at, pages, styles, own, dull)

    for b in batches:
        rows = []
        for host, path, said, c, first, having in zip(b["host"], b["path"], b["kids"], b["n"], b["pages"], b["having"], strict=True):
            if (host, path) != at:
                if at is not None:
                    rows.append(finished())
                    if host != at[0]:
                        done.clear()
                at, kids, pages, total, styles, clogc, below, spread = (host, path), {}, 0, 0, 0, 0.0, 0.0, 0.0
                while done and done[-1][0].startswith(path + SEP):
                    p, imp, dull = done.pop()
                    kids[p[len(path) + 1 :]] = (imp, dull)
            pages, total, styles, clogc, spread = pages + first, total + c, styles + 1, clogc + c * math.log(c), spread + math.log(having)
            parts = said.split(" ") if said else []
            held = [(kids[k][0], int(n)) for k, n in zip(parts[::2], parts[1::2], strict=True)]
            below += c * sum(v * n for v, n in held) / sum(n for _, n in held) if held else 0.0
        yield pd.DataFrame(rows, columns=columns)
    if at is not None:
        yield pd.DataFrame([finished()], columns=columns)


def style_tree(rows: DataFrame) -> DataFrame:
    """host, path, pages, styles, importance, dull: the nodes of the merged trees of _trees().

    Styles fall together by (host, path, style) before the shuffle. What is left of a host, its
    merged tree, is read in order by one task that holds one branch of it at a time.
    """
    styles = rows.where("style IS NOT NULL").groupBy("host", "path", "style", "kids").agg(F.sum("n").alias("n"), F.sum("pages").alias("pages"), F.count("*").alias("having"))
    return styles.repartition("host").sortWithinPartitions("host", F.desc("path")).select("host", "path", "kids", "n", "pages", "having").mapInPandas(_importance, NODE)


def clean_pages(df: DataFrame, key: str = "fact_id", host: str = "edinet_code", html: str = "html") -> DataFrame:
    """key, clean: the text of each page without branches of low importance. Pages are distinct by key.

    Pages are parsed once. A page of which no leaf is left has an empty text, one without html a null.
    """
    every = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max(F.col(html).isNotNull()).alias("some"))
    pages = df.select(F.col(key).alias("id"), F.coalesce(F.col(host), F.lit("")).alias("host"), F.col(html).alias("html")).where("id IS NOT NULL AND html IS NOT NULL").dropDuplicates(["id"])
    rows = cut(pages.mapInPandas(_trees, TREE))
    dull = style_tree(rows).where("dull").select("host", "path")
    kept = rows.where("pos IS NOT NULL").join(dull, ["host", "path"], "left_anti")
    back = kept.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "kind", "text"))).alias("parts"))
    texts = back.select("id", _written(F.col("parts")).alias("clean"))
    return every.join(texts, "id", "left").select(F.col("id").alias(key), F.when(F.col("some"), F.coalesce("clean", F.lit(""))).alias("clean"))


@F.pandas_udf(T.StringType())
def _written(s: pd.Series) -> pd.Series:
    return s.map(lambda parts: written([(p["kind"], p["text"]) for p in parts]))
