"""Scalar functions over filing metadata and markup text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def disclosure_type(name: Column) -> Column:
    """annual, semiannual, q1, q3 or prospectus; corrections and the rest are null."""
    month = F.regexp_extract(name, r"\([0-9]{4}\.([0-9]{2})\)", 1)
    return (
        F.when(name.rlike("정정|訂正"), F.lit(None).cast("string"))
        .when(name.rlike("증권신고서|證券申告書"), "prospectus")
        .when(name.rlike("사업보고서|事業報告書"), "annual")
        .when(name.rlike("반기보고서|半期報告書"), "semiannual")
        .when(name.rlike("분기보고서|四半期報告書"), F.when(month.isin("", "03"), "q1").otherwise("q3"))
    )


def period_of(name: Column) -> Column:
    """Last day of the month named in brackets, for months that end a quarter."""
    y, m = (F.regexp_extract(name, r"\(([0-9]{4})\.([0-9]{2})\)", i).try_cast("int") for i in (1, 2))
    return F.when(m.isin(3, 6, 9, 12), F.last_day(F.make_date(y, m, F.lit(1))))


def sane_xml(text: Column) -> Column:
    """Bare ampersands and angle brackets escaped, control characters dropped."""
    t = F.regexp_replace(text, r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9a-fA-F]+);)", "&amp;")
    t = F.regexp_replace(t, r"<(?![A-Za-z/!?])", "&lt;")
    return F.regexp_replace(t, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")


def front_matter(md: Column) -> Column:
    """A text without its front matter."""
    return F.regexp_replace(md, r"(?s)^---\n.*?\n---\n?", "")


def yaml_text(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))


def to_front_matter(fields: dict[str, Column]) -> Column:
    """Front matter of the fields that are there, in order; none if all are missing."""
    rows = F.concat_ws("\n", *[F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f"{k}: "), yaml_text(c))) for k, c in fields.items()])
    return F.when(rows != "", F.concat(F.lit("---\n"), rows, F.lit("\n---\n"))).otherwise("")


#: Which converter an exchange's filings go to.
FORMATS = {"sse": "layout", "szse": "layout", "bj": "layout", "jpx": "ixbrl_zip", "twse": "ixbrl", "tpex": "ixbrl", "ksc": "dart_xml", "koe": "dart_xml", "knx": "dart_xml", "nse": "xbrl", "br": "cvm_xml"}
ESEF = "lse fr nl be it es se dk fi no at pt lu gr pl cz hu is".split()


def format_of(exchange: Column) -> Column:
    """The format of an exchange; `unsupported` instead of an error."""
    out = F.when(exchange.isin(*ESEF), "esef").otherwise("unsupported")
    for e, f in FORMATS.items():
        out = F.when(exchange == e, f).otherwise(out)
    return out


def is_page_number(c: Column) -> Column:
    """Digits alone, or `n / m`."""
    return F.trim(c).rlike(r"^\p{Nd}+(?:\s*/\s*\p{Nd}+)?$")


#: Words of unit lines, and marks that end a sentence and so no caption or heading.
UNIT_WORD, NO_CAPTION = "单位", r"[。；，、．.,;:：]$"


def is_caption(c: Column) -> Column:
    """A unit line, or a short text that ends like no sentence."""
    return (c != "") & (F.contains(c, F.lit(UNIT_WORD)) | ((F.char_length(c) <= 40) & ~c.rlike(NO_CAPTION)))


def quoted_units(md: Column) -> Column:
    """Lines that begin with the unit, trimmed and quoted."""
    return F.regexp_replace(md, r"(?m)^[ \t\x{3000}]*((?:单位|単位)\s*[:：][^\n]*?)[ \t\r\x{3000}]*$", "> $1")


def needs_space(a: Column, b: Column) -> Column:
    """Whether two pieces of text are joined by a space: both sides of the seam are ASCII."""
    return a.rlike(r"[\x00-\x7F]$") & b.rlike(r"^[\x00-\x7F]")
