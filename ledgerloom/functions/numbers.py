"""Number parsers as column expressions. Their sign rules differ on purpose; they are kept apart.

All give null for blanks and dashes: not measured is not zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANKS = r"\s\x{A0}\x{3000}"
WIDE_DIGITS, DIGITS = "０１２３４５６７８９，．－（）", "0123456789,.-()"
#: Marks in front of a negative amount.
MINUS = "△▲−－-("


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^[{BLANKS}]+|[{BLANKS}]+$", "")


def fold_digits(c: Column) -> Column:
    """Full-width digits and signs in ASCII."""
    return F.translate(c, WIDE_DIGITS, DIGITS)


def num_lenient(c: Column) -> Column:
    """First number of a cell; ASCII brackets around the whole cell or a leading minus negate. A triangle does not."""
    s = strip(c)
    neg = s.rlike(r"^\(.*\)$")
    body = F.when(neg, F.regexp_replace(s, r"^\(|\)$", "")).otherwise(s)
    body = F.regexp_replace(body, rf"[{BLANKS}$¥￥※＊*]", "")
    raw = F.regexp_extract(body, r"([-+−]?[0-9,]+(?:\.[0-9]+)?)", 1)
    v = F.regexp_replace(F.translate(raw, "−", "-"), "[,+]", "").try_cast("double")
    return F.when(neg, -v).otherwise(v)


STRICT = r"^[（(]?[\s]*[¥$￥€]?[\s]*[-−+]?([0-9]{1,3}(,[0-9]{3})+|[0-9]+)(\.[0-9]+)?[\s]*[)）]?$"


def num_strict_cell(c: Column) -> Column:
    """num_lenient where the whole cell is one number with legal grouping, else null."""
    return F.when(strip(c).rlike(STRICT), num_lenient(c))


def num_ixbrl_cell(text: Column, scale: Column, sign: Column) -> Column:
    """Digits, dot and hyphen only, times ten to the scale; brackets and triangles are lost, the sign attribute negates."""
    v = F.regexp_replace(fold_digits(text), r"[^0-9.\-]", "").try_cast("double")
    v = v * F.pow(F.lit(10.0), F.coalesce(scale.try_cast("int"), F.lit(0)))
    return F.when(sign == "-", -v).otherwise(v)


def num_xbrl_fact(text: Column, scale: Column, sign: Column) -> Column:
    """Strict: the cleaned text must be one number. Brackets, triangles and minus negate; the sign attribute toggles."""
    s = F.regexp_replace(fold_digits(text), rf"[{BLANKS},$¥￥]", "")
    neg = s.rlike(r"^\(.*\)$") | s.rlike(r"^[△▲−-]")
    bare = F.regexp_replace(s, r"^\(|\)$|^[△▲−-]", "")
    v = F.when(bare.rlike(r"^[0-9]+(\.[0-9]+)?$"), bare.try_cast("double")) * F.pow(F.lit(10.0), F.coalesce(scale.try_cast("int"), F.lit(0)))
    return F.when(neg != F.coalesce(sign == "-", F.lit(False)), -v).otherwise(v)


def amount_cf(c: Column) -> Column:
    """Cash-flow amount: optional brackets, minus and dollar; only brackets negate besides the minus."""
    ok = c.rlike(r"^\(?-?\$?[0-9,]+(\.[0-9]+)?\)?$")
    v = F.regexp_replace(c, r"[,$()]", "").try_cast("double")
    return F.when(ok, F.when(c.rlike(r"^\(.*\)$"), -v).otherwise(v))


def amount_bs(c: Column) -> Column:
    """Balance-sheet amount: unsigned, 5 to 12 digits."""
    d = F.regexp_replace(c, r"[$,\s]", "")
    return F.when(c.rlike(r"^\s*\$?\s*[0-9,]+\s*$") & d.rlike(r"^[0-9]{5,12}$"), d.try_cast("double"))


def fmt_int(c: Column) -> Column:
    """Thousands separators where the text is an integer, else as it is."""
    return F.when(c.rlike(r"^-?[0-9]{1,18}$"), F.format_number(c.try_cast("bigint"), 0)).otherwise(c)


RUN = r"([^0-9.,]{0,2})([0-9.,]+)"
PREFIX = r"^([0-9]{1,3}(,[0-9]{3})+|[0-9]+)(\.[0-9]+)?([.,]|$)"


def numbers_in(text: Column) -> Column:
    """All numbers of a string, signed by the two characters before: maximal digit runs, read by their anchored prefix."""
    t = fold_digits(text)
    runs = F.arrays_zip(F.regexp_extract_all(t, F.lit(RUN), 1).alias("before"), F.regexp_extract_all(t, F.lit(RUN), 2).alias("run"))

    def value(r: Column) -> Column:
        v = F.regexp_replace(F.regexp_extract(r["run"], r"^((?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]+)?)(?:[.,]|$)", 1), ",", "").try_cast("double")
        return F.when(r["before"].rlike(r"[△▲−\-(]"), -v).otherwise(v)

    return F.filter(F.transform(runs, value), lambda v: v.isNotNull())


def numeric_hit(nums: Column, value: Column, printed: Column, rel: float = 1e-6) -> Column:
    """Whether a fact stands among the numbers: as printed with either sign, else its absolute value at scales 1, 10^3, 10^6, 10^8."""
    near = lambda x, t: F.abs(F.abs(x) - t) <= F.lit(rel) * F.greatest(t, F.lit(1e-300))
    said = F.abs(num_lenient(printed))
    scaled = F.exists(F.array(*[F.lit(float(10**k)) for k in (0, 3, 6, 8)]), lambda k: (F.abs(value) / k >= 1) & F.exists(nums, lambda x: near(x, F.abs(value) / k)))
    return F.coalesce(F.exists(nums, lambda x: near(x, said)), F.lit(False)) | F.coalesce(scaled, F.lit(False))


def number_is(x: Column, value: Column, printed: Column, rel: float = 1e-6) -> Column:
    """numeric_hit for one number: plain arithmetic, which stays in generated code."""
    near = lambda t: F.abs(F.abs(x) - t) <= F.lit(rel) * t
    out = F.coalesce(near(F.abs(printed)), F.lit(False))
    for k in (0, 3, 6, 8):
        t = F.abs(value) / float(10**k)
        out = out | F.coalesce((t >= 1) & near(t), F.lit(False))
    return out
