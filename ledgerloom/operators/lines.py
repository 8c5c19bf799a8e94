"""Metrics of a filing's text over its relation of lines.

One pass makes the lines; each metric is a partial aggregate by document, so a document's rows meet
once. A rate is null where nothing was tested, and `status` says skip.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import strip
from ledgerloom.session import merged

SECTION = r"^\s*#{1,4}\s+\S|^\s*第[一二三四五六七八九十百0-9]+[节章節]|^\s*SECTION[-\s]?[0-9]|^\s*第[一二三四五六七八九十0-9]+【"
#: Names of a financial report's main chapter.
FINANCIAL = "财务报告|財務報告|財務報表|財務諸表|連結財務諸表|财务报表"
#: Script a market's narrative must show, and its least share.
EXPECTED = {"jp": ("kana", 0.05), "kr": ("hangul", 0.05), "cn": ("han", 0.10), "tw": ("han", 0.10)}
SCRIPTS = {
    "kana": r"[\x{3040}-\x{30FF}\x{31F0}-\x{31FF}]", "hangul": r"[\x{AC00}-\x{D7AF}\x{1100}-\x{11FF}]", "han": r"[\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{F900}-\x{FAFF}]",
    "latin": r"[A-Za-z]", "digit": r"[0-9\x{FF10}-\x{FF19}]",
}
BROKEN = {"replacement": r"\x{FFFD}", "private_use": r"[\x{E000}-\x{F8FF}\x{F0000}-\x{FFFFD}\x{100000}-\x{10FFFD}]", "control": r"[\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}\x{7F}-\x{9F}]"}


def lines(docs: DataFrame, text: str = "md", key: str = "doc_id") -> DataFrame:
    return docs.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def duplication(docs: DataFrame, min_len: int = 20) -> DataFrame:
    """Share of plain-text lines of min_len or more that stood before; table rows and rules don't count."""
    s = strip(F.col("line"))
    kept = lines(docs).select("doc_id", s.alias("s")).where((F.char_length("s") >= min_len) & ~F.col("s").rlike(r"^[\s|:\-]+$") & ~F.col("s").startswith("|"))
    per = kept.groupBy("doc_id", "s").agg(F.count("*").alias("c"))
    out = per.groupBy("doc_id").agg(F.sum("c").alias("lines"), F.sum(F.col("c") - 1).alias("repeated"))
    return out.withColumn("dup_ratio", F.round(F.col("repeated") / F.col("lines"), 6))


def top_repeated(docs: DataFrame, k: int = 3, min_len: int = 20) -> DataFrame:
    """The k most repeated lines of each document; ties by where they stood first."""
    s = strip(F.col("line"))
    kept = lines(docs).select("doc_id", "line_no", s.alias("s")).where((F.char_length("s") >= min_len) & ~F.col("s").rlike(r"^[\s|:\-]+$") & ~F.col("s").startswith("|"))
    per = kept.groupBy("doc_id", "s").agg(F.count("*").alias("c"), F.min("line_no").alias("first")).where("c > 1")
    w = Window.partitionBy("doc_id").orderBy(F.desc("c"), "first")
    return per.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("doc_id", "rank", F.substring("s", 1, 60).alias("line"), "c")


def garbled(docs: DataFrame, text: str = "md") -> DataFrame:
    counts = {k: F.regexp_count(text, F.lit(p)).cast("bigint") for k, p in BROKEN.items()}
    out = docs.select("doc_id", F.char_length(text).cast("bigint").alias("chars"), *[c.alias(k) for k, c in counts.items()])
    return out.withColumn("ratio", F.round((F.col("replacement") + F.col("private_use") + F.col("control")) / F.greatest("chars", F.lit(1)), 6))


def sections(docs: DataFrame) -> DataFrame:
    """Number of headings, whether a financial chapter is there, first five headings."""
    heads = lines(docs).where(F.col("line").rlike(SECTION))
    per = heads.groupBy("doc_id").agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_list(F.struct("line_no", F.substring(strip(F.col("line")), 1, 40).alias("h")))), 1, 5).alias("first"))
    return docs.select("doc_id", F.col("md").rlike(FINANCIAL).alias("has_financial")).join(merged(per), "doc_id", "left").select(
        "doc_id", F.coalesce("n", F.lit(0)).alias("section_count"), "has_financial", F.array_join(F.transform("first", lambda x: x["h"]), " / ").alias("sample")
    )


def split_sections(docs: DataFrame) -> DataFrame:
    """doc_id, section_no, title, body_chars: cut at the first heading level there is, in six steps; the first line is the title."""
    n = "一二三四五六七八九十"
    body = F.regexp_replace("md", r"(?s)^---\n.*?\n---\n?", "")
    levels = [(r"\n# ", "# "), (r"\n## ", "## "), (rf"\n### [{n}]+、", rf"### [{n}]+、"), (rf"\n### （[{n}]+）", rf"### （[{n}]+）"), (r"\n### ", "### ")]
    level = F.lit(r"#{1,3} ")
    for test, start in reversed(levels):
        level = F.when(F.col("body").rlike(test), F.lit(start)).otherwise(level)
    d = docs.where("md IS NOT NULL").select("doc_id", body.alias("body")).select("doc_id", level.alias("level"), F.posexplode(F.split("body", "\n")).alias("line_no", "line"))
    d = d.withColumn("starts", (F.regexp_instr("line", F.concat(F.lit("^"), F.col("level"))) > 0).cast("int") * (F.col("line_no") > 0).cast("int"))
    w = Window.partitionBy("doc_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("section_no", F.sum("starts").over(w))
    parts = d.groupBy("doc_id", "section_no").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("ls"))
    text = F.transform("ls", lambda x: x["line"])
    title = strip(F.regexp_replace(F.get(text, F.lit(0)), r"^#+\s*", ""))
    rest = F.array_join(F.slice(text, F.lit(2), F.greatest(F.size(text), F.lit(1))), "\n")
    return parts.select("doc_id", "section_no", title.alias("title"), F.char_length(strip(rest)).alias("body_chars")).where("title <> ''")


def fragmentation(docs: DataFrame, min_body: int = 50) -> DataFrame:
    """Share of sections with a body under min_body characters; skip where there is one section or none."""
    per = split_sections(docs).groupBy("doc_id").agg(F.count("*").alias("sections"), F.count_if(F.col("body_chars") < min_body).alias("fragments"))
    out = docs.where("md IS NOT NULL").select("doc_id").join(merged(per), "doc_id", "left").na.fill(0, ["sections", "fragments"])
    ok = F.col("sections") > 1
    return out.select("doc_id", F.when(ok, "ok").otherwise("skip").alias("status"), "sections", F.when(ok, F.col("fragments")).alias("fragments"), F.when(ok, F.round(F.col("fragments") / F.col("sections"), 6)).alias("fragment_ratio"))


def fake_headings(docs: DataFrame) -> DataFrame:
    h = strip(F.substring("line", 5, 1 << 30))
    heads = lines(docs).where(F.col("line").startswith("### ")).select("doc_id", h.alias("h"))
    bad = F.col("h").rlike("[。；！？]$|。")
    return heads.groupBy("doc_id").agg(F.count("*").alias("headings"), F.count_if(bad).alias("fake")).withColumn("fake_ratio", F.round(F.col("fake") / F.col("headings"), 6))


def script_profile(docs: DataFrame) -> DataFrame:
    """Shares of scripts in the narrative (lines of ten or more characters outside tables) and in the whole text, and whether the market's own is missing from the narrative."""
    s = strip(F.col("line"))
    narrative = ~F.col("line").rlike(r"^\s*\|") & (F.char_length(s) >= 10)
    ls = docs.select("doc_id", "market", F.posexplode(F.split("md", "\n")).alias("line_no", "line"))
    counts = {k: F.regexp_count("line", F.lit(p)) for k, p in SCRIPTS.items()}
    filled = F.char_length(F.regexp_replace("line", r"[\s\x{A0}\x{3000}]", ""))
    per = ls.groupBy("doc_id", "market").agg(
        *[F.sum(F.when(narrative, c).otherwise(0)).alias(k) for k, c in counts.items()],
        F.sum(F.when(narrative, filled).otherwise(0)).alias("narrative_chars"),
        *[F.sum(c).alias(f"{k}_all") for k, c in counts.items()],
        F.sum(filled).alias("all_chars"),
    )
    ok = F.col("narrative_chars") >= 200
    share = lambda k: F.when(ok, F.round(F.col(k) / F.col("narrative_chars"), 6))
    want: Column = F.lit(None).cast("boolean")
    for market, (script, floor) in EXPECTED.items():
        want = F.when((F.col("market") == market) & ok, F.col(script) / F.col("narrative_chars") < floor).otherwise(want)
    whole = [F.round(F.try_divide(f"{k}_all", "all_chars"), 6).alias(f"{k}_whole") for k in SCRIPTS]
    status = F.when(ok, "ok").otherwise("skip").alias("status")
    return per.select("doc_id", status, "narrative_chars", *[share(k).alias(f"{k}_ratio") for k in SCRIPTS], *whole, want.alias("suspicious"))


def coverage(docs: DataFrame, sources: DataFrame) -> DataFrame:
    """Characters of the converted text against those of its source."""
    return docs.join(merged(sources), "doc_id").select("doc_id", F.char_length("md").alias("md_chars"), "source_chars", F.round(F.try_divide(F.char_length("md"), "source_chars"), 4).alias("coverage"))
