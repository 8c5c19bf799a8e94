"""Conversion held against truth: recall, pairing with failure attribution, reports, variants, vendor statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import numbers_in
from ledgerloom.operators.lines import lines
from ledgerloom.session import merged

LEAST = 1e6


def key_form(c):
    """Labels and lines without spaces, commas and pipes."""
    return F.regexp_replace(c, r"[\s\x{A0}\x{3000},|]", "")


REL = 1e-6
#: Bins of values are more than twice as wide as the tolerance: what is near stands in the own bin or the nearer one beside it.
WIDTH = 2.1 * REL
SCALES = (0, 3, 6, 8)


def _place(v):
    return F.log(v) / F.lit(WIDTH)


def _bin(v):
    """The bin of an absolute value; zero has one of its own."""
    return F.when(v == 0, F.lit(-(2**62))).otherwise(F.floor(_place(v)))


def _two_bins(v):
    low = _place(v) - F.floor(_place(v)) < 0.5
    return F.when(v == 0, F.array(_bin(v))).otherwise(F.array(_bin(v), _bin(v) + F.when(low, -1).otherwise(1)))


def value_recall(docs: DataFrame, truth: DataFrame) -> DataFrame:
    """Share of testable facts whose value stands anywhere in the text, at any of four scales.

    The tolerance join is an equality join on (document, logarithmic bin): a fact's value at each
    scale looks into two bins, a number of the text stands in one.
    """
    nums = docs.select("doc_id", F.explode(F.array_distinct(F.transform(numbers_in(F.col("md")), F.abs))).alias("x")).where("x <> 0")
    nums = nums.select("doc_id", "x", _bin(F.col("x")).alias("b"))
    t = truth.where(F.abs("value") >= LEAST).select("doc_id", "fact_no", F.abs("value").alias("v"))
    probes = t.select("doc_id", "fact_no", F.explode(F.array(*[F.col("v") / 10**k for k in SCALES])).alias("p")).where("p >= 1")
    probes = probes.select("doc_id", "fact_no", "p", F.explode(_two_bins(F.col("p"))).alias("b"))
    hits = probes.join(nums, ["doc_id", "b"]).where(F.abs(F.col("x") - F.col("p")) <= REL * F.col("p")).select("doc_id", "fact_no").distinct().withColumn("hit", F.lit(1))
    per = t.join(hits, ["doc_id", "fact_no"], "left").groupBy("doc_id").agg(F.count("*").alias("tested"), F.count("hit").alias("hits"))
    return per.withColumn("recall", F.round(F.col("hits") / F.col("tested"), 6))


def pairing(docs: DataFrame, truth: DataFrame, printed: str | None = None) -> DataFrame:
    """Each testable truth row as hit, value_elsewhere, value_absent or label_missing.

    Facts meet the numbers of their document by (document, logarithmic bin), so only numbers near a
    fact's value at one of its scales, or as printed, are held against its label; whether a label
    stands anywhere is asked once of the whole document. printed: the column of the value as
    printed, if it differs from the value.
    """
    lines_ = lines(docs).select("doc_id", key_form(F.col("line")).alias("norm"), F.array_distinct(F.transform(numbers_in(F.col("line")), F.abs)).alias("xs")).where("size(xs) > 0")
    nums = lines_.select("doc_id", "norm", F.explode("xs").alias("x")).withColumn("b", _bin(F.col("x")))
    said = F.abs(F.col(printed) if printed else F.col("value"))
    t = truth.where(F.abs("value") >= LEAST).select("doc_id", "fact_no", key_form(F.col("label")).alias("key"), F.abs("value").alias("v"), said.alias("said")).where("key <> ''")
    scaled = F.filter(F.array(*[F.col("v") / float(10**k) for k in SCALES]), lambda x: x >= 1)
    targets = F.array_distinct(F.filter(F.concat(F.array("said"), scaled), lambda x: x.isNotNull()))
    probes = t.select("doc_id", "fact_no", "key", F.explode(targets).alias("p")).select("*", F.explode(_two_bins(F.col("p"))).alias("b"))
    near = probes.join(merged(nums), ["doc_id", "b"]).where(F.abs(F.col("x") - F.col("p")) <= REL * F.col("p"))
    met = near.groupBy("doc_id", "fact_no").agg(F.bool_or(F.contains("norm", F.col("key"))).alias("hit"))
    whole = docs.select("doc_id", F.array_join(F.transform(F.split("md", "\n"), key_form), "\n").alias("text"))
    named = t.join(merged(whole), "doc_id", "left").groupBy("doc_id", "fact_no").agg(F.bool_or(F.contains("text", F.col("key"))).alias("lab"))
    j = named.join(merged(met), ["doc_id", "fact_no"], "left")
    status = F.when(F.col("hit"), "hit").when(~F.coalesce("lab", F.lit(False)), "label_missing").when(F.col("hit").isNotNull(), "value_elsewhere").otherwise("value_absent")
    return j.select("doc_id", "fact_no", status.alias("status"))


def attribution(pairs: DataFrame) -> DataFrame:
    kinds = ("hit", "value_elsewhere", "value_absent", "label_missing")
    return pairs.groupBy("doc_id").agg(F.count("*").alias("tested"), *[F.count_if(F.col("status") == k).alias(k) for k in kinds]).withColumn("rate", F.round(F.col("hit") / F.col("tested"), 6))


def evaluation(docs: dict[str, DataFrame], truth: DataFrame) -> DataFrame:
    """One row per document of `pdf` with the pairing rates of its sources side by side, and what keeps it from being measured.

    docs: by source (pdf; ixbrl and control where there are any) doc_id and md. suspect_input_mismatch:
    50 labelled facts or more but fewer than 150 characters for each. not_measurable: no labelled fact.
    """
    base = docs["pdf"].select("doc_id", F.coalesce(F.char_length("md"), F.lit(0)).alias("md_chars"))
    labelled = truth.where(F.col("label").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n_labeled"))
    out = base.join(merged(labelled), "doc_id", "left").withColumn("n_labeled", F.coalesce("n_labeled", F.lit(0)))
    for name, d in docs.items():
        a = attribution(pairing(d, truth))
        out = out.join(merged(a.select("doc_id", F.col("rate").alias(f"{name}_rate"), F.col("tested").alias(f"{name}_tested"))), "doc_id", "left")
    mismatch = (F.col("n_labeled") >= 50) & (F.col("md_chars") < 150 * F.col("n_labeled"))
    return out.withColumns({"suspect_input_mismatch": mismatch, "not_measurable": F.col("n_labeled") == 0})


def positional(rates: DataFrame, value: str, group: str) -> DataFrame:
    """Median, tenth and ninetieth percentile by position v[floor(n p)], least value and tails, by group.

    Works on counts of distinct rates: they are rounded, so a group of any size comes down to a
    bounded number of values before it meets in one window.
    """
    per = rates.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("c"))
    w = Window.partitionBy(group).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = per.withColumns({"upto": F.sum("c").over(w), "n": F.sum("c").over(Window.partitionBy(group))})
    at = lambda a, b: F.min(F.when(F.col("upto") > F.floor(F.col("n") * a / b), F.col(value)))
    tail = lambda limit: F.sum(F.when(F.col(value) < limit, F.col("c")).otherwise(0))
    return r.groupBy(group).agg(
        F.sum("c").alias("docs"), at(1, 2).alias("median"), at(1, 10).alias("p10"), at(9, 10).alias("p90"), F.min(value).alias("least"), tail(0.5).alias("below_half"), tail(0.8).alias("below_08")
    )


def compare_variants(base: DataFrame, other: DataFrame, value: str = "rate") -> DataFrame:
    """Wins, losses and ties of a variant over the documents both have."""
    j = base.select("doc_id", F.col(value).alias("a")).join(other.select("doc_id", F.col(value).alias("b")), "doc_id")
    return j.agg(F.count("*").alias("docs"), F.count_if(F.col("b") > F.col("a")).alias("wins"), F.count_if(F.col("b") < F.col("a")).alias("losses"), F.round(F.avg("a"), 6).alias("mean_base"), F.round(F.avg("b"), 6).alias("mean_other"))


def aligned(truth: DataFrame, reports: DataFrame) -> DataFrame:
    """Vendor rows of exactly the reported date; never the nearest."""
    return merged(reports).join(truth, ["symbol", "date"]).select("symbol", "date", "field", "value")


def cliff(statements: DataFrame, limit: float = 0.30) -> DataFrame:
    """Third against fourth quarter of a year: jump, and whether it is a restatement cliff."""
    per = statements.groupBy("symbol", "year").agg(F.sum(F.when(F.col("quarter") == 3, F.col("value"))).alias("q3"), F.sum(F.when(F.col("quarter") == 4, F.col("value"))).alias("q4"))
    jump = F.when((F.col("q3") != 0) & F.col("q4").isNotNull(), F.abs(F.col("q4") - F.col("q3")) / F.abs("q3"))
    return per.select("symbol", "year", "q3", "q4", F.round(jump, 6).alias("jump"), F.coalesce(jump > limit, F.lit(False)).alias("excluded"))


def consistency(rows: DataFrame, limit: float = 0.02) -> DataFrame:
    """A vendor's own identity: skip reason where it fails by more than the limit or cannot be asked."""
    off = F.try_divide(F.abs(F.col("assets") - F.col("liabilities") - F.col("equity")), F.abs("assets"))
    return rows.withColumn("skip_reason", F.when(off.isNull(), "incomplete").when(off > limit, "inconsistent"))


def eligible(checked: DataFrame, vendor: DataFrame, cliffs: DataFrame) -> DataFrame:
    """doc_id, skip_reason of each document for the vendor comparison: null where it takes part.

    checked: precheck of the texts (doc_id, reason); vendor: consistency (doc_id, skip_reason); cliffs:
    documents whose issuer restated (doc_id, excluded). The first reason counts.
    """
    j = checked.join(vendor.select("doc_id", F.col("skip_reason").alias("own")), "doc_id", "left").join(cliffs.groupBy("doc_id").agg(F.bool_or("excluded").alias("cliff")), "doc_id", "left")
    return j.select("doc_id", F.coalesce("reason", "own", F.when(F.col("cliff"), "restatement_cliff")).alias("skip_reason"))


def bench_summary(results: DataFrame) -> DataFrame:
    """Pass, fail and skip with rates by market and over all; skips count against the rate."""
    r = results.rollup("market").agg(
        F.grouping("market").alias("g"), F.count("*").alias("n"), *[F.count_if(F.col("status") == s).alias(s) for s in ("pass", "fail", "skip")], F.min("chars").alias("min_chars"), F.max("chars").alias("max_chars")
    )
    return r.select(F.when(F.col("g") == 1, "ALL").otherwise(F.coalesce("market", F.lit("?"))).alias("market"), "n", "pass", "fail", "skip", F.round(F.col("pass") / F.col("n"), 6).alias("pass_rate"), "min_chars", "max_chars")
