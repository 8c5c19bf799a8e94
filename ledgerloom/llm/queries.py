"""Queries of the training-text problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import lookalikes, markup, mixing, mojibake, pii, repetition, splitting, tokens
from ledgerloom.session import cut, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return repetition.found(table(spark, d, "filing_md"))


def p1_shares(spark: SparkSession, d: str) -> DataFrame:
    m = repetition.judged(table(spark, d, "filing_md"))
    return m.select("doc_id", F.round("repeat_share", 6).alias("repeat_share"), F.round("run_share", 6).alias("run_share"), F.round("line_share", 6).alias("line_share"), "violated")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.oversized(table(spark, d, "filing_md"), table(spark, d, "split_limits"))


def p2_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.pieces(table(spark, d, "filing_md").dropDuplicates(["doc_id"]), table(spark, d, "split_limits"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.found(table(spark, d, "dart_fetch"))


def p7_repaired(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.repair(table(spark, d, "dart_fetch"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.token_ids(table(spark, d, "documents"))


def p8_counts(spark: SparkSession, d: str) -> DataFrame:
    return tokens.token_counts(table(spark, d, "documents"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    sizes = cut(mixing.sized(table(spark, d, "documents")))
    return mixing.mixed(sizes, table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(p9_mix(spark, d), table(spark, d, "mix_targets"))


def _heated(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, float]:
    """Sizes, targets, and as many tokens asked as all usable documents of target sources hold: more than the repetition limits give at the targets."""
    sizes, targets = cut(mixing.sized(table(spark, d, "documents"))), table(spark, d, "mix_targets")
    named = targets.where("target_share > 0").select(mixing.source_key(F.col("source")).alias("source")).distinct()
    return sizes, targets, float(sizes.join(named, "source", "left_semi").agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0])


def p9_heated(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed(*_heated(spark, d))


def p9_heated_plan(spark: SparkSession, d: str) -> DataFrame:
    return mixing.plan(*_heated(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.with_markup(table(spark, d, "edinet_xbrl"))


def p4_text(spark: SparkSession, d: str) -> DataFrame:
    facts = table(spark, d, "edinet_xbrl").select("fact_id", "text").distinct()
    return facts.select("fact_id", markup.clean_column(F.col("text")).alias("clean"))


def p4_html(spark: SparkSession, d: str) -> DataFrame:
    return markup.clean_pages(table(spark, d, "edinet_xbrl"))


def _same_looking(spark: SparkSession, d: str) -> DataFrame:
    facts = table(spark, d, "edinet_xbrl").where("kind = 'text'")
    md = lookalikes.forms(table(spark, d, "filing_md"), "doc_id", ["stock_code", "doc_type", "report_period"], "md", "md")
    return lookalikes.classes(lookalikes.forms(facts, "fact_id", ["doc_id", "concept"], "text", "text").unionByName(md))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.pairs(_same_looking(spark, d))


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.links(_same_looking(spark, d))


def p5_forms(spark: SparkSession, d: str) -> DataFrame:
    facts = table(spark, d, "edinet_xbrl").where("kind = 'text'").select("fact_id", "text").distinct()
    return facts.withColumn("form", lookalikes.consistent_form(F.col("text")))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.found(table(spark, d, "documents"))


def p10_masked(spark: SparkSession, d: str) -> DataFrame:
    return pii.masked(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_shares, p2_found, p2_pieces, p4_found, p4_text, p4_html, p5_found, p5_classes, p5_forms, p7_found, p7_repaired, p8_ids, p8_counts, p9_mix, p9_shares, p9_heated, p9_heated_plan, p10_found, p10_masked)}

def _form_sql(c: str) -> str:
    """The shapes of a text, character by character: equal where consistent forms are."""
    plain = {chr(k): v for k, v in lookalikes.FORMS.items() if v and len(v) == 1} | lookalikes.TO_LATIN | lookalikes.KANA
    plain = {k: lookalikes.KANA.get(v, v) for k, v in plain.items()}
    gone = "".join(chr(k) for k, v in lookalikes.FORMS.items() if not v and k < 0x20000)
    out = f"translate(replace({c}, chr(13) || chr(10), chr(10)), '{''.join(plain)}{gone}', '{''.join(plain.values()).replace(chr(39), chr(39) * 2)}')"
    for k, v in lookalikes.FORMS.items():
        if v and len(v) > 1:
            out = f"replace({out}, '{chr(k)}', '{v}')"
    # Letters of other scripts under an accent: apart, by shape, together.
    return f"nfc_normalize({out})"


ORACLES = {
    "p5_found": f"""WITH t AS (SELECT DISTINCT 'text' AS field, fact_id AS id, doc_id || '|' || concept AS k, text AS s FROM edinet_xbrl WHERE kind = 'text' AND text IS NOT NULL
       UNION SELECT 'md', doc_id, stock_code || '|' || doc_type || '|' || report_period, md FROM filing_md WHERE md IS NOT NULL),
     f AS (SELECT field, id, k, s, {_form_sql('s')} AS form FROM t WHERE k IS NOT NULL)
     SELECT DISTINCT a.field AS field, a.id AS left_id, b.id AS right_id FROM f a JOIN f b ON a.field = b.field AND a.k = b.k AND a.form = b.form WHERE a.id < b.id AND a.s <> b.s""",
    "p2_found": """SELECT DISTINCT doc_id FROM filing_md JOIN split_limits USING (market)
     WHERE CASE size_unit WHEN 'bytes' THEN octet_length(encode(md)) ELSE length(md) END > max_size""",
}
