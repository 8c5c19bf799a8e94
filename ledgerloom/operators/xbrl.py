"""Facts and contexts of inline and plain XBRL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import num_xbrl_fact

FACT = r'(?s)<ix:(nonFraction|nonNumeric)\b((?:[^>"]|"[^"]*")*?)(?:/>|>(.*?)</ix:\1>)'
#: Names that are no concepts in generic XBRL.
NOISE = ("context", "unit", "schemaRef", "explicitMember", "measure")


def attribute(tag: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(tag, rf'\b{name}="([^"]*)"', 1), F.lit(""))


def inline_facts(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Facts tagged in markup: one row each, in order. A self-closing fact is empty and takes nothing of the next."""
    tags = F.arrays_zip(*[F.regexp_extract_all(html, F.lit(FACT), i).alias(n) for i, n in ((1, "kind"), (2, "attrs"), (3, "body"))])
    p = pages.where(F.col(html).contains("<ix:non")).select(key, F.posexplode(tags).alias("pos", "t"))
    a, body = F.col("t.attrs"), F.regexp_replace("t.body", r"<[^>]*>", "")
    return p.select(
        key, "pos", F.when(F.col("t.kind") == "nonFraction", "num").otherwise("text").alias("kind"), F.regexp_replace(attribute(a, "name"), "^[^:]*:", "").alias("concept"),
        attribute(a, "contextRef").alias("context_ref"), attribute(a, "unitRef").alias("unit_ref"), attribute(a, "scale").alias("scale"), attribute(a, "sign").alias("sign"), body.alias("text"),
        F.when(F.col("t.kind") == "nonFraction", num_xbrl_fact(body, attribute(a, "scale"), attribute(a, "sign"))).alias("value"),
    )


CONTEXT = r'(?s)<xbrli:context\b[^>]*?id="([^"]+)"[^>]*>(.*?)</xbrli:context>'


def inline_contexts(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Contexts with their period and the explicit members by axis."""
    tags = F.arrays_zip(F.regexp_extract_all(html, F.lit(CONTEXT), 1).alias("id"), F.regexp_extract_all(html, F.lit(CONTEXT), 2).alias("body"))
    p = pages.select(key, F.explode(tags).alias("t"))
    part = lambda name: F.try_to_date(F.nullif(F.regexp_extract("t.body", rf"<xbrli:{name}>\s*([0-9-]+)", 1), F.lit("")))
    axes, members = (F.regexp_extract_all("t.body", F.lit(r'explicitMember\s+dimension="([^"]+)"[^>]*>\s*([^<\s]+)'), i) for i in (1, 2))
    return p.select(key, F.col("t.id").alias("context_ref"), part("instant").alias("instant"), part("startDate").alias("start"), part("endDate").alias("end"), F.map_from_arrays(axes, members).alias("dims"))


def with_context(facts: DataFrame, contexts: DataFrame) -> DataFrame:
    """Facts with the period of their context; an id that a filing states twice counts as it stands in the last file."""
    one = contexts.groupBy("doc_id", "context_ref").agg(F.max_by(F.struct("ctx_instant", "ctx_end", "scope"), "file").alias("c"))
    return facts.join(one, ["doc_id", "context_ref"], "left").select("fact_id", "doc_id", "context_ref", "c.ctx_instant", "c.ctx_end", "c.scope")


def scope_of(context_ref: Column, dims: Column) -> Column:
    """individual where the context or its dimensions say so, unknown without a context, else consolidated."""
    own = F.contains(F.coalesce(dims, F.lit("")), F.lit("NonConsolidatedMember")) | F.contains(context_ref, F.lit("NonConsolidatedMember"))
    return F.when(F.coalesce(context_ref, F.lit("")) == "", "unknown").when(own, "individual").otherwise("consolidated")


def concept_rollup(facts: DataFrame, longest: int = 200) -> DataFrame:
    """Distinct printed values of each concept of a filing, in order of first appearance, joined and cut."""
    f = facts.where(~F.col("concept").isin(*NOISE) & (F.coalesce("text", F.lit("")) != ""))
    per = f.groupBy("doc_id", "concept", "text").agg(F.min("fact_id").alias("pos"), F.count("*").alias("c"))
    out = per.groupBy("doc_id", "concept").agg(F.sum("c").alias("n"), F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("vs"))
    return out.select("doc_id", "concept", "n", F.substring(F.array_join(F.transform("vs", lambda v: v["text"]), " / "), 1, longest).alias("values"))


def top_concepts(facts: DataFrame, k: int = 12) -> DataFrame:
    """The k most frequent concepts; ties by name."""
    return facts.groupBy("concept").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "concept").limit(k)


LEAF = r'(?s)<(?:[\w.-]+:)?([A-Za-z][\w.-]*)\s+[^<>]*?contextRef\s*=\s*"[^"]*"[^<>]*>([^<]*)</'


def generic_facts(pages: DataFrame, key: str, xml: str) -> DataFrame:
    """Leaf elements with a context of any XBRL text, rolled up by concept."""
    t = F.arrays_zip(F.regexp_extract_all(xml, F.lit(LEAF), 1).alias("concept"), F.regexp_extract_all(xml, F.lit(LEAF), 2).alias("text"))
    p = pages.select(F.col(key).alias("doc_id"), F.posexplode(t).alias("fact_id", "t")).select("doc_id", "fact_id", "t.concept", F.trim("t.text").alias("text"))
    return concept_rollup(p)


def latest(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """The latest row of each key: by the time column, then by all columns, so ties are settled. Partial aggregates, so a hot key is no hot task."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(F.col(by), *[F.col(c) for c in rest if c != by])
    return df.groupBy(*keys).agg(F.max_by(row, row).alias("r")).select(*keys, *[F.col(f"r.{c}").alias(c) for c in rest])
