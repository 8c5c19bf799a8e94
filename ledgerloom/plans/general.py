"""Queries of the general data problems: nested records and units."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import nested, units
from ledgerloom.session import table


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.node_places(table(spark, d, "edinet_xbrl"))


def p3_nodes(spark: SparkSession, d: str) -> DataFrame:
    return nested.dimension_nodes(table(spark, d, "edinet_xbrl")).drop("labels")


def p3_labels(spark: SparkSession, d: str) -> DataFrame:
    return nested.label_table(table(spark, d, "edinet_xbrl"))


def p3_contexts(spark: SparkSession, d: str) -> DataFrame:
    return nested.context_table(table(spark, d, "edinet_xbrl"))


def p3_facts(spark: SparkSession, d: str) -> DataFrame:
    return nested.fact_table(table(spark, d, "edinet_xbrl"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    facts = table(spark, d, "edinet_xbrl")
    return units.equal_amounts(units.based(facts, table(spark, d, "unit_codes")), facts.where("kind = 'num'"))


def p6_amounts(spark: SparkSession, d: str) -> DataFrame:
    amounts = units.in_base_units(table(spark, d, "edinet_xbrl"), table(spark, d, "unit_codes"))
    return amounts.select("fact_id", "unit_code", "dimension", "base_unit", F.round("amount", 6).alias("amount"))


QUERIES = {f.__name__: f for f in (p3_found, p3_nodes, p3_labels, p3_contexts, p3_facts, p6_found, p6_amounts)}


def _alias_values() -> str:
    rows = [(k, c) for c, keys in units.UNIT_ALIASES.items() for k in dict.fromkeys([*keys.split(), c.replace("_", "")])]
    return ", ".join(f"('{k}','{c}')" for k, c in rows)


def _amounts_sql() -> str:
    fold = lambda c: f"translate({c}, '{units.WIDE.replace(chr(39), chr(39) * 2)}', '{units.PLAIN.replace(chr(39), chr(39) * 2)}')"
    key = lambda c: (
        f"nullif(regexp_replace(regexp_replace(regexp_replace(lower({fold(c)}), '^\\s*(?:iso4217|xbrli|utr)\\s*:', ''), '[\\s _()\\[\\]:△▲+*/''\"-]', '', 'g'), '^[.,]+|[.,]+$', '', 'g'), '')"
    )
    num = units.NUMBER
    neg = f"regexp_matches({fold('text')}, '(?:[△▲-]\\s*|\\(\\s*)(?:{num})') AND NOT regexp_matches({fold('text')}, '\\)\\s*(?:[0-9]|\\.[0-9])')"
    printed = f"try_cast(replace(regexp_extract({fold('text')}, '({num})', 1), ',', '') AS DOUBLE)"
    rest = f"regexp_replace({fold('text')}, '^([^0-9]*?)(?:{num})', '\\1')"
    return f"""
    alias(unit_key, unit_code) AS (VALUES {_alias_values()}),
    f AS (SELECT DISTINCT fact_id, doc_id, concept, context_ref, value, scale, text, {key('unit_ref')} AS field_key, {key(rest)} AS text_key,
            CASE WHEN {neg} THEN -{printed} ELSE {printed} END AS said
          FROM edinet_xbrl WHERE kind = 'num'),
    amounts AS (SELECT f.fact_id, f.doc_id, f.concept, f.context_ref, f.value, u.unit_code, u.dimension, u.base_unit,
            coalesce(f.value, f.said) * pow(10.0, coalesce(try_cast(f.scale AS INT), 0)) * u.factor AS amount
          FROM f LEFT JOIN alias a ON a.unit_key = f.field_key LEFT JOIN alias b ON b.unit_key = f.text_key
          LEFT JOIN unit_codes u ON u.unit_code = coalesce(a.unit_code, b.unit_code))"""


def _expand(x: str) -> str:
    """The nodes at one place as a list of (axis, member, ...): a list, a node, or a plain object with a node per key."""
    items = f"list_filter(CASE json_type({x}) WHEN 'ARRAY' THEN json_extract({x}, '$[*]') ELSE [{x}] END, lambda e: json_type(e) = 'OBJECT')"
    one = "{'axis': e->>'$.axis', 'ch': e->'$.children', 'member': CASE WHEN json_type(e->'$.member') = 'OBJECT' THEN e->>'$.member.qname' ELSE e->>'$.member' END, 'typed': e->>'$.typed', 'ord': e->>'$.order', 'labels': e->'$.member.labels'}"
    each = "{'axis': k, 'ch': NULL::JSON, 'member': json_extract_string(e, '$.\"' || k || '\"'), 'typed': NULL::VARCHAR, 'ord': NULL::VARCHAR, 'labels': NULL::JSON}"
    return f"flatten(list_transform({items}, lambda e: CASE WHEN json_exists(e, '$.axis') THEN [{one}] ELSE list_transform(json_keys(e), lambda k: {each}) END))"


_PATH = "coalesce(parent_path || '.', '') || i"
#: One link of a chain; chr(1) comes before every character of a content.
_LINK = "lpad(i::VARCHAR, 6, '0') || coalesce(s.axis, '') || chr(2) || coalesce(s.member, '') || chr(2) || coalesce(s.typed, '') || chr(2) || coalesce(s.ord, '') || chr(1)"
#: The distinct nodes of each context with the chain of places and contents above them, c, in which a chain begins the chains of its branch.
_NODES_SQL = f"""WITH RECURSIVE d AS (SELECT DISTINCT doc_id, context_ref, dims::JSON AS j FROM edinet_xbrl WHERE context_ref <> '' AND json_valid(dims)),
     w AS (SELECT doc_id, context_ref, unnest(l) AS s, generate_subscripts(l, 1) AS i, 1 AS depth, '' AS above, NULL::VARCHAR AS parent_path FROM (SELECT *, {_expand('j')} AS l FROM d)
       UNION ALL SELECT doc_id, context_ref, unnest(l), generate_subscripts(l, 1), depth + 1, above || {_LINK}, {_PATH} FROM (SELECT *, {_expand('s.ch')} AS l FROM w WHERE s.ch IS NOT NULL)),
     n AS (SELECT DISTINCT doc_id, context_ref, {_PATH} AS node_path, s.axis AS axis, depth, parent_path, s.member AS member, s.typed AS typed, s.ord AS node_order, above || {_LINK} AS c, above FROM w),
     r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, context_ref ORDER BY c) AS pre FROM n),
     z AS (SELECT a.*, a.pre + (SELECT count(*) FROM r b WHERE b.doc_id = a.doc_id AND b.context_ref = a.context_ref AND starts_with(b.c, a.c) AND b.c <> a.c) - a.depth + 1 AS post FROM r a)"""

ORACLES = {
    "p3_nodes": f"""{_NODES_SQL} SELECT z.doc_id, z.context_ref, z.node_path, z.axis, z.depth, z.parent_path, z.member, z.typed, z.node_order, z.pre, z.post, p.pre AS parent_pre
     FROM z LEFT JOIN z p ON p.doc_id = z.doc_id AND p.context_ref = z.context_ref AND p.c = z.above""",
    "p3_labels": f"""{_NODES_SQL}, m AS (SELECT DISTINCT doc_id, context_ref, above || {_LINK} AS c, unnest(json_extract(s.labels, '$[*]')) AS l FROM w WHERE s.labels IS NOT NULL)
     SELECT DISTINCT z.doc_id, z.context_ref, z.node_path, z.pre, z.member, m.l->>'$.lang' AS lang, m.l->>'$.text' AS label FROM z JOIN m USING (doc_id, context_ref, c)""",
    "p3_found": f"""WITH RECURSIVE d AS (SELECT DISTINCT doc_id, context_ref, dims::JSON AS j FROM edinet_xbrl WHERE context_ref <> '' AND json_valid(dims)),
     n AS (SELECT doc_id, context_ref, unnest(l) AS s, generate_subscripts(l, 1)::VARCHAR AS node_path FROM (SELECT *, {_expand('j')} AS l FROM d)
       UNION ALL SELECT doc_id, context_ref, unnest(l) AS s, node_path || '.' || generate_subscripts(l, 1) AS node_path FROM (SELECT *, {_expand('s.ch')} AS l FROM n WHERE s.ch IS NOT NULL))
     SELECT DISTINCT doc_id, context_ref, node_path, s.axis AS axis FROM n""",
    "p6_found": f"""WITH {_amounts_sql()}
    SELECT DISTINCT l.fact_id AS left_id, r.fact_id AS right_id FROM amounts l JOIN amounts r
      ON l.doc_id = r.doc_id AND l.concept = r.concept AND l.context_ref = r.context_ref AND l.dimension = r.dimension
     WHERE l.context_ref <> '' AND l.fact_id < r.fact_id AND l.value <> r.value AND l.amount <> 0
       AND abs(l.amount - r.amount) <= 1e-5 * greatest(abs(l.amount), abs(r.amount))""",
    "p6_amounts": f"WITH {_amounts_sql()} SELECT fact_id, unit_code, dimension, base_unit, round(amount, 6) AS amount FROM amounts",
    "p3_contexts": """SELECT doc_id, context_ref, max(ctx_instant) AS ctx_instant, max(ctx_end) AS ctx_end, max(scope) AS scope, count(DISTINCT fact_id) AS n_facts
     FROM edinet_xbrl WHERE context_ref <> '' GROUP BY ALL""",
    "p3_facts": """SELECT DISTINCT fact_id, doc_id, nullif(context_ref, '') AS context_ref, kind, concept, unit_ref, value, scale, text FROM edinet_xbrl""",
}
