"""Queries of the text and table metrics, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions import numbers as N
from ledgerloom.operators import lines as L
from ledgerloom.operators import tables as Tb
from ledgerloom.plans import fixtures as X
from ledgerloom.session import table


def dup_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.duplication(X.filings(spark, d))


def dup_top_lines(spark: SparkSession, d: str) -> DataFrame:
    return L.top_repeated(X.filings(spark, d))


def garbled_profile(spark: SparkSession, d: str) -> DataFrame:
    return L.garbled(X.filings(spark, d).where("md IS NOT NULL"))


def section_count(spark: SparkSession, d: str) -> DataFrame:
    return L.sections(X.filings(spark, d))


def split_sections(spark: SparkSession, d: str) -> DataFrame:
    return L.split_sections(X.filings(spark, d))


def fragmentation(spark: SparkSession, d: str) -> DataFrame:
    return L.fragmentation(X.filings(spark, d))


def fake_headings(spark: SparkSession, d: str) -> DataFrame:
    return L.fake_headings(X.filings(spark, d))


def script_profile(spark: SparkSession, d: str) -> DataFrame:
    return L.script_profile(X.filings(spark, d).where("md IS NOT NULL"))


def content_coverage(spark: SparkSession, d: str) -> DataFrame:
    src = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(F.sum(F.length(F.col("l_extendedprice").cast("bigint").cast("string"))).alias("source_chars"))
    return L.coverage(X.ledgers(spark, d), src).select("doc_id", "source_chars", (F.col("coverage") > 0).alias("covered"))


def number_parsers(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "edinet_xbrl").where("kind = 'num' AND text IS NOT NULL").select("text").distinct()
    t = F.col("text")
    return f.select("text", N.num_lenient(t).alias("lenient"), N.num_strict_cell(t).alias("strict"), N.amount_cf(t).alias("cf"), N.amount_bs(t).alias("bs"))


def numbers_in(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "edinet_xbrl").where("text IS NOT NULL").select("fact_id", "text").distinct()
    n = f.select("fact_id", N.numbers_in(F.col("text")).alias("ns"))
    return n.select("fact_id", F.size("ns").alias("n"), F.get("ns", F.lit(0)).alias("first"), F.array_max("ns").alias("largest"))


def xbrl_number(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "edinet_xbrl").where("kind = 'num'").select("fact_id", "text", "scale").distinct()
    none = F.lit(None).cast("string")
    return f.select("fact_id", F.round(N.num_xbrl_fact(F.col("text"), F.col("scale"), none), 4).alias("value"), F.round(N.num_ixbrl_cell(F.col("text"), F.col("scale"), none), 4).alias("cell_value"))


def md_tables(spark: SparkSession, d: str) -> DataFrame:
    r = Tb.table_rows(X.filings(spark, d))
    return r.select("doc_id", "table_no", "row_no", F.size("cells").alias("n_cells"), F.array_join("cells", "¦").alias("row"))


def table_alignment(spark: SparkSession, d: str) -> DataFrame:
    return Tb.alignment(X.ledgers(spark, d))


def accounting_identity(spark: SparkSession, d: str) -> DataFrame:
    return Tb.identity(X.statements(spark, d))


def table_footing(spark: SparkSession, d: str) -> DataFrame:
    return Tb.footing(X.ledgers(spark, d))


def filing_footing(spark: SparkSession, d: str) -> DataFrame:
    return Tb.footing(X.filings(spark, d))


def articulation(spark: SparkSession, d: str) -> DataFrame:
    return Tb.articulation(X.statements(spark, d))


def cashflow_c1(spark: SparkSession, d: str) -> DataFrame:
    c = Tb.cash_flow(X.cash_flows(spark, d))
    return c.select("doc_id", "opening", "closing", "op", "inv", "fin", "fx", "status")


def labeled_rows(spark: SparkSession, d: str) -> DataFrame:
    r = Tb.labeled_rows(Tb.table_rows(X.ledgers(spark, d)))
    return r.select("doc_id", "row_no", "label", F.size("facts").alias("n_facts"), F.aggregate("facts", F.lit(0.0), lambda a, x: a + x["value"]).alias("total"))


def grid_markdown(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_quantity")
    li = table(spark, d, "lineitem").withColumn("n", F.row_number().over(w))
    cells = li.select(F.col("l_orderkey").alias("doc_id"), F.col("n").alias("row_no"), F.explode(F.array(
        F.struct(F.lit(0).alias("c"), F.concat(F.lit("a|"), F.col("l_linenumber")).alias("t")), F.struct(F.lit(1).alias("c"), F.lit("").alias("t")),
        F.struct(F.lit(2).alias("c"), F.round("l_quantity").cast("bigint").cast("string").alias("t")))).alias("x"))
    return Tb.pipe_markdown(cells.select("doc_id", "row_no", F.col("x.c").alias("col_no"), F.col("x.t").alias("text")), ["doc_id"])


NAMES = (
    dup_lines, dup_top_lines, garbled_profile, section_count, split_sections, fragmentation, fake_headings, script_profile, content_coverage, number_parsers, numbers_in, xbrl_number,
    md_tables, table_alignment, accounting_identity, table_footing, filing_footing, articulation, cashflow_c1, labeled_rows, grid_markdown,
)
QUERIES = {f.__name__: f for f in NAMES}

B = r"\s\x{A0}\x{3000}"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^[{B}]+|[{B}]+$', '', 'g')"


DOCS = "docs AS (SELECT DISTINCT ON (doc_id) * FROM filing_md)"
LINES = f"{DOCS}, ls AS (SELECT doc_id, market, unnest(string_split(md, chr(10))) AS line, generate_subscripts(string_split(md, chr(10)), 1) - 1 AS line_no FROM docs WHERE md IS NOT NULL)"
PLAIN = rf"""{LINES}, k AS (SELECT doc_id, line_no, {_strip('line')} AS s FROM ls), p AS (SELECT * FROM k WHERE length(s) >= 20 AND NOT regexp_matches(s, '^[\s|:\-]+$') AND s NOT LIKE '|%')"""
ROWS = rf"""{LINES}, st AS (SELECT doc_id, line_no, {_strip('line')} AS s FROM ls),
  pp AS (SELECT *, (s LIKE '|%|' AND length(s) > 1) AS pipe FROM st),
  isl AS (SELECT *, sum((NOT pipe)::INT) OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM pp),
  keep AS (SELECT *, count(*) OVER (PARTITION BY doc_id, island) AS n FROM isl WHERE pipe AND NOT regexp_full_match(s, '\|[\s:|\-]+\|')),
  num AS (SELECT *, dense_rank() OVER (PARTITION BY doc_id ORDER BY island) - 1 AS table_no FROM keep WHERE n >= 2),
  rows_ AS (SELECT doc_id, table_no, row_number() OVER (PARTITION BY doc_id, table_no ORDER BY line_no) - 1 AS row_no,
     [{_strip("replace(x, chr(1), '\\|')")} FOR x IN string_split(replace(substr(s, 2, length(s) - 2), '\|', chr(1)), '|')] AS cells FROM num)"""


def _count(p: str, c: str = "md") -> str:
    return f"len(regexp_extract_all({c}, '{p}'))"


_N = "一二三四五六七八九十"
_SECTIONS = rf"""WITH {DOCS}, b AS (SELECT doc_id, regexp_replace(md, '(?s)^---\n.*?\n---\n?', '') AS body FROM docs WHERE md IS NOT NULL),
  lv AS (SELECT doc_id, body, CASE WHEN contains(body, chr(10) || '# ') THEN '^# ' WHEN contains(body, chr(10) || '## ') THEN '^## ' WHEN regexp_matches(body, '\n### [{_N}]+、') THEN '^### [{_N}]+、'
    WHEN regexp_matches(body, '\n### （[{_N}]+）') THEN '^### （[{_N}]+）' WHEN contains(body, chr(10) || '### ') THEN '^### ' ELSE '^#{{1,3}} ' END AS lev FROM b),
  sl AS (SELECT doc_id, lev, unnest(string_split(body, chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) AS i FROM lv),
  sn AS (SELECT *, sum((i > 1 AND regexp_matches(line, lev))::INT) OVER (PARTITION BY doc_id ORDER BY i) AS section_no FROM sl),
  sg AS (SELECT doc_id, section_no, list(line ORDER BY i) AS l FROM sn GROUP BY ALL),
  sec AS (SELECT doc_id, section_no, {_strip("regexp_replace(l[1], '^#+[ ]*', '')")} AS title, length({_strip("array_to_string(l[2:], chr(10))")}) AS body_chars FROM sg)"""
LENIENT = rf"""(SELECT CASE WHEN neg THEN -v ELSE v END FROM (SELECT neg, try_cast(regexp_replace(translate(regexp_extract(regexp_replace(body, '[{B}$¥￥※＊*]', '', 'g'), '([-+−]?[0-9,]+(?:\.[0-9]+)?)', 1), '−', '-'), '[,+]', '', 'g') AS DOUBLE) AS v
  FROM (SELECT regexp_matches(s, '^\(.*\)$') AS neg, CASE WHEN regexp_matches(s, '^\(.*\)$') THEN regexp_replace(s, '^\(|\)$', '', 'g') ELSE s END AS body FROM (SELECT {_strip('XX')} AS s))))"""
STRICT = f"(CASE WHEN regexp_matches({_strip('XX')}, '{N.STRICT}') THEN {LENIENT} END)"
FOLD = f"translate(text, '{N.WIDE_DIGITS}', '{N.DIGITS}')"
ITEM = "SELECT l_orderkey AS doc_id, l_linenumber AS ln, round(l_quantity)::BIGINT AS q, round(l_extendedprice * 100)::BIGINT AS a FROM lineitem"
ORACLES = {
    "dup_lines": f"WITH {PLAIN}, g AS (SELECT doc_id, s, count(*) AS c FROM p GROUP BY ALL) SELECT doc_id, sum(c)::BIGINT AS lines, sum(c - 1)::BIGINT AS repeated, round(sum(c - 1) / sum(c), 6) AS dup_ratio FROM g GROUP BY doc_id",
    "dup_top_lines": f"WITH {PLAIN}, g AS (SELECT doc_id, s, count(*) AS c, min(line_no) AS f FROM p GROUP BY ALL HAVING count(*) > 1), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY c DESC, f)::INT AS rank FROM g) SELECT doc_id, rank, substr(s, 1, 60) AS line, c FROM r WHERE rank <= 3",
    "garbled_profile": f"WITH {DOCS}, c AS (SELECT doc_id, length(md) AS chars, " + ", ".join(f"{_count(p)} AS {k}" for k, p in L.BROKEN.items()) + " FROM docs WHERE md IS NOT NULL) SELECT *, round((replacement + private_use + control) / greatest(chars, 1), 6) AS ratio FROM c",
    "section_count": rf"""WITH {LINES}, h AS (SELECT doc_id, line_no, substr({_strip('line')}, 1, 40) AS h FROM ls WHERE regexp_matches(line, '{L.SECTION}')),
      a AS (SELECT doc_id, count(*) AS n, list(h ORDER BY line_no)[1:5] AS f FROM h GROUP BY doc_id)
      SELECT docs.doc_id, regexp_matches(md, '{L.FINANCIAL}') AS has_financial, coalesce(n, 0) AS section_count, array_to_string(f, ' / ') AS sample FROM docs LEFT JOIN a USING (doc_id)""",
    "split_sections": _SECTIONS + " SELECT doc_id, section_no::BIGINT AS section_no, title, body_chars FROM sec WHERE title <> ''",
    "fragmentation": _SECTIONS + """, c AS (SELECT doc_id, count(*) AS sections, count(*) FILTER (body_chars < 50) AS fragments FROM sec WHERE title <> '' GROUP BY doc_id)
      SELECT docs.doc_id, CASE WHEN coalesce(sections, 0) > 1 THEN 'ok' ELSE 'skip' END AS status, coalesce(sections, 0) AS sections, CASE WHEN sections > 1 THEN fragments END AS fragments,
        CASE WHEN sections > 1 THEN round(fragments / sections, 6) END AS fragment_ratio FROM docs LEFT JOIN c USING (doc_id) WHERE md IS NOT NULL""",
    "fake_headings": f"WITH {LINES}, h AS (SELECT doc_id, {_strip('substr(line, 5)')} AS h FROM ls WHERE line LIKE '### %') SELECT doc_id, count(*) AS headings, count(*) FILTER (regexp_matches(h, '[。；！？]$|。')) AS fake, round(count(*) FILTER (regexp_matches(h, '[。；！？]$|。')) / count(*), 6) AS fake_ratio FROM h GROUP BY doc_id",
    "script_profile": rf"""WITH {LINES}, n AS (SELECT doc_id, market, CASE WHEN NOT regexp_matches(line, '^\s*\|') AND length({_strip('line')}) >= 10 THEN line ELSE '' END AS x, line FROM ls),
      g AS (SELECT doc_id, market, """ + ", ".join(f"sum({_count(p, 'x')}) AS {k}, sum({_count(p, 'line')}) AS {k}_all" for k, p in L.SCRIPTS.items()) + rf""", sum(length(regexp_replace(line, '[\s\x{{A0}}\x{{3000}}]', '', 'g')))::BIGINT AS all_chars, sum(length(regexp_replace(x, '[\s\x{{A0}}\x{{3000}}]', '', 'g')))::BIGINT AS narrative_chars FROM n GROUP BY ALL)
      SELECT doc_id, CASE WHEN narrative_chars >= 200 THEN 'ok' ELSE 'skip' END AS status, narrative_chars, """ + ", ".join(f"CASE WHEN narrative_chars >= 200 THEN round({k} / narrative_chars, 6) END AS {k}_ratio, CASE WHEN all_chars > 0 THEN round({k}_all / all_chars, 6) END AS {k}_whole" for k in L.SCRIPTS) + ", CASE WHEN narrative_chars < 200 THEN NULL " + " ".join(f"WHEN market = '{m}' THEN {k} / narrative_chars < {f}" for m, (k, f) in L.EXPECTED.items()) + " END AS suspicious FROM g",
    "content_coverage": "SELECT l_orderkey AS doc_id, sum(length(cast(trunc(l_extendedprice) AS BIGINT)::VARCHAR))::BIGINT AS source_chars, true AS covered FROM lineitem GROUP BY 1",
    "number_parsers": rf"""SELECT text, {LENIENT.replace('XX', 'text')} AS lenient, {STRICT.replace('XX', 'text')} AS strict,
      CASE WHEN regexp_matches(text, '^\(?-?\$?[0-9,]+(\.[0-9]+)?\)?$') THEN try_cast(regexp_replace(text, '[,$()]', '', 'g') AS DOUBLE) * CASE WHEN regexp_matches(text, '^\(.*\)$') THEN -1 ELSE 1 END END AS cf,
      CASE WHEN regexp_matches(text, '^\s*\$?\s*[0-9,]+\s*$') AND regexp_matches(regexp_replace(text, '[$,\s]', '', 'g'), '^[0-9]{{5,12}}$') THEN try_cast(regexp_replace(text, '[$,\s]', '', 'g') AS DOUBLE) END AS bs
      FROM (SELECT DISTINCT text FROM edinet_xbrl WHERE kind = 'num' AND text IS NOT NULL)""",
    "numbers_in": rf"""WITH f AS (SELECT DISTINCT fact_id, {FOLD} AS t FROM edinet_xbrl WHERE text IS NOT NULL),
      r AS (SELECT fact_id, list_zip(regexp_extract_all(t, '{N.RUN}', 1), regexp_extract_all(t, '{N.RUN}', 2)) AS z FROM f),
      v AS (SELECT fact_id, list_filter([CASE WHEN regexp_matches(x[1], '[△▲−\-(]') THEN -1 ELSE 1 END * try_cast(replace(regexp_extract(x[2], '^((?:[0-9]{{1,3}}(?:,[0-9]{{3}})+|[0-9]+)(?:\.[0-9]+)?)(?:[.,]|$)', 1), ',', '') AS DOUBLE) FOR x IN z], lambda q: q IS NOT NULL) AS ns FROM r)
      SELECT fact_id, len(ns) AS n, ns[1] AS first, list_max(ns) AS largest FROM v""",
    "xbrl_number": rf"""WITH f AS (SELECT DISTINCT fact_id, {FOLD} AS t, coalesce(try_cast(scale AS INT), 0) AS sc FROM edinet_xbrl WHERE kind = 'num'),
      s AS (SELECT fact_id, t, sc, regexp_replace(t, '[\s\x{{A0}}\x{{3000}},$¥￥]', '', 'g') AS s FROM f),
      n AS (SELECT *, regexp_matches(s, '^\(.*\)$') OR regexp_matches(s, '^[△▲−-]') AS neg, regexp_replace(s, '^\(|\)$|^[△▲−-]', '', 'g') AS bare FROM s)
      SELECT fact_id, round(CASE WHEN regexp_matches(bare, '^[0-9]+(\.[0-9]+)?$') THEN bare::DOUBLE * pow(10.0, sc) * CASE WHEN neg THEN -1 ELSE 1 END END, 4) AS value,
        round(try_cast(regexp_replace(t, '[^0-9.\-]', '', 'g') AS DOUBLE) * pow(10.0, sc), 4) AS cell_value FROM n""",
    "md_tables": f"WITH {ROWS} SELECT doc_id, table_no::INT AS table_no, row_no::INT AS row_no, len(cells)::INT AS n_cells, array_to_string(cells, '¦') AS row FROM rows_",
    "table_alignment": f"SELECT doc_id, 1 AS tables, (doc_id % 5 = 2)::INT AS misaligned, (doc_id % 5 = 2)::INT AS worst_rows, (doc_id % 5 = 2)::DOUBLE AS misaligned_ratio FROM (SELECT DISTINCT doc_id FROM ({ITEM}))",
    "accounting_identity": "SELECT c_custkey AS doc_id, CASE WHEN c_custkey % 7 = 5 THEN 'skip' WHEN c_custkey % 7 = 3 THEN 'fail' ELSE 'pass' END AS status, CASE WHEN c_custkey % 7 = 5 THEN NULL WHEN c_custkey % 7 = 3 THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END AS diff, 1 AS asset_n, CASE WHEN c_custkey % 7 = 5 THEN 0 ELSE 1 END AS liability_n, 1 AS equity_n FROM customer",
    "table_footing": f"""WITH i AS ({ITEM}), g AS (SELECT doc_id, count(*) AS n, sum(q) AS tq, sum(a) AS ta, max_by(q, (ln, q, a)) AS lq, max_by(a, (ln, q, a)) AS la FROM i GROUP BY doc_id),
      t AS (SELECT doc_id, n, 'labeled' AS kind, tq AS said, tq AS adds FROM g WHERE doc_id % 5 <> 3 UNION ALL SELECT doc_id, n, 'labeled', ta + CASE WHEN doc_id % 5 = 1 THEN ta + 1000 ELSE 0 END, ta FROM g WHERE doc_id % 5 <> 3
        UNION ALL SELECT doc_id, n - 1, 'inferred', lq, tq - lq FROM g WHERE doc_id % 5 = 3 AND n >= 3 UNION ALL SELECT doc_id, n - 1, 'inferred', la, ta - la FROM g WHERE doc_id % 5 = 3 AND n >= 3),
      c AS (SELECT *, abs(said - adds) AS r, abs(said - adds) <= greatest(2.0, abs(said) * 0.005) AS ok FROM t WHERE n >= 2)
      SELECT doc_id, count(*) FILTER (kind = 'labeled') AS labeled_tested, count(*) FILTER (kind = 'labeled' AND ok) AS labeled_passed, count(*) FILTER (kind = 'inferred') AS inferred_tested, count(*) FILTER (kind = 'inferred' AND ok) AS inferred_passed,
        round(max(r) FILTER (NOT ok)::DOUBLE, 2) AS worst_residual FROM c GROUP BY doc_id""",
    "filing_footing": f"""WITH {ROWS}, sh AS (SELECT doc_id, table_no, max(len(cells)) AS nc, count(*) AS nr FROM rows_ GROUP BY ALL HAVING max(len(cells)) >= 2 AND count(*) >= 3),
      c AS (SELECT r.doc_id, r.table_no, row_no, coalesce(list_filter(cells[1:2], lambda z: regexp_matches(z, '{Tb.CJK}'))[1], cells[1], '') AS lab, unnest(cells) AS cell, generate_subscripts(cells, 1) AS col FROM rows_ r JOIN sh USING (doc_id, table_no)),
      v AS (SELECT doc_id, table_no, row_no, col, regexp_matches(lab, '{Tb.TOTAL}') AS tot, {STRICT.replace('XX', 'cell')} AS v FROM c WHERE col >= 2),
      w AS (SELECT *, count(*) OVER q AS n, sum(tot::INT) OVER q AS tots, max(row_no) OVER q AS last, coalesce(sum(tot::INT) OVER (PARTITION BY doc_id, table_no, col ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM v WHERE v IS NOT NULL WINDOW q AS (PARTITION BY doc_id, table_no, col)),
      k AS (SELECT *, CASE WHEN tots > 0 THEN tot ELSE row_no = last END AS is_sum, CASE WHEN tots > 0 THEN seg ELSE 0 END AS sg, tots > 0 AS lb FROM w WHERE n >= 3),
      g AS (SELECT doc_id, table_no, col, sg, lb, sum(v) FILTER (NOT is_sum) AS adds, count(*) FILTER (NOT is_sum) AS kk, max(v) FILTER (is_sum) AS said FROM k GROUP BY ALL),
      o AS (SELECT *, abs(said - adds) AS r, abs(said - adds) <= greatest(2.0, abs(said) * 0.005) AS ok FROM g WHERE said IS NOT NULL AND kk >= 2)
      SELECT doc_id, count(*) FILTER (lb) AS labeled_tested, count(*) FILTER (lb AND ok) AS labeled_passed, count(*) FILTER (NOT lb) AS inferred_tested, count(*) FILTER (NOT lb AND ok) AS inferred_passed, round(max(r) FILTER (NOT ok), 2) AS worst_residual FROM o GROUP BY doc_id""",
    "articulation": "SELECT c_custkey AS doc_id, 2 AS tested, (c_custkey % 5 <> 2)::BIGINT AS matched, (c_custkey % 5 <> 2)::INT / 2.0 AS ratio FROM customer",
    "cashflow_c1": """WITH o AS (SELECT o_orderkey AS k, round(o_totalprice * 100)::BIGINT AS t FROM orders),
      x AS (SELECT k, t, t * 2 AS opening, t AS op, -(t // 3) AS inv, -(t // 5) AS fin, CASE WHEN k % 6 <> 1 THEN 17 END AS fx FROM o),
      y AS (SELECT *, opening + op + inv + fin + coalesce(fx, 0) + CASE WHEN k % 6 = 4 THEN t ELSE 0 END AS closing FROM x)
      SELECT k AS doc_id, opening::DOUBLE AS opening, closing::DOUBLE AS closing, op::DOUBLE AS op, CASE WHEN k % 6 <> 2 THEN inv::DOUBLE END AS inv, fin::DOUBLE AS fin, fx::DOUBLE AS fx,
        CASE WHEN k % 6 = 2 THEN 'skip' WHEN k % 6 = 4 THEN 'fail' ELSE 'pass' END AS status FROM y""",
    "labeled_rows": f"""WITH i AS ({ITEM}), g AS (SELECT doc_id, count(*) AS n, sum(q) AS tq, sum(a) AS ta FROM i GROUP BY doc_id)
      SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ln, q, a)::INT AS row_no, 'item ' || ln AS label, 2 AS n_facts, (q + a)::DOUBLE AS total FROM i
      UNION ALL SELECT doc_id, (n + 1)::INT, 'total', 2, (tq + ta + CASE WHEN doc_id % 5 = 1 THEN ta + 1000 ELSE 0 END)::DOUBLE FROM g WHERE doc_id % 5 <> 3""",
    "grid_markdown": f"""WITH i AS ({ITEM}), r AS (SELECT doc_id, list('| a\\|' || ln || ' | ' || q || ' |' ORDER BY ln, q) AS ls FROM i GROUP BY doc_id HAVING count(*) >= 2)
      SELECT doc_id, array_to_string([ls[1], '| --- | --- |'] || ls[2:], chr(10)) AS md FROM r""",
}
