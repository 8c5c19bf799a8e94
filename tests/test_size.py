import duckdb
import pytest

import __spark_entry__ as entry
from compare import TABLES
from ledgerloom.operators import layout

DATA = "/root/testdata/sf0.001"
#: Queries that make many rows or long texts out of a narrow table, whose size the optimizer takes for small.
NAMES = ["document_suite", "truth_align", "evaluation"]


@pytest.mark.parametrize("name", NAMES)
def test_made_rows_are_never_broadcast(spark, name):
    """However small the source seems: the plan that ran has no broadcast, and its rows are those of the SQL."""
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        df = entry.queries()[name](spark, DATA)
        rows, cols = df.collect(), sorted(df.columns)
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got = con.execute(entry.oracle_sql()[name])
    at = [[c[0] for c in got.description].index(c) for c in cols]
    assert sorted(repr([r[c] for c in cols]) for r in rows) == sorted(repr([r[i] for i in at]) for r in got.fetchall())


def test_reading_order_shuffles_its_words_once(spark):
    """Two columns read across: all words match, and half of the steps go on in the page's order."""
    w = spark.createDataFrame([(1, 1, i, 300.0 * (i % 2), 10.0 * (i // 2), None if i == 7 else f"w{i % 50}") for i in range(80)], "doc_id bigint, page_no int, seq int, x0 double, y0 double, text string")
    o = w.selectExpr("doc_id", "seq AS pos", "text AS word")
    d = layout.reading_order(w, o)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert [tuple(r) for r in d.collect()] == [(1, "ok", 79, 0.512821)]
