import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from compare import TABLES

DATA = "/root/testdata/sf0.001"
NAMES = "p3_contexts p6_found p6_amounts accounting_identity table_footing articulation cashflow_c1 pairing md_tables split_sections map_section page_stitch word_to_cell".split()


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = con.execute(entry.oracle_sql()[name])
    at = [[c[0] for c in got.description].index(c) for c in cols]
    plain = lambda v: round(float(v), 6) + 0.0 if isinstance(v, float) else v
    assert sorted(repr([plain(r[c]) for c in cols]) for r in df.collect()) == sorted(repr([plain(r[i]) for i in at]) for r in got.fetchall())


def test_core_needs_no_training_text_package():
    code = "import sys; sys.modules['ledgerloom.llm'] = None\nimport __spark_entry__ as e\nassert 'p3_found' in e.queries() and 'p1_found' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parent.parent)
