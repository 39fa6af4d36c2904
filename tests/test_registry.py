"""Registered queries against their SQL on the smallest data; FILINGLAKE_ALL=1 runs every one."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))
import compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from filinglake.catalog.registry import all_queries  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUICK = ["a15_top_buyers", "a4_value_units", "a9_filing_lags", "g1_merge_holdings", "p1_13f_filings", "s8_figi_ingest", "w1_first_last"]
NAMES = sorted(all_queries()) if os.environ.get("FILINGLAKE_ALL") else QUICK
needs_data = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no given tables here")


def test_every_query_has_sql():
    assert {name for name, query in all_queries().items() if query.oracle() is None} == set()
    assert set(all_queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@needs_data
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = compare.oracle(FOLDER).execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert compare.rows_of(df.columns, df.collect()) == compare.rows_of(columns, cursor.fetchall())


@needs_data
def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() == 10
