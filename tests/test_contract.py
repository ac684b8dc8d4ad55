"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as contract
from clickloom.plans.segments import UNFLAGGED, segment_rules
from harness.compare import rows_of
from harness.oracles import ORACLES
from harness.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def db():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= contract.queries().items() and ORACLES.items() <= contract.oracle_sql().items()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["metric", "masthead", "period", "value"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    got = contract.queries()[name](spark, SF_DIR)
    want = db.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got.columns, got.collect()) == rows_of(columns, want.fetchall())


def test_every_segment_occurs(spark):
    """The fixture has all outcomes of the rules, and visitors who clear cookies and who do not."""
    found = QUERIES["segments_of_every_kind"](spark, SF_DIR).select("segment", "cookieClearer").distinct().collect()
    assert {row.segment for row in found} == {name for _, name in segment_rules()} | {UNFLAGGED}
    assert {row.cookieClearer for row in found} == {0, 1}
