"""Every registered query against its SQL, on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables not present")

ROWS = {
    "decode_documents": 200,
    "normalize_text": 200,
    "tokenize": 76_205,
    "term_frequency": 47_059,
    "peak_document_per_term": 20_119,
    "peak_document_formatted": 20_119,
}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_sql():
    assert registry._own_queries().keys() == registry._own_sql().keys()


@pytest.mark.parametrize("name", registry._own_queries())
def test_query_equals_sql(spark, tables, name):
    result = registry._own_queries()[name](spark, str(DATA))
    columns = sorted(result.columns)
    got = Counter(tuple(row[c] for c in columns) for row in result.collect())
    expected = tables.sql(registry._own_sql()[name])
    assert sorted(expected.columns) == columns
    assert got == Counter(expected.project(", ".join(columns)).fetchall())
    if name in ROWS:
        assert got.total() == ROWS[name]


def test_entry(spark):
    result = registry.entry(spark)
    assert result.columns == ["word", "filename", "n"]
    assert result.count() == ROWS["peak_document_per_term"]
