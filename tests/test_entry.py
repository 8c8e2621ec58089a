"""Every registered query against its SQL counterpart."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
SQL_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def in_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows), key=lambda row: [(v is None, str(v)) for v in row]
    )


def test_every_query_has_a_counterpart():
    assert set(ORACLES) <= set(QUERIES)
    # Beyond SQL: trained models, tokenizers, curves and probabilities; their own tests use brute force.
    beyond = {f"op{n}" for n in (1, 2, 3, 4, 5, 6, 7, 9, 10, 13)} | {"pipeline"}
    assert {q.partition("_")[0] for q in QUERIES if q not in ORACLES} <= beyond


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(columns) == sorted(df.columns)
    kinds = {c: str(d[1]) for c, d in zip(columns, expected.description)}
    for column, kind in df.dtypes:
        if column in kinds and kind in SQL_TYPES:
            assert kinds[column] in (SQL_TYPES[kind], "NULL", "HUGEINT"), column
    rows = [tuple(r) for r in df.collect()]
    assert in_order(df.columns, rows) == in_order(columns, expected.fetchall())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["c_mktsegment", "application_count", "labelled_count", "default_count", "default_rate"]
    assert df.count() == 5
