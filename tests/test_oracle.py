"""Every registered query against its oracle SQL in an independent engine."""

import decimal

import duckdb
import pytest

import __spark_entry__ as registry
from support import SF_DIR

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def engine():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'"
        )
    yield connection
    connection.close()


def plain(value):
    return float(value) if isinstance(value, (float, decimal.Decimal)) else value


BASE = sorted([*registry.OPERATORS, "bronze_row_counts"])


def test_every_query_has_an_oracle():
    assert set(BASE) <= set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", BASE)
def test_matches_oracle(spark, engine, name):
    frame = registry.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in frame.collect()), key=repr)

    cursor = engine.execute(registry.oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert columns == sorted(names)
    places = [names.index(column) for column in columns]
    theirs = sorted((tuple(plain(r[i]) for i in places) for r in cursor.fetchall()), key=repr)
    assert ours == theirs


def test_entry(spark):
    frame = registry.entry(spark)
    assert frame.columns == [
        "population",
        "lines",
        "lines_pct",
        "quantity",
        "revenue",
        "revenue_pct",
    ]
    assert frame.count() > 0
