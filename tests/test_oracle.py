"""Every registered query against its SQL in DuckDB: same columns, same rows."""

import re
from decimal import Decimal

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(str(r[i]) if isinstance(r[i], Decimal) else r[i] for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_library_queries_have_sql():
    # Training-data operators that SQL cannot express are tested against brute force.
    assert not [n for n in set(queries()) - set(oracle_sql()) if n != "pipeline" and not re.match(r"op\d+_", n)]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, duck, sf_dir, name):
    frame = queries()[name](spark, sf_dir)
    found = _sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    answer = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    expected = _sorted_rows(columns, answer.fetchall())
    assert sorted(frame.columns) == sorted(columns)
    assert len(found) == len(expected)
    assert found == expected
    assert expected
