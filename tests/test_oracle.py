"""Every registered query against its SQL statement run by DuckDB."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as registry

# The text operators and the pipeline have tests of their own.
QUERIES = {
    name: query
    for name, query in registry.queries().items()
    if name != "pipeline" and not re.match(r"op\d+_", name)
}
STATEMENTS = registry.oracle_sql()


@pytest.fixture(scope="module")
def database(sf_small):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_small}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in found)


def test_every_query_has_a_statement():
    assert set(QUERIES) <= set(STATEMENTS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_statement(name, spark, database, sf_small):
    df = QUERIES[name](spark, sf_small)
    result = database.execute(STATEMENTS[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    expected = canonical(columns, result.fetchall())
    assert expected
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_entry_has_rows(spark):
    assert registry.entry(spark).count() > 0
