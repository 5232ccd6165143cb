"""Every registered query against its SQL on DuckDB, over whole tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

QUERIES, ORACLE = contract.QUERIES, contract.ORACLE


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([record[i] for i in order]) for record in records)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    want = duck.sql(ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def test_entry_is_the_flagship_query(spark):
    row = contract.entry(spark).first()
    assert (row.total_chars, row.regular_input_tokens, row.cached_input_tokens) == (485_988, 105_347, 180)
    assert (row.aws_cost, row.openai_cost) == (0.0, 0.015816)
