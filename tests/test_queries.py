"""Every query against its SQL counterpart on the smallest test tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entries
from workload.views import TABLES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def comparable(rows, columns):
    places = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(repr(row[i]) for i in places) for row in rows)


@pytest.mark.parametrize("name", sorted(entries.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entries.queries()[name](spark, SF_DIR)
    result = duck.execute(entries.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert comparable(df.collect(), df.columns) == comparable(result.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(entries.queries()) - set(entries.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert not entries.queries()[name](spark, SF_DIR).isEmpty()


def test_sql_counterparts_belong_to_queries():
    assert set(entries.oracle_sql()) <= set(entries.queries())


def test_flagship_query(spark):
    df = entries.entry(spark)
    assert "market_value_diff_eur" in df.columns and not df.isEmpty()


def test_the_model_queries_share_their_joins(spark):
    for name in ("train_forest", "score_future", "score_future_checks", "model_roundtrip"):
        read = entries.queries()[name](spark, SF_DIR).inputFiles()
        assert read and not [file for file in read if file.startswith(f"file://{SF_DIR}")], name
