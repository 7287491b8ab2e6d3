"""Every registered query against its SQL statement, on the smallest tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from tidemill.plans.oracles import oracle_statements
from tidemill.plans.queries import registered_queries

TABLES = "/root/testdata/sf0.001"
QUERIES = registered_queries()
STATEMENTS = oracle_statements()


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(table, key=lambda r: [(v is not None, str(v)) for v in r])


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)
    assert set(QUERIES) <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_statement(spark, sql, name):
    result = QUERIES[name](spark, TABLES)
    answer = sql.execute(STATEMENTS[name])
    columns = [d[0] for d in answer.description]
    assert sorted(result.columns) == sorted(columns)
    expected = comparable(answer.fetchall(), columns)
    assert comparable([tuple(r) for r in result.collect()], result.columns) == expected
    assert expected


def test_entry(spark):
    result = entry_point.entry(spark)
    assert result.columns == ["window_start", "window_end", "event_type", "event_count"]
    assert result.count() > 0


@pytest.fixture(scope="module")
def table_folders(spark, tmp_path_factory):
    """The same tables, each as a folder of several files."""
    folder = str(tmp_path_factory.mktemp("tables"))
    for name in ("events", "orders", "lineitem"):
        table = spark.read.parquet(f"{TABLES}/{name}.parquet")
        table.repartition(5).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize(
    "name", ["j1_funnel_hourly", "j6_order_revenue_batch", "silver_dedup_product_events"]
)
def test_tables_may_be_folders(spark, sql, table_folders, name):
    result = QUERIES[name](spark, table_folders)
    answer = sql.execute(STATEMENTS[name])
    columns = [d[0] for d in answer.description]
    expected = comparable(answer.fetchall(), columns)
    assert comparable([tuple(r) for r in result.collect()], result.columns) == expected
