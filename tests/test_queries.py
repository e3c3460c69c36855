"""Every registered query against its SQL equivalent on the same tables."""

import math

import duckdb
import pytest
from pyspark.errors import AnalysisException

import __spark_entry__ as contract
from tidegauge.plans.catalog import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in ("events", "region"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        return "nan" if isinstance(value, float) and math.isnan(value) else value

    return sorted(([plain(row[i]) for i in order] for row in rows), key=repr)


def test_every_query_has_an_equivalent():
    assert set(QUERIES) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, tables, name):
    result = contract.queries()[name](spark, FOLDER)
    answer = tables.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(result.columns) == sorted(columns)
    expected = normal(columns, answer.fetchall())
    assert expected
    assert normal(result.columns, map(tuple, result.collect())) == expected


def test_a_table_may_be_a_folder_of_parts(spark, tables, tmp_path):
    for name in ("events", "region"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name in ("window_stats_stream", "quarantine_stream", "stream_delivery_report"):
        answer = tables.execute(contract.oracle_sql()[name])
        columns = [d[0] for d in answer.description]
        result = contract.queries()[name](spark, str(tmp_path))
        assert normal(result.columns, map(tuple, result.collect())) == normal(columns, answer.fetchall())


def test_a_missing_table_fails(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        contract.queries()["quarantine_stream"](spark, str(tmp_path))


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "window_start", "window_end", "device_type", "avg_temperature", "median_humidity"]
