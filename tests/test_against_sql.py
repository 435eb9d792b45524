"""Every query with an SQL twin gives the same rows, names and types as DuckDB."""

import os

import duckdb
import pytest

from pedalflow.plans.oracle import ORACLE
from pedalflow.plans.queries import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}
ROWS_ONLY = {
    "forecast_latest",
    "forecast_metrics",
    "forecast_predictions",
    "forecast_series",
    "model_roundtrip",
    "rolling_forecast",
    "stream_scores",
    "util_quantile_bins",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def _sorted(records, names):
    return sorted(tuple(repr(r[n] + 0.0 if isinstance(r[n], float) else r[n]) for n in names) for r in records)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, duck, name):
    ours = QUERIES[name](spark, FOLDER)
    theirs = duck.sql(ORACLE[name])
    kinds = dict(zip(theirs.columns, map(str, theirs.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in ours.schema} == kinds
    names = sorted(ours.columns)
    expected = [dict(zip(theirs.columns, record)) for record in theirs.fetchall()]
    assert _sorted([r.asDict() for r in ours.collect()], names) == _sorted(expected, names)


def test_only_models_and_sketches_go_without_sql():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 28
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
