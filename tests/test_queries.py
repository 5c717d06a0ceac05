"""Every query against its SQL twin, on the smallest provided data."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry_points
from riskweave.oracle import ORACLE_SQL
from riskweave.queries import QUERIES as CORE_QUERIES
from riskweave.schemas import PROVIDED
from tests.conftest import DATA

FOLDER = f"{DATA}/sf0.001"
QUERIES, TWINS = CORE_QUERIES, ORACLE_SQL
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}
WITHOUT_TWIN = {"feature_importances", "model_alerts"}


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for table in PROVIDED:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def comparable(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, float):
        return repr(value + 0.0)
    return f"{type(value).__name__} {value}"


def test_twins_belong_to_queries():
    assert set(QUERIES) - set(TWINS) == WITHOUT_TWIN
    assert set(TWINS) <= set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_its_twin(spark, database, name):
    result = QUERIES[name](spark, FOLDER)
    twin = database.execute(TWINS[name])
    names = [column[0] for column in twin.description]
    types = {column[0]: str(column[1]) for column in twin.description}
    assert {c: TYPES[kind] for c, kind in result.dtypes} == types
    order = sorted(names)
    got = sorted(repr([comparable(row[c]) for c in order]) for row in result.collect())
    places = [names.index(c) for c in order]
    want = sorted(repr([comparable(row[i]) for i in places]) for row in twin.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(WITHOUT_TWIN))
def test_query_without_twin_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.count() == 202
    assert {"risk_score", "flags", "label"} <= set(result.columns)
