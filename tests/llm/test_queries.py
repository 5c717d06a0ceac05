from __future__ import annotations

import duckdb
import pytest

import __spark_entry__
from riskweave.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import DATA

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_its_sql(spark, oracle, name):
    found = QUERIES[name](spark, FOLDER)
    expected = oracle.sql(ORACLE_SQL[name])
    names = sorted(found.columns)
    assert names == sorted(expected.columns)
    key = lambda rows: sorted(rows, key=repr)
    assert key(tuple(r) for r in found.select(names).collect()) == key(expected.select(*names).fetchall())


def test_every_operator_is_registered_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLE_SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in ORACLE_SQL))
def test_runs_over_every_document(spark, name):
    found = QUERIES[name](spark, FOLDER)
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    if name == "op11_spelling_variants":
        assert found.select("word").distinct().count() == found.count() > 0
    elif name != "pipeline":
        assert found.count() == documents.count()
        assert found.select("doc_id").exceptAll(documents.select("doc_id")).isEmpty()
    else:
        assert found.select("doc_id").subtract(documents.select("doc_id")).isEmpty()
