"""Every query against its SQL twin: names, types, rows."""

import importlib.util
import json
import math

import pytest
from pyspark.sql import functions as F

from guestlens.catalog import oracle, queries
from tests.conftest import ROOT

spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

QUERIES, SQL = queries.QUERIES, oracle.ORACLE_SQL
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
# Randomized or iterative estimators have no SQL twin.
ROWS_ONLY = {"rf_predict", "svc_predict", "svc_scored", "model_compare"}


def canonical(rows):
    rows = [tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in row) for row in rows]
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_a_twin_or_a_reason():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    mine = canonical(tuple(row[c] for c in columns) for row in df.collect())
    cursor = duck.execute(SQL[name])
    found = {d[0]: str(d[1]) for d in cursor.description}
    order = [list(found).index(c) for c in columns]
    theirs = canonical(tuple(row[i] for i in order) for row in cursor.fetchall())
    assert found == {c: TYPES[df.schema[c].dataType.simpleString()] for c in columns}
    assert mine == theirs


def test_arrays_of_one_source_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(queries, "ARRAY_ROWS", 100)
    rated = spark.range(3000).selectExpr("id AS doc_id", "'one' AS source")
    sizes = [len(json.loads(r.value)) for r in queries._arrays(rated, F.struct("doc_id")).collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 200


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert [row["rank"] for row in rows] == [1, 2, 3]


@pytest.mark.parametrize("kind", ["rf_predict", "svc_predict"])
def test_estimators_beat_nothing(spark, sf, kind):
    """All rows of the city are scored, with known labels."""
    rows = QUERIES[kind](spark, sf).collect()
    assert len(rows) == QUERIES["nb_predict"](spark, sf).count()
    assert {row["predicted_review_label"] for row in rows} <= {"positive", "negative"}
