"""Every registered query against its SQL on the same tables, and its plan."""

import pandas as pd
import pytest
from conftest import DATA, plan

import __spark_entry__ as entry
from ticketflow.plans.oracle import ORACLE
from ticketflow.plans.queries import QUERIES

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def _cell(value):
    if pd.isna(value):
        return None
    if hasattr(value, "year"):
        return str(pd.Timestamp(value))
    return value


def _table(frame):
    frame = frame[sorted(frame.columns)]
    cells = [tuple(_cell(v) for v in r) for r in frame.itertuples(index=False)]
    return sorted(cells, key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    expected = duck.sql(ORACLE[name])
    assert {c: TYPES[t] for c, t in df.dtypes} == dict(zip(expected.columns, map(str, expected.types)))
    result = df.toPandas()
    assert len(result) > 0
    assert _table(result) == _table(expected.df())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_stays_in_spark_without_products(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in text


def test_entry(spark):
    assert entry.entry(spark).count() > 0
