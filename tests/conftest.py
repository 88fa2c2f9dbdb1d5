import datetime as dt
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ticketflow.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    options = {"spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": f"{shared}/warehouse"}
    session = build_session("local[4]", 4, app="ticketflow-tests", options=options)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return con


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    changed = {}

    def set_option(key, value):
        changed.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield set_option
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def at(text):
    return None if text is None else dt.datetime.fromisoformat(text)


def day(text):
    return None if text is None else dt.date.fromisoformat(text)


def rows(df):
    """Rows as sorted tuples, missing values last."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
