import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from scoreline.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[8]", 8, "scoreline-tests", str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


@pytest.fixture
def frame(spark):
    """Build a DataFrame from rows and a schema text."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def rows_of(df):
    """The rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
