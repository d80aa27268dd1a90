from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rollscore.session import local_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark():
    return local_session(8, app="tests")


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


@pytest.fixture
def values(spark):
    """Evaluate one expression over a list of texts, in order."""

    def run(texts, expr):
        df = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
        rows = df.select("id", expr.alias("v")).collect()
        return [r.v for r in sorted(rows, key=lambda r: r.id)]

    return run
