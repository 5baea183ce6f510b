"""One local session and one set of reference answers for all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from tallymark.session import build_session  # noqa: E402

TESTDATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tallymark-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="8g",
        spark__sql__streaming__metricsEnabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return str(TESTDATA / "sf0.01")


@pytest.fixture(scope="session")
def small_dir():
    return str(TESTDATA / "sf0.001")


def duckdb_with_tables(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


@pytest.fixture(scope="session")
def duck(sf_dir):
    return duckdb_with_tables(sf_dir)


@pytest.fixture(scope="session")
def small_duck(small_dir):
    return duckdb_with_tables(small_dir)
