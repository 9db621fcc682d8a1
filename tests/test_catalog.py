"""Every registered query against its SQL, on the smallest sample tables."""

from __future__ import annotations

import math
from pathlib import Path

import pandas as pd
import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="sample tables are absent")


def plain(value):
    if hasattr(value, "item"):
        value = value.item()
    if value is None or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    return round(value, 5) if isinstance(value, float) else value


def rows_of(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted((tuple(map(plain, r)) for r in pdf.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, sql, name):
    found = entry.queries()[name](spark, str(SF_DIR)).toPandas()
    assert len(found) > 0
    if name in entry.oracle_sql():
        want = sql.execute(entry.oracle_sql()[name]).df()
        assert sorted(found.columns) == sorted(want.columns)
        assert rows_of(found) == rows_of(want)


def test_entry(spark):
    assert entry.entry(spark).count() == 7
