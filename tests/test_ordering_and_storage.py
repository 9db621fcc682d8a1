"""Thresholds instead of sorts, and where intermediate tables are written."""

from __future__ import annotations

import random

import pytest

from casequarry import storage
from casequarry.operators import ordering


@pytest.mark.parametrize("limit", [0, 1, 7, 120, 299, 300, 500])
def test_largest(spark, monkeypatch, limit):
    monkeypatch.setattr(ordering, "BINS", 4)
    rng = random.Random(limit)
    rows = [(f"t{i:03d}", rng.choice([1, 1, 1, 2, 3, 50, 51, 10**9])) for i in range(300)]
    table = spark.createDataFrame(rows, "term string, tf long").repartition(5)
    found = ordering.largest(table, "tf", "term", limit)
    want = sorted(rows, key=lambda r: (-r[1], r[0]))[:limit]
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_largest_of_nothing(spark):
    assert ordering.largest(spark.createDataFrame([], "term string, tf long"), "tf", "term", 3).count() == 0


class Settings:
    """What the storage reads of a session."""

    def __init__(self, **named):
        self.conf = {k.replace("_", "."): v for k, v in named.items()}


def test_shared_folder(spark):
    assert storage.shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    unset = Settings(spark_sql_warehouse_dir="s3a://bucket/warehouse/")
    assert storage.shared_root(unset) == "s3a://bucket/warehouse"


def test_written_by_column(spark):
    table = spark.range(10).selectExpr("id", "id % 2 AS side", "'x' AS text")
    written = storage.materialize(table, "by-side", partition_by="side")
    assert written.columns == table.columns
    assert sorted(map(tuple, written.collect())) == sorted(map(tuple, table.collect()))
    plan = written.where("side = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(side" in plan
