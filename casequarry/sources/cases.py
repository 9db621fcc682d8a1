"""The case table from its CSV source."""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casequarry.functions.text import missing_to_null, parse_day
from casequarry.operators.clean import cap_rows
from casequarry.operators.ordering import part_offsets
from casequarry.schema import CASES, SOURCE_COLUMNS
from casequarry.sources.quoted_records import records
from casequarry.storage import materialize


def headers(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """Every distinct header of the source files with the files that have it, in file order.

    The first line of a file is found by its place, one row per file.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("row"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    first = lines.where(F.col("start") == 0).groupBy("file").agg(F.min_by("value", "row").alias("line"))
    found: dict[tuple, list[str]] = {}
    for row in first.orderBy("file").collect():
        names = next(csv.reader([row["line"].removeprefix("\ufeff").rstrip("\r")]), [])
        found.setdefault(tuple(names), []).append(unquote(row["file"]))
    return [(list(names), files) for names, files in found.items()]


def read_source(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, by name. Quoted line breaks are kept, short lines padded, long ones cut.

    Files may have their columns in different orders, and a column that a file lacks is null there.
    Of columns with the same name the first is read. Records are cut by ``quoted_records``, so a large
    file is read by many tasks although its cells hold line breaks.
    """

    def read(names: list[str], files: list[str]) -> DataFrame:
        place: dict[str, int] = {}
        for i, name in enumerate(names):
            place.setdefault(name, i)
        schema = ", ".join(f"c{i} string" for i in range(len(names)))
        options = {"quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}
        cells = F.from_csv("record", schema, options)
        return (
            records(spark, files)
            .withColumn("cells", cells)
            .select(
                *[F.col(f"cells.c{i}").alias(name) for name, i in place.items()],
                F.struct("file", "start").alias("__split"),
                F.col("row").alias("__row"),
            )
        )

    found = headers(spark, path)
    if not found:
        raise ValueError(f"no lines in {path}")
    parts = [read(names, files) for names, files in found]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def source_columns(spark: SparkSession, path: str) -> DataFrame:
    """Column list of the source as ``(idx, name)``."""
    found = headers(spark, path)
    if not found:
        raise ValueError(f"no lines in {path}")
    names = dict.fromkeys(name for header, _ in found for name in header)
    return spark.createDataFrame(list(enumerate(names)), "idx int, name string")


def ingest(spark: SparkSession, path: str) -> DataFrame:
    """Canonical cases with a dense ``ingest_pos`` in file order.

    Positions need only the row counts of the splits, which are counted without parsing a cell; no row is
    moved for them, and the cells are parsed where the result is read.
    """
    source = read_source(spark, path)
    absent = [name for name in SOURCE_COLUMNS if name not in source.columns]
    if absent:
        raise ValueError(f"source lacks columns: {absent}")
    parsed = source.select(
        *[missing_to_null(F.col(f"`{old}`")).alias(new) for old, new in SOURCE_COLUMNS.items()],
        F.col("__split").alias("split"),
        F.col("__row").alias("row"),
    )
    # At most one row per split of the input.
    offsets = F.broadcast(materialize(part_offsets(source, F.col("__split"), F.lit(1)), "split-offsets"))
    placed = parsed.join(offsets, F.col("split") == F.col("part")).select(
        "case_id",
        parse_day(F.col("received")).alias("received"),
        "product",
        "issue",
        "text",
        (F.col("offset") + F.col("row")).alias("ingest_pos"),
    )
    return placed.select(*[F.col(f.name).cast(f.dataType) for f in CASES.fields])


def read_cases(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    """Ingested cases from their table; the cap on rows reaches the scan as a filter."""
    return cap_rows(spark.read.schema(CASES).parquet(path), max_rows)


def dev_subset(cases: DataFrame, path: str, rows: int) -> int:
    """Write the first ``rows`` source rows, whole records, and return their number."""
    cap_rows(cases, rows).write.mode("overwrite").parquet(path)
    return cases.sparkSession.read.parquet(path).count()
