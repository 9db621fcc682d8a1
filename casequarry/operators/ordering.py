"""Dense positions over a whole table without a one-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casequarry.storage import materialize

# Ranges into which values are counted at a time.
BINS = 1024


def part_offsets(rows: DataFrame, part: Column, weight: Column, **extra: Column) -> DataFrame:
    """Per part: the weight of all earlier parts, and the weight of the whole table.

    One row per task or file of the previous stage, so the single-task window here sees no data
    rows. ``extra`` are further aggregates per part.
    """
    parts = rows.groupBy(part.alias("part")).agg(
        F.sum(weight).cast("long").alias("weight"), *[c.alias(name) for name, c in extra.items()]
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    return parts.select(
        "part",
        *extra,
        F.coalesce(F.sum("weight").over(before), F.lit(0)).cast("long").alias("offset"),
        F.sum("weight").over(everything).cast("long").alias("total"),
    )


def _threshold(rows: DataFrame, value: str, limit: int) -> tuple[int, int] | None:
    """The value of the ``limit``-th largest row and how many rows are above it.

    Counts rows per range of values and narrows the range down, so no task sees more than the
    ranges. None if there are no more rows than ``limit``.
    """
    low, high, n = rows.agg(F.min(value), F.max(value), F.count(F.lit(1))).first()
    if n <= limit:
        return None
    above = 0
    while low < high:
        width = -(-(high - low + 1) // BINS)
        inside = rows.where(F.col(value).between(low, high))
        place = F.floor((F.col(value) - low) / F.lit(width)).cast("int")
        counts = {r["bin"]: r["n"] for r in inside.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()}
        for number in sorted(counts, reverse=True):
            if above + counts[number] >= limit:
                break
            above += counts[number]
        low, high = low + number * width, min(high, low + (number + 1) * width - 1)
    return low, above


def nth_largest(rows: DataFrame, value: str, n: int) -> int | None:
    """The whole ``value`` of the ``n``-th largest row, None if there are no more rows than ``n``.

    Reads ``rows`` several times, so they should be written.
    """
    found = _threshold(rows, value, n)
    return None if found is None else found[0]


def largest(rows: DataFrame, value: str, tie: str, limit: int) -> DataFrame:
    """The ``limit`` rows with the largest whole ``value``; ties go to the lower ``tie``.

    Rows above the threshold need no order. Those that tie there are sorted by range, and only
    the totals of the ranges pass through one task.
    """
    rows = materialize(rows, "ranked-rows")
    found = _threshold(rows, value, limit)
    if found is None:
        return rows
    edge, above = found
    ties = rows.where(F.col(value) == edge).repartitionByRange(tie)
    ranged = materialize(ties.withColumn("part", F.spark_partition_id()), "tied-rows")
    offsets = part_offsets(ranged, F.col("part"), F.lit(1))
    place = F.row_number().over(Window.partitionBy("part").orderBy(tie)) + F.col("offset")
    first = ranged.join(F.broadcast(offsets), "part").where(F.col("offset") < limit - above)
    first = first.withColumn("place", place).where(F.col("place") <= limit - above)
    return rows.where(F.col(value) > edge).unionByName(first.select(*rows.columns))
