"""Chronological train, validation and test assignment."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casequarry.operators.clean import dated_cases, usable_cases, with_string_id
from casequarry.operators.ordering import part_offsets
from casequarry.schema import SPLITS
from casequarry.storage import materialize


# Shares of all rows, rounded down, that the earlier splits take; the last has the rest.
SHARES = {"train": 0.70, "val": 0.15}


def chronological_runs(rows: DataFrame) -> DataFrame:
    """``(case_id, received, n, start, total)``: equal rows as one run, in ``(received, case_id)`` order.

    Equal rows are counted before the sort, so a group of copies costs one row per task. The sort
    is by range, and only the part totals pass through one task.
    """
    runs = rows.groupBy("received", "case_id").agg(F.count(F.lit(1)).alias("n"))
    ranged = materialize(
        runs.repartitionByRange("received", "case_id").withColumn("part", F.spark_partition_id()),
        "runs",
    )
    if ranged.isEmpty():
        raise ValueError("no case has a usable text and a valid date, so no split can be listed")
    offsets = part_offsets(ranged, F.col("part"), F.col("n"))
    earlier = (
        Window.partitionBy("part")
        .orderBy("received", "case_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return ranged.join(F.broadcast(offsets), "part").select(
        "case_id",
        "received",
        "n",
        (F.col("offset") + F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("start"),
        "total",
    )


def _places(total: Column, shares: Mapping[str, float]) -> list[tuple[str, Column, Column]]:
    """Each split with its first place in chronological order and the place behind its last."""
    *earlier, last = SPLITS
    if set(shares) != set(earlier) or min(shares.values()) < 0 or sum(shares.values()) > 1:
        raise ValueError(f"shares of {', '.join(earlier)} that leave a rest for {last} are needed")
    places, low = [], F.lit(0).cast("long")
    for name in earlier:
        high = low + F.floor(total * F.lit(shares[name])).cast("long")
        places.append((name, low, high))
        low = high
    return [*places, (last, low, total)]


def build_splits(cases: DataFrame, shares: Mapping[str, float] = SHARES) -> DataFrame:
    """Split lists as runs ``(case_id, received, split, pos, n)``.

    ``pos`` is the zero-based place in the list of the split. ``n`` equal entries follow each
    other from there; it is 1 wherever ids do not repeat on one day.
    """
    rows = with_string_id(cases.select("case_id", "received"))
    runs = chronological_runs(rows)
    pieces = []
    for name, low, high in _places(F.col("total"), shares):
        first = F.greatest(F.col("start"), low)
        last = F.least(F.col("start") + F.col("n"), high)
        pieces.append(
            F.struct(
                F.lit(name).alias("split"), (first - low).alias("pos"), (last - first).alias("n")
            )
        )
    return (
        runs.select("case_id", "received", F.explode(F.array(*pieces)).alias("piece"))
        .select("case_id", "received", "piece.*")
        .where(F.col("n") > 0)
    )


def split_cases(cases: DataFrame, shares: Mapping[str, float] = SHARES) -> DataFrame:
    """Splits over the rows with usable text and a valid date."""
    return build_splits(dated_cases(usable_cases(cases)), shares)


def split_stats(splits: DataFrame) -> DataFrame:
    return splits.groupBy("split").agg(
        F.sum("n").alias("n"),
        F.min("received").alias("date_min"),
        F.max("received").alias("date_max"),
    )


def _ordinal(split: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SPLITS]), split)


def last_split_per_id(splits: DataFrame) -> DataFrame:
    """An id listed in several splits belongs to the latest of them."""
    return splits.groupBy("case_id").agg(F.max_by("split", _ordinal(F.col("split"))).alias("split"))


def attach_split_by_id(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Inner equi-join on the id, for rows that carry no date. Duplicate rows are kept."""
    return with_string_id(rows).join(last_split_per_id(splits), "case_id")


@dataclass(frozen=True)
class SplitLookup:
    """What is needed to place a listed row without moving it.

    ``val_start`` and ``test_start`` are the first ``(received, case_id)`` keys of these splits.
    """

    val_start: tuple | None
    test_start: tuple | None

    def place(self, received: Column, case_id: Column) -> Column:
        key = F.struct(received.alias("received"), case_id.alias("case_id"))

        def reached(start: tuple | None) -> Column:
            if start is None:
                return F.lit(False)
            return key >= F.struct(
                F.lit(start[0]).alias("received"), F.lit(start[1]).alias("case_id")
            )

        return (
            F.when(reached(self.test_start), "test")
            .when(reached(self.val_start), "val")
            .otherwise("train")
        )


def split_lookup(splits: DataFrame) -> SplitLookup:
    starts = {
        row["split"]: tuple(row["first"])
        for row in splits.where(F.col("split") != "train")
        .groupBy("split")
        .agg(F.min(F.struct("received", "case_id")).alias("first"))
        .collect()
    }
    return SplitLookup(starts.get("val"), starts.get("test"))


def _looked_up(dated: DataFrame, splits: DataFrame) -> DataFrame:
    """``(case_id, looked_up)`` of the ids of ``dated`` rows that a comparison of keys may misplace.

    These are ids whose entries fall into several splits, and ids of a ``(received, case_id)`` that
    is not listed; ``looked_up`` is the split of the id, null if the id is not listed at all. Keys
    are compared on narrow columns, and the result is written, so the planner knows its size.
    """
    listed = splits.groupBy("case_id").agg(
        F.min(_ordinal(F.col("split"))).alias("first_split"),
        F.max(_ordinal(F.col("split"))).alias("last_split"),
        F.max_by("split", _ordinal(F.col("split"))).alias("looked_up"),
    )
    moved = listed.where(F.col("first_split") < F.col("last_split")).select("case_id")
    keys = dated.select("received", "case_id").distinct()
    unlisted = keys.join(splits, ["received", "case_id"], "left_anti").select("case_id")
    ids = moved.unionByName(unlisted).distinct()
    return materialize(
        ids.join(listed, "case_id", "left").select("case_id", "looked_up"), "looked-up-ids"
    )


def attach_split(cases: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows of listed ids with the split of their id; the text is not shuffled where all are listed.

    The split lists are contiguous in ``(received, case_id)`` order, so a row with a listed key finds
    its split by comparing with two keys. Ids in several splits, ids of rows with another date than
    the listed one, and ids of undated rows are joined. Rows of unlisted ids are dropped.
    """
    lookup = split_lookup(splits)
    rows = with_string_id(cases)
    dated = dated_cases(rows)
    joined = _looked_up(dated, splits).withColumn("by_id", F.lit(True))
    placed = F.when(F.col("by_id"), F.col("looked_up")).otherwise(
        lookup.place(F.col("received"), F.col("case_id"))
    )
    dated = (
        dated.join(joined, "case_id", "left")
        .withColumn("split", placed)
        .where(F.col("split").isNotNull())
        .drop("looked_up", "by_id")
    )
    undated = attach_split_by_id(rows.where(F.col("received").isNull()), splits)
    return dated.unionByName(undated)


def listed_texts(cases: DataFrame, splits: DataFrame) -> DataFrame:
    """Every split entry with the text of its id: ``(case_id, received, split, n, text)``.

    Of several rows with one id the last in file order gives the text. An id with one row and one
    entry of the same date is placed by that date; all others, found on narrow columns, are joined
    with the lists.
    """
    usable = with_string_id(usable_cases(cases)).select(
        "case_id", "received", "text", "ingest_pos"
    )
    entries = splits.groupBy("case_id").agg(
        F.sum("n").alias("entries"), F.min("received").alias("listed")
    )
    once = (F.col("rows") == 1) & (F.col("entries") == 1) & F.col("day").eqNullSafe(F.col("listed"))
    repeated = materialize(
        usable.groupBy("case_id")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.max("ingest_pos").alias("last_pos"),
            F.min("received").alias("day"),
        )
        .join(entries, "case_id", "left")
        .where(~F.coalesce(once, F.lit(False)))
        .select("case_id", "last_pos"),
        "repeated-ids",
    )
    lookup = split_lookup(splits)
    marked = usable.join(repeated, "case_id", "left")
    single = dated_cases(marked.where(F.col("last_pos").isNull())).select(
        "case_id",
        "received",
        lookup.place(F.col("received"), F.col("case_id")).alias("split"),
        F.lit(1).cast("long").alias("n"),
        "text",
    )
    latest = marked.where(F.col("ingest_pos") == F.col("last_pos")).select("case_id", "text")
    several = splits.join(latest, "case_id").select("case_id", "received", "split", "n", "text")
    return single.unionByName(several)
