"""Records of CSV files whose quoted cells hold line breaks, with many tasks on one file.

Spark's text reader cuts files into splits at line ends, quoted or not. Whether a split begins inside of a
quoted cell depends on everything before it, but only through one bit: every line maps the state before
it (outside, inside) to the state behind it, and these maps compose. So one pass gives the map of every split,
a running composition over the splits of a file gives the states at their starts, and a second pass joins
the lines of each record. Only the parts of records that cross a split meet, a few rows a file.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from casequarry.storage import materialize

# A cell without its comma: quoted with doubled quotes, then what follows the closing one; or plain.
_INSIDE = r'(?:[^"]|"")*'
_AFTER = r'"(?:[^",][^,]*)?'
_CELLS = rf'(?:(?:"{_INSIDE}{_AFTER}|[^",][^,]*)?,)*'
OPENS = rf'^{_CELLS}"{_INSIDE}$'
STAYS_OPEN = rf'^{_INSIDE}(?:{_AFTER},{_CELLS}"{_INSIDE})?$'

WHOLE, TAIL, HEAD, MIDDLE = 0, 1, 2, 3
RECORDS = "file string, start long, row long, kind int, record string"


def _lines(spark: SparkSession, files: list[str] | str) -> DataFrame:
    return (
        spark.read.option("lineSep", "\n")
        .text(files)
        .select(
            F.make_valid_utf8("value").alias("line"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
        )
    )


def _splits_of(batch: pa.RecordBatch):
    """Parts of a batch that belong to one split of one file each."""
    if not batch.num_rows:
        return
    start = batch.column("start").to_numpy()
    file = pc.dictionary_encode(batch.column("file")).indices.to_numpy()
    change = np.flatnonzero((start[1:] != start[:-1]) | (file[1:] != file[:-1])) + 1
    for low, high in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
        yield batch.column("file")[low].as_py(), int(start[low]), batch.slice(low, high - low)


def _maps(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Is a cell open behind each line, if none and if one was open before it?"""
    found = (pc.match_substring_regex(lines, pattern) for pattern in (OPENS, STAYS_OPEN))
    return tuple(f.to_numpy(zero_copy_only=False) for f in found)


def _states(outside: np.ndarray, inside: np.ndarray, before: bool) -> np.ndarray:
    """Is a cell open behind each line, from the state before the first?"""
    forgets = outside == inside
    last = np.maximum.accumulate(np.where(forgets, np.arange(len(outside)), -1))
    turns = np.cumsum(outside & ~inside)
    known = np.where(last >= 0, outside[last], before)
    since = turns - np.where(last >= 0, turns[last], 0)
    return known ^ (since % 2 == 1)


def open_splits(spark: SparkSession, files: list[str] | str) -> DataFrame:
    """``(file, start)`` of the splits that begin inside of a quoted cell."""

    def work(batches):
        maps: dict = {}
        for batch in batches:
            for file, start, part in _splits_of(batch):
                outside, inside = _maps(part.column("line"))
                told = maps.get((file, start), (False, True))
                maps[file, start] = tuple(bool(_states(outside, inside, s)[-1]) for s in told)
        rows = [(*key, *told) for key, told in maps.items()]
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
        columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["file", "start", "outside", "inside"])

    maps = _lines(spark, files).mapInArrow(work, "file string, start long, outside boolean, inside boolean")
    ordered = F.array_sort(F.collect_list(F.struct("start", "outside", "inside")))
    states = F.aggregate(
        "maps",
        F.struct(F.lit(False).alias("open"), F.array().cast("array<bigint>").alias("starts")),
        lambda s, m: F.struct(
            F.when(s["open"], m["inside"]).otherwise(m["outside"]).alias("open"),
            F.when(s["open"], F.array_append(s["starts"], m["start"])).otherwise(s["starts"]).alias("starts"),
        ),
    )
    # One row per split, so a group is the length of a file by the length of a split.
    return (
        maps.groupBy("file")
        .agg(ordered.alias("maps"))
        .select("file", F.explode(states["starts"]).alias("start"))
    )


def _cut(lines: DataFrame) -> DataFrame:
    """Records and parts of records of every split; ``lines`` has ``file, start, line, inside``."""

    def work(batches):
        split, state, number, pending, at_head = None, False, 0, [], False

        def row(kind, text, own):
            file, start = split
            values = [[file], [start], [own], [kind], [text]]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
            arrays = [pa.array(v, k) for v, k in zip(values, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=["file", "start", "row", "kind", "record"])

        def rest():
            if pending:
                yield row(MIDDLE if at_head else TAIL, "\n".join(pending), number)

        for batch in batches:
            for file, start, part in _splits_of(batch):
                if split != (file, start):
                    yield from rest()
                    split, number, pending = (file, start), -1 if start == 0 else 0, []
                    state = at_head = bool(part.column("inside")[0].as_py())
                lines = part.column("line")
                states = _states(*_maps(lines), state)
                state = bool(states[-1])
                ends = np.flatnonzero(~states)
                if not len(ends):
                    pending += lines.to_pylist()
                    continue
                first = int(ends[0]) + 1
                if pending or at_head:
                    head = "\n".join([*pending, *lines.slice(0, first).to_pylist()])
                    yield row(HEAD if at_head else WHOLE, head, number)
                    number += not at_head
                    ends, at_head = ends[1:], False
                else:
                    first = 0
                pending = lines.slice(int(ends[-1]) + 1 if len(ends) else first).to_pylist()
                if not len(ends):
                    continue
                offsets = np.concatenate([[first], ends + 1]).astype(np.int32)
                records = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), lines), "\n")
                # Empty lines are no records.
                records = records.filter(pc.invert(pc.is_in(records, pa.array(["", "\r"]))))
                n = len(records)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([file], pa.string()).take(pa.array(np.zeros(n, np.int64))),
                        pa.array(np.full(n, start)),
                        pa.array(np.arange(number, number + n)),
                        pa.array(np.full(n, WHOLE, np.int32)),
                        records,
                    ],
                    names=["file", "start", "row", "kind", "record"],
                )
                number += n
        if split is not None:
            yield from rest()

    return lines.mapInArrow(work, RECORDS)


def records(spark: SparkSession, files: list[str] | str) -> DataFrame:
    """``(file, start, row, record)`` of all records but the headers.

    ``row`` counts the records that begin in the split at ``start``, from 0 on without gaps.
    """
    inside = materialize(open_splits(spark, files), "open-splits").withColumn("inside", F.lit(True))
    lines = _lines(spark, files)
    # At most one row per split of the input.
    asked = lines.join(F.broadcast(inside), ["file", "start"], "left").select(
        "file", "start", "line", F.coalesce("inside", F.lit(False)).alias("inside")
    )
    cut = materialize(_cut(asked), "csv-records")
    # A record that crosses splits is a tail, middles and a head, in the order of the splits.
    so_far = Window.partitionBy("file").orderBy("start", "kind_order")
    parts = (
        cut.where(F.col("kind") != WHOLE)
        .withColumn("kind_order", F.when(F.col("kind") == TAIL, 1).otherwise(0))
        .withColumn("whole", F.sum((F.col("kind") == TAIL).cast("int")).over(so_far))
        .groupBy("file", "whole")
        .agg(F.array_sort(F.collect_list(F.struct("start", "kind_order", "row", "record"))).alias("parts"))
        .select(
            "file",
            F.col("parts")[0]["start"].alias("start"),
            F.col("parts")[0]["row"].alias("row"),
            F.array_join("parts.record", "\n").alias("record"),
        )
    )
    whole = cut.where(F.col("kind") == WHOLE).select("file", "start", "row", "record")
    return (
        whole.unionByName(parts)
        .where(F.col("row") >= 0)
        .withColumn("record", F.regexp_replace("record", "\r$", ""))
    )
