"""How the operators read their tables and run Arrow batches."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casequarry.llm.tokens import slices
from casequarry.storage import spread

# The words of most contracts, as a regex class.
WORD = r"[^\x20\x09-\x0D]+"
# Bytes of an Arrow batch of the pipeline. A task holds one several times over, as vectors, as the
# bytes sent and in Python; the default of 64 MB makes that hundreds of MB outside the heap.
BATCH_BYTES = 4 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a whole table; other columns, whatever their names, are not read."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns))


def fold(key: Column, folds: int) -> Column:
    """CRC-32 of a key as text, modulo ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bound_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches have ``BATCH_BYTES`` or one row, if it has set no limit."""
    if spark.conf.get(_BATCH_LIMIT, None) is None:
        spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` under column names that no result has, so that whole rows and a text in them travel once."""
    return rows.toDF(*(f"column_{i}" for i in range(len(rows.columns))))


def append(
    rows: DataFrame,
    fields: T.StructType,
    compute: Callable[[pa.RecordBatch], list],
    text: str = "text",
    keep: list[str] | None = None,
) -> DataFrame:
    """``rows`` with further columns computed batch by batch, without a shuffle.

    ``compute`` gets a slice of bounded text size and returns one list or array per field. Of the
    columns of ``rows`` those in ``keep`` are returned, all if it is not given; one that has the
    name of a new column is replaced.
    """
    names = [c for c in (rows.columns if keep is None else keep) if c not in fields.fieldNames()]
    schema = T.StructType([rows.schema[c] for c in names] + fields.fields)

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for batch in batches:
            for part in slices(batch, text):
                new = [
                    pa.array(values, target.field(field.name).type)
                    if not isinstance(values, (pa.Array, pa.ChunkedArray))
                    else values
                    for field, values in zip(fields.fields, compute(part))
                ]
                kept = [part.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*kept, *new], names=target.names)

    return rows.select(*dict.fromkeys([*names, text])).mapInArrow(work, schema)
