"""Row filters that decide which cases are used."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casequarry.functions.text import is_usable


def usable_cases(
    cases: DataFrame, text_col: str = "text", label_col: str | None = None
) -> DataFrame:
    """Rows with usable text and, where the label column is given and present, a usable label."""
    rows = cases.where(is_usable(F.col(text_col)))
    if label_col is not None and label_col in cases.columns:
        rows = rows.where(is_usable(F.col(label_col)))
    return rows


def dated_cases(cases: DataFrame) -> DataFrame:
    return cases.where(F.col("received").isNotNull())


def with_string_id(cases: DataFrame, id_col: str = "case_id") -> DataFrame:
    """Ids as text; a missing id becomes the text ``nan``, so it still joins."""
    return cases.withColumn(id_col, F.coalesce(F.col(id_col).cast("string"), F.lit("nan")))


def cap_rows(cases: DataFrame, max_rows: int | None) -> DataFrame:
    """First ``max_rows`` source rows in file order, taken before any filter."""
    if max_rows is None:
        return cases
    return cases.where(F.col("ingest_pos") < max_rows)


def select_split(rows: DataFrame, *names: str) -> DataFrame:
    return rows.where(F.col("split").isin(*names))
