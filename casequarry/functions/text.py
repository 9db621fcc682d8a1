"""Text expressions; all of them run inside the JVM."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casequarry.schema import NA_LITERALS, WHITESPACE


def missing_to_null(col: Column) -> Column:
    """Drop replacement characters of undecodable bytes, then null the missing literals."""
    clean = F.replace(col, F.lit("\ufffd"), F.lit(""))
    return F.when(~clean.isin(NA_LITERALS), clean)


def is_usable(col: Column) -> Column:
    """Not null, not only whitespace and not the word ``nan`` in any case."""
    is_nan_word = (F.length(col) == 3) & (F.lower(col) == "nan")
    return col.isNotNull() & col.rlike(f"[^{WHITESPACE}]") & ~is_nan_word


def parse_day(col: Column) -> Column:
    """``yyyy-MM-dd`` to timestamp, null for everything else."""
    return F.try_to_timestamp(col, F.lit("yyyy-MM-dd"))


def char_count(col: Column) -> Column:
    return F.length(col).cast("long")


def word_count(col: Column) -> Column:
    return F.regexp_count(col, F.lit(f"[^{WHITESPACE}]+")).cast("long")


def shorten(col: Column, max_chars: int) -> Column:
    """Collapse whitespace runs, trim, cut beyond ``max_chars`` and mark the cut."""
    flat = F.trim(F.regexp_replace(col, f"[{WHITESPACE}]+", " "))
    return F.when(
        F.length(flat) > max_chars, F.concat(F.substring(flat, 1, max_chars), F.lit("..."))
    ).otherwise(flat)


def alnum_tokens(col: Column) -> Column:
    """Lower-case runs of ASCII letters and digits; repeats kept."""
    return F.regexp_extract_all(F.lower(col), F.lit("[a-z0-9]+"), F.lit(0))


def word_tokens(col: Column) -> Column:
    """Lower-case runs of two or more Unicode word characters; repeats kept."""
    return F.regexp_extract_all(F.lower(col), F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def ngrams(tokens: Column, ngram_range: tuple[int, int]) -> Column:
    """All n-grams of the range, words joined by one space."""
    low, high = ngram_range
    parts = []
    for n in range(low, high + 1):
        gram = tokens
        for shift in range(1, n):
            width = F.greatest(F.size(tokens) - shift, F.lit(0))
            gram = F.zip_with(
                F.slice(gram, 1, width),
                F.slice(tokens, shift + 1, width),
                lambda left, right: F.concat(left, F.lit(" "), right),
            )
        parts.append(gram)
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def month_of(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def fixed_decimals(col: Column, digits: int) -> Column:
    """A fixed number of decimals of the exact binary value; ties go to the even digit.

    For the handful of numbers in a report; JVM functions round the shortest decimal instead, which
    differs where that looks like a tie and the binary value is none.
    """

    @F.pandas_udf("string")
    def shown(numbers: pd.Series) -> pd.Series:
        return numbers.map(lambda x: None if pd.isna(x) else f"{x:.{digits}f}").astype(object)

    return shown(col.cast("double"))


def decimals_or_na(col: Column, digits: int) -> Column:
    """Fixed decimals as :func:`fixed_decimals` shows them; ``NA`` for null."""
    return F.coalesce(fixed_decimals(col, digits), F.lit("NA"))


def double_or_null(col: Column) -> Column:
    return col.try_cast("double")


def long_or_default(col: Column, default: int = 0) -> Column:
    """Whole part of a number given as text, ``default`` where it is none."""
    return F.coalesce(col.try_cast("double").cast("long"), F.lit(default).cast("long"))


def with_bag(rows: DataFrame, terms: Column, out: str = "bag") -> DataFrame:
    """Add ``array<struct<term, tf>>``: every distinct term with its count, without a shuffle.

    In the sorted array the places where a new term starts give the terms, and the distances
    between them the counts. Each step is a projection of its own, so it is evaluated once.
    """
    term_at = F.col("__terms")
    begin = F.col("__begin")
    ends = F.concat(
        F.slice(begin, 2, F.size(begin)), F.slice(F.array(F.size(term_at)), 1, F.size(begin))
    )
    return (
        rows.withColumn("__terms", F.sort_array(terms))
        .withColumn(
            "__begin",
            F.filter(
                F.transform(
                    term_at, lambda term, i: F.when(~F.get(term_at, i - 1).eqNullSafe(term), i)
                ),
                lambda i: i.isNotNull(),
            ),
        )
        .withColumn(
            out,
            F.zip_with(
                begin,
                ends,
                lambda start, end: F.struct(
                    F.get(term_at, start).alias("term"), (end - start).cast("long").alias("tf")
                ),
            ),
        )
        .drop("__terms", "__begin")
    )


def unnest_bag(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per distinct term of every bag.

    The outer form keeps the optimizer from copying the whole expression of the bag into a filter
    on its size, which would compute the bag once more per use.
    """
    return rows.select(*keep, F.inline_outer("bag")).where(F.col("term").isNotNull())
