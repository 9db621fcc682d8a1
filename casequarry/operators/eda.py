"""Profile of the usable cases: label shares, text lengths, months, report lines.

All results come from one small table of counted values, so the texts are scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casequarry.functions.text import (
    char_count,
    decimals_or_na,
    double_or_null,
    long_or_default,
    month_of,
    word_count,
)

QUANTILES = (0.10, 0.50, 0.90)


def text_lengths(cases: DataFrame) -> DataFrame:
    return cases.withColumns(
        {
            "text_len_chars": char_count(F.col("text")),
            "text_len_words": word_count(F.col("text")),
        }
    )


def value_counts(rows: DataFrame, **facets: Column) -> DataFrame:
    """``(facet, value, n)``: how often each value of each facet occurs; null is a value too.

    Every row emits one pair per facet and the pairs are combined before the shuffle, so a value
    held by a third of all rows costs one record per task.
    """
    pairs = [
        F.struct(F.lit(name).alias("facet"), col.cast("string").alias("value"))
        for name, col in facets.items()
    ]
    return (
        rows.select(F.explode(F.array(*pairs)).alias("pair"))
        .select("pair.*")
        .groupBy("facet", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def profile(cases: DataFrame) -> DataFrame:
    """Counted values of everything that the profile reports."""
    return value_counts(
        cases,
        product=F.col("product"),
        issue=F.col("issue"),
        day=F.date_format("received", "yyyy-MM-dd HH:mm:ss"),
        chars=char_count(F.col("text")),
        words=word_count(F.col("text")),
    )


def label_counts(cases: DataFrame, column: str, top: int = 10) -> DataFrame:
    """Most frequent values of a label column; ties in label order, null last."""
    return top_labels(value_counts(cases, label=F.col(column)), "label", top)


def top_labels(counts: DataFrame, facet: str, top: int = 10) -> DataFrame:
    return (
        counts.where(F.col("facet") == facet)
        .select(F.col("value").alias("label"), "n")
        .orderBy(F.desc("n"), F.asc_nulls_last("label"))
        .limit(top)
    )


def label_share(top: DataFrame, total_rows: Column) -> DataFrame:
    """Percent of all rows per label, ascending."""
    share = F.col("n") / F.greatest(total_rows, F.lit(1)) * 100.0
    return top.withColumn("percent", share).orderBy("percent")


def _quantiles(counts: DataFrame, facet: str, quantiles: tuple[float, ...]) -> Column:
    value = F.when(F.col("facet") == facet, F.col("value").try_cast("long"))
    return F.percentile(value, list(quantiles), F.col("n"))


def summary(counts: DataFrame) -> DataFrame:
    """One row: number of cases, time span, length quantiles, number of labels."""

    def of(facet: str) -> Column:
        return (F.col("facet") == facet) & F.col("value").isNotNull()

    day = F.when(of("day"), F.col("value"))
    chars = _quantiles(counts, "chars", QUANTILES)
    words = _quantiles(counts, "words", QUANTILES)
    return counts.agg(
        F.coalesce(F.sum(F.when(F.col("facet") == "chars", F.col("n"))), F.lit(0))
        .cast("long")
        .alias("rows_loaded_after_skip"),
        F.min(day).alias("date_min"),
        F.max(day).alias("date_max"),
        chars.alias("chars"),
        words.alias("words"),
        F.count_if(of("product")).alias("num_unique_products"),
        F.count_if(of("issue")).alias("num_unique_issues"),
    ).select(
        "rows_loaded_after_skip",
        "date_min",
        "date_max",
        *[F.get("chars", F.lit(i)).alias(f"text_chars_p{q * 100:.0f}") for i, q in enumerate(QUANTILES)],
        *[F.get("words", F.lit(i)).alias(f"text_words_p{q * 100:.0f}") for i, q in enumerate(QUANTILES)],
        "num_unique_products",
        "num_unique_issues",
    )


def length_percentiles(cases: DataFrame) -> DataFrame:
    """Exact 10th, 50th and 90th percentile of both lengths, linearly interpolated.

    Lengths are counted first; the percentile then reads one row per distinct length.
    """
    counts = value_counts(
        cases, chars=char_count(F.col("text")), words=word_count(F.col("text"))
    )
    found = F.percentile(F.col("value").cast("long"), list(QUANTILES), F.col("n"))
    return (
        counts.groupBy("facet")
        .agg(found.alias("p"))
        .select("facet", *[F.get("p", F.lit(i)).alias(f"p{q * 100:.0f}") for i, q in enumerate(QUANTILES)])
    )


def monthly_counts(rows: DataFrame, date_col: str = "received") -> DataFrame:
    """Rows per ``YYYY-MM``, ascending, undated rows left out."""
    return (
        rows.where(F.col(date_col).isNotNull())
        .groupBy(month_of(F.col(date_col)).alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("month")
    )


def months_of(counts: DataFrame) -> DataFrame:
    """Rows per ``YYYY-MM`` from the counted days."""
    return (
        counts.where((F.col("facet") == "day") & F.col("value").isNotNull())
        .groupBy(F.substring("value", 1, 7).alias("month"))
        .agg(F.sum("n").alias("n"))
        .orderBy("month")
    )


def length_histogram(cases: DataFrame, bins: int = 50) -> DataFrame:
    """Word lengths clipped at the 99th percentile, in equal bins; the last bin is closed."""
    return histogram_of(value_counts(cases, words=word_count(F.col("text"))), bins)


def histogram_of(counts: DataFrame, bins: int = 50) -> DataFrame:
    """Histogram of the counted word lengths.

    The windows see one row per distinct length. Empty bins are listed with zero.
    """
    lengths = counts.where(F.col("facet") == "words").select(
        F.col("value").cast("long").alias("words"), "n"
    )
    whole = Window.partitionBy()
    clipped = lengths.withColumn("p99", F.percentile("words", 0.99, F.col("n")).over(whole)).select(
        F.least(F.col("words").cast("double"), F.col("p99")).alias("words"), "n"
    )
    ranged = clipped.withColumns(
        {"low": F.min("words").over(whole), "high": F.max("words").over(whole)}
    )
    # All lengths equal: one unit wide range around the value, as histogram functions do.
    flat = F.col("low") == F.col("high")
    low = F.when(flat, F.col("low") - 0.5).otherwise(F.col("low"))
    high = F.when(flat, F.col("high") + 0.5).otherwise(F.col("high"))
    width = (high - low) / F.lit(float(bins))
    bin_of = F.least(F.floor((F.col("words") - low) / width).cast("int"), F.lit(bins - 1))
    filled = ranged.select(bin_of.alias("bin"), low.alias("low"), width.alias("width"), "n")
    edges = filled.agg(F.first("low").alias("low"), F.first("width").alias("width")).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "low", "width"
    )
    counted = filled.groupBy("bin").agg(F.sum("n").alias("n"))
    return edges.join(counted, "bin", "left").select(
        "bin",
        (F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def top_coverage(counts: DataFrame, top: int = 10) -> DataFrame:
    """Share of all rows held by the most frequent issues and products, 0 without rows."""
    rank = F.row_number().over(
        Window.partitionBy("facet").orderBy(F.desc("n"), F.asc_nulls_last("value"))
    )
    held = F.sum(F.when(F.col("place") <= top, F.col("n")))
    return (
        counts.where(F.col("facet").isin("issue", "product"))
        .withColumn("place", rank)
        .groupBy("facet")
        .agg((held / F.sum("n")).alias("coverage"))
    )


def report(counts: DataFrame, top: int = 10) -> DataFrame:
    """The seven report lines as ``(ln, value)``, from the counted values."""
    shares = top_coverage(counts, top).agg(
        F.coalesce(F.max(F.when(F.col("facet") == "issue", F.col("coverage"))), F.lit(0.0)).alias("issues"),
        F.coalesce(F.max(F.when(F.col("facet") == "product", F.col("coverage"))), F.lit(0.0)).alias("products"),
    )
    # Two one-row tables side by side.
    both = summary(counts).unionByName(shares, allowMissingColumns=True)
    return render(both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns]))


def render(facts: DataFrame) -> DataFrame:
    """Report lines of a one-row table; its values may be numbers or text."""

    def spread(name: str) -> list[Column]:
        cols = [double_or_null(F.col(f"text_{name}_p{q}").cast("string")) for q in (10, 50, 90)]
        return [decimals_or_na(c, 1) for c in cols]

    def number(name: str) -> Column:
        return long_or_default(F.col(name).cast("string"))

    def percent(name: str) -> Column:
        return decimals_or_na(F.col(name) * 100, 2)

    def date(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("NA"))

    # The wording of the report.
    lines = [
        F.format_string("Usable narratives (after robust parsing + filtering): N = %d", number("rows_loaded_after_skip")),
        F.format_string("Time coverage: %s to %s", date("date_min"), date("date_max")),
        F.format_string("Narrative length (words): P10=%s, P50=%s, P90=%s", *spread("words")),
        F.format_string("Narrative length (chars): P10=%s, P50=%s, P90=%s", *spread("chars")),
        F.format_string(
            "Label space size: #Products=%d, #Issues=%d",
            number("num_unique_products"),
            number("num_unique_issues"),
        ),
        F.format_string("Top-10 Issue coverage: %s%% of narratives", percent("issues")),
        F.format_string("Top-10 Product coverage: %s%% of narratives", percent("products")),
    ]
    return facts.select(F.posexplode(F.array(*lines)).alias("ln", "value"))
