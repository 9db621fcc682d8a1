"""Site-relative line dedup: lines on too large a share of the pages of their host go.

A line is compared without the white space around it, as a 64-bit hash within its host. Its share is
the number of pages of the host that have it, divided by all pages of the host; it is boilerplate
if that exceeds ``RATIO`` and it stands on ``LEAST_PAGES`` pages at least. As a page has few lines,
a host has few such lines: at most the mean number of lines of its pages divided by ``RATIO``.

Defined results: rows without host are one host; a null text stays null and has no lines, but its
row is a page; blank lines stay; repeated rows are pages of their own; a line that a page repeats
counts once for the page and is dropped everywhere on it.

``RATIO`` and ``LEAST_PAGES`` are those of the SQL of ``op5_line_dedup``. The pipeline uses the smaller
``SHARED_RATIO`` and, before it, ``drop_passages``: a line of over ``PASSAGE_WORDS`` words that stands in
several texts of a host stays in one of them only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casequarry.storage import materialize

RATIO = 0.05
LEAST_PAGES = 5
SHARED_RATIO = 0.005
PASSAGE_WORDS = 50
_AROUND = " \t\r\x0b\x0c"


def _key(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(_AROUND)))


def _is_blank(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(_AROUND))) == 0


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _host_key(host: Column) -> Column:
    return F.coalesce(F.concat(F.lit("h"), host.cast("string")), F.lit(""))


def boilerplate(
    docs: DataFrame,
    host: str,
    text: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    copies_once: bool = False,
) -> DataFrame:
    """``(host_key, dropped)``: the hashes of the boilerplate lines of every host that has some.

    Pages are counted by host and by line of a host, both map-side first, so a host with a third of
    all pages is no larger than the others where it arrives. With ``copies_once`` equal texts of a
    host are one page.
    """
    pages = docs.select(_host_key(F.col(host)).alias("host_key"), F.col(text).alias("text"))
    filled = F.filter(_lines(F.col("text")), lambda line: ~_is_blank(line))
    distinct = F.array_distinct(F.transform(filled, _key))
    if copies_once:
        page = F.xxhash64("text").alias("page")
        lines = pages.select("host_key", page, F.explode(distinct).alias("line")).distinct()
        pages = pages.select("host_key", page).distinct()
    else:
        lines = pages.select("host_key", F.explode(distinct).alias("line"))
    totals = pages.groupBy("host_key").agg(F.count(F.lit(1)).alias("pages"))
    counted = (
        lines.groupBy("host_key", "line")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least_pages)
    )
    over = counted.join(totals, "host_key").where(F.col("n") > ratio * F.col("pages"))
    return over.groupBy("host_key").agg(F.sort_array(F.collect_list("line")).alias("dropped"))


def drop_passages(
    docs: DataFrame, host: str = "source", text: str = "text", words: int = PASSAGE_WORDS
) -> DataFrame:
    """``docs`` where a line of over ``words`` words stays in one of the texts of its host.

    That is the text with the smallest hash, so nothing is lost with the repeats, and equal texts
    keep the same lines. The lists are of single texts, which have few such lines.
    """
    is_long = lambda line: F.regexp_count(line, F.lit(r"\S+")) > words
    passages = F.transform(F.filter(_lines(F.col(text)), is_long), _key)
    page = F.xxhash64(F.col(text)).alias("page")
    parts = docs.select(
        _host_key(F.col(host)).alias("host_key"), page, F.explode(F.array_distinct(passages)).alias("line")
    )
    parts = materialize(parts.distinct(), "passages")
    repeated = (
        parts.groupBy("host_key", "line")
        .agg(F.min("page").alias("first"), F.max("page").alias("last"))
        .where(F.col("first") < F.col("last"))
    )
    gone = (
        parts.join(repeated, ["host_key", "line"])
        .where(F.col("page") != F.col("first"))
        .groupBy("host_key", "page")
        .agg(F.collect_list("line").alias("gone"))
    )
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), _host_key(F.col(host)).alias("host_key"), page
    ).join(materialize(gone, "repeated-passages"), ["host_key", "page"], "left")
    kept = F.filter(
        _lines(F.col("row")[text]), lambda line: ~F.array_contains(F.col("gone"), _key(line))
    )
    new = F.when(F.col("gone").isNull(), F.col("row")[text]).otherwise(F.array_join(kept, "\n"))
    return rows.select(*((new if c == text else F.col("row")[c]).alias(c) for c in docs.columns))


def drop_boilerplate(
    docs: DataFrame,
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    least_pages: int = LEAST_PAGES,
    spare_whole: bool = False,
    count: bool = True,
    copies_once: bool = False,
) -> DataFrame:
    """``docs`` with the lines gone from ``text``; with ``count`` also ``n_lines`` and ``n_dropped``.

    ``spare_whole`` leaves a page alone all of whose lines would go: that is no page around
    boilerplate but a copy of others, and near-duplicate removal decides on it.
    """
    over = boilerplate(docs, host, text, ratio, least_pages, copies_once)
    found = materialize(over, "boilerplate")
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        _host_key(F.col(host)).alias("host_key"),
        _lines(F.col(text)).alias("lines"),
    ).join(found, "host_key", "left")
    clean = F.filter(
        "lines",
        lambda line: _is_blank(line) | ~F.array_contains(F.col("dropped"), _key(line)),
    )
    kept = F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(clean)
    rows = rows.select("row", "lines", kept.alias("kept"))
    if spare_whole:
        left = F.exists("kept", lambda line: ~_is_blank(line))
        rows = rows.withColumn("kept", F.when(left, F.col("kept")).otherwise(F.col("lines")))
    new = F.when(F.size("lines") == F.size("kept"), F.col("row")[text]).otherwise(
        F.array_join("kept", "\n")
    )
    counted = ("n_lines", "n_dropped") if count else ()
    columns = [
        (new if c == text else F.col("row")[c]).alias(c) for c in docs.columns if c not in counted
    ]
    none = F.when(F.col("lines").isNull(), F.lit(0).cast("long"))
    numbers = {
        "n_lines": none.otherwise(F.size("lines").cast("long")),
        "n_dropped": none.otherwise((F.size("lines") - F.size("kept")).cast("long")),
    }
    return rows.select(*columns, *[numbers[name].alias(name) for name in counted])
