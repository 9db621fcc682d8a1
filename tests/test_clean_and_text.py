from __future__ import annotations

import re

from pyspark.sql import functions as F

from casequarry.functions import text
from casequarry.functions.vectors import l2_normalize
from casequarry.operators.clean import usable_cases, with_string_id


def one(spark, value, build):
    return spark.createDataFrame([(value,)], "x string").select(build(F.col("x"))).first()[0]


def test_usable_rows(spark):
    rows = spark.createDataFrame(
        [
            ("valid complaint", "Fees"),
            (None, "Fees"),
            ("   ", "Fees"),
            ("nan", "Fees"),
            ("second valid complaint", None),
        ],
        "text string, issue string",
    )
    assert [tuple(r) for r in usable_cases(rows, "text", "issue").collect()] == [
        ("valid complaint", "Fees")
    ]
    assert usable_cases(rows).count() == 2
    assert usable_cases(rows.drop("issue"), "text", "issue").count() == 2


def test_every_unicode_whitespace_is_blank(spark):
    blanks = [chr(i) for i in range(0x110000) if chr(i).isspace()]
    others = ["​", "﻿", "\x00", "᠎", "a"]
    rows = spark.createDataFrame([(c,) for c in blanks + others], "text string")
    assert sorted(r[0] for r in usable_cases(rows).collect()) == sorted(others)


def test_nan_word_is_unusable_only_unstripped(spark):
    rows = spark.createDataFrame([(c,) for c in ["NaN", "nan", " nan ", "nana"]], "text string")
    assert sorted(r[0] for r in usable_cases(rows).collect()) == [" nan ", "nana"]


def test_missing_id_joins_as_text(spark):
    rows = spark.createDataFrame([(None,), (7,)], "case_id long")
    assert [r[0] for r in with_string_id(rows).collect()] == ["nan", "7"]


def test_shorten(spark):
    for n in (219, 220, 221):
        s = "x" * n
        assert one(spark, s, lambda c: text.shorten(c, 220)) == (s if n <= 220 else s[:220] + "...")
    messy = "  a \t　 b\n\x1cc  "
    assert one(spark, messy, lambda c: text.shorten(c, 220)) == "a b c"
    spaced = "ab " * 100
    flat = " ".join(spaced.split())
    assert one(spark, spaced, lambda c: text.shorten(c, 220)) == flat[:220] + "..."


def test_lengths_and_tokens_equal_python(spark):
    samples = ["Héllo, wörld! x2 a_b  don't", "é😀", "", " a\x85b\xa0c", "ÀB ß I1 _ __ 1 22"]
    for s in samples:
        assert one(spark, s, text.char_count) == len(s)
        assert one(spark, s, text.word_count) == len(s.split())
        cleaned = re.sub(r"[^a-z0-9\s]", " ", s.lower())
        assert one(spark, s, text.alnum_tokens) == cleaned.split()
        assert one(spark, s, text.word_tokens) == re.findall(r"(?u)\b\w\w+\b", s.lower())


def test_ngrams(spark):
    def grams(words, pair):
        rows = spark.createDataFrame([(words,)], "t array<string>")
        return rows.select(text.ngrams(F.col("t"), pair)).first()[0]

    assert grams(["a", "b", "c"], (1, 2)) == ["a", "b", "c", "a b", "b c"]
    assert grams(["a", "b", "c", "d"], (2, 3)) == ["a b", "b c", "c d", "a b c", "b c d"]
    assert grams(["a"], (1, 2)) == ["a"]
    assert grams([], (1, 2)) == []


def test_bag(spark):
    rows = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, ["z"])], "id int, t array<string>")
    bag = text.unnest_bag(text.with_bag(rows, F.col("t")), "id")
    assert sorted(map(tuple, bag.collect())) == [(1, "a", 1), (1, "b", 2), (3, "z", 1)]


def test_bag_is_computed_once_per_row(spark):
    """The optimizer must not copy the expression of the bag into a filter."""
    rows = spark.createDataFrame([("a b a",)], "x string")
    bag = text.unnest_bag(text.with_bag(rows, F.split("x", " ")))
    plan = bag._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("sort_array") == 1


def test_numbers_in_reports(spark):
    row = spark.createDataFrame([("2.25", "x", None)], "a string, b string, c string").select(
        text.decimals_or_na(text.double_or_null(F.col("a")), 1),
        text.decimals_or_na(text.double_or_null(F.col("b")), 1),
        text.long_or_default(F.col("a")),
        text.long_or_default(F.col("c"), 5),
    ).first()
    assert tuple(row) == ("2.2", "NA", 2, 5)


def test_vectors(spark):
    rows = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, z array<float>")
    row = rows.select(l2_normalize(F.col("a")), l2_normalize(F.col("z"))).first()
    assert row[0] == [0.6, 0.8] and row[1] == [0.0, 0.0]
