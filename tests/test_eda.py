from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pandas as pd

from casequarry.operators import eda


def frame(spark, n=300):
    rng = random.Random(3)
    rows = [
        (
            str(i),
            None if i % 50 == 0 else dt.datetime(2023, 1, 1) + dt.timedelta(days=rng.randrange(400)),
            rng.choice(["card", "loan", None]),
            f"issue {rng.randrange(14):02d}",
            " ".join("w" * rng.randrange(1, 9) for _ in range(rng.randrange(1, 40))),
        )
        for i in range(n)
    ]
    schema = "case_id string, received timestamp, product string, issue string, text string"
    return spark.createDataFrame(rows, schema), pd.DataFrame(
        rows, columns=["case_id", "received", "product", "issue", "text"]
    )


def test_summary_equals_pandas(spark):
    cases, pdf = frame(spark)
    row = eda.summary(eda.profile(cases)).first()
    chars, words = pdf["text"].str.len(), pdf["text"].str.split().str.len()
    assert row["rows_loaded_after_skip"] == len(pdf)
    assert row["date_min"] == str(pdf["received"].min())
    assert row["date_max"] == str(pdf["received"].max())
    for q in (10, 50, 90):
        assert np.isclose(row[f"text_chars_p{q}"], chars.quantile(q / 100))
        assert np.isclose(row[f"text_words_p{q}"], words.quantile(q / 100))
    assert (row["num_unique_products"], row["num_unique_issues"]) == (2, pdf["issue"].nunique())


def test_label_counts_with_null_and_ties(spark):
    cases = spark.createDataFrame(
        [(x,) for x in ["b", "a", None, None, "c", "b", "a"]], "product string"
    )
    assert [tuple(r) for r in eda.label_counts(cases, "product", 3).collect()] == [
        ("a", 2),
        ("b", 2),
        (None, 2),
    ]


def test_months_and_coverage(spark):
    cases, pdf = frame(spark)
    want = pdf["received"].dropna().dt.to_period("M").astype(str).value_counts().sort_index()
    assert {r["month"]: r["n"] for r in eda.months_of(eda.profile(cases)).collect()} == want.to_dict()
    assert [tuple(r) for r in eda.monthly_counts(cases).collect()] == list(want.items())
    coverage = {r["facet"]: r["coverage"] for r in eda.top_coverage(eda.profile(cases)).collect()}
    assert np.isclose(coverage["issue"], pdf["issue"].value_counts().head(10).sum() / len(pdf))
    assert coverage["product"] == 1.0


def test_histogram_equals_numpy(spark):
    cases, pdf = frame(spark)
    words = pdf["text"].str.split().str.len()
    counts, edges = np.histogram(words.clip(upper=words.quantile(0.99)), bins=50)
    rows = eda.length_histogram(cases).orderBy("bin").collect()
    assert [r["n"] for r in rows] == counts.tolist()
    assert np.allclose([r["bin_start"] for r in rows], edges[:-1])


def test_histogram_of_one_length(spark):
    cases = spark.createDataFrame([("a b",), ("c d",)], "text string")
    counts, _ = np.histogram([2, 2], bins=50)
    rows = eda.length_histogram(cases).orderBy("bin").collect()
    assert [r["n"] for r in rows] == counts.tolist()


def test_report_lines(spark):
    cases, pdf = frame(spark)
    lines = [r["value"] for r in eda.report(eda.profile(cases)).orderBy("ln").collect()]
    assert len(lines) == 7
    assert lines[0].endswith("N = 300")
    share = pdf["issue"].value_counts().head(10).sum() / len(pdf) * 100
    assert lines[5] == f"Top-10 Issue coverage: {share:.2f}% of narratives"


def test_report_without_rows(spark):
    cases, _ = frame(spark)
    lines = [r["value"] for r in eda.report(eda.profile(cases.limit(0))).orderBy("ln").collect()]
    assert lines[0].endswith("N = 0") and "P10=NA" in lines[2] and "0.00%" in lines[5]


def test_label_share(spark):
    from pyspark.sql import functions as F

    top = spark.createDataFrame([("a", 3), ("b", 1)], "label string, n long")
    assert [(r["label"], r["percent"]) for r in eda.label_share(top, F.lit(8)).collect()] == [
        ("b", 12.5),
        ("a", 37.5),
    ]
