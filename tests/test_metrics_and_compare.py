from __future__ import annotations

import pytest

from casequarry.operators import compare, metrics


def preds(spark, rows):
    return spark.createDataFrame(rows, "split string, issue string, pred_issue string")


def test_union_of_true_and_predicted_labels(spark):
    rows = [("test", "a", "a"), ("test", "a", "a"), ("test", "b", "c"), ("val", "a", "b")]
    got = {r["split"]: r for r in metrics.split_metrics(preds(spark, rows)).collect()}
    test = got["test"]
    assert (test["n"], test["accuracy"]) == (3, pytest.approx(2 / 3))
    assert test["macro_f1"] == pytest.approx(1 / 3)
    assert test["weighted_f1"] == pytest.approx(2 / 3)
    assert (got["val"]["accuracy"], got["val"]["macro_f1"], got["val"]["weighted_f1"]) == (0, 0, 0)


def test_rows_without_split_form_no_group(spark):
    rows = [("test", "a", "a"), (None, "a", "b")]
    assert [r["split"] for r in metrics.split_metrics(preds(spark, rows)).collect()] == ["test"]


def test_report(spark):
    rows = [("test", "a", "a"), ("test", "a", "b"), ("test", "b", "b"), ("test", "c", "b")]
    got = {r["label"]: r for r in metrics.classification_report(preds(spark, rows)).collect()}
    assert list(got) == ["a", "b", "c", "accuracy", "macro avg", "weighted avg"]
    assert (got["a"]["precision"], got["a"]["recall"]) == (1.0, 0.5)
    assert got["b"]["f1_score"] == pytest.approx(0.5)
    assert got["c"]["f1_score"] == 0.0
    assert {got["accuracy"][c] for c in ("precision", "recall", "f1_score", "support")} == {0.5}
    assert got["macro avg"]["recall"] == pytest.approx((0.5 + 1 + 0) / 3)
    assert got["weighted avg"]["precision"] == pytest.approx((2 * 1 + 1 / 3 + 0) / 4)
    assert got["macro avg"]["support"] == 4


def test_train_label_count(spark):
    rows = preds(spark, [("train", "a", ""), ("train", "b", ""), ("train", "a", "")])
    assert tuple(metrics.train_label_count(rows).first()) == (3, 2)


def test_comparison(spark):
    def table(split_scores, rate=None):
        cols = "split string, n long, accuracy double, macro_f1 double, weighted_f1 double"
        rows = [(s, 10, f, f, f) for s, f in split_scores]
        if rate is not None:
            cols, rows = cols + ", retrieval_override_rate double", [(*r, rate) for r in rows]
        return spark.createDataFrame(rows, cols)

    both = compare.union_metrics(
        {
            compare.BASELINE: table([("val", 0.9), ("test", 0.5)]),
            compare.AUGMENTED: table([("test", 0.4)]),
            compare.HYBRID: table([("test", 0.6125)], 0.25),
        }
    )
    assert both.columns == list(compare.COLUMNS)
    rates = {r["model"]: r["retrieval_override_rate"] for r in both.collect()}
    assert rates == {compare.BASELINE: None, compare.AUGMENTED: None, compare.HYBRID: 0.25}
    assert compare.best_model(both).first()["model"] == compare.HYBRID
    lines = [r["value"] for r in compare.summary_lines(both).collect()]
    assert len(lines) == 6
    assert lines[1].startswith("- TF-IDF + Logistic Regression baseline: accuracy=0.500, macro-F1=0.500")
    assert lines[4] == "Best test weighted-F1 in the current run: Hybrid retrieval (0.613)."
    assert lines[5] == compare.CONCLUSIONS["above"]
    for score, word in ((0.5, "equal"), (0.4, "below")):
        tied = compare.union_metrics(
            {
                compare.BASELINE: table([("test", 0.5)]),
                compare.AUGMENTED: table([("test", 0.3)]),
                compare.HYBRID: table([("test", score)], 0.0),
            }
        )
        last = [r["value"] for r in compare.summary_lines(tied).collect()][-1]
        assert last == compare.CONCLUSIONS[word]


def test_fixed_decimals_follow_the_binary_value(spark):
    from casequarry.functions.text import fixed_decimals

    rows = spark.createDataFrame([(x,) for x in (0.1125, 0.0005, 0.5015, 0.5, None)], "x double")
    shown = [r[0] for r in rows.select(fixed_decimals(rows["x"], 3)).collect()]
    assert shown == ["0.113", "0.001", "0.501", "0.500", None]
