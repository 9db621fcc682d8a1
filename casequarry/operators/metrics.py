"""Classification quality from counted (label, prediction) pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion_counts(
    preds: DataFrame, label_col: str = "issue", pred_col: str = "pred_issue", by: tuple[str, ...] = ("split",)
) -> DataFrame:
    """Number of rows per group, label and prediction; rows without a group key are left out."""
    rows = preds
    for key in by:
        rows = rows.where(F.col(key).isNotNull())
    return rows.groupBy(
        *by,
        F.col(label_col).cast("string").alias("label"),
        F.col(pred_col).cast("string").alias("pred"),
    ).agg(F.count(F.lit(1)).alias("n"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def class_scores(confusion: DataFrame, by: tuple[str, ...] = ("split",)) -> DataFrame:
    """Precision, recall, F1 and support of every label that is true or predicted somewhere.

    Each pair counts once for its label and once for its prediction. 0 where undefined.
    """
    roles = F.array(
        F.struct(F.col("label").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
    )
    right = F.when((F.col("label") == F.col("pred")), F.col("n")).otherwise(F.lit(0))
    counted = (
        confusion.select(*by, right.alias("right"), F.explode(roles).alias("role"))
        .select(*by, "right", "role.*")
        .groupBy(*by, "label")
        .agg(
            F.sum("support").alias("support"),
            F.sum("predicted").alias("predicted"),
            F.sum(F.when(F.col("support") > 0, F.col("right"))).alias("tp"),
        )
        .na.fill({"tp": 0})
    )
    precision = _ratio(F.col("tp"), F.col("predicted"))
    recall = _ratio(F.col("tp"), F.col("support"))
    # 2pr / (p + r) in counts.
    f1 = _ratio(2.0 * F.col("tp"), F.col("predicted") + F.col("support"))
    return counted.select(
        *by,
        "label",
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1_score"),
        "support",
        "tp",
    )


# Scores are added up as decimals of this type, so a sum does not depend on the order of the rows.
EXACT = "decimal(20,12)"


def _exact(score: Column) -> Column:
    return score.cast(EXACT)


def split_metrics(
    preds: DataFrame, label_col: str = "issue", pred_col: str = "pred_issue", by: tuple[str, ...] = ("split",)
) -> DataFrame:
    """``n, accuracy, macro_f1, weighted_f1`` per group."""
    scores = class_scores(confusion_counts(preds, label_col, pred_col, by), by)
    total = F.sum("support")
    return scores.groupBy(*by).agg(
        total.alias("n"),
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(_exact(F.col("f1_score"))).cast("double") / F.count(F.lit(1))).alias("macro_f1"),
        (F.sum(_exact(F.col("f1_score")) * F.col("support")).cast("double") / total).alias(
            "weighted_f1"
        ),
    )


def classification_report(
    preds: DataFrame, label_col: str = "issue", pred_col: str = "pred_issue"
) -> DataFrame:
    """One row per label, then accuracy, macro average and weighted average.

    The accuracy row repeats the accuracy in every column.
    """
    scores = class_scores(confusion_counts(preds, label_col, pred_col, ()), ())
    total = F.sum("support").cast("double")
    weighted = {
        name: (F.sum(F.col(name) * F.col("support")) / total)
        for name in ("precision", "recall", "f1_score")
    }
    accuracy = F.sum("tp") / total
    summary = scores.agg(
        F.array(
            F.struct(
                F.lit(1).alias("section"),
                F.lit("accuracy").alias("label"),
                *[accuracy.alias(name) for name in ("precision", "recall", "f1_score", "support")],
            ),
            F.struct(
                F.lit(2).alias("section"),
                F.lit("macro avg").alias("label"),
                *[F.avg(name).alias(name) for name in ("precision", "recall", "f1_score")],
                total.alias("support"),
            ),
            F.struct(
                F.lit(3).alias("section"),
                F.lit("weighted avg").alias("label"),
                *[col.alias(name) for name, col in weighted.items()],
                total.alias("support"),
            ),
        ).alias("rows")
    ).select(F.inline("rows"))
    classes = scores.select(
        F.lit(0).alias("section"),
        "label",
        "precision",
        "recall",
        "f1_score",
        F.col("support").cast("double").alias("support"),
    )
    return classes.unionByName(summary).orderBy("section", "label")


def train_label_count(rows: DataFrame, label_col: str = "issue") -> DataFrame:
    """Number of rows and distinct labels; labels are counted per value first."""
    per_label = rows.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    return per_label.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("train_rows"),
        F.count(label_col).alias("distinct_issues"),
    )
