"""Comparison of the three classifiers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casequarry.functions.text import fixed_decimals

# Names of the models in the comparison, and how a report line calls them.
BASELINE, AUGMENTED, HYBRID = "TF-IDF + LogReg", "RAC: augmented text", "Hybrid retrieval"
LINE_NAMES = {
    BASELINE: "TF-IDF + Logistic Regression baseline",
    AUGMENTED: "Retrieval-augmented text classifier",
    HYBRID: "Conservative hybrid retrieval classifier",
}

# What the last line of a report says, by how the best retrieval model compares with the baseline.
CONCLUSIONS = {
    "above": "Conclusion: similar cases raise the weighted-F1 of the baseline on held-out cases.",
    "equal": "Conclusion: with similar cases the weighted-F1 on held-out cases is that of the baseline.",
    "below": "Conclusion: similar cases explain a prediction, but held-out weighted-F1 falls below the "
    "baseline.",
    "unknown": "Conclusion: baseline and retrieval were not both evaluated.",
}

COLUMNS = ("model", "split", "n", "accuracy", "macro_f1", "weighted_f1", "retrieval_override_rate")


def union_metrics(metrics: dict[str, DataFrame]) -> DataFrame:
    """Metrics of all models under a model name; the override rate is null where unknown."""
    frames = [df.withColumn("model", F.lit(name)) for name, df in metrics.items()]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return together.select(*[c for c in COLUMNS if c in together.columns])


def held_out_rows(comparison: DataFrame) -> DataFrame:
    return comparison.where(F.col("split") == "test")


def best_model(comparison: DataFrame) -> DataFrame:
    return held_out_rows(comparison).orderBy(F.desc("weighted_f1"), "model").limit(1)


def summary_lines(comparison: DataFrame) -> DataFrame:
    """Report as ``(ln, value)``: heading, one line per known model, best model, conclusion.

    The conclusion compares the best retrieval model with the baseline: above, equal or below.
    """
    tests = held_out_rows(comparison)
    place = F.array_position(F.array(*[F.lit(m) for m in LINE_NAMES]), F.col("model")).cast("int")
    names = F.create_map(*[F.lit(x) for pair in LINE_NAMES.items() for x in pair])

    def number(name: str):
        return fixed_decimals(F.col(name), 3)

    per_model = tests.where(F.col("model").isin(list(LINE_NAMES))).select(
        place.alias("ln"),
        F.format_string(
            "- %s: accuracy=%s, macro-F1=%s, weighted-F1=%s.",
            names[F.col("model")],
            number("accuracy"),
            number("macro_f1"),
            number("weighted_f1"),
        ).alias("value"),
    )
    everything = Window.partitionBy()
    plain = F.max(F.when(F.col("model") == BASELINE, F.col("weighted_f1"))).over(everything)
    helped = F.max(F.when(F.col("model") != BASELINE, F.col("weighted_f1"))).over(everything)
    # At most one row per model.
    scored = tests.select("model", "weighted_f1", plain.alias("plain"), helped.alias("helped"))
    lead = (
        F.when(F.col("helped") > F.col("plain"), CONCLUSIONS["above"])
        .when(F.col("helped") == F.col("plain"), CONCLUSIONS["equal"])
        .when(F.col("helped") < F.col("plain"), CONCLUSIONS["below"])
        .otherwise(CONCLUSIONS["unknown"])
    )
    around = scored.orderBy(F.desc("weighted_f1"), "model").limit(1).select(
        F.inline(
            F.array(
                F.struct(
                    F.lit(0).alias("ln"),
                    F.lit("Issue classification results on the held-out test split:").alias("value"),
                ),
                F.struct(
                    F.lit(len(LINE_NAMES) + 1).alias("ln"),
                    F.format_string(
                        "Best test weighted-F1 in the current run: %s (%s).",
                        "model",
                        number("weighted_f1"),
                    ).alias("value"),
                ),
                F.struct(F.lit(len(LINE_NAMES) + 2).alias("ln"), lead.alias("value")),
            )
        )
    )
    return per_model.unionByName(around).orderBy("ln")
