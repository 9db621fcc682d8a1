"""Neighbour votes and the conservative override of a baseline prediction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casequarry.operators.metrics import split_metrics


def aggregate_evidence(evidence: DataFrame, top_k: int = 3) -> DataFrame:
    """Per query: label of the nearest hit, majority label, and whether the first k all agree.

    The majority counts all evidence rows; ties go to the label seen first. Fewer than ``top_k``
    hits never agree. Equal (query, rank, label) rows are counted before the windows, so the
    group of one query stays small.
    """
    counted = (
        evidence.where(F.col("query_id").isNotNull())
        .groupBy("query_id", "rank", F.col("hit_issue").cast("string").alias("hit_issue"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    by_query = Window.partitionBy("query_id")
    earlier = by_query.orderBy("rank", "hit_issue").rowsBetween(Window.unboundedPreceding, -1)
    by_label = Window.partitionBy("query_id", "hit_issue")
    marked = counted.withColumns(
        {
            "before": F.coalesce(F.sum("n").over(earlier), F.lit(0)),
            "votes": F.sum("n").over(by_label),
            "seen": F.min("rank").over(by_label),
        }
    )
    in_top = F.col("before") < top_k
    votes = F.struct("votes", -F.col("seen"))
    return marked.groupBy("query_id").agg(
        F.min_by("hit_issue", F.struct("rank", "hit_issue")).alias("retrieval_top1_issue"),
        F.max_by("hit_issue", votes).alias("retrieval_vote_issue"),
        (
            (F.sum("n") >= top_k)
            & (F.min(F.when(in_top, F.col("hit_issue"))) == F.max(F.when(in_top, F.col("hit_issue"))))
        ).alias("top3_all_agree"),
    ).withColumnRenamed("query_id", "case_id")


def override(preds: DataFrame, votes: DataFrame) -> DataFrame:
    """Predictions with the vote in their place wherever the neighbours agree."""
    agree = F.coalesce("top3_all_agree", F.lit(False))
    return preds.join(votes, "case_id", "left").withColumn(
        "hybrid_pred_issue",
        F.when(agree, F.col("retrieval_vote_issue")).otherwise(F.col("pred_issue").cast("string")),
    )


def override_rate(merged: DataFrame) -> DataFrame:
    """Share of rows per split whose neighbours agree, whether or not the label changes."""
    return (
        merged.where(F.col("split").isNotNull())
        .groupBy("split")
        .agg(
            F.avg(F.coalesce("top3_all_agree", F.lit(False)).cast("double")).alias(
                "retrieval_override_rate"
            )
        )
    )


def hybrid_metrics(merged: DataFrame) -> DataFrame:
    scores = split_metrics(merged, "issue", "hybrid_pred_issue")
    return (
        scores.join(override_rate(merged), "split")
        .select("split", "n", "retrieval_override_rate", "accuracy", "macro_f1", "weighted_f1")
        .orderBy("split")
    )
