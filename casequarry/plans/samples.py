"""The case table derived from the sample ``documents`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casequarry.storage import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as cases: language as issue, source as product, a date from the id."""
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("doc_id") % 730).cast("int"))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("case_id"),
        day.cast("timestamp").alias("received"),
        F.col("source").alias("product"),
        F.col("lang").alias("issue"),
        "text",
        F.col("doc_id").alias("ingest_pos"),
    )
