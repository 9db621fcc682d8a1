"""From documents to a training mix: five stages, each written as Parquet and read by the next.

language_id    documents without a learned language go
line_dedup     repeats of long lines and lines on too large a share of the pages of their source go
ngram_jaccard  one document of each group of near duplicates stays
decontaminate  documents with too much of a benchmark go
mix_sources    words are taken from each source up to its target

The stages that run Python bound the bytes of the session's Arrow batches, if nothing else does.
Every stage works on all rows its predecessor kept; all but the last return the columns of
``documents``, with other columns of the table as they are. The last adds ``size, source_size, target,
taken`` and leaves out documents of which nothing is taken. SQL cannot express the learned, random
and iterative stages, so tests compare each with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casequarry.llm import decontaminate, jaccard, langid, lines, mixing
from casequarry.llm.frames import bound_batches, fold
from casequarry.storage import materialize

ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns as the query of language identification does; a text of a learned language stays."""
    bound_batches(spark)
    return langid.keep_identified(docs, fold(F.col("doc_id"), 4) == 2)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of a page count once and are left to the next stage; an emptied page stays empty."""
    clean = lines.drop_passages(docs)
    clean = lines.drop_boilerplate(clean, ratio=lines.SHARED_RATIO, count=False, copies_once=True)
    if "n_chars" in clean.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return jaccard.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.keep_clean(docs, benchmark)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontaminate", decontaminated),
    ("mix_sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
