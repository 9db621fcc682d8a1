"""One query per operator over its whole sample table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casequarry.llm import (
    centroids,
    decontaminate,
    jaccard,
    langid,
    lines,
    lsh_forest,
    mixing,
    ngram_lm,
    pii,
    quality,
    ranked_search,
    template,
    warc,
)
from casequarry.llm.frames import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op1_ngram_jaccard(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return jaccard.cluster(docs).select("doc_id", "n_shingles", "component_id")


@query
def op2_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    held_out = fold(F.col("doc_id"), 3) == 1
    known = labels.where(~held_out).select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(docs, known)
    return quality.score(docs, model, keep=["doc_id"]).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@query
def op3_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return mixing.mix(docs)


@query
def op4_lm_score(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return ngram_lm.score(docs, fold(F.col("doc_id"), 10) == 0)


@query
def op5_line_dedup(spark, sf_dir):
    """Documents without the lines that stand on too many pages of their source."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return lines.drop_boilerplate(docs).select("doc_id", "n_lines", "n_dropped", "text")


@query
def op6_nearest_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return lsh_forest.search(vectors, F.col("vec_id") % 50 == 0)


@query
def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = fold(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


@query
def op8_warc(spark, sf_dir):
    return warc.archive(table(spark, sf_dir, "pages", "page_id", "url", "html")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op9_pii(spark, sf_dir):
    return pii.annotate(table(spark, sf_dir, "documents", "doc_id", "text"))


@query
def op10_decontaminate(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    benchmark = table(spark, sf_dir, "benchmark", "item_id", "text")
    return decontaminate.mark(docs, benchmark, keep=["doc_id"]).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


@query
def op11_ranked_search(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    items = table(spark, sf_dir, "benchmark", "item_id", "text")
    return ranked_search.search(ranked_search.build(docs), items)


@query
def op12_centroid_clusters(spark, sf_dir):
    return centroids.cluster(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@query
def op13_html_extraction(spark, sf_dir):
    return template.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))
