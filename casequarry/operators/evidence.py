"""Evidence from similar train cases and the text augmented with it."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casequarry.functions.text import shorten
from casequarry.operators import ivf, svd, tfidf
from casequarry.operators.ivf import IvfConfig
from casequarry.operators.svd import SvdConfig
from casequarry.operators.tfidf import TfidfConfig
from casequarry.schema import EVIDENCE
from casequarry.storage import materialize


@dataclass(frozen=True)
class RetrieverConfig:
    tfidf: TfidfConfig = TfidfConfig(max_features=60_000)
    svd: SvdConfig = SvdConfig()
    ivf: IvfConfig = IvfConfig()
    snippet_chars: int = 350


@dataclass(frozen=True)
class Retriever:
    """Fitted on the train rows; ``vectors`` holds ``(pos, case_id, split, embedding)`` of all."""

    tfidf: tfidf.TfidfModel
    svd: svd.SvdModel
    index: ivf.IvfIndex
    vectors: DataFrame
    config: RetrieverConfig = field(default_factory=RetrieverConfig)


def fit_retriever(rows: DataFrame, config: RetrieverConfig = RetrieverConfig()) -> Retriever:
    """Text to sparse to dense vectors and their cells. ``rows`` need ``ingest_pos, case_id, split, text``."""
    texts = rows.select(F.col("ingest_pos").alias("pos"), "case_id", "split", "text")
    train = F.col("split") == "train"
    terms = tfidf.fit(texts.where(train), "text", config.tfidf)
    sparse = materialize(terms.transform(texts, "text"), "retriever-tfidf")
    reduced = svd.fit(sparse.where(train), terms.size, terms.n_docs, config.svd)
    vectors = materialize(svd.encode(sparse, reduced), "retriever-vectors")
    index = ivf.build_index(vectors.where(train), config.ivf)
    return Retriever(terms, reduced, index, vectors, config)


def collect_evidence(
    index: ivf.IvfIndex,
    vectors: DataFrame,
    rows: DataFrame,
    snippet_chars: int = 350,
    nprobe: int | None = None,
) -> DataFrame:
    """Evidence rows of every query against the train rows, with ``query_pos`` to join by.

    ``vectors`` are ``(pos, case_id, split, embedding)``, ``rows`` are
    ``(ingest_pos, case_id, split, issue, text)``. A train query never meets its own id. Snippets
    are cut before the join, so whole texts are not shuffled.
    """
    known = rows.where(F.col("split") == "train").select(
        F.col("ingest_pos").alias("pos"),
        "case_id",
        F.col("issue").alias("hit_issue"),
        shorten(F.col("text"), snippet_chars).alias("hit_snippet"),
    )
    asked = vectors.select(
        "pos",
        "embedding",
        F.when(F.col("split") == "train", F.col("case_id")).alias("own_id"),
        F.col("case_id").alias("query_id"),
        F.col("split").alias("query_split"),
    )
    hits = ivf.search(index, asked, known, nprobe)
    return hits.select("query_pos", *EVIDENCE.fieldNames())


def augment(rows: DataFrame, evidence: DataFrame) -> DataFrame:
    """Rows with ``augmented_text``: the text, a heading, and one line per hit in rank order.

    A row without hits keeps the heading. A query has at most ``topk`` evidence rows.
    """
    line = F.format_string(
        "Similar case %d. Issue: %s. Narrative: %s", "rank", "hit_issue", "hit_snippet"
    )
    lines = evidence.groupBy(F.col("query_pos").alias("ingest_pos")).agg(
        F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))).alias("hits")
    )
    return rows.join(lines, "ingest_pos", "left").select(
        *rows.columns,
        F.concat(
            F.lit("Query narrative: "),
            F.col("text"),
            F.lit("\n\nRetrieved evidence:\n"),
            F.coalesce(F.array_join("hits.line", "\n"), F.lit("")),
        ).alias("augmented_text"),
    )
