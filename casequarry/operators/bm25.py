"""BM25 retrieval of similar cases."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casequarry.functions.text import alnum_tokens, shorten, unnest_bag, with_bag
from casequarry.operators import postings
from casequarry.operators.splits import listed_texts
from casequarry.storage import materialize


# The constants of the ranking that the workflow states.
@dataclass(frozen=True)
class Bm25Config:
    k1: float = 1.5
    b: float = 0.75
    epsilon: float = 0.25
    topk: int = 5
    num_queries: int = 2
    snippet_chars: int = 220


@dataclass(frozen=True)
class Bm25Corpus:
    """Numbered documents ``(case_id, received, n, doc)``, their postings, and what was counted.

    ``n`` is how often a document is listed, ``doc`` its place in train order.
    """

    docs: DataFrame
    postings: DataFrame
    n_docs: int
    avg_length: float
    term_stats: DataFrame
    negative_idf: float
    config: Bm25Config

    def gain(self, tf: Column, length: Column) -> Column:
        return _gain(self.config, self.avg_length, tf, length)


def _gain(cfg: Bm25Config, avg_length: float, tf: Column, length: Column) -> Column:
    """What a term that stands ``tf`` times in a document adds, before its weight."""
    tf = tf.cast("double")
    length_norm = 1.0 - cfg.b + cfg.b * length / F.lit(avg_length)
    return tf * (cfg.k1 + 1.0) / (tf + cfg.k1 * length_norm)


def bags(texts: DataFrame) -> DataFrame:
    """Replace ``text`` by its token count and its bag; row-local."""
    tokenized = texts.withColumn("tokens", alnum_tokens(F.col("text"))).drop("text")
    counted = tokenized.withColumn("length", F.size("tokens").cast("long"))
    return with_bag(counted, F.col("tokens")).drop("tokens")


def term_statistics(index: DataFrame, n_docs: int) -> DataFrame:
    """``(term, df, raw_idf)`` over the vocabulary, from the blocks of the index."""
    df = F.col("df").cast("double")
    return (
        index.groupBy("term")
        .agg(F.sum("df").alias("df"))
        .select("term", "df", (F.log(F.lit(float(n_docs)) - df + 0.5) - F.log(df + 0.5)).alias("raw_idf"))
    )


def build_corpus(docs: DataFrame, config: Bm25Config = Bm25Config()) -> Bm25Corpus:
    """Number and index documents, and count lengths and terms.

    ``docs`` needs ``case_id, received, n, text``.
    """
    bagged = materialize(bags(docs), "bm25-docs")
    totals = bagged.agg(
        F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("length")).alias("length")
    ).first()
    n_docs = int(totals["docs"] or 0)
    if n_docs == 0:
        raise ValueError("no documents to index")
    avg_length = totals["length"] / n_docs
    placed = postings.numbered(bagged, "received", "case_id")
    index = postings.build(placed, lambda tf, length: _gain(config, avg_length or 1.0, tf, length))
    stats = materialize(term_statistics(index, n_docs), "bm25-terms")
    mean_idf = stats.agg(F.avg("raw_idf")).first()[0]
    return Bm25Corpus(
        docs=placed.select("case_id", "received", "n", "doc"),
        postings=index,
        n_docs=n_docs,
        avg_length=avg_length,
        term_stats=stats,
        negative_idf=config.epsilon * (mean_idf or 0.0),
        config=config,
    )


def idf_table(corpus: Bm25Corpus) -> DataFrame:
    """Terms with the idf in use; a negative idf is replaced by a share of the mean."""
    return corpus.term_stats.select(
        "term",
        "df",
        F.when(F.col("raw_idf") < 0, F.lit(corpus.negative_idf))
        .otherwise(F.col("raw_idf"))
        .alias("idf"),
    )


def query_terms(corpus: Bm25Corpus, queries: DataFrame) -> DataFrame:
    """``(query_id, term, weight)`` of the terms that the corpus has.

    Written, so that the planner knows their size: it broadcasts a small table and joins a large
    one by term.
    """
    terms = unnest_bag(bags(queries.select("query_id", "text")), "query_id")
    weighted = terms.join(idf_table(corpus), "term").select(
        "query_id", "term", (F.col("tf") * F.col("idf")).alias("weight")
    )
    return materialize(weighted, "bm25-query-terms")


def topk(corpus: Bm25Corpus, queries: DataFrame) -> DataFrame:
    """``(query_id, rank, hit_id, bm25_score)``: highest scores first, ties in train order.

    ``queries`` needs ``query_id, text``. A document listed several times fills several ranks. A query
    with fewer than ``topk`` positive scores is filled up with documents that score zero; these also
    stand before negative scores.
    """
    k = corpus.config.topk
    weights = query_terms(corpus, queries)
    best = materialize(postings.topk(corpus.postings, weights, corpus.gain, k), "bm25-best")
    listed = corpus.docs.join(best, "doc")
    positive = (
        listed.where(F.col("score") > 0).groupBy("query_id").agg(F.sum("n").alias("positive"))
    )
    short = materialize(
        queries.select("query_id")
        .join(positive, "query_id", "left")
        .where(F.coalesce("positive", F.lit(0)) < k)
        .drop("positive"),
        "bm25-short-queries",
    )
    if not short.isEmpty():
        free = materialize(
            postings.free_positions(corpus.postings, weights, short, k), "bm25-free-positions"
        )
        best = best.unionByName(free.withColumn("score", F.lit(0.0)))
        listed = corpus.docs.join(best, "doc")
    order = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "doc", "copy")
    copies = F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int")))
    return (
        listed.withColumn("copy", copies)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("case_id").alias("hit_id"), F.col("score").alias("bm25_score"))
    )


def first_queries(texts: DataFrame, num_queries: int) -> DataFrame:
    """The first test entries in chronological order; an id listed twice asks once."""
    return (
        texts.where(F.col("split") == "test")
        .orderBy("received", "case_id")
        .limit(num_queries)
        .select(F.col("case_id").alias("query_id"), "text")
        .dropDuplicates(["query_id"])
    )


def retrieve(cases: DataFrame, splits: DataFrame, config: Bm25Config = Bm25Config()) -> DataFrame:
    """Hits of the first test cases among the train cases, with snippets of both."""
    texts = listed_texts(cases, splits)
    train = texts.where(F.col("split") == "train")
    corpus = build_corpus(train.drop("split"), config)
    queries = materialize(first_queries(texts, config.num_queries), "bm25-queries")
    hits = materialize(topk(corpus, queries), "bm25-hits")
    snippets = (
        train.join(hits.select(F.col("hit_id").alias("case_id")).distinct(), "case_id", "left_semi")
        .select(
            F.col("case_id").alias("hit_id"),
            shorten(F.col("text"), config.snippet_chars).alias("hit_snippet"),
        )
        .distinct()
    )
    return (
        hits.join(snippets, "hit_id")
        .join(
            queries.select(
                "query_id", shorten(F.col("text"), config.snippet_chars).alias("query_snippet")
            ),
            "query_id",
        )
        .select("query_id", "query_snippet", "rank", "hit_id", "bm25_score", "hit_snippet")
    )


def nested_hits(hits: DataFrame) -> DataFrame:
    """One row per query with its ranked hits as an array; at most ``topk`` hits each."""
    return hits.groupBy("query_id", "query_snippet").agg(
        F.sort_array(
            F.collect_list(F.struct("rank", "hit_id", F.col("bm25_score").alias("score"), "hit_snippet"))
        ).alias("topk")
    )
