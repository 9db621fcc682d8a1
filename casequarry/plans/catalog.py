"""Queries over the sample tables, one per operator or small group of operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casequarry.functions.text import shorten
from casequarry.functions.vectors import l2_normalize
from casequarry.operators import (
    bm25,
    clean,
    compare,
    eda,
    evidence,
    hybrid,
    ivf,
    metrics,
    ovr,
    splits,
    svd,
    tfidf,
)
from casequarry.plans import classify, samples
from casequarry.schema import SOURCE_COLUMNS
from casequarry.sources import cases, tables
from casequarry.storage import materialize, shared_root

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_STAGE_TABLES: dict[tuple[str, str, str], DataFrame] = {}

METRIC_COLUMNS = ("accuracy", "macro_f1", "weighted_f1")


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def _stage_table(
    spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """A table that several queries read, written once per session as a stage would."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STAGE_TABLES:
        _STAGE_TABLES[key] = materialize(build(), name)
    return _STAGE_TABLES[key]


def forget() -> None:
    """Let the next query build the tables it shares with others anew."""
    _STAGE_TABLES.clear()


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


def _usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.usable_cases(samples.cases(spark, sf_dir), "text", "issue")


def _splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage_table(
        spark, sf_dir, "splits", lambda: splits.split_cases(samples.cases(spark, sf_dir))
    )


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stage_table(
        spark,
        sf_dir,
        "rows",
        lambda: splits.attach_split(_usable(spark, sf_dir), _splits(spark, sf_dir)),
    )


def _train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.select_split(_rows(spark, sf_dir), "train")


def _day(number: Column) -> Column:
    return F.date_add(F.lit("2020-01-01").cast("date"), (number % 730).cast("int")).cast("timestamp")


# Profile


@query
def usable_cases(spark, sf_dir):
    return eda.text_lengths(_usable(spark, sf_dir)).select(
        "case_id", "text_len_chars", "text_len_words"
    )


def _top(spark, sf_dir, column):
    usable = _usable(spark, sf_dir)
    counts = materialize(eda.value_counts(usable, label=F.col(column)), "label-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return _rounded(eda.label_share(eda.top_labels(counts, "label"), F.lit(total)), "percent")


@query
def top_issues(spark, sf_dir):
    return _top(spark, sf_dir, "issue")


@query
def top_products(spark, sf_dir):
    return _top(spark, sf_dir, "product")


@query
def length_percentiles(spark, sf_dir):
    return _rounded(eda.length_percentiles(_usable(spark, sf_dir)), "p10", "p50", "p90")


@query
def eda_summary(spark, sf_dir):
    return eda.summary(eda.profile(_usable(spark, sf_dir)))


@query
def monthly_counts(spark, sf_dir):
    return eda.monthly_counts(samples.table(spark, sf_dir, "orders"), "o_orderdate")


@query
def monthly_case_counts(spark, sf_dir):
    return eda.months_of(eda.profile(_usable(spark, sf_dir)))


@query
def length_histogram(spark, sf_dir):
    return _rounded(eda.length_histogram(_usable(spark, sf_dir)), "bin_start")


@query
def top_coverage(spark, sf_dir):
    usable = _usable(spark, sf_dir)
    counts = eda.value_counts(usable, issue=F.col("issue"), product=F.col("product"))
    return _rounded(eda.top_coverage(counts), "coverage")


@query
def eda_report(spark, sf_dir):
    counts = _stage_table(spark, sf_dir, "profile", lambda: eda.profile(_usable(spark, sf_dir)))
    return eda.report(counts)


@query
def capped_cases(spark, sf_dir):
    """The row cap of a run, taken before any filter."""
    capped = clean.cap_rows(samples.cases(spark, sf_dir), 200)
    return clean.usable_cases(capped).select("case_id", "issue", "ingest_pos")


@query
def snippets(spark, sf_dir):
    return samples.cases(spark, sf_dir).select(
        "case_id",
        shorten(F.col("text"), 220).alias("snippet_220"),
        shorten(F.col("text"), 350).alias("snippet_350"),
    )


# Sources and sinks

_SOURCE_NAMES = {new: old for old, new in SOURCE_COLUMNS.items()}


def _complaints(spark, sf_dir):
    """Cases under the names of the source, dates as text, some of them or of the ids missing."""
    number = F.col("ingest_pos")
    day = F.date_format("received", "yyyy-MM-dd")
    return samples.cases(spark, sf_dir).select(
        F.when(number % 11 != 0, F.col("case_id")).alias("case_id"),
        F.when(number % 7 != 0, day).otherwise("not a day").alias("received"),
        F.when(number % 13 != 0, F.col("product")).otherwise("N/A").alias("product"),
        "issue",
        F.when(number % 17 == 0, "nan").when(number % 19 == 0, " \t ").otherwise(F.col("text")).alias("text"),
        number.alias("number"),
    )


def _ingested(spark, sf_dir):
    """Several CSV files with their columns in two orders, some with a column more, read as one source."""

    def build():
        folder = f"{shared_root(spark)}/casequarry/complaints-{uuid.uuid4().hex}"
        rows = _complaints(spark, sf_dir).withColumnsRenamed(_SOURCE_NAMES)
        names = list(_SOURCE_NAMES.values())
        orders = (names, [*reversed(names), "number"])
        for part, order in enumerate(orders):
            chosen = rows.where(F.col("number") % 2 == part).select(*order)
            writer = chosen.write.option("header", True).option("escape", '"')
            writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(
                f"{folder}/{part}"
            )
        return cases.ingest(spark, f"{folder}/*/*.csv")

    return _stage_table(spark, sf_dir, "ingested", build)


@query
def csv_ingest(spark, sf_dir):
    found = _ingested(spark, sf_dir)
    return found.select(
        "case_id", F.date_format("received", "yyyy-MM-dd").alias("received"), "product", "issue", "text"
    )


@query
def csv_usable(spark, sf_dir):
    """Usable rows of the source: blank texts, the word nan and missing literals are not."""
    rows = clean.with_string_id(clean.usable_cases(_ingested(spark, sf_dir), "text", "issue"))
    return rows.groupBy("case_id").agg(F.count(F.lit(1)).alias("n"), F.count("received").alias("dated"))


@query
def source_columns(spark, sf_dir):
    """The header of the documents, written as CSV."""
    folder = f"{shared_root(spark)}/casequarry/header-{uuid.uuid4().hex}"
    samples.table(spark, sf_dir, "documents").drop("text").write.option("header", True).csv(folder)
    return cases.source_columns(spark, f"{folder}/*.csv")


@query
def dev_subset(spark, sf_dir):
    """The first rows of the source as a table of their own."""
    folder = f"{shared_root(spark)}/casequarry/subset-{uuid.uuid4().hex}"
    cases.dev_subset(samples.cases(spark, sf_dir), folder, 100)
    return spark.read.parquet(folder).select("case_id", "product", "text")


@query
def splits_round_trip(spark, sf_dir):
    folder = f"{shared_root(spark)}/casequarry/splits-{uuid.uuid4().hex}"
    tables.write_splits(_splits(spark, sf_dir), folder)
    return tables.read_splits(spark, folder).select("case_id", "split", "pos", "n")


@query
def predictions_round_trip(spark, sf_dir):
    """Predictions with texts of any kind through CSV and back."""
    folder = f"{shared_root(spark)}/casequarry/predictions-{uuid.uuid4().hex}"
    rows = samples.cases(spark, sf_dir).select(
        "case_id", F.lit("val").alias("split"), "issue", F.col("product").alias("pred_issue"), "text"
    )
    tables.write_table(rows, folder, "csv")
    return tables.read_predictions(spark, folder, "csv")


def _scratch(spark, name):
    return f"{shared_root(spark)}/casequarry/{name}-{uuid.uuid4().hex}"


@query
def hits_json_round_trip(spark, sf_dir):
    """Ranked hits as one JSON object per query, read again."""
    folder = _scratch(spark, "hits-json")
    tables.write_hits_json(_bm25_hits(spark, sf_dir), folder)
    schema = "query_id string, query_snippet string, topk array<struct<rank int, hit_id string>>"
    ranked = F.transform(F.array_sort("topk"), lambda hit: hit["hit_id"])
    return spark.read.schema(schema).json(folder).select(
        "query_id", "query_snippet", F.array_join(ranked, ",").alias("hit_ids")
    )


@query
def report_round_trip(spark, sf_dir):
    """The lines of the report from its text file."""
    folder = _scratch(spark, "report")
    tables.write_report_text(eda_report(spark, sf_dir), folder)
    return spark.read.text(folder)


@query
def augmented_checkpoint(spark, sf_dir):
    """Augmented texts built once; the second run reads what the first has written."""
    folder = _scratch(spark, "augmented")

    def again(written):
        raise AssertionError("a complete table was built again")

    tables.load_or_build(spark, folder, {"augmented": lambda written: augmented_text(spark, sf_dir)}, sf_dir)
    return tables.load_or_build(spark, folder, {"augmented": again}, sf_dir)["augmented"]


# Splits


@query
def chronological_split(spark, sf_dir):
    return splits.split_cases(samples.cases(spark, sf_dir)).select("case_id", "split", "pos", "n")


def _as_days(stats: DataFrame) -> DataFrame:
    return stats.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("date_min", "date_max")}
    )


@query
def split_stats(spark, sf_dir):
    return _as_days(splits.split_stats(_splits(spark, sf_dir)))


@query
def order_split_stats(spark, sf_dir):
    orders = samples.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("case_id"), F.col("o_orderdate").alias("received")
    )
    return _as_days(splits.split_stats(splits.build_splits(orders)))


@query
def attach_split(spark, sf_dir):
    found = splits.attach_split(_usable(spark, sf_dir), _splits(spark, sf_dir))
    return found.select("case_id", "issue", "split")


@query
def attach_split_unlisted(spark, sf_dir):
    """Lists from two thirds of the cases; rows of all, some of them under another date."""
    cases = samples.cases(spark, sf_dir)
    listed = splits.split_cases(cases.where(F.col("ingest_pos") % 3 != 0))
    later = F.expr("received + INTERVAL 40 DAYS")
    moved = F.when(F.col("ingest_pos") % 5 == 0, later).otherwise(F.col("received"))
    rows = clean.usable_cases(cases).withColumn("received", moved)
    attached = splits.attach_split(rows, materialize(listed, "unlisted-splits"))
    return attached.select("case_id", "split")


@query
def listed_texts_unlisted(spark, sf_dir):
    """The texts of lists that were built from other rows: some ids absent, some under other dates."""
    cases = samples.cases(spark, sf_dir)
    listed = materialize(splits.split_cases(cases), "all-splits")
    later = F.expr("received + INTERVAL 40 DAYS")
    moved = F.when(F.col("ingest_pos") % 5 == 0, later).otherwise(F.col("received"))
    rows = cases.where(F.col("ingest_pos") % 3 != 0).withColumn("received", moved)
    return splits.listed_texts(rows, listed).select("case_id", "split", "n", "text")


@query
def attach_split_by_id(spark, sf_dir):
    labels = samples.table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "case_id")
    return splits.attach_split_by_id(labels, _splits(spark, sf_dir))


def _conversations(spark, sf_dir):
    """Turns as rows that repeat the id of their conversation."""
    return samples.table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("case_id"),
        _day(F.col("conv_id")).alias("received"),
        "text",
        (F.col("conv_id") * 1_000_000 + F.col("turn")).alias("ingest_pos"),
    )


def _conversation_splits(spark, sf_dir):
    return _stage_table(
        spark,
        sf_dir,
        "conversation-splits",
        lambda: splits.split_cases(_conversations(spark, sf_dir)),
    )


@query
def repeated_id_split(spark, sf_dir):
    return splits.split_cases(_conversations(spark, sf_dir)).select("case_id", "split", "pos", "n")


@query
def repeated_id_attach(spark, sf_dir):
    turns = clean.usable_cases(_conversations(spark, sf_dir))
    found = splits.attach_split(turns, _conversation_splits(spark, sf_dir))
    return found.select("case_id", "ingest_pos", "split")


@query
def latest_text_per_id(spark, sf_dir):
    listed = splits.listed_texts(
        _conversations(spark, sf_dir), _conversation_splits(spark, sf_dir)
    )
    return listed.select("case_id", "split", "n", "text")


# BM25


def _bm25_corpus(spark, sf_dir):
    texts = splits.listed_texts(samples.cases(spark, sf_dir), _splits(spark, sf_dir))
    return bm25.build_corpus(clean.select_split(texts, "train").drop("split"))


@query
def bm25_corpus_stats(spark, sf_dir):
    return _rounded(bm25.idf_table(_bm25_corpus(spark, sf_dir)), "idf")


@query
def bm25_topk(spark, sf_dir):
    hits = bm25.retrieve(samples.cases(spark, sf_dir), _splits(spark, sf_dir))
    return _rounded(hits, "bm25_score")


@query
def bm25_questions(spark, sf_dir):
    """Many questions at once against the stored postings."""
    config = bm25.Bm25Config(num_queries=200)
    hits = bm25.retrieve(samples.cases(spark, sf_dir), _splits(spark, sf_dir), config)
    return _rounded(hits.drop("query_snippet", "hit_snippet"), "bm25_score")


def _bm25_hits(spark, sf_dir):
    return _stage_table(
        spark,
        sf_dir,
        "bm25-hits",
        lambda: bm25.retrieve(samples.cases(spark, sf_dir), _splits(spark, sf_dir)),
    )


@query
def bm25_nested_hits(spark, sf_dir):
    return bm25.nested_hits(_bm25_hits(spark, sf_dir)).select(
        "query_id", "query_snippet", F.array_join("topk.hit_id", ",").alias("hit_ids")
    )


# TF-IDF, SVD


def _tfidf_model(spark, sf_dir, config=tfidf.TfidfConfig()):
    return tfidf.fit(_train(spark, sf_dir), "text", config)


@query
def tfidf_vocabulary(spark, sf_dir):
    train = _train(spark, sf_dir)
    return _rounded(tfidf.vocabulary(train, "text", tfidf.TfidfConfig(), train.count()), "idf")


@query
def tfidf_vocabulary_cut(spark, sf_dir):
    """A vocabulary that its limit cuts among terms of equal frequency."""
    train = _train(spark, sf_dir)
    config = tfidf.TfidfConfig(max_features=1000)
    return _rounded(tfidf.vocabulary(train, "text", config, train.count()), "idf")


@query
def tfidf_weights(spark, sf_dir):
    model = _tfidf_model(spark, sf_dir)
    rows = model.transform(_rows(spark, sf_dir).select("case_id", "text"), "text")
    long = tfidf.weights(rows)
    return _rounded(
        long.join(model.table(spark).select("term_id", "term"), "term_id").drop("term_id"), "weight"
    )


@query
def matrix_stats(spark, sf_dir):
    model = _tfidf_model(spark, sf_dir)
    rows = model.transform(_train(spark, sf_dir).select("case_id", "text"), "text")
    return tfidf.matrix_stats(rows, model)


@query
def train_label_count(spark, sf_dir):
    return metrics.train_label_count(_train(spark, sf_dir))


def _svd_input(spark, sf_dir):
    config = evidence.RetrieverConfig().tfidf
    model = _tfidf_model(spark, sf_dir, config)
    rows = _rows(spark, sf_dir).select("case_id", "split", "text")
    return model, materialize(model.transform(rows, "text"), "svd-input")


@query
def svd_encode(spark, sf_dir):
    """Unit vectors for every case, from the retriever's TF-IDF."""
    model, matrix = _svd_input(spark, sf_dir)
    train = clean.select_split(matrix, "train")
    reduced = svd.fit(train, model.size, model.n_docs)
    return svd.encode(matrix, reduced)


@query
def svd_invariants(spark, sf_dir):
    """Orthonormal components that carry what their singular values say."""
    model, matrix = _svd_input(spark, sf_dir)
    train = clean.select_split(matrix, "train")
    found = svd.invariants(train, svd.fit(train, model.size, model.n_docs))
    return found.select("i", "j", F.abs(F.round("value", 5)).alias("value"))


@query
def explained_variance(spark, sf_dir):
    """Share of the variance of the train matrix that the retriever's components carry."""
    model, matrix = _svd_input(spark, sf_dir)
    train = clean.select_split(matrix, "train")
    reduced = svd.fit(train, model.size, model.n_docs)
    share = svd.explained_variance_sum(train, reduced)
    return spark.createDataFrame([(reduced.dim, round(share, 4))], "components int, explained double")


# Neighbours over the given vectors


def _vectors(spark, sf_dir):
    """Vectors as cases with a date from the id, so that they get splits like any other case."""
    return samples.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("pos"),
        F.col("vec_id").cast("string").alias("case_id"),
        _day(F.col("vec_id")).alias("received"),
        F.col("label").cast("string").alias("issue"),
        l2_normalize(F.col("embedding")).alias("embedding"),
    )


def _split_vectors(spark, sf_dir):
    def build():
        vectors = _vectors(spark, sf_dir)
        return splits.attach_split(vectors, materialize(splits.build_splits(vectors), "vector-splits"))

    return _stage_table(spark, sf_dir, "split-vectors", build)


def _vector_rows(spark, sf_dir):
    """The vectors' cases with the text of the document of the same number, if there is one."""
    texts = samples.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("ingest_pos"), "text"
    )
    cases = _split_vectors(spark, sf_dir).select(
        F.col("pos").alias("ingest_pos"), "case_id", "split", "issue"
    )
    return cases.join(texts, "ingest_pos", "left").na.fill({"text": ""})


def _evidence(spark, sf_dir, nprobe=None):
    vectors = _split_vectors(spark, sf_dir)
    index = ivf.build_index(clean.select_split(vectors, "train"))
    probes = index.n_cells if nprobe is None else nprobe
    rows = _vector_rows(spark, sf_dir)
    return evidence.collect_evidence(index, vectors, rows, nprobe=probes)


def _exact_evidence(spark, sf_dir):
    return _stage_table(spark, sf_dir, "evidence", lambda: _evidence(spark, sf_dir))


@query
def ivf_full_probe(spark, sf_dir):
    """All cells probed: the search is exact."""
    found = _evidence(spark, sf_dir).drop("query_pos")
    return _rounded(found, "cosine_similarity")


GIVEN_CELLS = 40


@query
def ivf_given_cells(spark, sf_dir):
    """The first vectors as cells, and the 16 nearest cells of each query probed."""
    vectors = _split_vectors(spark, sf_dir)
    first = vectors.where(F.col("pos") < GIVEN_CELLS).orderBy("pos").select("embedding").collect()
    centroids = np.array([row["embedding"] for row in first])
    index = ivf.build_index(clean.select_split(vectors, "train"), centroids=centroids)
    rows = _vector_rows(spark, sf_dir)
    found = evidence.collect_evidence(index, vectors, rows, nprobe=ivf.IvfConfig().nprobe)
    return _rounded(found.drop("query_pos"), "cosine_similarity")


@query
def ivf_search(spark, sf_dir):
    """The 16 nearest cells probed."""
    found = _evidence(spark, sf_dir, ivf.IvfConfig().nprobe).drop("query_pos")
    return _rounded(found, "cosine_similarity")


def _split_index(spark, sf_dir):
    """Coarse cells that are split into small ones, however few the vectors."""
    train = clean.select_split(_split_vectors(spark, sf_dir), "train")
    return ivf.build_index(train, ivf.IvfConfig(nlist=16, cell_rows=64))


@query
def ivf_split_cells(spark, sf_dir):
    """All cells of both levels probed: the search is exact."""
    index, rows = _split_index(spark, sf_dir), _vector_rows(spark, sf_dir)
    found = evidence.collect_evidence(index, _split_vectors(spark, sf_dir), rows, nprobe=index.n_cells)
    return _rounded(found.drop("query_pos"), "cosine_similarity")


@query
def ivf_recall(spark, sf_dir):
    """Exact neighbours of each split, and whether the probes chosen on a sample meet nine tenths of them."""
    index, vectors = _split_index(spark, sf_dir), _split_vectors(spark, sf_dir)
    own = F.when(F.col("split") == "train", F.col("case_id"))
    train = clean.select_split(vectors, "train").select("pos", "case_id")
    asked = vectors.select("pos", "embedding", own.alias("own_id"))
    found = ivf.search(index, asked, train, ivf.probes_for(index, asked, train)).select(
        F.col("query_pos").cast("string").alias("query_id"), "hit_id", F.lit(True).alias("met")
    )
    exact = _exact_evidence(spark, sf_dir).select("query_split", "query_id", "hit_id")
    per_split = exact.join(found, ["query_id", "hit_id"], "left").groupBy("query_split")
    return per_split.agg(
        F.count_distinct("query_id").alias("n_queries"),
        F.count(F.lit(1)).alias("n_exact"),
        (F.count("met") >= 0.9 * F.count(F.lit(1))).alias("met_most"),
    )


@query
def knn_votes(spark, sf_dir):
    return hybrid.aggregate_evidence(_exact_evidence(spark, sf_dir))


@query
def augmented_text(spark, sf_dir):
    rows = _vector_rows(spark, sf_dir)
    return evidence.augment(rows, _exact_evidence(spark, sf_dir)).select(
        "case_id", "split", "augmented_text"
    )


def _coarse(rows: DataFrame, *names: str) -> DataFrame:
    """Labels in two groups, so that neighbours often agree."""
    return rows.withColumns({c: (F.col(c).cast("int") % 2).cast("string") for c in names})


def _coarse_merged(spark, sf_dir):
    found = _coarse(_exact_evidence(spark, sf_dir), "hit_issue")
    preds = _coarse(_base_predictions(spark, sf_dir), "issue", "pred_issue")
    return hybrid.override(preds, hybrid.aggregate_evidence(found))


@query
def coarse_override(spark, sf_dir):
    """Overrides take place."""
    return _coarse_merged(spark, sf_dir)


@query
def coarse_hybrid_metrics(spark, sf_dir):
    return _rounded(
        hybrid.hybrid_metrics(_coarse_merged(spark, sf_dir)), "retrieval_override_rate", *METRIC_COLUMNS
    )


def _base_predictions(spark, sf_dir):
    vectors = clean.select_split(_split_vectors(spark, sf_dir), "val", "test")
    guess = F.floor(F.col("pos") / 10) % 10
    return vectors.select("case_id", "split", "issue", guess.cast("string").alias("pred_issue"))


def _merged(spark, sf_dir):
    votes = hybrid.aggregate_evidence(_exact_evidence(spark, sf_dir))
    return hybrid.override(_base_predictions(spark, sf_dir), votes)


@query
def hybrid_override(spark, sf_dir):
    return _merged(spark, sf_dir)


@query
def hybrid_metrics(spark, sf_dir):
    return _rounded(
        hybrid.hybrid_metrics(_merged(spark, sf_dir)), "retrieval_override_rate", *METRIC_COLUMNS
    )


# Metrics


@query
def split_metrics(spark, sf_dir):
    return _rounded(metrics.split_metrics(_base_predictions(spark, sf_dir)), *METRIC_COLUMNS)


def _label_rows(spark, sf_dir):
    return samples.table(spark, sf_dir, "labels").select(
        F.col("quality").cast("string").alias("issue"), F.col("toxic").cast("string").alias("pred_issue")
    )


@query
def confusion_counts(spark, sf_dir):
    return metrics.confusion_counts(_label_rows(spark, sf_dir), by=())


@query
def classification_report(spark, sf_dir):
    report = metrics.classification_report(_label_rows(spark, sf_dir))
    return _rounded(report, "precision", "recall", "f1_score", "support")


def _comparison(spark, sf_dir):
    base = _base_predictions(spark, sf_dir)
    votes = hybrid.aggregate_evidence(_exact_evidence(spark, sf_dir))
    voted = base.join(votes, "case_id").withColumn("pred_issue", F.col("retrieval_vote_issue"))
    return compare.union_metrics(
        {
            compare.BASELINE: metrics.split_metrics(base),
            compare.AUGMENTED: metrics.split_metrics(voted),
            compare.HYBRID: hybrid.hybrid_metrics(_merged(spark, sf_dir)),
        }
    )


@query
def compare_models(spark, sf_dir):
    return _rounded(_comparison(spark, sf_dir), *METRIC_COLUMNS, "retrieval_override_rate")


@query
def best_model(spark, sf_dir):
    best = compare.best_model(_comparison(spark, sf_dir))
    return _rounded(best.select("model", "weighted_f1"), "weighted_f1")


@query
def compare_report(spark, sf_dir):
    return compare.summary_lines(materialize(_comparison(spark, sf_dir), "comparison"))


# Classifiers


@query
def ovr_predictions(spark, sf_dir):
    return classify.predictions(_rows(spark, sf_dir))


@query
def ovr_optimality(spark, sf_dir):
    """Every binary problem of the baseline is solved under balanced weights."""
    train = _train(spark, sf_dir)
    terms = tfidf.fit(train, "text", tfidf.TfidfConfig())
    matrix = materialize(terms.transform(train.select("issue", "text"), "text"), "train-matrix")
    return ovr.optimality(matrix, ovr.fit(matrix))


@query
def retrieval_evidence(spark, sf_dir):
    """Text to TF-IDF, SVD, cells and the evidence of every case."""
    return _text_evidence(spark, sf_dir).drop("query_pos")


def _text_evidence(spark, sf_dir):
    def build():
        rows = _rows(spark, sf_dir)
        retriever = evidence.fit_retriever(rows)
        return evidence.collect_evidence(retriever.index, retriever.vectors, rows)

    return _stage_table(spark, sf_dir, "text-evidence", build)


@query
def rac_predictions(spark, sf_dir):
    """Classifier on the text augmented with retrieved evidence."""
    rows = evidence.augment(_rows(spark, sf_dir), _text_evidence(spark, sf_dir))
    augmented = _stage_table(spark, sf_dir, "augmented", lambda: rows)
    return classify.predictions(
        augmented, "augmented_text", tfidf.TfidfConfig(max_features=120_000)
    )
