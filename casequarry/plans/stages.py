"""The stages of the workflow; each reads tables and writes tables under one folder."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casequarry.operators import bm25, compare, eda, evidence, hybrid, metrics, splits
from casequarry.operators.bm25 import Bm25Config
from casequarry.operators.clean import dated_cases, select_split, usable_cases
from casequarry.operators.evidence import RetrieverConfig
from casequarry.operators.ovr import OvrConfig
from casequarry.operators.splits import SHARES
from casequarry.operators.tfidf import TfidfConfig
from casequarry.plans import classify
from casequarry.schema import EVIDENCE, PREDICTIONS
from casequarry.sources import cases as case_source
from casequarry.sources import tables
from casequarry.storage import materialize


@dataclass(frozen=True)
class StageConfig:
    """``source`` is the CSV, ``out_dir`` a folder every executor can reach."""

    source: str
    out_dir: str
    max_rows: int | None = None
    subset_rows: int = 200_000
    result_format: str = "csv"
    shares: Mapping[str, float] = field(default_factory=lambda: dict(SHARES))
    bm25: Bm25Config = Bm25Config()
    baseline: TfidfConfig = TfidfConfig()
    retriever: RetrieverConfig = field(default_factory=RetrieverConfig)
    augmented: TfidfConfig = TfidfConfig(max_features=120_000)
    classifier: OvrConfig = OvrConfig()

    def at(self, name: str) -> str:
        return f"{self.out_dir.rstrip('/')}/{name}"


# Columns that go along with a prediction.
PREDICTED = ("case_id", "split", "issue", "text")


def _cases(spark: SparkSession, cfg: StageConfig) -> DataFrame:
    return case_source.read_cases(spark, cfg.at("cases"), cfg.max_rows)


def _labelled(spark: SparkSession, cfg: StageConfig) -> DataFrame:
    """Rows with usable text and label, and their split; written once, a folder per split."""
    rows = usable_cases(_cases(spark, cfg), "text", "issue")
    attached = splits.attach_split(rows, tables.read_splits(spark, cfg.at("splits")))
    return materialize(attached, "labelled", partition_by="split")


def _result(df: DataFrame, cfg: StageConfig, name: str) -> None:
    tables.write_table(df, cfg.at(name), cfg.result_format)


def check_header(spark: SparkSession, cfg: StageConfig) -> None:
    _result(case_source.source_columns(spark, cfg.source), cfg, "source_columns")


def ingest(spark: SparkSession, cfg: StageConfig) -> None:
    tables.write_table(case_source.ingest(spark, cfg.source), cfg.at("cases"))


def explore(spark: SparkSession, cfg: StageConfig) -> None:
    """One scan of the texts gives the counted profile; all results are read from it."""
    usable = usable_cases(_cases(spark, cfg))
    tables.write_table(eda.profile(usable), cfg.at("profile"))
    counts = tables.read_table(spark, cfg.at("profile"))
    summary = eda.summary(counts)
    _result(summary, cfg, "eda_summary")
    total = summary.first()["rows_loaded_after_skip"]
    for facet, name in (("product", "top_products"), ("issue", "top_issues")):
        top = eda.top_labels(counts, facet)
        _result(eda.label_share(top, F.lit(total)), cfg, name)
    _result(eda.months_of(counts), cfg, "month_counts")
    _result(eda.histogram_of(counts), cfg, "word_length_histogram")


def explore_report(spark: SparkSession, cfg: StageConfig) -> None:
    counts = tables.read_table(spark, cfg.at("profile"))
    tables.write_report_text(eda.report(counts), cfg.at("eda_report_ready"))


def make_subset(spark: SparkSession, cfg: StageConfig) -> None:
    case_source.dev_subset(_cases(spark, cfg), cfg.at("cases_subset"), cfg.subset_rows)


def make_split(spark: SparkSession, cfg: StageConfig) -> None:
    listed = splits.build_splits(dated_cases(usable_cases(_cases(spark, cfg))), cfg.shares)
    tables.write_splits(listed, cfg.at("splits"))
    written = tables.read_splits(spark, cfg.at("splits"))
    _result(splits.split_stats(written), cfg, "split_counts")


def bm25_demo(spark: SparkSession, cfg: StageConfig) -> None:
    listed = tables.read_splits(spark, cfg.at("splits"))
    hits = bm25.retrieve(_cases(spark, cfg), listed, cfg.bm25)
    _result(hits, cfg, "retrieval_demo_table")
    again = tables.read_table(spark, cfg.at("retrieval_demo_table"), hits.schema, cfg.result_format)
    tables.write_hits_json(again, cfg.at("retrieval_demo_json"))


def _evaluated(spark: SparkSession, cfg: StageConfig, preds: DataFrame, name: str) -> None:
    """Write predictions once; metrics and report are read from them."""
    ordered = preds.select(*PREDICTIONS.fieldNames())
    tables.write_table(ordered, cfg.at(f"{name}_predictions"))
    written = tables.read_predictions(spark, cfg.at(f"{name}_predictions"))
    tables.write_table(metrics.split_metrics(written), cfg.at(f"{name}_metrics"))
    report = metrics.classification_report(select_split(written, "test"))
    _result(report, cfg, f"{name}_classification_report")


def baseline(spark: SparkSession, cfg: StageConfig) -> None:
    preds = classify.predictions(
        _labelled(spark, cfg), "text", cfg.baseline, cfg.classifier, PREDICTED
    )
    _evaluated(spark, cfg, preds, "tfidf_logreg_issue")


def _augmented(spark: SparkSession, cfg: StageConfig) -> dict[str, DataFrame]:
    """Evidence, then the augmented rows; only parts with changed rows are built while train stays the same."""
    rows = _labelled(spark, cfg)

    def found(changed, _: dict[str, DataFrame]) -> DataFrame:
        retriever = evidence.fit_retriever(rows, cfg.retriever)
        asked = retriever.vectors.where(changed("pos"))
        return evidence.collect_evidence(retriever.index, asked, rows, cfg.retriever.snippet_chars)

    def augmented(changed, written: dict[str, DataFrame]) -> DataFrame:
        return evidence.augment(rows.where(changed("ingest_pos")), written["evidence"])

    return tables.load_or_build_parts(
        spark,
        cfg.at("rac_checkpoint"),
        rows,
        "ingest_pos",
        F.col("split") == "train",
        {"evidence": ("query_pos", found), "augmented": ("ingest_pos", augmented)},
        cfg.source,
        cfg.max_rows,
        cfg.retriever,
    )


def retrieval_augmented(spark: SparkSession, cfg: StageConfig) -> None:
    built = _augmented(spark, cfg)
    tables.write_table(
        built["evidence"].select(*EVIDENCE.fieldNames()), cfg.at("rac_retrieval_evidence")
    )
    preds = classify.predictions(
        built["augmented"], "augmented_text", cfg.augmented, cfg.classifier, PREDICTED
    )
    _evaluated(spark, cfg, preds, "rac_issue")


def hybrid_retrieval(spark: SparkSession, cfg: StageConfig) -> None:
    preds = tables.read_predictions(spark, cfg.at("tfidf_logreg_issue_predictions"))
    votes = hybrid.aggregate_evidence(tables.read_evidence(spark, cfg.at("rac_retrieval_evidence")))
    tables.write_table(hybrid.override(preds, votes), cfg.at("hybrid_retrieval_issue_predictions"))
    merged = tables.read_table(spark, cfg.at("hybrid_retrieval_issue_predictions"))
    tables.write_table(hybrid.hybrid_metrics(merged), cfg.at("hybrid_retrieval_issue_metrics"))


def compare_results(spark: SparkSession, cfg: StageConfig) -> None:
    names = {
        compare.BASELINE: "tfidf_logreg_issue_metrics",
        compare.AUGMENTED: "rac_issue_metrics",
        compare.HYBRID: "hybrid_retrieval_issue_metrics",
    }
    comparison = compare.union_metrics(
        {model: tables.read_table(spark, cfg.at(name)) for model, name in names.items()}
    )
    _result(comparison, cfg, "classification_model_comparison")
    tables.write_report_text(compare.summary_lines(comparison), cfg.at("classification_report_ready"))


STAGES = {
    "header": check_header,
    "ingest": ingest,
    "explore": explore,
    "report": explore_report,
    "subset": make_subset,
    "split": make_split,
    "bm25": bm25_demo,
    "baseline": baseline,
    "augmented": retrieval_augmented,
    "hybrid": hybrid_retrieval,
    "compare": compare_results,
}


def run(spark: SparkSession, cfg: StageConfig, *names: str) -> None:
    """Run the named stages, or all, in workflow order."""
    for name, stage in STAGES.items():
        if not names or name in names:
            stage(spark, cfg)
