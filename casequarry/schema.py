"""Column contracts shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the source file and their canonical names.
SOURCE_COLUMNS = {
    "Complaint ID": "case_id",
    "Date received": "received",
    "Product": "product",
    "Issue": "issue",
    "Consumer complaint narrative": "text",
}

# Text that the CSV reader of the source treats as missing.
NA_LITERALS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Inside of a regex class that matches the Unicode whitespace code points.
WHITESPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"

# Split names in chronological order.
SPLITS = ("train", "val", "test")

CASES = T.StructType(
    [
        T.StructField("case_id", T.StringType()),
        T.StructField("received", T.TimestampType()),
        T.StructField("product", T.StringType()),
        T.StructField("issue", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("ingest_pos", T.LongType()),
    ]
)

SPLIT_RUNS = T.StructType(
    [
        T.StructField("case_id", T.StringType()),
        T.StructField("received", T.TimestampType()),
        T.StructField("split", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("n", T.LongType()),
    ]
)

EVIDENCE = T.StructType(
    [
        T.StructField("query_id", T.StringType()),
        T.StructField("query_split", T.StringType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("hit_id", T.StringType()),
        T.StructField("hit_issue", T.StringType()),
        T.StructField("cosine_similarity", T.DoubleType()),
        T.StructField("hit_snippet", T.StringType()),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("case_id", T.StringType()),
        T.StructField("split", T.StringType()),
        T.StructField("issue", T.StringType()),
        T.StructField("pred_issue", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
