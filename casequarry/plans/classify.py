"""Train a text classifier on the train split and predict the other rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casequarry.operators import ovr, tfidf
from casequarry.operators.ovr import OvrConfig
from casequarry.operators.tfidf import TfidfConfig
from casequarry.storage import materialize


def predictions(
    rows: DataFrame,
    text_col: str = "text",
    terms: TfidfConfig = TfidfConfig(),
    classifier: OvrConfig = OvrConfig(),
    carry: tuple[str, ...] = ("case_id", "split", "issue"),
) -> DataFrame:
    """The ``carry`` columns and ``pred_issue`` of the rows outside train.

    ``rows`` need ``split``, ``issue`` and ``text_col``. The train matrix is written once and read
    by every pass of the fit; the other rows are vectorised and scored in one pass.
    """
    is_train = F.col("split") == "train"
    train = rows.where(is_train)
    vocabulary = tfidf.fit(train, text_col, terms)
    matrix = materialize(
        vocabulary.transform(train.select("issue", text_col), text_col), "train-matrix"
    )
    model = ovr.fit(matrix, classifier)
    unseen = rows.where(~is_train).select(*carry, F.col(text_col).alias("__text"))
    return ovr.predict(vocabulary.transform(unseen, "__text"), model)
