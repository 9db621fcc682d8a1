"""Vector expressions on ``array`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def l2_norm(col: Column) -> Column:
    return F.sqrt(
        F.aggregate(col, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    )


def l2_normalize(col: Column) -> Column:
    """Divide by the norm; zero vectors stay zero."""
    norm = l2_norm(col)
    return F.when(norm > 0, F.transform(col, lambda x: x / norm)).otherwise(col)
