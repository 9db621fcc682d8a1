"""One-vs-rest logistic regression with weights balanced within every binary problem."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casequarry.functions.sparse import add_transposed_times, csr, packed, sum_over_tasks, times, unpacked
from casequarry.storage import materialize

# Coefficients of so many bytes are scored in one pass; more labels take further passes.
COEFFICIENT_BYTES = 512 << 20
# Driver memory for the fits of one group of labels; more labels are fitted group by group.
FIT_BYTES = 2 << 30
# Past steps kept per label by the quasi-Newton method.
HISTORY = 10


@dataclass(frozen=True)
class OvrConfig:
    """``c`` is the inverse strength of the L2 penalty.

    A fit ends when its gradient norm is below ``tol`` times the norm at the start, scaled by the
    share of the smaller class.
    """

    c: float = 1.0
    max_iter: int = 1000
    tol: float = 1e-4


@dataclass(frozen=True)
class OvrModel:
    """Labels in sorted order, coefficients ``(labels, terms)`` and intercepts.

    With two labels there is one row, for the second label.
    """

    labels: list[str]
    coefficients: np.ndarray
    intercepts: np.ndarray


def _losses(rows: DataFrame, classes: np.ndarray, share: np.ndarray, weights: np.ndarray, curved: bool = False):
    """Mean weighted log loss and its gradient, for several labels in one pass over the rows.

    ``rows`` are ``(x, class)``, packed. A label held by a share ``p`` of the rows weighs them ``1 / 2p``
    and the others ``1 / 2(1 - p)``. The last weight of a label is its intercept. ``curved`` adds the
    diagonal of the second derivative, from the same pass.
    """
    terms, n = weights.shape[1] - 1, len(classes)
    shared = rows.sparkSession.sparkContext.broadcast(
        (np.ascontiguousarray(weights.T), classes, 0.5 / share, 0.5 / (1.0 - share))
    )

    def add(batch, total):
        w, of, weight_in, weight_out = shared.value
        for x, classes in unpacked(batch):
            offsets, indices, values = x = x[0], x[1].astype(np.int64), x[2]
            inside = classes[:, None] == of
            sign = np.where(inside, 1.0, -1.0)
            weight = np.where(inside, weight_in, weight_out)
            margin = sign * (times(*x, w[:-1]) + w[-1])
            wrong = np.exp(-np.logaddexp(0.0, margin))
            pull = -sign * weight * wrong
            add_transposed_times(total[:terms, :n], *x, pull)
            total[terms, :n] += pull.sum(axis=0)
            total[terms + 1, :n] += (weight * np.logaddexp(0.0, -margin)).sum(axis=0)
            if curved:
                bend = weight * wrong * (1.0 - wrong)
                add_transposed_times(total[:terms, n:], offsets, indices, values * values, bend)
                total[terms, n:] += bend.sum(axis=0)

    total = sum_over_tasks(rows, add, (terms + 2, 2 * n if curved else n))
    shared.destroy()
    return (total[-1, :n], *total[:-1].T.reshape(-1, n, terms + 1))


def _direction(gradient: np.ndarray, curvature: np.ndarray, steps: list, changes: list) -> np.ndarray:
    """Limited-memory quasi-Newton direction from past steps and gradient changes.

    It starts from the diagonal ``curvature`` of the second derivative. That of a frequent term grows with the
    rows while that of a rare one is little more than the penalty; without it the steps needed grow too.
    """
    d = -gradient
    kept = []
    for s, y in zip(reversed(steps), reversed(changes)):
        a = (s @ d) / (s @ y)
        kept.append(a)
        d = d - a * y
    d = d / curvature
    if steps:
        d = d * (steps[-1] @ changes[-1]) / (changes[-1] @ (changes[-1] / curvature))
    for s, y, a in zip(steps, changes, reversed(kept)):
        d = d + (a - (y @ d) / (s @ y)) * s
    return d


def _fit_group(rows: DataFrame, n: int, classes: np.ndarray, share: np.ndarray, terms: int, config: OvrConfig) -> np.ndarray:
    """Fit several labels side by side: every pass evaluates the next trial point of each."""
    penalty = 1.0 / (config.c * n)

    def evaluate(which: np.ndarray, at: np.ndarray):
        loss, gradient, curvature = _losses(rows, classes[which], share[which], at, curved=True)
        return (
            loss / n + 0.5 * penalty * (at * at).sum(axis=1),
            gradient / n + penalty * at,
            curvature / n + penalty,
        )

    everyone = np.arange(len(classes))
    w = np.zeros((len(classes), terms + 1))
    value, gradient, curvature = evaluate(everyone, w)
    goal = config.tol * np.maximum(np.minimum(share, 1.0 - share), 1.0 / n)
    goal = goal * np.linalg.norm(gradient, axis=1)
    past: list[tuple[list, list]] = [([], []) for _ in everyone]
    direction = np.array([_direction(g, c, [], []) for g, c in zip(gradient, curvature)])
    step = np.ones(len(classes))
    accepted = np.zeros(len(classes), dtype=int)
    open_ = everyone[np.linalg.norm(gradient, axis=1) > goal]
    while len(open_):
        trial = w[open_] + step[open_, None] * direction[open_]
        new_value, new_gradient, new_curvature = evaluate(open_, trial)
        going = []
        for i, k in enumerate(open_):
            slope = gradient[k] @ direction[k]
            if new_value[i] > value[k] + 1e-4 * step[k] * slope:
                step[k] *= 0.5
                if step[k] > 1e-10:
                    going.append(k)
                continue
            steps, changes = past[k]
            s, y = trial[i] - w[k], new_gradient[i] - gradient[k]
            if s @ y > 0:
                steps.append(s)
                changes.append(y)
                del steps[:-HISTORY], changes[:-HISTORY]
            w[k], value[k], gradient[k], curvature[k] = trial[i], new_value[i], new_gradient[i], new_curvature[i]
            accepted[k] += 1
            if np.linalg.norm(gradient[k]) > goal[k] and accepted[k] < config.max_iter:
                direction[k], step[k] = _direction(gradient[k], curvature[k], steps, changes), 1.0
                going.append(k)
        open_ = np.array(going, dtype=int)
    return w


def _numbered(train: DataFrame, names: Column, features: str, label: str) -> DataFrame:
    """The rows as packed ``(x, class)``, classes by their place in ``names``."""
    number = (F.array_position(names, F.col(label)) - 1).cast("int").alias("class")
    return packed(train.select(F.unwrap_udt(features).alias("x"), number))


def fit(
    train: DataFrame, config: OvrConfig = OvrConfig(), features: str = "features", label: str = "issue"
) -> OvrModel:
    """One weighted binary fit per label on a shared, cached matrix.

    In the problem of a label with ``m`` of ``n`` rows, its rows weigh ``n / 2m`` and the others
    ``n / 2(n - m)``; the weights sum to ``n``, so the penalty is ``1 / (c n)``. The intercept
    is penalised like a coefficient. All labels share each pass over the rows, so the number of
    passes is that of the slowest label and does not grow with the number of labels.
    """
    counts = {
        row["label"]: row["n"]
        for row in train.groupBy(F.col(label).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    labels, n = sorted(counts), sum(counts.values())
    if not labels:
        raise ValueError("no rows to train on")
    first = train.select(F.unwrap_udt(features)["size"]).first()
    terms = first[0]
    targets = {1: [], 2: [1]}.get(len(labels), range(len(labels)))
    if not targets:
        return OvrModel(labels, np.zeros((0, terms)), np.zeros(0))
    names = F.array(*[F.lit(name) for name in labels])
    rows = _numbered(train, names, features, label).persist(StorageLevel.MEMORY_AND_DISK)
    share = np.array([counts[name] / n for name in labels])
    group = max(1, FIT_BYTES // (8 * (terms + 1) * (2 * HISTORY + 10)))
    try:
        fitted = []
        for low in range(0, len(targets), group):
            classes = np.array(targets[low : low + group])
            fitted.append(_fit_group(rows, n, classes, share[classes], terms, config))
    finally:
        rows.unpersist()
    w = np.concatenate(fitted)
    return OvrModel(labels, w[:, :-1], w[:, -1])


def optimality(
    train: DataFrame,
    model: OvrModel,
    config: OvrConfig = OvrConfig(),
    features: str = "features",
    label: str = "issue",
) -> DataFrame:
    """``(label, n, weight_sum, solved)`` of every binary problem of a fitted model.

    ``weight_sum`` adds up the balanced weights of all rows. A problem is solved if the gradient at
    its coefficients is as small as ``tol`` asks, or the allowed steps were used up.
    """
    counts = {
        row["label"]: row["n"]
        for row in train.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()
    }
    n, names = sum(counts.values()), F.array(*[F.lit(x) for x in model.labels])
    targets = np.arange(len(model.labels)) if len(model.labels) > 2 else np.array([1])
    share = np.array([counts[model.labels[t]] / n for t in targets])
    rows = _numbered(train, names, features, label)
    penalty = 1.0 / (config.c * n)
    w = np.concatenate([model.coefficients, model.intercepts[:, None]], axis=1)
    gradient = _losses(rows, targets, share, w)[1] / n + penalty * w
    start = _losses(rows, targets, share, np.zeros_like(w))[1] / n
    goal = config.tol * np.maximum(np.minimum(share, 1 - share), 1.0 / n)
    # Sums over tasks round differently from run to run.
    solved = np.linalg.norm(gradient, axis=1) <= 1.01 * goal * np.linalg.norm(start, axis=1)
    out = []
    for t, ok in zip(targets.tolist(), solved.tolist()):
        m = counts[model.labels[t]]
        weights = m * (n / (2 * m)) + (n - m) * (n / (2 * (n - m)))
        out.append((model.labels[t], m, round(weights, 6), ok))
    schema = "label string, n long, weight_sum double, solved boolean"
    return train.sparkSession.createDataFrame(out, schema)


def _score(rows: DataFrame, coefficients: np.ndarray, intercepts: np.ndarray, first: int) -> DataFrame:
    """Keep the best ``(score, class)`` so far; later classes win ties."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((np.ascontiguousarray(coefficients.T), intercepts))
    schema = T.StructType([f for f in rows.schema.fields if f.name != "__x"] )

    def score(batches):
        weights, bias = shared.value
        for batch in batches:
            names = [n for n in batch.schema.names if n != "__x"]
            scores = times(*csr(batch.column("__x")), weights) + bias
            best = scores.shape[1] - 1 - scores[:, ::-1].argmax(axis=1)
            top = scores[np.arange(len(scores)), best]
            columns = {name: batch.column(name) for name in names}
            ahead = top >= np.asarray(columns["__score"])
            columns["__class"] = pa.array(
                np.where(ahead, best + first, np.asarray(columns["__class"])).astype(np.int32)
            )
            columns["__score"] = pa.array(np.where(ahead, top, np.asarray(columns["__score"])))
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return rows.mapInArrow(score, schema)


def predict(
    rows: DataFrame, model: OvrModel, features: str = "features", out: str = "pred_issue"
) -> DataFrame:
    """Label with the highest decision value; the features are dropped.

    Row-local: the coefficients travel to the rows, in passes of bounded size.
    """
    keep = [c for c in rows.columns if c != features]
    names = F.array(*[F.lit(label) for label in model.labels])
    if len(model.labels) == 1:
        return rows.select(*keep, F.lit(model.labels[0]).alias(out))
    n_models, n_terms = model.coefficients.shape
    per_pass = max(1, COEFFICIENT_BYTES // (8 * n_terms))
    lowest = 0.0 if n_models == 1 else float("-inf")
    scored = rows.select(
        *keep,
        F.lit(lowest).alias("__score"),
        F.lit(0).alias("__class"),
        F.unwrap_udt(features).alias("__x"),
    )
    if n_models == 1:
        # The single model speaks for the second label, and must score above zero.
        scored = _score(scored, model.coefficients, model.intercepts - np.finfo(float).tiny, 1)
    elif n_models <= per_pass:
        scored = _score(scored, model.coefficients, model.intercepts, 0)
    else:
        matrix = materialize(scored.select("*", F.monotonically_increasing_id().alias("__row")), "ovr-rows")
        best = None
        for first in range(0, n_models, per_pass):
            part = slice(first, first + per_pass)
            one = _score(matrix, model.coefficients[part], model.intercepts[part], first)
            one = one.select("__row", F.struct("__score", "__class").alias("found"))
            best = one if best is None else best.unionByName(one)
        winners = best.groupBy("__row").agg(F.max("found").alias("found"))
        scored = matrix.drop("__score", "__class").join(winners, "__row").select("*", "found.*")
    return scored.select(*keep, F.element_at(names, F.col("__class") + 1).alias(out))
