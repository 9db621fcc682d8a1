"""Quality by nearest neighbours in a latent space of term weights.

Terms are words and word shapes (upper case, lower case, digits, each mark as itself, runs
collapsed), hashed into a fixed number of columns, and words that repeat the word before. Their document frequencies are counted over
all documents. A truncated SVD of the weighted terms of the labelled sample gives the latent
space; the labelled vectors travel to every task, which computes the exact cosines of all its
documents with all of them block by block and lets the nearest vote by similarity.

Parameter ``labelled`` bounds the labelled rows (chosen by a hash of their key); everything else
covers all rows. Defined results: a null, blank or wholly unknown text has no vector and gets the
mean label of the sample; without labels every score is 0.5; several labels of one document count
as their mean.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casequarry.llm import frames, tokens

WORD_COLUMNS, SHAPE_COLUMNS = 6144, 2048
# A repeated word is one term; so is its share of the words of a text, in steps of an eighth.
REPEATS = WORD_COLUMNS + SHAPE_COLUMNS
SHARES = 8
COLUMNS = REPEATS + 1 + SHARES
LABELLED = 3000
COMPONENTS = 32
NEIGHBOURS = 25
# Documents compared with all labelled vectors at a time.
BLOCK = 1024

RESULT = T.StructType([T.StructField("score", T.DoubleType())])

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[48:58] = ord("0")
_SHAPE[65:91] = ord("1")
_SHAPE[97:123] = ord("2")
_SHAPE[128:] = ord("2")


def _shapes(texts: pa.Array) -> tokens.Words:
    at, data = tokens._text_bytes(texts)
    shape = _SHAPE[data]
    used = np.concatenate([[True], shape[1:] != shape[:-1]]) if len(shape) else shape.astype(bool)
    used[at[:-1][at[:-1] < len(used)]] = True
    upto = np.concatenate([[0], np.cumsum(used)]).astype(np.int64)
    squeezed = pa.Array.from_buffers(
        pa.large_binary(),
        len(at) - 1,
        [None, pa.py_buffer(upto[at].tobytes()), pa.py_buffer(shape[used].tobytes())],
    )
    return tokens.words(squeezed)


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, column, count)`` sorted by text and column."""
    plain = tokens.words(texts)
    again = np.zeros(len(plain.hashes), bool)
    again[1:] = plain.hashes[1:] == plain.hashes[:-1]
    again[plain.offsets[:-1][plain.offsets[:-1] < len(again)]] = False
    upto = np.concatenate([[0], np.cumsum(again)])
    repeats = upto[plain.offsets[1:]] - upto[plain.offsets[:-1]]
    texts_with = np.flatnonzero(repeats)
    share = repeats[texts_with] * SHARES // plain.counts()[texts_with]
    keys = [
        plain.text_of_word()[again] * COLUMNS + REPEATS,
        np.repeat(texts_with * COLUMNS + REPEATS + 1 + share, repeats[texts_with]),
    ]
    for found, low, size in (
        (plain, 0, WORD_COLUMNS),
        (_shapes(texts), WORD_COLUMNS, SHAPE_COLUMNS),
    ):
        column = low + (found.hashes % np.uint64(size)).astype(np.int64)
        keys.append(found.text_of_word() * COLUMNS + column)
    keys, counts = tokens.counted(np.concatenate(keys))
    return keys // COLUMNS, keys % COLUMNS, counts


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """Texts that have a term of each column, and the number of texts; one row per task is sent."""

    def count(batches):
        total = np.zeros(COLUMNS + 1, np.int64)
        for batch in batches:
            for part in tokens.slices(batch, text):
                _, column, _ = terms(part.column(text))
                total[:COLUMNS] += np.bincount(column, minlength=COLUMNS)
                total[COLUMNS] += part.num_rows
        column = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, pa.int32()), pa.array(total[column])], names=["column", "n"]
        )

    counted = docs.select(text).mapInArrow(count, "column int, n long")
    total = np.zeros(COLUMNS + 1, np.int64)
    for row in counted.groupBy("column").agg(F.sum("n").alias("n")).collect():
        total[row["column"]] = row["n"]
    return total[:COLUMNS], int(total[COLUMNS])


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    components: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def encode(self, texts: pa.Array) -> np.ndarray:
        """Unit latent vectors; zero where a text has no known term."""
        out = np.zeros((len(texts), self.components.shape[1]))
        text, column, counts = terms(texts)
        weight = (1 + np.log(counts)) * self.idf[column]
        begin = tokens.distinct(text)
        # Term rows are gathered for a bounded number of texts at a time.
        for low in range(0, len(begin), 256):
            first, last = begin[low], begin[low + 256] if low + 256 < len(begin) else len(text)
            products = self.components[column[first:last]] * weight[first:last, None]
            sums = np.add.reduceat(products, begin[low : low + 256] - first, axis=0)
            out[text[begin[low : low + 256]]] = sums
        return _unit(out)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 1e-9)


def _components(weights: np.ndarray, n: int) -> np.ndarray:
    """Right singular vectors by a randomised range finder with power iterations."""
    rng = np.random.default_rng(7)
    basis = rng.standard_normal((weights.shape[1], n + 8)).astype(weights.dtype)
    for _ in range(4):
        basis, _ = np.linalg.qr(weights.T @ (weights @ basis))
    _, _, right = np.linalg.svd(weights @ basis, full_matrices=False)
    return (basis @ right.T)[:, :n].astype(np.float64)


def labelled_sample(labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """``(doc_id, label)`` of at most ``limit`` documents, chosen by a hash of the id."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    means = known.groupBy("doc_id").agg(F.avg("label").alias("label"))
    total = means.count()
    # Only about as many rows as are wanted take part in the sort.
    slots = 1 << 30
    taken = slots if total <= limit else int(slots * min(1.0, 1.2 * limit / total + 1e-6))
    order = F.xxhash64("doc_id")
    return (
        means.where(F.pmod(order, F.lit(slots)) < taken)
        .orderBy(F.pmod(order, F.lit(slots)), "doc_id")
        .limit(limit)
    )


def fit(
    docs: DataFrame, labels: DataFrame, limit: int = LABELLED, components: int = COMPONENTS
) -> Model:
    """Learn from ``labels (doc_id, label)``; document frequencies come from all of ``docs``."""
    frequency, n_docs = document_frequencies(docs)
    idf = np.log((1 + n_docs) / (1 + frequency)) + 1
    sample = docs.select("doc_id", "text").join(labelled_sample(labels, limit), "doc_id")
    rows = sample.where(F.col("text").isNotNull()).toArrow().combine_chunks().sort_by("doc_id")
    if not rows.num_rows:
        empty = np.zeros((0, components))
        return Model(idf, np.zeros((COLUMNS, components)), empty, np.zeros(0))
    weights = np.zeros((rows.num_rows, COLUMNS), np.float32)
    low = 0
    for batch in rows.to_batches(max_chunksize=256):
        text, column, counts = terms(batch.column("text"))
        weights[low + text, column] = (1 + np.log(counts)) * idf[column]
        low += batch.num_rows
    weights = _unit(weights)
    model = Model(
        idf,
        _components(weights, min(components, rows.num_rows)),
        np.zeros((0, components)),
        np.zeros(0),
    )
    encoded = [model.encode(b.column("text")) for b in rows.to_batches(max_chunksize=256)]
    labels_of = rows["label"].to_numpy()
    return Model(idf, model.components, np.concatenate(encoded), labels_of)


def votes(model: Model, vectors: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Similarity-weighted mean label of the nearest labelled vectors."""
    if not len(model.labels):
        return np.full(len(vectors), 0.5)
    prior = float(model.labels.mean())
    out = np.full(len(vectors), prior)
    k = min(neighbours, len(model.labels))
    for low in range(0, len(vectors), BLOCK):
        block = vectors[low : low + BLOCK]
        cosine = block @ model.vectors.T
        nearest = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, nearest, axis=1), 0)
        total = weight.sum(axis=1)
        mean = (weight * model.labels[nearest]).sum(axis=1) / np.where(total > 0, total, 1)
        out[low : low + BLOCK] = np.where(total > 0, mean, prior)
    return np.clip(out, 0, 1)


def score(
    docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` with ``score``; every document meets every labelled vector."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch):
        return [votes(shared.value, shared.value.encode(batch.column(text)))]

    return frames.append(docs, RESULT, compute, text, keep)
