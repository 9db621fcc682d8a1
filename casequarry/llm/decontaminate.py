"""Benchmark decontamination: an FM-index per shard of documents, searched for benchmark windows.

A task turns the texts of a shard into word hashes. Words that no benchmark item has, and
neighbours that stand side by side in no item, cannot lie inside a window, so a separator takes
their place; this loses no occurrence and keeps the index small. The rest is indexed, all
windows are searched backwards at once, occurrences are located from sampled suffix positions,
and their spans are merged.

Defined results: null and blank texts have no words and no hits; an item without words has no
window; items with the same id count once; an item without id marks words but is not listed; an
empty benchmark marks nothing; repeated documents are judged each on its own.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casequarry.llm import frames, tokens
from casequarry.llm.fm_index import FmIndex

WINDOW = 13
# A word of 20 hit is contamination.
SHARE = 20
# The benchmark travels to every task; a larger one is refused rather than cut.
MAX_BENCHMARK_BYTES = 512 << 20

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("n_items", T.LongType()),
        T.StructField("items_sha256", T.StringType()),
        T.StructField("contaminated", T.BooleanType()),
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType(
                    [T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
                )
            ),
        ),
    ]
)


@dataclass(frozen=True)
class Phrases:
    """All distinct windows of a benchmark in word numbers from 1, and the items that have them."""

    vocabulary: np.ndarray
    maybe: np.ndarray
    pairs: np.ndarray
    words: np.ndarray
    lengths: np.ndarray
    items_of: list[list[str]]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers; 0 for words outside the benchmark."""
        out = np.zeros(len(hashes), np.int64)
        if len(self.vocabulary):
            likely = np.flatnonzero(self.maybe[hashes & np.uint64(len(self.maybe) - 1)])
            place = np.searchsorted(self.vocabulary, hashes[likely])
            place[place == len(self.vocabulary)] = 0
            known = self.vocabulary[place] == hashes[likely]
            out[likely[known]] = place[known] + 1
        return out

    def adjacent(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        if not len(self.pairs):
            return np.zeros(len(key), bool)
        place = np.searchsorted(self.pairs, key)
        place[place == len(self.pairs)] = 0
        return self.pairs[place] == key


def phrases(ids: list, texts: pa.Array, window: int = WINDOW) -> Phrases:
    found = tokens.words(texts, tokens.NOT_ALNUM)
    vocabulary, _ = tokens.counted(found.hashes)
    numbers = np.searchsorted(vocabulary, found.hashes) + 1
    items: dict[tuple, set[str]] = {}
    pairs = set()
    for i, item in enumerate(ids):
        own = numbers[found.offsets[i] : found.offsets[i + 1]].tolist()
        pairs.update((a << 32) | b for a, b in zip(own, own[1:]))
        for start in range(max(1, len(own) - window + 1) if own else 0):
            names = items.setdefault(tuple(own[start : start + window]), set())
            if item is not None:
                names.add(str(item))
    lengths = np.array([len(p) for p in items], np.int64)
    words = np.zeros((len(items), window), np.int64)
    for row, phrase in enumerate(items):
        words[row, : len(phrase)] = phrase
    maybe = np.zeros(1 << 22, bool)
    maybe[vocabulary & np.uint64(len(maybe) - 1)] = True
    return Phrases(
        vocabulary,
        maybe,
        np.array(sorted(pairs), np.int64),
        words,
        lengths,
        [sorted(names) for names in items.values()],
    )


def _runs(found: tokens.Words, model: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of the index and the word each stands for; a separator (-1) ends every run."""
    number = model.numbers(found.hashes)
    place = np.flatnonzero(number)
    if not len(place) or not len(model.lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = found.text_of_word()[place]
    linked = (np.diff(place) == 1) & (np.diff(text) == 0)
    linked &= model.adjacent(number[place[:-1]], number[place[1:]])
    begin = np.concatenate([[0], np.flatnonzero(~linked) + 1])
    length = np.diff(np.concatenate([begin, [len(place)]]))
    long = length >= model.lengths.min()
    place = place[np.repeat(long, length)]
    ends = np.cumsum(length[long])
    symbols = np.insert(number[place], ends, 0)
    return symbols, np.insert(place, ends, -1)


def occurrences(found: tokens.Words, model: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """``(first word, phrase)`` of every occurrence of a phrase in the texts of a shard."""
    symbols, place = _runs(found, model)
    if not len(symbols):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    alphabet = symbols[np.sort(np.unique(symbols, return_index=True)[1])]
    alphabet = np.sort(alphabet)
    dense = np.zeros(len(model.vocabulary) + 1, np.int64)
    dense[alphabet] = np.arange(len(alphabet))
    present = np.zeros(len(dense), bool)
    present[alphabet] = True
    searchable = np.flatnonzero(present[model.words].all(axis=1))
    index = FmIndex(dense[symbols], len(alphabet))
    low, high = index.search(dense[model.words[searchable]], model.lengths[searchable])
    count = np.maximum(high - low, 0)
    phrase = np.repeat(searchable, count)
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return place[index.locate(np.repeat(low, count) + within)], phrase


def _judge(model: Phrases, batch: pa.RecordBatch, text: str) -> list:
    found = tokens.words(batch.column(text), tokens.NOT_ALNUM)
    first, phrase = occurrences(found, model)
    change = np.zeros(len(found.hashes) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + model.lengths[phrase], -1)
    hit = (np.cumsum(change)[:-1] > 0).astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(hit)])
    n_words = found.counts()
    n_hit = upto[found.offsets[1:]] - upto[found.offsets[:-1]]
    items: dict[int, set[str]] = {}
    doc = np.searchsorted(found.offsets, first, "right") - 1
    for key in tokens.counted(doc * len(model.lengths) + phrase)[0].tolist():
        row, which = divmod(key, len(model.lengths))
        items.setdefault(row, set()).update(model.items_of[which])
    names = [sorted(items.get(row, ())) for row in range(len(found))]
    spans: list[list] = [[] for _ in range(len(found))]
    for row in np.flatnonzero(n_hit):
        low, high = found.offsets[row], found.offsets[row + 1]
        edge = np.diff(np.concatenate([[0], hit[low:high], [0]]))
        spans[row] = [
            {"start": a, "end": b}
            for a, b in zip(np.flatnonzero(edge > 0).tolist(), np.flatnonzero(edge < 0).tolist())
        ]
    return [
        n_words,
        n_hit,
        [len(x) for x in names],
        [hashlib.sha256(",".join(x).encode()).hexdigest() for x in names],
        ((n_hit > 0) & (SHARE * n_hit >= n_words)).tolist(),
        spans,
    ]


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with the columns of ``RESULT``; ``spans`` are ranges of hit words to remove.

    ``benchmark`` has ``item_id`` and ``text``. Its size is checked before it travels to the
    tasks; nothing is shuffled.
    """
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > MAX_BENCHMARK_BYTES:
        raise ValueError(f"the benchmark has {size} bytes, more than {MAX_BENCHMARK_BYTES}")
    items = benchmark.select("item_id", "text").toArrow().combine_chunks()
    texts = items["text"].combine_chunks()
    texts = texts if isinstance(texts, pa.Array) else pa.array([], pa.string())
    model = phrases(items["item_id"].to_pylist(), texts, window)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return frames.append(docs, RESULT, lambda batch: _judge(shared.value, batch, text), text, keep)


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their columns as they are."""
    rows = frames.numbered(docs)
    marked = mark(rows, benchmark, rows.columns[docs.columns.index("text")])
    return marked.where(~F.col("contaminated")).select(*rows.columns).toDF(*docs.columns)
