"""Ranked lexical search: best-first document intervals bounded by range maxima of posting lists.

The index holds shards of documents, numbered by id. A shard has the sorted posting list of every term
with its counts. A search reads the lists of its terms, turns counts into whole-number impacts and
builds a sparse table of range maxima over each list. An interval of document numbers is bounded by the
sum of the weighted maxima of its terms there; the interval with the highest bound is split at the
document that has the greatest of these maxima, which is scored exactly. An interval goes when its bound
cannot enter the best ``k`` found so far in the task, equal scores decided by id. Nothing is left out
otherwise, so the result is exact.

Building and searching are passes over documents and shards without a shuffle of either; per task and
item ``k`` rows move. Queries travel to the tasks in blocks of ``BLOCK_TERMS`` terms on average.

Defined results: a text without terms (or null) is no document, an item without terms has no rows. Each
row of the items is an item, also where ids repeat or are null; repeated documents rank one after the
other, a null id behind the others. Terms are 64-bit hashes of whole words. Empty tables give no rows.
A text of any length is one document; a shard has at least one.
"""

from __future__ import annotations

from bisect import insort
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casequarry.llm import tokens
from casequarry.storage import materialize

TOP = 10
# Length normalisation in hundredths, and the scale of weights and impacts.
B = 75
WEIGHT_SCALE = 1000
IMPACT_SCALE = 1_000_000_000
SHARD_TOKENS, SHARD_DOCS = 1 << 20, 1 << 16
BLOCK_TERMS = 1 << 19
# Items searched together in a shard, and intervals looked at together.
ITEMS, INTERVALS = 256, 512


@dataclass(frozen=True)
class Index:
    """Shards of documents with their posting lists; ``n_docs`` documents have ``n_terms`` terms."""

    shards: DataFrame
    n_docs: int
    n_terms: int


def _packed(values: np.ndarray, kind) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.astype(kind).tobytes())


def _unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _shard(ids: list[pa.Array], lengths: list[np.ndarray], hashes: list[np.ndarray]) -> list:
    """One row: documents in the order of their ids, and the posting lists of all terms."""
    ids = pa.concat_arrays(ids)
    order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
    lengths, hashes = np.concatenate(lengths), np.concatenate(hashes)
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    vocabulary, term = np.unique(hashes, return_inverse=True)
    code = np.sort(term * len(order) + np.repeat(number, lengths))
    begin = tokens.distinct(code)
    counts = np.diff(np.append(begin, len(code)))
    term, docs = np.divmod(code[begin], len(order))
    return [
        ids.take(pa.array(order)),
        _packed(lengths[order], np.int64),
        _packed(vocabulary, np.uint64),
        _packed(np.bincount(term, minlength=len(vocabulary)), np.uint32),
        _packed(docs, np.uint32),
        _packed(counts, np.uint32),
        len(order),
        int(lengths.sum()),
    ]


def build(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Index:
    """Index the whole texts of all documents; one pass, written once."""
    schema = T.StructType(
        [T.StructField("ids", T.ArrayType(docs.schema[doc_id].dataType))]
        + [T.StructField(c, T.BinaryType()) for c in ("lengths", "vocabulary", "df", "docs", "tf")]
        + [T.StructField(c, T.LongType()) for c in ("n_docs", "n_tokens")]
    )

    def work(batches):
        ids, lengths, hashes, size = [], [], [], 0

        def row():
            own, *rest = _shard(ids, lengths, hashes)
            whole = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
            kinds = [pa.binary()] * 5 + [pa.int64()] * 2
            columns = [pa.array([v], kind) for v, kind in zip(rest, kinds)]
            return pa.RecordBatch.from_arrays([whole, *columns], names=schema.fieldNames())

        for batch in batches:
            for part in tokens.slices(batch, text, limit=1 << 20):
                found = tokens.words(part.column(text), tokens.NOT_ALNUM)
                counts = found.counts()
                if not counts.any():
                    continue
                ids.append(part.column(doc_id).filter(pa.array(counts > 0)))
                lengths.append(counts[counts > 0])
                hashes.append(found.hashes)
                size += len(found.hashes)
                if size >= SHARD_TOKENS or sum(map(len, ids)) >= SHARD_DOCS:
                    yield row()
                    ids, lengths, hashes, size = [], [], [], 0
        if ids:
            yield row()

    shards = materialize(docs.select(doc_id, text).mapInArrow(work, schema), "search-shards")
    n_docs, n_terms = shards.agg(F.sum("n_docs"), F.sum("n_tokens")).first()
    return Index(shards, n_docs or 0, n_terms or 0)


class _Tables:
    """Impacts of the postings of some terms in one shard, and range maxima over every list.

    ``key`` is ``term * n_docs + document``, ascending, so a range of documents of a term is a range
    of places. Level ``j`` of the sparse table holds the place of the first maximum of ``2^j`` places.
    """

    def __init__(self, n_docs: int, starts: np.ndarray, docs: np.ndarray, impact: np.ndarray):
        self.n_docs = n_docs
        self.docs, self.impact = docs, impact
        sizes = np.diff(starts)
        self.key = np.repeat(np.arange(len(sizes)), sizes) * n_docs + docs
        level = np.arange(len(docs), dtype=np.int32)
        levels = [level]
        while 2 << (len(levels) - 1) <= int(sizes.max(initial=0)):
            half = 1 << (len(levels) - 1)
            left, right = level[:-half], level[half:]
            level = np.where(impact[left] >= impact[right], left, right)
            levels.append(level)
        self.begin = np.cumsum([0] + [len(x) for x in levels])[:-1]
        self.flat = np.concatenate(levels)

    def places(self, term: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The first place in the list of each term whose document is not before ``doc``."""
        return np.searchsorted(self.key, term * self.n_docs + doc)

    def first_maxima(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Place of the first maximum of every range; ranges are not empty."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        begin = self.begin[level]
        left = self.flat[begin + low]
        right = self.flat[begin + high - (1 << level.astype(np.int64))]
        return np.where(self.impact[left] >= self.impact[right], left, right)


def _of_shard(row: dict, terms: np.ndarray, n_docs: int, n_terms: int):
    """Tables of the searched terms that the shard has, and their numbers among ``terms``."""
    vocabulary = _unpacked(row["vocabulary"], np.uint64)
    at = np.searchsorted(vocabulary, terms)
    present = np.flatnonzero(vocabulary[np.minimum(at, len(vocabulary) - 1)] == terms)
    ends = np.cumsum(_unpacked(row["df"], np.uint32).astype(np.int64))
    begin = np.concatenate([[0], ends[:-1]])[at[present]]
    sizes = ends[at[present]] - begin
    starts = np.concatenate([[0], np.cumsum(sizes)])
    places = np.repeat(begin - starts[:-1], sizes) + np.arange(starts[-1])
    docs = _unpacked(row["docs"], np.uint32)[places].astype(np.int64)
    tf = _unpacked(row["tf"], np.uint32)[places].astype(np.int64)
    lengths = _unpacked(row["lengths"], np.int64)
    if int(lengths.max()) * B * n_docs >= 1 << 63:
        lengths = lengths.astype(object)
    m = (100 - B + lengths * B * n_docs // n_terms).astype(np.int64)
    impact = IMPACT_SCALE * tf // (WEIGHT_SCALE * tf + 8 * m[docs])
    return _Tables(len(lengths), starts, docs, impact), present


class _Best:
    """The best ``k`` rows of one item over the shards of a task."""

    def __init__(self, k: int):
        self.k = k
        self.rows: list[tuple] = []

    def least(self) -> int:
        """A score that must at least be reached."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 1

    def open(self, bound: int, first_id) -> bool:
        """Could a document with an id from ``first_id`` on and a score up to ``bound`` enter?"""
        least = self.least()
        if bound != least or len(self.rows) < self.k:
            return bound >= least
        return (first_id is None, first_id) < self.rows[-1][1]

    def offer(self, score: int, doc_id) -> None:
        if self.open(score, doc_id):
            insort(self.rows, (-score, (doc_id is None, doc_id)), key=_order)
            del self.rows[self.k :]


def _order(row: tuple) -> tuple:
    score, (missing, doc_id) = row
    return (score, missing) if missing else (score, missing, doc_id)


def _search_shard(tables: _Tables, ids: list, items: list[tuple], best: list[_Best]) -> None:
    """Best-first search of ``items (terms, weights)`` in one shard, all items in step."""
    heaps: list[list] = [[] for _ in items]

    def look(intervals: list[tuple[int, int, int]]) -> None:
        """Bound the intervals ``(item, low, high)``, score their splits, and keep the open ones."""
        sizes = np.array([len(items[i][0]) for i, _, _ in intervals])
        term = np.concatenate([items[i][0] for i, _, _ in intervals])
        weight = np.concatenate([items[i][1] for i, _, _ in intervals])
        owner = np.repeat(np.arange(len(intervals)), sizes)
        low = np.array([a for _, a, _ in intervals])[owner]
        high = np.array([b for _, _, b in intervals])[owner]
        left, right = tables.places(term, low), tables.places(term, high)
        some = np.flatnonzero(left < right)
        if not len(some):
            return
        places = tables.first_maxima(left[some], right[some])
        value = weight[some] * tables.impact[places]
        begin = tokens.distinct(owner[some])
        bounds = np.add.reduceat(value, begin)
        greatest = np.maximum.reduceat(value, begin)
        runs = np.diff(np.append(begin, len(some)))
        top = np.flatnonzero(value == np.repeat(greatest, runs))
        top = top[tokens.distinct(np.repeat(np.arange(len(runs)), runs)[top])]
        split = tables.docs[places[top]]
        # The exact score of the split document; all its terms lie in the ranges.
        doc = np.repeat(split, runs)
        exact = tables.places(term[some], doc)
        exact = np.minimum(exact, len(tables.key) - 1)
        hit = tables.key[exact] == term[some] * tables.n_docs + doc
        scores = np.add.reduceat(np.where(hit, weight[some] * tables.impact[exact], 0), begin)
        told = zip(
            owner[some][begin].tolist(), bounds.tolist(), split.tolist(), scores.tolist()
        )
        for n, bound, at, score in told:
            i, a, b = intervals[n]
            if bound < best[i].least():
                continue
            if score > 0:
                best[i].offer(score, ids[at])
            heappush(heaps[i], (-bound, a, b, at))

    look([(i, 0, tables.n_docs) for i, (terms, _) in enumerate(items) if len(terms)])
    while True:
        active = [i for i, heap in enumerate(heaps) if heap]
        if not active:
            return
        intervals = []
        for i in active:
            for _ in range(max(1, INTERVALS // (2 * len(active)))):
                if not heaps[i]:
                    break
                bound, a, b, at = heappop(heaps[i])
                if -bound < best[i].least():
                    heaps[i].clear()  # so are all others
                    break
                if best[i].open(-bound, ids[a]):
                    intervals += [(i, x, y) for x, y in ((a, at), (at + 1, b)) if x < y]
        if intervals:
            look(intervals)


def _bags(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``(row, item_id, terms, counts, n)`` of every item that has terms."""
    schema = T.StructType(
        [
            T.StructField("item_id", items.schema[item_id].dataType),
            T.StructField("terms", T.BinaryType()),
            T.StructField("counts", T.BinaryType()),
            T.StructField("n", T.LongType()),
        ]
    )

    def work(batches):
        for batch in batches:
            for part in tokens.slices(batch, text):
                found = tokens.words(part.column(text), tokens.NOT_ALNUM)
                bags = [tokens.counted(found.of(i)) for i in range(len(found))]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(item_id),
                        pa.array([t.tobytes() for t, _ in bags], pa.binary()),
                        pa.array([c.tobytes() for _, c in bags], pa.binary()),
                        pa.array([len(t) for t, _ in bags], pa.int64()),
                    ],
                    names=schema.fieldNames(),
                )

    bags = items.select(item_id, text).mapInArrow(work, schema).where(F.col("n") > 0)
    return materialize(bags.withColumn("row", F.monotonically_increasing_id()), "search-items")


def _frequencies(index: Index, terms: np.ndarray) -> np.ndarray:
    """In how many documents each of ``terms`` stands; one number per task and term moves."""

    def work(batches):
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for vocabulary, df in zip(*(batch.column(c).to_pylist() for c in ("vocabulary", "df"))):
                vocabulary = _unpacked(vocabulary, np.uint64)
                at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
                total += np.where(vocabulary[at] == terms, _unpacked(df, np.uint32)[at], 0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["term", "df"]
        )

    counted = index.shards.select("vocabulary", "df").mapInArrow(work, "term int, df long")
    df = np.zeros(len(terms), np.int64)
    for row in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[row["term"]] = row["df"]
    return df


def _search_block(index: Index, block: list, k: int) -> DataFrame:
    """``(row, doc_id, score)``: per task and item the best ``k``."""
    bags = [(np.frombuffer(b["terms"], np.uint64), np.frombuffer(b["counts"], np.int64)) for b in block]
    rows = [b["row"] for b in block]
    terms = np.unique(np.concatenate([t for t, _ in bags]))
    df = _frequencies(index, terms)
    weights = np.floor(WEIGHT_SCALE * np.log((2 * index.n_docs + 2) / (2 * df + 1))).astype(np.int64)
    weights[df == 0] = 0  # such terms are in no list
    numbered = []
    for own, counts in bags:
        at = np.searchsorted(terms, own)
        keep = weights[at] > 0
        numbered.append((at[keep], (weights[at] * counts)[keep]))
    n_docs, n_terms = index.n_docs, index.n_terms
    id_type = index.shards.schema["ids"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("doc_id", id_type),
            T.StructField("score", T.LongType()),
        ]
    )

    def work(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        best = [_Best(k) for _ in rows]
        for batch in batches:
            for n in range(batch.num_rows):
                row = {c: batch.column(c)[n].as_py() for c in batch.schema.names}
                tables, present = _of_shard(row, terms, n_docs, n_terms)
                if not len(present):
                    continue
                local = np.full(len(terms), -1, np.int64)
                local[present] = np.arange(len(present))
                for first in range(0, len(rows), ITEMS):
                    items = []
                    for own, weight in numbered[first : first + ITEMS]:
                        here = local[own]
                        items.append((here[here >= 0], weight[here >= 0]))
                    _search_shard(tables, row["ids"], items, best[first : first + ITEMS])
        found = [(r, i, -s) for r, b in zip(rows, best) for s, (_, i) in b.rows]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r for r, _, _ in found], pa.int64()),
                pa.array([i for _, i, _ in found], to_arrow_type(id_type)),
                pa.array([s for _, _, s in found], pa.int64()),
            ],
            names=schema.fieldNames(),
        )

    read = index.shards.select("ids", "lengths", "vocabulary", "df", "docs", "tf")
    return read.mapInArrow(work, schema)


def search(
    index: Index, items: DataFrame, k: int = TOP, item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` documents with the highest scores above 0."""
    bags = _bags(items, item_id, text)
    total = bags.agg(F.sum("n")).first()[0] or 0
    blocks = -(-total // BLOCK_TERMS)
    place = F.pmod(F.xxhash64("row"), F.lit(max(blocks, 1)))
    found = None
    for number in range(blocks if index.n_docs else 0):
        block = bags.where(place == number).select("row", "terms", "counts").collect()
        if block:
            part = materialize(_search_block(index, block, k), "search-found")
            found = part if found is None else found.unionByName(part)
    if found is None:
        id_type = index.shards.schema["ids"].dataType.elementType
        found = bags.select("row", F.lit(None).cast(id_type).alias("doc_id"), F.lit(0).alias("score"))
        found = found.where(F.lit(False))
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .join(bags.select("row", "item_id"), "row")
        .select(F.col("item_id").alias(item_id), "rank", "doc_id", F.col("score").cast("long").alias("score"))
    )
