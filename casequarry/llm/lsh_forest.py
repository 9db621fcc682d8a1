"""Approximate nearest neighbours by cosine in a forest of sorted hash strings.

In every tree a vector has a string of ``BITS`` signs of random projections. The strings of a tree
are kept sorted and cut into cells by their first bits; a task holds one cell, or one of the equal
parts of a cell that is too large. A query descends each tree along its own string and along the
strings that differ where its projections are closest to zero. In the sorted array a prefix is a
range; a range with too few vectors is ascended, one bit at a time. All trees are searched
in step, with one prefix length. It starts from the number of vectors and is ascended until the
descents of a sample of the queries meet ``RECALL`` of their true neighbours, which one pass over the
vectors finds; so the search widens with the table, in the end to all vectors. Every vector met is
compared exactly, in double precision, on the original components.

Equal vectors are one class with its smallest ids, so copies cost nothing and tie by id.

Defined results: vectors that are null, empty, zero or hold null or non-finite components and rows
without id take no part; equal rows count once; vectors of another length are no candidates; a query
with fewer than ``k`` candidates in reach returns those.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casequarry.storage import materialize

TREES = 28
BITS = 32
PROBES = 32
# Vectors that share the full prefix of a descent, on average, and the least before ascending.
LEAF = 12
LEAST = 4
# Queries whose true neighbours are found, and the share of these that the descents have to meet.
SAMPLE = 256
RECALL = 0.95
# Vectors of a cell, and the largest number of cells of a tree (their sizes travel to the tasks).
CELL = 4096
MOST_CELL_BITS = 14


def depths(n: int) -> tuple[int, int]:
    """Bits of a cell and of the longest prefix of a descent for ``n`` vectors."""
    prefix = min(BITS, max(1, round(math.log2(max(n, 2) / LEAF))))
    cell = min(MOST_CELL_BITS, max(0, math.ceil(math.log2(max(n, 1) / CELL))))
    return min(cell, prefix), prefix


def _planes(dimension: int) -> np.ndarray:
    return np.random.default_rng(dimension).standard_normal((dimension, TREES * BITS))


_CACHE: dict[int, np.ndarray] = {}


def _projections(vectors: np.ndarray) -> np.ndarray:
    dimension = vectors.shape[1]
    if dimension not in _CACHE:
        _CACHE[dimension] = _planes(dimension)
    return (vectors @ _CACHE[dimension]).reshape(len(vectors), TREES, BITS)


def _strings(projections: np.ndarray) -> np.ndarray:
    weights = (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)
    return (projections > 0) @ weights


def _flips(margins: np.ndarray, n: int) -> list[tuple[int, ...]]:
    """The ``n`` cheapest sets of bits to flip, by the sum of squared margins."""
    order = np.argsort(margins, kind="stable")
    cost = np.square(margins[order]).tolist()
    sets: list[tuple[int, ...]] = [()]
    heap = [(cost[0], (0,))]
    while heap and len(sets) < n:
        total, chosen = heapq.heappop(heap)
        sets.append(tuple(int(order[i]) for i in chosen))
        last = chosen[-1]
        if last + 1 < len(cost):
            heapq.heappush(heap, (total + cost[last + 1], chosen + (last + 1,)))
            swapped = total - cost[last] + cost[last + 1]
            heapq.heappush(heap, (swapped, chosen[:-1] + (last + 1,)))
    return sets


def _by_dimension(batch: pa.RecordBatch):
    """Row numbers and the matrix of the vectors of each length in a batch."""
    vectors = batch.column("embedding")
    lengths = np.asarray(vectors.value_lengths())
    flat = np.asarray(vectors.flatten())
    begin = np.cumsum(lengths) - lengths
    for dimension in np.flatnonzero(np.bincount(lengths)):
        rows = np.flatnonzero(lengths == dimension)
        yield rows, flat[begin[rows, None] + np.arange(dimension)].astype(np.float64)


def classes(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """``(class_id, embedding, members, asked)``: equal vectors with their ``k + 1`` smallest ids."""
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    valid = vectors.where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & finite
        & F.exists("embedding", lambda x: x != 0)
    )
    # Adding zero makes the two zeros of floating point one value.
    one_zero = F.transform("embedding", lambda x: x + F.lit(0).cast("float"))
    rows = valid.select(
        "vec_id", one_zero.alias("embedding"), is_query.alias("asked")
    ).distinct()
    by_id = Window.partitionBy("embedding").orderBy("vec_id")
    first = (
        rows.select("vec_id", "embedding")
        .withColumn("place", F.row_number().over(by_id))
        .where(F.col("place") <= k + 1)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    )
    asked = rows.where("asked").select("embedding").distinct().withColumn("asked", F.lit(True))
    return first.join(asked, "embedding", "left").select(
        F.col("members")[0].alias("class_id"),
        "embedding",
        "members",
        F.coalesce("asked", F.lit(False)).alias("asked"),
    )


def _cell_of(tree: np.ndarray, string: np.ndarray, bits: int) -> np.ndarray:
    return (tree << MOST_CELL_BITS) | (string >> (BITS - bits))


def _index(table: DataFrame, bits: int) -> DataFrame:
    """One row per vector and tree: ``(dimension, cell, string, class_id, embedding)``."""

    def work(batches):
        trees = np.arange(TREES)
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                for rows, vectors in _by_dimension(part):
                    strings = _strings(_projections(vectors))
                    cells = _cell_of(trees[None, :], strings, bits)
                    take = pa.array(np.repeat(rows, TREES))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(strings.size, vectors.shape[1]), pa.int32()),
                            pa.array(cells.ravel(), pa.int32()),
                            pa.array(strings.ravel(), pa.int64()),
                            part.column("class_id").take(take),
                            part.column("embedding").take(take),
                        ],
                        names=["dimension", "cell", "string", "class_id", "embedding"],
                    )

    schema = "dimension int, cell int, string long, class_id long, embedding array<float>"
    return table.select("class_id", "embedding").mapInArrow(work, schema)


def _prefixes(string: int, margins: np.ndarray, prefix: int) -> list[int]:
    """The prefixes that a query with these margins visits in a tree."""
    own = string >> (BITS - prefix)
    found = []
    for flips in _flips(margins[:prefix], PROBES):
        other = own
        for bit in flips:
            other ^= 1 << (prefix - 1 - bit)
        found.append(other)
    return found


def _true_neighbours(table: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int) -> list:
    """Rows ``(at, embedding)``: the ``k`` nearest other classes of ``queries``, by comparing all."""
    dimension = queries.shape[1]
    units = queries / np.sqrt((queries * queries).sum(axis=1))[:, None]

    def work(batches):
        best = np.full((len(ids), k), -np.inf)
        at = np.zeros((len(ids), k), np.int64)
        rows = np.zeros((len(ids), k, dimension), np.float32)
        each = np.arange(len(ids))[:, None]
        for batch in batches:
            for low in range(0, batch.num_rows, 2048):
                part = batch.slice(low, 2048)
                for numbers, vectors in _by_dimension(part):
                    if vectors.shape[1] != dimension:
                        continue
                    classes = part.column("class_id").to_numpy()[numbers]
                    norms = np.sqrt((vectors * vectors).sum(axis=1))
                    score = (units @ vectors.T) / norms
                    score[ids[:, None] == classes[None, :]] = -np.inf
                    top = np.argsort(-score, axis=1, kind="stable")[:, :k]
                    both = np.concatenate([best, score[each, top]], axis=1)
                    order = np.argsort(-both, axis=1, kind="stable")[:, :k]
                    at = np.concatenate([at, classes[top]], axis=1)[each, order]
                    new = vectors[top].astype(np.float32)
                    rows = np.concatenate([rows, new], axis=1)[each, order]
                    best = both[each, order]
        query, place = np.nonzero(best > -np.inf)
        flat = pa.array(rows[query, place].ravel(), pa.float32())
        ends = pa.array(np.arange(len(query) + 1) * dimension, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(query, pa.int32()),
                pa.array(at[query, place]),
                pa.array(best[query, place]),
                pa.ListArray.from_arrays(ends, flat),
            ],
            names=["at", "class_id", "score", "embedding"],
        )

    schema = "at int, class_id long, score double, embedding array<float>"
    found = table.select("class_id", "embedding").mapInArrow(work, schema)
    nearest = Window.partitionBy("at").orderBy(F.col("score").desc(), "class_id")
    found = found.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k)
    return found.select("at", "embedding").collect()


def _met(queries: np.ndarray, at: np.ndarray, near: np.ndarray, prefix: int) -> float:
    """Share of the neighbours ``near`` of ``queries[at]`` that descents to ``prefix`` meet."""
    projections = _projections(queries)
    strings, margins = _strings(projections), np.abs(projections)
    met = np.zeros(len(at), bool)
    theirs = _strings(_projections(near)) >> (BITS - prefix)
    for i in range(len(queries)):
        rows = np.flatnonzero(at == i)
        for tree in range(TREES):
            visited = _prefixes(int(strings[i, tree]), margins[i, tree], prefix)
            met[rows] |= np.isin(theirs[rows, tree], visited)
    return float(met.mean())


def _ascended(table: DataFrame, prefix: int, k: int) -> int:
    """The longest prefix, ``prefix`` at most, whose descents meet enough of the true neighbours.

    Descents to so few bits that they visit all prefixes meet everything and need no sample.
    """
    if 1 << prefix <= PROBES:
        return prefix
    asked = table.where("asked").select("class_id", "embedding")
    sample = asked.orderBy(F.xxhash64("class_id"), "class_id").limit(SAMPLE).collect()
    for dimension in sorted({len(row["embedding"]) for row in sample}):
        rows = [row for row in sample if len(row["embedding"]) == dimension]
        ids = np.array([row["class_id"] for row in rows])
        queries = np.array([row["embedding"] for row in rows], np.float64)
        pairs = _true_neighbours(table, ids, queries, k)
        if not pairs:
            continue
        at = np.array([pair["at"] for pair in pairs])
        near = np.array([pair["embedding"] for pair in pairs], np.float64)
        while 1 << prefix > PROBES and _met(queries, at, near, prefix) < RECALL:
            prefix -= 1
    return prefix


def _visits(table: DataFrame, bits: int, prefix: int) -> DataFrame:
    """One row per query and cell: ``(dimension, cell, class_id, embedding, prefixes)``."""

    def work(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                for rows, vectors in _by_dimension(part):
                    projections = _projections(vectors)
                    strings = _strings(projections)
                    out = {"cell": [], "row": [], "prefixes": []}
                    for i, row in enumerate(rows.tolist()):
                        for tree in range(TREES):
                            margins = np.abs(projections[i, tree])
                            visited: dict[int, list[int]] = {}
                            for other in _prefixes(int(strings[i, tree]), margins, prefix):
                                visited.setdefault(other >> (prefix - bits), []).append(other)
                            for cell, prefixes in visited.items():
                                out["cell"].append((tree << MOST_CELL_BITS) | cell)
                                out["row"].append(row)
                                out["prefixes"].append(prefixes)
                    take = pa.array(out["row"], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([vectors.shape[1]] * len(take), pa.int32()),
                            pa.array(out["cell"], pa.int32()),
                            part.column("class_id").take(take),
                            part.column("embedding").take(take),
                            pa.array(out["prefixes"], pa.list_(pa.int64())),
                        ],
                        names=["dimension", "cell", "class_id", "embedding", "prefixes"],
                    )

    schema = """dimension int, cell int, class_id long, embedding array<float>,
        prefixes array<long>"""
    return table.select("class_id", "embedding").mapInArrow(work, schema)


def _matrix(table: pa.Table) -> np.ndarray:
    flat = np.asarray(table["embedding"].combine_chunks().flatten(), np.float64)
    return flat.reshape(table.num_rows, -1)


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine of each row with the query; the same for equal rows wherever they stand."""
    dots = (vectors * query).sum(axis=1)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    return dots / (norms * np.sqrt((query * query).sum()))


def _search(bits: int, prefix: int, k: int):
    schema = pa.schema(
        [("query", pa.int64()), ("class_id", pa.int64()), ("score", pa.float64())]
    )

    def work(cell: pa.Table, visits: pa.Table) -> pa.Table:
        if not cell.num_rows or not visits.num_rows:
            return schema.empty_table()
        strings = cell["string"].to_numpy()
        order = np.argsort(strings, kind="stable")
        strings, ids = strings[order], cell["class_id"].to_numpy()[order]
        vectors, queries = _matrix(cell)[order], _matrix(visits)
        out: tuple[list, list, list] = ([], [], [])
        for i, prefixes in enumerate(visits["prefixes"].to_pylist()):
            found = np.array(prefixes, np.int64)
            length = np.full(len(found), prefix)
            while True:
                low = np.searchsorted(strings, found << (BITS - length))
                high = np.searchsorted(strings, (found + 1) << (BITS - length))
                few = (high - low < LEAST) & (length > bits)
                if not few.any():
                    break
                found, length = np.where(few, found >> 1, found), length - few
            met = np.zeros(len(ids) + 1, np.int64)
            np.add.at(met, low, 1)
            np.add.at(met, high, -1)
            rows = np.flatnonzero(np.cumsum(met)[:-1])
            score = cosines(vectors[rows], queries[i])
            best = np.lexsort((ids[rows], -score))[: k + 1]
            out[0].append(np.full(len(best), visits["class_id"][i].as_py()))
            out[1].append(ids[rows][best])
            out[2].append(score[best])
        return pa.table([np.concatenate(x) for x in out], schema=schema)

    return work


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """The ``k`` nearest found for each query row of ``vectors (vec_id, embedding)``.

    Returns ``query_id, rank, vec_id, score``.
    """
    table = materialize(classes(vectors, is_query, k), "vector-classes")
    n = table.count()
    bits, prefix = depths(n)
    prefix = _ascended(table, prefix, k)
    bits = min(bits, prefix)
    index = _index(table, bits)
    visits = _visits(table.where("asked"), bits, prefix)
    # At most 2 ** MOST_CELL_BITS cells of each tree, of which only large ones are listed.
    limit = 4 * max(CELL, n >> MOST_CELL_BITS)
    sizes = index.groupBy("dimension", "cell").count().where(F.col("count") > limit)
    parts = {
        (row["dimension"], row["cell"]): -(-row["count"] // limit) for row in sizes.toLocalIterator()
    }
    if parts:
        listed = index.sparkSession.createDataFrame(
            [(d, c, p) for (d, c), p in parts.items()], "dimension int, cell int, parts int"
        )
        number = F.coalesce("parts", F.lit(1))
        index = index.join(F.broadcast(listed), ["dimension", "cell"], "left").withColumn(
            "part", F.pmod(F.xxhash64("class_id"), number).cast("int")
        )
        visits = visits.join(F.broadcast(listed), ["dimension", "cell"], "left").withColumn(
            "part", F.explode(F.sequence(F.lit(0), number - 1))
        )
    else:
        index, visits = (x.withColumn("part", F.lit(0)) for x in (index, visits))
    keys = ["dimension", "cell", "part"]
    found = (
        index.groupBy(*keys)
        .cogroup(visits.groupBy(*keys))
        .applyInArrow(_search(bits, prefix, k), "query long, class_id long, score double")
    )
    near = found.groupBy("query", "class_id").agg(F.max("score").alias("score"))
    by_score = Window.partitionBy("query").orderBy(F.col("score").desc(), "class_id")
    near = near.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= k + 1)
    ids = table.select("class_id", "members")
    near = near.join(ids, "class_id").select("query", "score", F.explode("members").alias("vec_id"))
    return _ranked(vectors, is_query, near, table, k)


def _ranked(vectors, is_query, near: DataFrame, table: DataFrame, k: int) -> DataFrame:
    """Give every query row the neighbours of its class but itself."""
    one_zero = F.transform("embedding", lambda x: x + F.lit(0).cast("float"))
    asked = (
        vectors.where(is_query)
        .select(F.col("vec_id").alias("query_id"), one_zero.alias("embedding"))
        .distinct()
        .join(table.where("asked").select("class_id", "embedding"), "embedding")
        .select("query_id", F.col("class_id").alias("query"))
    )
    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    # One more than wanted, as the query itself may be among them.
    near = near.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1)
    listed = near.groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("near")
    )
    others = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    return asked.join(listed, "query").select(
        "query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "found")
    ).select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("found")["vec_id"].alias("vec_id"),
        F.col("found")["score"].alias("score"),
    )
