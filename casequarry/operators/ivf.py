"""Cosine neighbours through an inverted file of vector cells.

Cells have two levels. At most ``nlist`` coarse cells are learned from a bounded sample; each is split
into cells of about ``cell_rows`` vectors, learned from its own sample in one task. So the number of cells
grows with the table and a probe reads about as many vectors at any size. The centroids of the inner cells are
a table that meets rows by coarse cell; only the coarse ones are broadcast.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casequarry.functions.vectors import l2_norm
from casequarry.storage import materialize


# Queries of a block that are multiplied together.
QUERIES_AT_ONCE = 512
# Sampled vectors per inner cell to be learned.
INNER_SAMPLES = 64
_BUCKETS = 1 << 30


@dataclass(frozen=True)
class IvfConfig:
    """``block_rows`` and ``block_queries`` bound what one task holds at a time.

    Coarse cells are learned from the distinct ones of about ``train_samples`` vectors picked by hash, from
    all if it is None. A coarse cell is split into at most ``nlist`` cells.
    """

    nlist: int = 1024
    nprobe: int = 16
    train_samples: int | None = 262_144
    cell_rows: int = 16_384
    topk: int = 3
    max_iter: int = 10
    seed: int = 410
    block_rows: int = 16_384
    block_queries: int = 32_768


@dataclass(frozen=True)
class IvfIndex:
    """``centroids`` are the coarse ones, bounded by ``nlist``; ``cells`` holds the distinct vectors by cell.

    ``inner`` has ``(coarse, first_cell, centers)`` for every coarse cell, or is None if none is split.

    A row of ``cells`` is ``(cell, block, embedding, members, first_pos, owner)``. ``members`` are
    the positions of the rows with this vector, as many as any query can need. ``owner`` is their
    id if they all share one.
    """

    centroids: np.ndarray
    cells: DataFrame
    blocks_per_cell: DataFrame
    config: IvfConfig
    n_cells: int
    inner: DataFrame | None = None


def with_direction(vectors: DataFrame) -> DataFrame:
    """Vectors that point somewhere; zero and missing ones cannot be compared by angle."""
    return vectors.where(F.col("embedding").isNotNull() & (l2_norm(F.col("embedding")) > 0))


def nearest_cells(centroids: np.ndarray, count: int, embedding: Column, spark) -> Column:
    """The ``count`` cells with the highest inner product, nearest first."""
    shared = spark.sparkContext.broadcast(centroids)
    count = min(count, len(centroids))

    @F.pandas_udf("array<int>")
    def search(vectors: pd.Series) -> pd.Series:
        if vectors.empty:
            return pd.Series([], dtype=object)
        sims = _matrix(vectors) @ shared.value.T
        near = np.argpartition(-sims, count - 1, axis=1)[:, :count]
        order = np.argsort(-np.take_along_axis(sims, near, axis=1), axis=1, kind="stable")
        return pd.Series(list(np.take_along_axis(near, order, axis=1).astype(np.int32)))

    return search(embedding)


def fit_centroids(vectors: DataFrame, config: IvfConfig) -> np.ndarray:
    """Spherical k-means on the distinct vectors, or about ``train_samples`` of them by hash.

    Copies count once, or a large group of copies would take most of the starting points.
    """
    n = vectors.count()
    if n == 0:
        raise ValueError("no vectors to index")
    n_cells = min(config.nlist, max(1, math.isqrt(n)))
    sample = vectors
    if config.train_samples is not None and n > config.train_samples:
        kept = F.pmod(F.xxhash64("embedding"), F.lit(_BUCKETS)) < int(config.train_samples / n * _BUCKETS)
        sample = vectors.where(kept)
    points = sample.select("embedding").distinct()
    points = points.select(array_to_vector("embedding").alias("features"))
    if n_cells == 1:
        centers = np.array([np.ones(len(vectors.first()["embedding"]))])
    else:
        points = materialize(points, "ivf-sample").persist()
        model = KMeans(
            k=n_cells,
            distanceMeasure="cosine",
            initMode="random",
            maxIter=config.max_iter,
            seed=config.seed,
        ).fit(points)
        centers = np.array(model.clusterCenters())
        points.unpersist()
    return centers / np.linalg.norm(centers, axis=1, keepdims=True)


def distinct_vectors(vectors: DataFrame, topk: int) -> DataFrame:
    """One row per distinct vector with the positions any query can need.

    A group of copies may hold much of the table. A query takes ``topk`` hits, none of them with
    its own id, so of one vector at most ``topk`` rows per id, and ``2 * topk`` rows in all, can
    matter. Both limits are applied in each task before the shuffle.
    """
    keyed = vectors.withColumns(
        {"key": F.xxhash64("embedding"), "key2": F.xxhash64(F.lit(1), "embedding")}
    )
    of_id = Window.partitionBy("key", "key2", "case_id").orderBy("pos")
    of_all = Window.partitionBy("key", "key2").orderBy("pos")
    return (
        keyed.withColumn("place", F.row_number().over(of_id))
        .where(F.col("place") <= topk)
        .withColumn("place", F.row_number().over(of_all))
        .where(F.col("place") <= 2 * topk)
        .groupBy("key", "key2")
        .agg(
            F.first("embedding").alias("embedding"),
            F.array_sort(F.collect_list("pos")).alias("members"),
            F.min("pos").alias("first_pos"),
            F.when(F.min("case_id") == F.max("case_id"), F.min("case_id")).alias("owner"),
        )
        .drop("key2")
    )


def _spherical_means(points: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Unit centroids of unit vectors, from the first ``k`` of them; one without vectors stays."""
    centers = points[:k].copy()
    for _ in range(rounds):
        near = _nearest(points, centers, 1)[0][:, 0]
        order = np.argsort(near, kind="stable")
        used, begin = np.unique(near[order], return_index=True)
        sums = np.add.reduceat(points[order], begin)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        turned = length[:, 0] > 0
        centers[used[turned]] = sums[turned] / length[turned]
    return centers


def _nearest(points: np.ndarray, centers: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and products of the nearest centroids of each point, nearest first, a few points at a time."""
    numbers, products = [], []
    for low in range(0, len(points), QUERIES_AT_ONCE):
        sims = points[low : low + QUERIES_AT_ONCE] @ centers.T
        order = np.argsort(-sims, axis=1, kind="stable")[:, :count]
        numbers.append(order)
        products.append(np.take_along_axis(sims, order, axis=1))
    return np.concatenate(numbers), np.concatenate(products)


def _unit_rows(column: pa.ChunkedArray, n: int) -> np.ndarray:
    values = np.asarray(column.combine_chunks().flatten(), np.float64).reshape(n, -1)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _per_coarse(rows: DataFrame) -> dict[int, int]:
    """Rows by coarse cell; at most ``nlist`` numbers."""
    return {r["coarse"]: r["count"] for r in rows.groupBy("coarse").count().collect()}


def fit_inner(placed: DataFrame, centroids: np.ndarray, counts: dict[int, int], config: IvfConfig):
    """Number of all cells, and the table of inner ones, None where no coarse cell is split.

    ``placed`` are distinct vectors ``(key, embedding, coarse)``. The sample of a coarse cell has about
    ``INNER_SAMPLES`` vectors per cell to be learned, so at most that many times ``nlist``.
    """
    spark = placed.sparkSession
    wanted = [
        min(config.nlist, max(1, -(-counts.get(c, 0) // config.cell_rows))) for c in range(len(centroids))
    ]
    if max(wanted) == 1:
        return len(centroids), None
    first = np.cumsum([0, *wanted]).tolist()
    own = [(c, first[c], centroids[c].astype(np.float64).tobytes()) for c in range(len(centroids))]
    unsplit = spark.createDataFrame(own, "coarse int, first_cell int, own binary")
    shares = [
        (c, k, min(_BUCKETS, int(INNER_SAMPLES * k / counts[c] * _BUCKETS) + 1))
        for c, k in enumerate(wanted)
        if k > 1
    ]
    shares = spark.createDataFrame(shares, "coarse int, k int, share long")
    sample = placed.join(F.broadcast(shares), "coarse").where(
        F.pmod(F.xxhash64(F.lit(7), "key"), F.lit(_BUCKETS)) < F.col("share")
    )
    rounds = config.max_iter

    def learn(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("key")
        points = _unit_rows(rows["embedding"], rows.num_rows)
        centers = _spherical_means(points, rows["k"][0].as_py(), rounds)
        return pa.table({"coarse": rows["coarse"][:1], "centers": pa.array([centers.tobytes()], pa.binary())})

    learned = sample.select("coarse", "k", "key", "embedding").groupBy("coarse").applyInArrow(
        learn, "coarse int, centers binary"
    )
    # A sample may be empty by chance; the coarse cell then stays whole.
    inner = unsplit.join(learned, "coarse", "left").select(
        "coarse", "first_cell", F.coalesce("centers", "own").alias("centers")
    )
    return first[-1], materialize(inner, "ivf-inner")


def inner_cells(
    rows: DataFrame, inner: DataFrame, counts: dict[int, int], row_id: str, keep: list[str], count: int, at_once: int
) -> DataFrame:
    """``keep`` and ``near``, the ``count`` nearest inner cells of the coarse cell of each row.

    ``near`` are ``(away, cell)``, ``away`` the negative cosine, nearest first. Rows of a popular coarse cell
    are dealt out to groups of about ``at_once`` rows, each with a copy of the cell's centroids.
    """
    spark = rows.sparkSession
    groups = [(c, -(-n // at_once)) for c, n in counts.items()]
    groups = spark.createDataFrame(groups, "coarse int, salts int")
    left = rows.join(F.broadcast(groups), "coarse").withColumn(
        "salt", F.pmod(F.xxhash64(row_id), F.col("salts")).cast("int")
    )
    right = inner.join(F.broadcast(groups), "coarse").select(
        "coarse", "first_cell", "centers", _numbers_below(F.col("salts")).alias("salt")
    )
    kind = T.StructType([T.StructField("away", T.DoubleType()), T.StructField("cell", T.IntegerType())])
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField("near", T.ArrayType(kind))])

    def search(asked: pa.Table, cells: pa.Table) -> pa.Table:
        n, kept = asked.num_rows, asked.select(keep)
        if not n or not cells.num_rows:
            none = pa.array([], pa.list_(pa.struct([("away", pa.float64()), ("cell", pa.int32())])))
            return kept.slice(0, 0).append_column("near", none)
        points = _unit_rows(asked["embedding"], n)
        centers = np.frombuffer(cells["centers"][0].as_buffer()).reshape(-1, points.shape[1])
        numbers, products = _nearest(points, centers, count)
        found = pa.StructArray.from_arrays(
            [
                pa.array(-products.ravel()),
                pa.array((numbers.ravel() + cells["first_cell"][0].as_py()).astype(np.int32)),
            ],
            names=["away", "cell"],
        )
        offsets = pa.array(np.arange(n + 1, dtype=np.int32) * numbers.shape[1])
        return kept.append_column("near", pa.ListArray.from_arrays(offsets, found))

    keys = ["coarse", "salt"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, schema)


def build_index(
    vectors: DataFrame, config: IvfConfig = IvfConfig(), centroids: np.ndarray | None = None
) -> IvfIndex:
    """Index ``(pos, case_id, embedding)`` rows. Large cells are cut into blocks.

    The unit vectors ``centroids`` are taken as coarse cells if given, else they are learned.
    """
    spark = vectors.sparkSession
    usable = with_direction(vectors.select("pos", "case_id", "embedding"))
    if centroids is None:
        centroids = fit_centroids(usable, config)
    placed = materialize(
        distinct_vectors(usable, config.topk).withColumn(
            "coarse", F.get(nearest_cells(centroids, 1, F.col("embedding"), spark), F.lit(0))
        ),
        "ivf-vectors",
    )
    counts = _per_coarse(placed)
    n_cells, inner = fit_inner(placed, centroids, counts, config)
    if inner is None:
        placed = placed.withColumnRenamed("coarse", "cell")
    else:
        keep = [c for c in placed.columns if c != "coarse"]
        found = inner_cells(placed, inner, counts, "key", keep, 1, config.block_queries)
        placed = materialize(
            found.select(*keep, F.get("near", F.lit(0))["cell"].alias("cell")), "ivf-placed"
        )
    # One row per cell: two numbers for at most nlist * nlist of them, and usually one for cell_rows vectors.
    blocks = materialize(
        placed.groupBy("cell").agg(
            F.ceil(F.count(F.lit(1)) / F.lit(config.block_rows)).cast("int").alias("blocks")
        ),
        "ivf-cells",
    )
    cells = placed.join(F.broadcast(blocks), "cell").select(
        "cell",
        F.pmod("key", "blocks").cast("int").alias("block"),
        "embedding",
        "members",
        "first_pos",
        "owner",
    )
    return IvfIndex(centroids, cells, blocks, config, n_cells, inner)


def _probed(index: IvfIndex, queries: DataFrame, nprobe: int) -> DataFrame:
    """The queries with ``probes``, their ``nprobe`` nearest cells.

    With split cells these are the nearest inner ones of the ``nprobe`` nearest coarse ones; the vector
    travels to each of those, and only numbers of cells come back.
    """
    asked = with_direction(queries)
    coarse = nearest_cells(index.centroids, nprobe, F.col("embedding"), queries.sparkSession)
    if index.inner is None:
        return asked.withColumn("probes", coarse)
    apart = materialize(asked.select("pos", "embedding", F.explode(coarse).alias("coarse")), "ivf-coarse")
    found = inner_cells(
        apart, index.inner, _per_coarse(apart), "pos", ["pos"], nprobe, index.config.block_queries
    )
    nearest = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, nprobe)
    probes = found.groupBy("pos").agg(F.transform(nearest, lambda x: x["cell"]).alias("probes"))
    return asked.join(probes, "pos").select(*queries.columns, "probes")


def _as_one_cell(index: IvfIndex, queries: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Queries with ``probes``, cells and their blocks for a search of all cells, which are taken as one.

    A query then meets every block once instead of every cell. Cells hold about the root of the table, so their
    number grows with it, while a block has ``block_rows`` vectors at any size.
    """
    rows = index.config.block_rows
    n_blocks = max(1, -(-index.cells.count() // rows))
    cell = F.lit(0).alias("cell")
    block = F.pmod(F.xxhash64("first_pos"), F.lit(n_blocks)).cast("int").alias("block")
    cells = index.cells.select(cell, block, "embedding", "members", "first_pos", "owner")
    probed = with_direction(queries).withColumn("probes", F.array(F.lit(0)))
    blocks = queries.sparkSession.createDataFrame([(0, n_blocks)], "cell int, blocks int")
    return probed, cells, blocks


def _numbers_below(limit: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), limit - 1))


def candidates(index: IvfIndex, queries: DataFrame, nprobe: int) -> DataFrame:
    """The best distinct vectors per query and block.

    Columns are those of the query without its vector, and ``sim, members, first_pos`` of what was
    found. Queries meet the cells they probe in a grid of blocks, so neither a large cell nor a
    popular one becomes a large task. A block compares by one matrix product and returns a bounded
    number of rows per query. A vector that only ``own_id`` has is no candidate. If all cells are probed,
    they make up one.
    """
    cfg = index.config
    if nprobe >= index.n_cells:
        probed, cells, blocks_per_cell = _as_one_cell(index, queries)
    else:
        probed, cells, blocks_per_cell = _probed(index, queries, nprobe), index.cells, index.blocks_per_cell
    probed = materialize(probed, "ivf-queries")
    # One row per cell, as above.
    grid = materialize(
        probed.select(F.explode("probes").alias("cell"))
        .groupBy("cell")
        .agg(
            F.ceil(F.count(F.lit(1)) / F.lit(cfg.block_queries)).cast("int").alias("query_blocks")
        )
        .join(F.broadcast(blocks_per_cell), "cell"),
        "ivf-grid",
    )
    carried = [f for f in queries.schema.fields if f.name != "embedding"]
    names = [f.name for f in carried]
    left = (
        probed.select(*names, "embedding", F.explode("probes").alias("cell"))
        .join(F.broadcast(grid), "cell")
        .withColumn("query_block", F.pmod(F.xxhash64("pos"), F.col("query_blocks")).cast("int"))
        .select("cell", "query_block", _numbers_below(F.col("blocks")).alias("block"), *names, "embedding")
    )
    right = cells.join(F.broadcast(grid.drop("blocks")), "cell").select(
        "cell",
        _numbers_below(F.col("query_blocks")).alias("query_block"),
        "block",
        "embedding",
        "members",
        "first_pos",
        "owner",
    )
    keys = ["cell", "query_block", "block"]
    wanted = _vectors_per_query(index)
    schema = T.StructType(
        [
            *carried,
            T.StructField("sim", T.DoubleType()),
            T.StructField("members", T.ArrayType(T.LongType())),
            T.StructField("first_pos", T.LongType()),
        ]
    )

    def compare(asked: pa.Table, stored: pa.Table) -> pa.Table:
        none = np.empty(0, np.int64)
        if not asked.num_rows or not stored.num_rows:
            return answers(asked, stored, none, none, np.empty(0))
        stored = stored.sort_by("first_pos")
        queries, matrix = _dense_rows(asked), _dense_rows(stored)
        own = pd.merge(
            asked.select(["own_id"]).to_pandas().dropna().rename_axis("q").reset_index(),
            stored.select(["owner"]).to_pandas().dropna().rename_axis("v").reset_index(),
            left_on="own_id",
            right_on="owner",
        ).sort_values("q")
        own_q, own_v = own["q"].to_numpy(np.int64), own["v"].to_numpy(np.int64)
        found = []
        # A few queries at a time, so that the products take little memory.
        for low in range(0, len(queries), QUERIES_AT_ONCE):
            sims = queries[low : low + QUERIES_AT_ONCE] @ matrix.T
            part = slice(*np.searchsorted(own_q, [low, low + len(sims)]))
            sims[own_q[part] - low, own_v[part]] = -np.inf
            q, v, value = best_of(sims)
            found.append((q + low, v, value))
        return answers(asked, stored, *(np.concatenate(x) for x in zip(*found)))

    def best_of(sims: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, columns and values of the highest of each row, those of own vectors left out."""
        width = min(wanted, sims.shape[1])
        bound = np.maximum(np.partition(sims, -width, axis=1)[:, -width], np.finfo(float).min)
        q, v = np.nonzero(sims >= bound[:, None])
        finite = np.isfinite(sims[q, v])
        q, v = q[finite], v[finite]
        value = sims[q, v]
        # Highest similarity first; ties in position order, which is the order of the columns.
        order = np.lexsort((v, -value, q))
        q, v, value = q[order], v[order], value[order]
        best = np.arange(len(q)) - np.searchsorted(q, np.arange(len(sims)))[q] < wanted
        return q[best], v[best], value[best]

    def answers(asked: pa.Table, stored: pa.Table, q: np.ndarray, v: np.ndarray, value: np.ndarray) -> pa.Table:
        found = asked.select(names).take(pa.array(q)).append_column("sim", pa.array(value, pa.float64()))
        for name in ("members", "first_pos"):
            found = found.append_column(name, stored[name].take(pa.array(v)))
        return found

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, schema)


def _dense_rows(table: pa.Table) -> np.ndarray:
    values = table["embedding"].combine_chunks().flatten()
    return np.asarray(values, np.float64).reshape(table.num_rows, -1)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def _vectors_per_query(index: IvfIndex) -> int:
    """One more than the hits: a shared vector may lose its first row to the query's own id."""
    return index.config.topk + 1


def search(index: IvfIndex, queries: DataFrame, train: DataFrame, nprobe: int | None = None) -> DataFrame:
    """Hits with ``rank, hit_pos, hit_id, cosine_similarity``, and the columns of both sides.

    ``queries`` need ``pos, own_id, embedding``; a hit never has the id ``own_id``, which is null
    where any id may be found. ``train`` has ``pos, case_id`` and what is to be known about a hit.
    Ties go to the earlier position. A query whose cells hold too few vectors gets fewer hits.
    """
    found = candidates(index, queries, nprobe or index.config.nprobe)
    near = Window.partitionBy("query_pos").orderBy(F.desc("sim"), "first_pos")
    hits = (
        found.withColumnRenamed("pos", "query_pos")
        .withColumn("place", F.row_number().over(near))
        .where(F.col("place") <= _vectors_per_query(index))
        .withColumn("hit_pos", F.explode("members"))
        .drop("place", "members", "first_pos")
    )
    known = train.withColumnsRenamed({"pos": "hit_pos", "case_id": "hit_id"})
    final = Window.partitionBy("query_pos").orderBy(F.desc("sim"), "hit_pos")
    return (
        hits.join(known, "hit_pos")
        .where(F.col("own_id").isNull() | (F.col("own_id") != F.col("hit_id")))
        .withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= index.config.topk)
        .withColumnRenamed("sim", "cosine_similarity")
    )


def probes_for(
    index: IvfIndex, queries: DataFrame, train: DataFrame, goal: float = 0.95, sample: int = 512
) -> int:
    """Fewest probes, by doubling from ``nprobe``, with which a sample of queries meets its true neighbours.

    About ``sample`` queries picked by hash search all cells once, then ever more of their nearest ones until
    they find ``goal`` of those hits. So the share found does not fall where near vectors are hard to find.
    """
    total = queries.count()
    share = min(_BUCKETS, int(sample / max(total, 1) * _BUCKETS) + 1)
    few = materialize(
        queries.where(F.pmod(F.xxhash64(F.lit(3), "pos"), F.lit(_BUCKETS)) < share), "ivf-sample-queries"
    )
    names = ["query_pos", "hit_pos"]
    true = materialize(search(index, few, train, index.n_cells).select(*names), "ivf-true")
    wanted, nprobe = true.count(), index.config.nprobe
    while nprobe < index.n_cells:
        met = search(index, few, train, nprobe).join(true, names, "left_semi").count()
        if met >= goal * wanted:
            break
        nprobe *= 2
    return min(nprobe, index.n_cells)
