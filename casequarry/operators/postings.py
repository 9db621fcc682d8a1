"""A stored inverted index: posting lists in blocks of documents, each with its largest gain.

Documents are numbered in train order and cut into blocks of consecutive numbers. A row of the index is
one term in one block, with the documents, counts and lengths there and the largest gain that the term
has in the block. Rows are sorted by term within files, and files lie in folders by bucket of the term, so
a search opens the folders of its terms only and skips the pages of other terms. A frequent term is many
rows, none longer than a block.

A search bounds every block by the sum of the weighted largest gains of its terms, which needs none of the
lists. The blocks with the highest bounds are scored first; their ``k``-th best score is a threshold, and
only blocks that can still reach it are scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casequarry.functions.text import unnest_bag
from casequarry.operators.ordering import part_offsets
from casequarry.storage import materialize

# Documents of a block, folders of the index, and blocks whose lists share a file.
BLOCK = 512
BUCKETS = 32
FILE_BLOCKS = 1024
# Blocks per query that are scored before there is a threshold.
SEEDS = 4
# Queries that meet the lists of a block in one task.
QUERIES_AT_ONCE = 1024
# Scores that are equal up to this are ties.
TIE = 1e-9
# Consecutive documents that are counted together when free positions are looked for.
RANGE = 1 << 16


def numbered(docs: DataFrame, *order: str) -> DataFrame:
    """``docs`` with a dense number ``doc`` in the given order.

    One shuffle by range; only the row counts of the ranges meet in one task.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(
        ranged.withColumn("__part", F.spark_partition_id()).withColumn("__row", row), "numbered-docs"
    )
    offsets = part_offsets(placed, F.col("__part"), F.lit(1)).select("part", "offset")
    # One row per task of the stage before.
    return placed.join(F.broadcast(offsets), F.col("__part") == F.col("part")).select(
        *docs.columns, (F.col("offset") + F.col("__row")).alias("doc")
    )


def bucket_of(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def build(docs: DataFrame, gain) -> DataFrame:
    """Rows ``(term, block, df, best, postings, bucket)``.

    ``docs`` has ``doc, n, length, bag``; ``gain(tf, length)`` is the gain of a term in a document.
    Documents arrive in their order, so most of a row is put together before the shuffle.
    """
    posting = F.struct(
        (F.col("doc") % BLOCK).cast("int").alias("at"),
        F.col("tf").cast("int").alias("tf"),
        F.col("length").cast("int").alias("length"),
    )
    rows = (
        unnest_bag(docs, "doc", "n", "length")
        .groupBy("term", F.floor(F.col("doc") / BLOCK).alias("block"))
        .agg(
            F.sum("n").alias("df"),
            F.max(gain(F.col("tf"), F.col("length"))).alias("best"),
            F.sort_array(F.collect_list(posting)).alias("postings"),
        )
        .withColumn("bucket", bucket_of(F.col("term")))
    )
    dealt = rows.repartition("bucket", F.floor(F.col("block") / FILE_BLOCKS))
    dealt = dealt.sortWithinPartitions("bucket", "term", "block")
    return materialize(dealt, "postings", partition_by="bucket")


def touched(index: DataFrame, terms: DataFrame) -> DataFrame:
    """The rows of the folders in which any of ``terms (term)`` can stand."""
    found = terms.select(bucket_of(F.col("term")).alias("bucket")).distinct().collect()
    return index.where(F.col("bucket").isin([r["bucket"] for r in found]))


def bounds(index: DataFrame, weights: DataFrame) -> DataFrame:
    """``(query_id, block, bound)`` of every block in which a term of the query stands.

    ``weights`` has ``query_id, term, weight``. Only the largest gains are read.
    """
    reach = F.greatest(F.col("weight"), F.lit(0.0)) * F.col("best")
    return (
        touched(index, weights)
        .select("term", "block", "best")
        .join(weights, "term")
        .groupBy("query_id", "block")
        .agg(F.sum(reach).alias("bound"))
    )


def scores(index: DataFrame, weights: DataFrame, blocks: DataFrame, gain) -> DataFrame:
    """``(query_id, doc, score)``: the best documents with a term of the query in each of ``blocks``.

    ``blocks`` has ``query_id, block, wanted``, the last being how many documents of it can matter. The lists
    of a block and the queries that ask it meet once, so neither a posting nor a document becomes a row per
    query. A group has one block and about ``QUERIES_AT_ONCE`` queries.
    """
    asked = weights.groupBy("query_id").agg(
        F.collect_list("term").alias("terms"), F.collect_list("weight").alias("weights")
    )
    salts = max(1, -(-asked.count() // QUERIES_AT_ONCE))
    left = blocks.join(asked, "query_id").withColumn(
        "salt", F.pmod(F.xxhash64("query_id"), F.lit(salts)).cast("int")
    )
    lists = (
        touched(index, weights)
        .join(weights.select("term").distinct(), "term", "left_semi")
        .select(
            "block",
            "term",
            F.col("postings.at").alias("at"),
            F.transform("postings", lambda p: gain(p["tf"], p["length"])).alias("gain"),
            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
        )
    )

    def score(asked: pa.Table, lists: pa.Table) -> pa.Table:
        queries, docs, scored = [], [], []
        if asked.num_rows and lists.num_rows:
            first = asked["block"][0].as_py() * BLOCK
            terms = lists["term"].combine_chunks()
            at = np.asarray(lists["at"].combine_chunks().flatten())
            gains = np.asarray(lists["gain"].combine_chunks().flatten())
            ends = np.cumsum(np.asarray(pc.list_value_length(lists["at"])), dtype=np.int64)
            begins = np.concatenate([[0], ends[:-1]])
            named, weight = asked["terms"].combine_chunks(), asked["weights"].combine_chunks()
            for i, (query, k) in enumerate(zip(asked["query_id"].to_pylist(), asked["wanted"].to_pylist())):
                place = pc.index_in(named[i].values, value_set=terms)
                known = np.asarray(pc.is_valid(place))
                place = np.asarray(pc.fill_null(place, 0))[known]
                if not len(place):
                    continue
                n = ends[place] - begins[place]
                of = np.repeat(begins[place] - np.cumsum(n) + n, n) + np.arange(n.sum())
                adds = np.repeat(np.asarray(weight[i].values)[known], n) * gains[of]
                total = np.bincount(at[of], adds, BLOCK)
                found = np.flatnonzero(np.bincount(at[of], minlength=BLOCK))
                found = found[np.argsort(-np.round(total[found], 9), kind="stable")[:k]]
                queries += [query] * len(found)
                docs.append(first + found)
                scored.append(total[found])
        return pa.table(
            {
                "query_id": pa.array(queries, asked.schema.field("query_id").type),
                "doc": pa.array(np.concatenate(docs or [np.empty(0)]).astype(np.int64)),
                "score": pa.array(np.concatenate(scored or [np.empty(0)])),
            }
        )

    keys = ["block", "salt"]
    schema = T.StructType(
        [weights.schema["query_id"], T.StructField("doc", T.LongType()), T.StructField("score", T.DoubleType())]
    )
    return left.groupBy(*keys).cogroup(lists.groupBy(*keys)).applyInArrow(score, schema)


def best(scored: DataFrame, k: int) -> DataFrame:
    """The ``k`` best documents per query; the limit acts in each task before the shuffle.

    Equal documents tie however their sums were ordered, and then go by their number.
    """
    order = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "doc")
    return scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def topk(index: DataFrame, weights: DataFrame, gain, k: int) -> DataFrame:
    """``(query_id, doc, score)``: the ``k`` best of the documents that share a term with the query."""
    bounded = materialize(bounds(index, weights), "block-bounds")
    by_bound = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")
    wanted = F.lit(k).alias("wanted")
    seeds = bounded.withColumn("place", F.row_number().over(by_bound)).where(F.col("place") <= SEEDS)
    first = materialize(best(scores(index, weights, seeds.select("query_id", "block", wanted), gain), k), "seed-scores")
    threshold = first.where(F.col("place") == k).select(
        "query_id", F.col("score").alias("threshold")
    )
    # A block whose bound is the threshold may hold a tie with a smaller number.
    reaches = F.col("bound") >= F.col("threshold") - 2 * TIE - 1e-12 * F.abs("threshold")
    rest = (
        bounded.join(seeds.select("query_id", "block"), ["query_id", "block"], "left_anti")
        .join(threshold, "query_id", "left")
        .where(F.col("threshold").isNull() | reaches)
    )
    rest = materialize(rest.select("query_id", "block"), "open-blocks")
    found = best(scores(index, weights, rest.withColumn("wanted", wanted), gain), k)
    both = first.drop("place").unionByName(found.drop("place"))
    return best(both, k).drop("place")


def free_positions(index: DataFrame, weights: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``(query_id, doc)``: the first ``k`` numbers without any term of the query.

    With ``r`` matched documents before a matched document ``p``, ``p - r`` free numbers lie before it.
    So the free number ``j`` is ``j`` plus the matched documents that have ``j`` or fewer free ones
    before them. ``r`` is the total of earlier ranges plus the rank within a range.
    """
    matched = (
        touched(index, weights)
        .select("term", "block", "postings")
        .join(weights.join(queries.select("query_id"), "query_id", "left_semi"), "term")
        .select("query_id", "block", F.explode("postings.at").alias("at"))
        .select("query_id", (F.col("block") * BLOCK + F.col("at")).alias("doc"))
        .distinct()
        .withColumn("range", F.floor(F.col("doc") / RANGE))
    )
    matched = materialize(matched, "matched-docs")
    totals = matched.groupBy("query_id", "range").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("query_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        "query_id", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    ).where(F.col("range") * RANGE - F.col("before") < k)  # others have too many free ones before
    inside = Window.partitionBy("query_id", "range").orderBy("doc")
    free = F.col("doc") - F.col("before") - (F.row_number().over(inside) - 1)
    counts = (
        matched.join(totals, ["query_id", "range"])
        .select("query_id", free.alias("free"))
        .where(F.col("free") < k)
        .groupBy("query_id", "free")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    so_far = Window.partitionBy("query_id").orderBy("free")
    return (
        queries.select("query_id", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("free"))
        .withColumn("free", F.col("free").cast("long"))
        .join(counts, ["query_id", "free"], "left")
        .select(
            "query_id",
            (F.col("free") + F.sum(F.coalesce("n", F.lit(0))).over(so_far)).alias("doc"),
        )
    )
