"""Mixing sources to target weights by pivotal dependent rounding; DataFrame functions only.

A source's target, as a multiple of its size, is how many copies each of its documents gets: a whole
part and a fraction. Two fractions meet at a time. One of the two random transfers that leave their
words together as they are, and the expected copies of both, is taken, and makes one of them 0 or 1;
the other carries what is left. Blocks of a bounded number of documents are folded this way, then
the remainders of blocks, in a tree with ``FAN`` children per node, until one fraction per source
remains, which takes its share of words of its document. So a source's words come within rounding
of its target, and every document's expected words to the same multiple of its size.

Random numbers are hashes of the document and its place in the tree, so reruns agree.

Defined results: a null or blank text has size 0 and takes nothing; the null source is one source,
last in order; equal rows are folded as one and share its words; a table without words takes
nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casequarry.llm.frames import word_count
from casequarry.operators.ordering import part_offsets
from casequarry.storage import materialize

# Weights of the sources in order, the share of all words, the most copies.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
FAN = 64
SEED = 17


def _source_key(source: Column) -> Column:
    """Never null, so that the null source joins like any other."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


def units(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size, rows, key)``: documents with their words; equal rows are one unit."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return sized.groupBy("doc_id", "source", "size").agg(
        F.count(F.lit(1)).alias("rows"), F.any_value(_source_key(F.col("source"))).alias("key")
    )


def targets(counted: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``(key, source_size, units, target)`` of every source.

    The place of a source in the order comes from a range partitioning and the totals of its parts.
    Targets above their limit are cut and the rest is shared anew by weight, one aggregate over
    the sources a time, until none is above.
    """
    sources = counted.groupBy("key").agg(
        F.any_value("source").alias("source"),
        F.sum(F.col("size") * F.col("rows")).alias("source_size"),
        F.count(F.lit(1)).alias("units"),
    )
    in_order = F.col("source").asc_nulls_last()
    ranged = materialize(
        sources.repartitionByRange(in_order).withColumn("part", F.spark_partition_id()), "sources"
    )
    offsets = part_offsets(ranged, F.col("part"), F.lit(1))
    within = F.row_number().over(Window.partitionBy("part").orderBy(in_order)) - 1
    placed = ranged.withColumn("within", within).join(offsets, "part")
    turn = F.pmod(F.col("offset") + F.col("within"), F.lit(len(weights))).cast("int")
    weighed = materialize(
        placed.select(
            "key",
            "source_size",
            "units",
            F.get(F.array(*[F.lit(float(w)) for w in weights]), turn).alias("weight"),
            (F.col("source_size") * MOST_COPIES).cast("double").alias("limit"),
        ),
        "source-weights",
    )
    wanted = share * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = F.col("limit") <= level * F.col("weight")
        row = weighed.agg(
            F.sum(F.when(full, F.col("limit"))).alias("used"),
            F.sum(F.when(~full, F.col("weight"))).alias("weight"),
        ).first()
        if not row["weight"]:
            break
        following = (wanted - (row["used"] or 0.0)) / row["weight"]
        if following <= level:
            break
        level = following
    return weighed.select(
        "key",
        "source_size",
        "units",
        F.least("limit", F.lit(level) * F.col("weight")).alias("target"),
    )


def _bind(value: Column, use) -> Column:
    """Evaluate ``value`` once for several uses inside a higher-order function."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _uniform(left: Column, right: Column, level: int) -> Column:
    """A number in [0, 1) that depends on two documents and the level of the tree."""
    number = F.pmod(F.xxhash64(left, right, F.lit(SEED + level)), F.lit(1 << 40))
    return number / float(1 << 40)


def _with(item: Column, part: Column) -> Column:
    return F.struct(
        *[item[c].alias(c) for c in ("order", "doc_id", "size", "rows", "words")],
        part.alias("part"),
    )


def _pivot(first: Column, second: Column, level: int) -> Column:
    """``(settled, left)`` after a random transfer of words between two fractions."""
    p, q = first["part"], second["part"]
    ratio = second["words"] / first["words"]

    def moved(limits: Column) -> Column:
        up, down = limits["up"], limits["down"]
        # Up makes the first 1 or the second 0, down makes the first 0 or the second 1.
        fills = up >= 1 - p
        empties = down >= p
        rise = F.when(
            fills,
            F.struct(
                _with(first, F.lit(1.0)).alias("settled"),
                _with(second, F.greatest(q - up / ratio, F.lit(0.0))).alias("left"),
            ),
        ).otherwise(
            F.struct(
                _with(second, F.lit(0.0)).alias("settled"),
                _with(first, F.least(p + up, F.lit(1.0))).alias("left"),
            )
        )
        fall = F.when(
            empties,
            F.struct(
                _with(first, F.lit(0.0)).alias("settled"),
                _with(second, F.least(q + down / ratio, F.lit(1.0))).alias("left"),
            ),
        ).otherwise(
            F.struct(
                _with(second, F.lit(1.0)).alias("settled"),
                _with(first, F.greatest(p - down, F.lit(0.0))).alias("left"),
            )
        )
        chance = _uniform(first["order"], second["order"], level)
        return F.when(chance * (up + down) < down, rise).otherwise(fall)

    limits = F.struct(
        F.least(1 - p, q * ratio).alias("up"), F.least(p, (1 - q) * ratio).alias("down")
    )
    return _bind(limits, moved)


def _fold(items: Column, level: int) -> Column:
    """``(settled, left)`` of a sorted array of fractions, folded from its first element."""
    first = F.get(items, F.lit(0))
    empty = F.slice(items, 1, 0)
    start = F.struct(empty.alias("settled"), first.alias("left"))

    def step(state: Column, item: Column) -> Column:
        return _bind(
            _pivot(state["left"], item, level),
            lambda moved: F.struct(
                F.concat(state["settled"], F.array(moved["settled"])).alias("settled"),
                moved["left"].alias("left"),
            ),
        )

    return F.aggregate(F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))), start, step)


def _round(open_parts: DataFrame, level: int) -> DataFrame:
    """Fold the fractions of every block; ``open_parts`` has ``(key, block, item)``."""
    blocks = open_parts.groupBy("key", "block").agg(
        F.sort_array(F.collect_list("item")).alias("items")
    )
    folded = blocks.select("key", "block", _fold(F.col("items"), level).alias("folded"))
    return materialize(folded.select("key", "block", "folded.*"), f"mix-level-{level}")


def plan(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``(doc_id, source, key, size, rows, source_size, target, words)`` of every unit.

    ``words`` are those its rows take together.
    """
    counted = materialize(units(docs), "mix-units")
    of_source = materialize(targets(counted, weights, share), "mix-targets")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = counted.join(of_source, "key").withColumn("copies", copies)
    joined = joined.withColumn("whole", F.floor("copies").cast("long"))
    hashed = F.xxhash64("doc_id", "size", "key")
    spread = F.greatest(F.ceil(F.col("units") / FAN), F.lit(1)).cast("long")
    item = F.struct(
        hashed.alias("order"),
        "doc_id",
        "size",
        "rows",
        (F.col("size") * F.col("rows")).cast("double").alias("words"),
        (F.col("copies") - F.col("whole")).alias("part"),
    )
    current = joined.where((F.col("size") > 0) & (F.col("copies") > F.col("whole"))).select(
        "key", F.pmod(F.xxhash64(hashed, F.lit(SEED)), spread).alias("block"), item.alias("item")
    )
    most = of_source.agg(F.max("units")).first()[0] or 0
    blocks, level, settled = max(1, -(-most // FAN)), 0, None
    while True:
        folded = _round(current, level)
        done = folded.select("key", F.explode("settled").alias("item"))
        settled = done if settled is None else settled.unionByName(done)
        current = folded.select(
            "key", F.floor(F.col("block") / FAN).cast("long").alias("block"), F.col("left").alias("item")
        )
        if blocks <= 1:
            break
        blocks, level = -(-blocks // FAN), level + 1
    last = current.select("key", "item")
    rounded = settled.unionByName(last).select(
        "key",
        "item.doc_id",
        "item.size",
        F.round(F.col("item.part") * F.col("item.words")).cast("long").alias("extra"),
    )
    # An equality that holds for null ids too, so that a unit without id finds its share.
    a, b = joined.alias("a"), rounded.alias("b")
    same = (
        F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))
        & (F.col("a.key") == F.col("b.key"))
        & (F.col("a.size") == F.col("b.size"))
    )
    words = F.col("whole") * F.col("a.size") * F.col("a.rows") + F.coalesce("b.extra", F.lit(0))
    return a.join(b, same, "left").select(
        "a.doc_id",
        "a.source",
        "a.key",
        "a.size",
        "a.rows",
        "source_size",
        "target",
        words.cast("long").alias("words"),
    )


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken)``, one row per row of ``docs``."""
    found = plan(docs, weights, share)
    each = F.floor(F.col("words") / F.col("rows"))
    more = F.col("words") - each * F.col("rows")
    numbered = found.withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    taken = each + F.when(F.col("number") <= more, 1).otherwise(0)
    return numbered.select(
        "doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def apply(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE) -> DataFrame:
    """The documents of the mix with ``size, source_size, target, taken`` (none that takes nothing).

    Rows that are one unit share its words as in ``mix``: those left over go to its first texts.
    """
    new = ("size", "source_size", "target", "taken")
    rows = docs.select(
        F.struct(*[c for c in docs.columns if c not in new]).alias("row"),
        F.col("doc_id").alias("id"),
        _source_key(F.col("source")).alias("key"),
        word_count(F.col("text")).alias("size"),
    )
    found = materialize(plan(docs, weights, share).withColumnRenamed("doc_id", "id"), "mix-plan")
    a, b = rows.alias("a"), found.alias("b")
    same = (
        F.col("a.id").eqNullSafe(F.col("b.id"))
        & (F.col("a.key") == F.col("b.key"))
        & (F.col("a.size") == F.col("b.size"))
    )
    number = F.row_number().over(
        Window.partitionBy("a.id", "a.key", "a.size").orderBy(F.xxhash64("a.row.text"))
    )
    each = F.floor(F.col("words") / F.col("rows"))
    more = F.col("words") - each * F.col("rows")
    alone = a.join(b.where("rows = 1"), same).withColumn("taken", F.col("words"))
    several = a.join(b.where("rows > 1"), same).withColumn("number", number)
    several = several.withColumn("taken", each + F.when(F.col("number") <= more, 1).otherwise(0))
    columns = ("a.row.*", "a.size", "source_size", "target", F.col("taken").cast("long").alias("taken"))
    return alone.select(*columns).union(several.select(*columns)).where(F.col("taken") > 0)
