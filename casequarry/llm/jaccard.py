"""N-gram Jaccard join: which documents share at least ``PERCENT`` hundredths of their shingles.

1. Equal shingle sets are one class; copies meet in a count and are never paired.
2. Two similar sets share the ``k`` first shingles of what they have in common, in any common order,
   within prefixes of ``n - ceil(0.75 n) + k`` shingles, ``k`` being that of the larger set. Shingles of
   frequent slots come last, so passages that many documents share stay out of prefixes. Classes
   that share fewer prefix shingles with others than ``k`` have no partner and go; shingles that stand
   in the prefixes of the same classes are one. This deals the classes out to tasks and loses no pair.
3. Within the classes that share a prefix shingle, one leads. Members whose count-vector bound
   allows it are verified against their leader on the whole sets; linked ones are contracted. A few
   rounds take groups of near copies together without pairing them all; they end early when a round
   leaves nearly as much open as it found.
4. Of the shingles whose classes are still in several components a class needs all but the ``k - 1``
   with the most pairs to compare, as a partner shares ``k``. For the others, count vectors go into
   R-trees, which are joined under the bound; the surviving pairs of different components are verified
   exactly, unless their ends are connected by then. After this every pair is linked, connected
   through links, or refuted.

Shingles and classes are 64-bit hashes. Defined results: a text without words (or null) has no
shingles, links with nothing and is a component of its own; a row without id takes part, and a
component is named by the smallest id in it (null if it has none); repeated rows are copies.
"""

from __future__ import annotations

import uuid
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casequarry.llm import frames, tokens
from casequarry.llm.components import components
from casequarry.llm.count_rtree import GROUPS, RTree, count_vector, join, needed, unlimited
from casequarry.storage import materialize, shared_root

SHINGLE = 5
PERCENT = 75
# Rounds of leaders at most; after one that leaves more than this share of the rows open, the trees follow.
ROUNDS, LEFT_OPEN = 5, 0.9
# Slots in which shingle frequencies are counted; they only choose the common order.
SLOT_BITS = 20
SLOT_BLOCKS = 64
# Shingles that the prefixes of a pair share, unless its sets are too small.
SHARED = 32
# Of them so many are not counted on: shingles of one class may be one key, as keys have 32 bits in a bucket.
SPARE = 1
# A shingle is frequent from this multiple of the mean slot and this many texts on.
FREQUENT_TIMES, FREQUENT_LEAST = 8, 50_000
# Postings of a bucket, postings a task holds back, members of a group that are compared at once.
BUCKET = 750_000
HELD = 1 << 19
GROUP = 1024
# Blocks that a group is cut into, more only where a block would have more members than this.
GRID, BLOCK = 4, 16_384
# Rows of R-trees of the keys of one class that go to one bin.
TREE_ROWS = 6_000
FILTER_BITS = 24

_SALT = np.uint64(0x2545F4914F6CDD1D)


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text; a short text is one shingle."""
    found = tokens.words(texts)
    hashes, complete = tokens.windows(found, size)
    out = []
    for i, (low, high) in enumerate(zip(found.offsets[:-1].tolist(), found.offsets[1:].tolist())):
        if high - low >= size:
            own = np.sort(hashes[low : high - size + 1])
            out.append(own[tokens.distinct(own)])
        elif high > low:
            out.append(np.array([tokens.whole(found.of(i))]))
        else:
            out.append(found.hashes[:0])
    return out


def _class_of(members: np.ndarray) -> int:
    total = np.add.reduce(tokens.mix(members ^ _SALT)) + np.uint64(len(members))
    return int(tokens.mix(np.array([total]))[0].astype(np.int64))


def _least_shared(n):
    """Prefix shingles that a set of ``n`` shares with any similar set.

    They have ``PERCENT`` hundredths of the larger set at least in common, and prefixes that are not
    whole sets leave out all but ``SHARED`` shingles of so many.
    """
    return np.minimum(SHARED, -(-PERCENT * n // 100))


def _counted_on(n: Column) -> Column:
    """Weight of the keys that a class of ``n`` shares with any similar class."""
    least = F.least(F.ceil(F.lit(PERCENT) * n / 100), F.lit(SHARED))
    return F.greatest(least - SPARE, F.lit(1))


def _prefix(members: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """First shingles in the common order: by level of the slot's frequency, then by hash."""
    n = len(members)
    size = n - -(-PERCENT * n // 100) + int(_least_shared(n))
    level = frequency[members >> np.uint64(64 - SLOT_BITS)]
    if not level.any():
        return members[:size]
    return members[np.argsort(level, kind="stable")[:size]]


def profiles(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n, class)`` of every row, and blocks of slot frequencies in the same table."""
    key = docs.schema[doc_id].dataType.simpleString()

    def work(batches):
        slots = np.zeros(1 << SLOT_BITS, np.uint32)
        id_type = None
        for batch in batches:
            for part in tokens.slices(batch, text):
                ids = part.column(doc_id)
                id_type = ids.type
                sets = shingle_sets(part.column(text))
                if any(len(s) for s in sets):
                    merged = np.concatenate(sets) >> np.uint64(64 - SLOT_BITS)
                    slots += np.bincount(merged.astype(np.int64), minlength=len(slots)).astype(
                        np.uint32
                    )
                n = len(sets)
                classes = [_class_of(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(classes, pa.int64()),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.binary()),
                    ],
                    names=["doc_id", "n", "class", "block", "slots"],
                )
        if id_type is not None and slots.any():
            parts = np.split(np.minimum(slots, 65_535).astype(np.uint16), SLOT_BLOCKS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(SLOT_BLOCKS, id_type),
                    pa.nulls(SLOT_BLOCKS, pa.int64()),
                    pa.nulls(SLOT_BLOCKS, pa.int64()),
                    pa.array(range(SLOT_BLOCKS), pa.int32()),
                    pa.array([p.tobytes() for p in parts], pa.binary()),
                ],
                names=["doc_id", "n", "class", "block", "slots"],
            )

    schema = f"doc_id {key}, n long, class long, block int, slots binary"
    return docs.select(doc_id, text).mapInArrow(work, schema)


def _levels(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Level of every slot (how many doublings above the mean), and which slots are frequent.

    The driver holds the sums once, as 32-bit numbers, and works on a block of them at a time.
    """

    def add_up(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.frombuffer(part.as_buffer(), np.uint16).astype(np.int64)
                totals[block] = totals[block] + values if block in totals else values
        for block, values in totals.items():
            values = np.minimum(values, 0xFFFFFFFF).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([values.tobytes()], pa.binary())],
                names=["block", "slots"],
            )

    parts = table.where(F.col("block").isNotNull()).select("block", "slots")
    found = parts.repartition("block").mapInArrow(add_up, "block int, slots binary").collect()
    blocks = {row["block"]: np.frombuffer(row["slots"], np.uint32) for row in found}
    total = sum(int(counts.sum(dtype=np.int64)) for counts in blocks.values())
    mean = max(1.0, total / (1 << SLOT_BITS))
    level, frequent = np.zeros(1 << SLOT_BITS, np.uint8), np.zeros(1 << SLOT_BITS, bool)
    width = (1 << SLOT_BITS) // SLOT_BLOCKS
    for block, counts in blocks.items():
        own = slice(block * width, (block + 1) * width)
        level[own] = np.floor(np.log2(np.maximum(counts / mean, 1)))
        frequent[own] = counts > FREQUENT_TIMES * mean + FREQUENT_LEAST
    return level, frequent


def _postings(docs: DataFrame, text: str, shared, n_buckets: int) -> DataFrame:
    """``(bucket, keys, places, classes)``: prefix shingles, packed by bucket; copies once per task.

    Within a bucket 32 bits of a shingle's hash tell it apart; ``places`` are those of its class in
    ``classes``. Frequent shingles go to buckets of their own, dealt out by class as well.
    """

    def work(batches):
        level, frequent = shared.value
        seen: set[int] = set()
        keys, owners, classes, held = [], [], [], 0

        def emit():
            key, owner = np.concatenate(keys), np.concatenate(owners)
            known = np.array(classes, np.int64)
            scrambled = tokens.mix(key)
            bucket = (scrambled % np.uint64(n_buckets)).astype(np.int64)
            often = frequent[key >> np.uint64(64 - SLOT_BITS)]
            if often.any():
                dealt = tokens.mix(key[often] ^ known[owner[often]].astype(np.uint64))
                bucket[often] = n_buckets + (dealt % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, owner = bucket[order], owner[order]
            short = (scrambled[order] >> np.uint64(32)).astype(np.uint32)
            begin = tokens.distinct(bucket)
            out: tuple[list, list, list] = ([], [], [])
            for low, high in zip(begin, np.concatenate([begin[1:], [len(bucket)]])):
                own, place = np.unique(owner[low:high], return_inverse=True)
                for column, values in zip(out, (short[low:high], place.astype(np.uint32), known[own])):
                    column.append(values.tobytes())
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[begin], pa.int32()), *(pa.array(x, pa.binary()) for x in out)],
                names=["bucket", "keys", "places", "classes"],
            )

        for batch in batches:
            for part in tokens.slices(batch, text):
                for members in shingle_sets(part.column(text)):
                    if not len(members):
                        continue
                    cls = _class_of(members)
                    if cls in seen:
                        continue
                    if len(seen) < HELD:
                        seen.add(cls)
                    prefix = _prefix(members, level)
                    keys.append(prefix)
                    owners.append(np.full(len(prefix), len(classes), np.int32))
                    classes.append(cls)
                    held += len(prefix)
                if held > HELD:
                    yield emit()
                    keys, owners, classes, held = [], [], [], 0
        if held:
            yield emit()

    schema = "bucket int, keys binary, places binary, classes binary"
    return docs.select(text).mapInArrow(work, schema)


def _shared_keys(postings: DataFrame, n_buckets: int) -> DataFrame:
    """``(key, class)`` of the shingles that stand in the prefixes of several classes."""

    def work(rows: pa.Table) -> pa.Table:
        bucket = rows["bucket"][0].as_py()
        key = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["keys"].to_pylist()])
        cls = np.concatenate(
            [
                np.frombuffer(known, np.int64)[np.frombuffer(place, np.uint32)]
                for known, place in zip(rows["classes"].to_pylist(), rows["places"].to_pylist())
            ]
        )
        order = np.argsort(key, kind="stable")
        key, cls = key[order], cls[order]
        sizes = np.diff(np.concatenate([tokens.distinct(key), [len(key)]]))
        if bucket < n_buckets:
            several = np.repeat(sizes > 1, sizes)
            key, cls = key[several], cls[several]
        order = np.lexsort((cls, key))
        key, cls = key[order], cls[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
        key, cls = key[new], cls[new]
        if bucket < n_buckets:
            # Copies in other tasks made some of them look shared.
            sizes = np.diff(np.concatenate([tokens.distinct(key), [len(key)]]))
            several = np.repeat(sizes > 1, sizes)
            key, cls = key[several], cls[several]
            high = bucket
        else:
            high = n_buckets
        return pa.table({"key": (np.int64(high) << 32) | key.astype(np.int64), "class": cls})

    return postings.groupBy("bucket").applyInArrow(work, "key long, class long")


def _plausible(keys: DataFrame, sizes: DataFrame) -> DataFrame:
    """The keys of classes that share enough of them with others; the rest has no partner."""
    enough = (
        keys.groupBy("class")
        .agg(F.count(F.lit(1)).alias("shared"))
        .join(sizes, "class")
        .where(F.col("shared") >= _counted_on(F.col("n")))
        .select("class")
    )
    left = keys.join(enough, "class")
    several = left.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > 1)
    return left.join(several.select("key"), "key").select("key", "class")


def _merged(keys: DataFrame) -> DataFrame:
    """``(key, class, weight)``: of the keys with the same classes one, with their number."""
    alike = keys.groupBy("key").agg(
        F.bit_xor(F.xxhash64("class")).alias("one"),
        F.bit_xor(F.xxhash64("class", F.lit(1))).alias("two"),
        F.count(F.lit(1)).alias("held"),
    )
    first = alike.groupBy("one", "two", "held").agg(
        F.min("key").alias("key"), F.count(F.lit(1)).alias("weight")
    )
    return keys.join(first.select("key", "weight"), "key")


def _sets(docs: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """``(class, n, vector, members)`` of the wanted classes.

    A bitmap of the hashes of the wanted classes, of fixed size, spares most other texts the way.
    """
    slot = F.shiftrightunsigned("class", 64 - FILTER_BITS)
    bits = wanted.groupBy(F.shiftright(slot, 15).cast("int").alias("bucket")).agg(
        F.bitmap_construct_agg(slot.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits")
    )
    bitmap = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in bits.toLocalIterator():
        bitmap[row["bucket"] << 12 : (row["bucket"] + 1) << 12] = np.frombuffer(row["bits"], np.uint8)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def work(batches):
        seen: set[int] = set()
        for batch in batches:
            for part in tokens.slices(batch, text):
                out: tuple[list, list, list, list] = ([], [], [], [])
                for members in shingle_sets(part.column(text)):
                    if not len(members):
                        continue
                    cls = _class_of(members)
                    place = (cls & (2**64 - 1)) >> (64 - FILTER_BITS)
                    if cls in seen or not shared.value[place >> 3] >> (place & 7) & 1:
                        continue
                    if len(seen) < HELD:
                        seen.add(cls)
                    row = (cls, len(members), count_vector(members).tobytes(), members.tobytes())
                    for column, value in zip(out, row):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, _SET_TYPES)], names=_SET_NAMES
                )

    found = docs.select(text).mapInArrow(
        work, "class long, n long, vector binary, members binary"
    )
    return found.join(wanted, "class", "left_semi").dropDuplicates(["class"])


def _bucketed(rows: DataFrame, key: str, name: str) -> DataFrame:
    """A written table in buckets of ``key``, which joins on ``key`` need not shuffle again."""
    spark = rows.sparkSession
    name = f"casequarry_{name}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        rows.write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", f"{shared_root(spark)}/casequarry/{name}")
        .saveAsTable(name)
    )
    return spark.table(name)


_SET_NAMES = ["class", "n", "vector", "members"]
_SET_TYPES = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]


def _vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Count vectors as rows of a matrix, without a copy of each."""
    array = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    if not len(array):
        return np.zeros((0, GROUPS), np.uint16)
    _, offsets, data = array.buffers()
    begin = np.frombuffer(offsets, np.int32)[array.offset]
    size = 2 * GROUPS * len(array)
    return np.frombuffer(data, np.uint8)[begin : begin + size].view(np.uint16).reshape(-1, GROUPS)


def _side(sets: DataFrame, end: str, *columns: str) -> DataFrame:
    """One end of a pair: ``class`` as ``end``, and the columns with its name behind them."""
    return sets.select(
        F.col("class").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns]
    )


def _bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` that the count vectors do not refute."""

    def work(batches):
        for batch in batches:
            a, b = (_vectors(batch.column(c)) for c in ("vector_a", "vector_b"))
            size_a, size_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            shared = np.minimum(unlimited(a), unlimited(b)).sum(axis=1, dtype=np.int64)
            yield batch.select(["a", "b"]).filter(
                pa.array(shared >= needed(size_a, size_b, PERCENT))
            )

    sizes = (100 * F.least("n_a", "n_b")) >= PERCENT * F.greatest("n_a", "n_b")
    joined = pairs.join(_side(sets, "a", "n", "vector"), "a").join(
        _side(sets, "b", "n", "vector"), "b"
    )
    return joined.where(sizes).mapInArrow(work, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar enough."""

    def work(batches):
        for batch in batches:
            links = []
            for a, b in zip(batch.column("members_a"), batch.column("members_b")):
                left, right = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
                both = np.sort(np.concatenate([left, right]))
                shared = int((both[1:] == both[:-1]).sum())
                links.append(100 * shared >= PERCENT * (len(both) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(links, pa.bool_()))

    joined = pairs.join(_side(sets, "a", "members"), "a").join(_side(sets, "b", "members"), "b")
    return joined.mapInArrow(work, "a long, b long")


def _labelled(keys: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``(key, class, label)`` of the keys whose classes are in several components."""
    if labels is None:
        return keys.withColumn("label", F.col("class"))
    known = labels.select(F.col("node").alias("class"), "label")
    marked = keys.join(known, "class", "left").withColumn("label", F.coalesce("label", "class"))
    return _open(marked).select("key", "class", "weight", "label")


def _open(marked: DataFrame) -> DataFrame:
    """The rows of the keys whose classes are in several components."""
    several = (
        marked.groupBy("key")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where(F.col("low") != F.col("high"))
    )
    return marked.join(several.select("key"), "key")


def _cheapest(marked: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(key, class, label)`` of keys of which any two similar classes of different components share one.

    Keys are ordered by the pairs they make. Classes that are similar share the weight that is counted
    on, so the first key they share stays if each of them does without less than that at the end.
    """
    per_label = marked.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    total, most = F.sum("n"), F.max("n")
    pairs = per_label.groupBy("key").agg(((total - most) * total).alias("pairs"))
    from_end = Window.partitionBy("class").orderBy(F.desc("pairs"), F.desc("key"))
    left = (
        marked.join(pairs, "key")
        .withColumn("behind", F.sum("weight").over(from_end))
        .join(sizes, "class")
        .where(F.col("behind") >= _counted_on(F.col("n")))
        .select("key", "class", "label")
    )
    return _open(materialize(left, "jaccard-left")).select("key", "class", "label")


def _led(marked: DataFrame, number: int) -> DataFrame:
    """``(a, b)``: each class with the leader it shares most prefix shingles with.

    A shingle is led by the smallest of its classes under a hash that changes with the round.
    """
    rank = F.struct(F.xxhash64("class", F.lit(number)), F.col("class"), F.col("label"))
    leader = marked.groupBy("key").agg(F.min(rank).alias("first"))
    met = (
        marked.join(leader, "key")
        .where(F.col("label") != F.col("first.label"))
        .groupBy(F.col("class").alias("a"), F.col("first.class").alias("b"))
        .agg(F.sum("weight").alias("n"))
    )
    return met.groupBy("a").agg(F.max_by("b", F.struct("n", "b")).alias("b"))


def _met_before(own: pa.Array, key: int, i: np.ndarray, j: np.ndarray):
    """Which pairs of rows of ``own``, lists of keys, also share a key below ``key``."""
    flat = own.flatten().to_numpy()
    row = np.repeat(np.arange(len(own)), np.asarray(own.value_lengths()))
    row, flat = row[flat < key], flat[flat < key]
    if not len(flat):
        return np.zeros(len(i), bool)
    known, column = np.unique(flat, return_inverse=True)
    held = np.zeros((len(own), len(known)), bool)
    held[row, column] = True
    held = np.packbits(held, axis=1)
    met = np.zeros(len(i), bool)
    for start in range(0, len(i), 100_000):
        part = slice(start, start + 100_000)
        met[part] = (held[i[part]] & held[j[part]]).any(axis=1)
    return met


def _rest(marked: DataFrame, sets: DataFrame, size: int) -> DataFrame:
    """Pairs of different components that share a key and survive the joined R-trees.

    Of the components of a key all but the largest are minor, and only their members are compared
    with the others, so a large group of linked copies is not compared with itself. Members and
    minor ones are cut into a few blocks, and a spot is a block of each; a row goes to a spot for every
    block of the other side, so the rows grow with the members. A spot is compared by parts of
    ``GROUP``. A pair that shares several keys is looked at under the smallest. Keys go to a bin by the smallest hash of their classes, so keys with
    much the same classes meet there and a class sends its vector to few bins, once to each. Returns
    ``(bin, classes, left, right)``: a row per bin with the pairs as places in its list of classes.
    """
    bins = max(48, 4 * size // TREE_ROWS)

    def cut(members):
        few = F.least(F.ceil(members / GROUP), F.lit(GRID))
        return F.greatest(few, F.ceil(members / BLOCK)).cast("int")

    tally = marked.groupBy("key", "label").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.xxhash64("class")).alias("home")
    )
    largest = tally.groupBy("key").agg(
        F.max_by("label", F.struct("n", "label")).alias("major"),
        F.sum("n").alias("size"),
        F.max("n").alias("most"),
        F.min("home").alias("home"),
    )
    loads = largest.groupBy("home").agg(F.ceil(F.sum("size") / TREE_ROWS).alias("parts"))
    part = F.pmod(F.xxhash64("key"), F.col("parts"))
    largest = largest.join(loads, "home").withColumn("home", F.xxhash64("home", part))
    rows = marked.join(largest, "key").select(
        "key",
        "class",
        "label",
        (F.col("label") != F.col("major")).alias("minor"),
        cut(F.col("size")).alias("blocks"),
        cut(F.col("size") - F.col("most")).alias("minor_blocks"),
        "home",
    )

    def one(blocks):
        return F.array(F.pmod(F.xxhash64("class"), blocks).cast("int"))

    def every(blocks):
        return F.sequence(F.lit(0), blocks - 1)

    # A minor row is there twice, as one that asks and as one of all members.
    asks, blocks, minor_blocks = (F.col(c) for c in ("asks", "blocks", "minor_blocks"))
    roles = F.when(F.col("minor"), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    held = rows.select("*", F.explode(roles).alias("asks"))
    of_all = F.when(asks, every(blocks)).otherwise(one(blocks))
    of_minor = F.when(asks, one(minor_blocks)).otherwise(every(minor_blocks))
    held = held.select("*", F.explode(of_all).alias("block"))
    held = held.select("*", F.explode(of_minor).alias("minor_block"))
    spot = F.xxhash64("key", "block", "minor_block")
    place = F.when((blocks == 1) & (minor_blocks == 1), F.col("home")).otherwise(spot)
    dealt = held.select(
        "key", "class", "label", spot.alias("spot"), "asks", F.pmod(place, F.lit(bins)).alias("bin")
    )
    dealt = materialize(dealt, "jaccard-dealt")
    keys = marked.groupBy("class").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    described = sets.select("class", "n", "vector").join(keys, "class")
    homes = dealt.select(F.col("bin").alias("home"), F.col("class").alias("member")).distinct()
    described = homes.join(described, F.col("member") == F.col("class")).select(
        "home", "member", "n", "vector", "keys"
    )

    def parts(rows, size):
        rows = rows[np.argsort(size, kind="stable")]
        return [rows[low : low + GROUP] for low in range(0, len(rows), GROUP)]

    def work(table: pa.Table, held: pa.Table) -> pa.Table:
        spot = table["spot"].to_numpy()
        order = np.argsort(spot, kind="stable")
        spot = spot[order]
        begin = tokens.distinct(spot)
        cls, label, asks, key = (
            table[c].to_numpy()[order] for c in ("class", "label", "asks", "key")
        )
        known = held["member"].to_numpy()
        by_class = np.argsort(known)
        place = by_class[np.searchsorted(known, cls, sorter=by_class)]
        sizes, vectors = held["n"].to_numpy(), _vectors(held["vector"])
        keys = pa.concat_arrays(held["keys"].chunks)
        out: tuple[list, list] = ([], [])
        for low, high in zip(begin, np.concatenate([begin[1:], [len(order)]])):
            rows = np.arange(low, high)
            left, right = rows[asks[rows]], rows[~asks[rows]]
            if not len(left) or not len(right):
                continue
            for left, right in product(parts(left, sizes[place[left]]), parts(right, sizes[place[right]])):
                trees = (RTree(vectors[place[x]], sizes[place[x]]) for x in (left, right))
                i, j = join(*trees, PERCENT)
                apart = label[left[i]] != label[right[j]]
                i, j = i[apart], j[apart]
                own = keys.take(pa.array(place[np.concatenate([left, right])]))
                new = ~_met_before(own, key[low], i, len(left) + j)
                for column, values in zip(out, (place[left[i[new]]], place[right[j[new]]])):
                    column.append(values)
        empty = np.zeros(0, np.int64)
        a, b = (np.concatenate([empty, *x]) for x in out)
        # Each pair once, as the places of its classes among those that have pairs here.
        low, high = np.divmod(np.unique(np.minimum(a, b) * len(known) + np.maximum(a, b)), max(len(known), 1))
        used, at = np.unique(np.concatenate([low, high]), return_inverse=True)
        packed = [at[: len(low)].astype(np.uint32).tobytes(), at[len(low) :].astype(np.uint32).tobytes()]
        return pa.table(
            {
                "bin": pa.array([table["bin"][0].as_py()], pa.int64()),
                "classes": pa.array([known[used].tolist()], pa.list_(pa.int64())),
                "left": pa.array(packed[:1], pa.binary()),
                "right": pa.array(packed[1:], pa.binary()),
            }
        ).slice(0, min(1, len(low)))

    return (
        dealt.groupBy("bin")
        .cogroup(described.groupBy("home"))
        .applyInArrow(work, "bin long, classes array<bigint>, left binary, right binary")
    )


def _verified_together(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Links that connect what all similar pairs of ``_rest`` connect.

    The pairs of a bin are verified in one place, where every set is needed once, and a pair
    whose ends are connected already is passed over.
    """
    asked_for = pairs.select(F.col("bin").alias("home"), F.explode("classes").alias("member"))
    needed_sets = asked_for.join(
        sets.select("class", "members"), F.col("member") == F.col("class")
    ).select("home", "member", "members")

    def work(asked: pa.Table, held: pa.Table) -> pa.Table:
        members = {
            cls: np.frombuffer(data.as_buffer(), np.uint64)
            for cls, data in zip(held["member"].to_pylist(), held["members"].combine_chunks())
        }
        parent = dict.fromkeys(members)

        def root(node):
            while parent[node] is not None:
                above = parent[node]
                if parent[above] is not None:
                    parent[node] = parent[above]
                node = above
            return node

        out: tuple[list, list] = ([], [])
        for row in asked.to_pylist():
            left, right = (np.frombuffer(row[c], np.uint32) for c in ("left", "right"))
            classes = row["classes"]
            for i, j in zip(left, right):
                a, b = classes[i], classes[j]
                top_a, top_b = root(a), root(b)
                if top_a == top_b:
                    continue
                both = np.sort(np.concatenate([members[a], members[b]]))
                shared = int((both[1:] == both[:-1]).sum())
                if 100 * shared >= PERCENT * (len(both) - shared):
                    parent[max(top_a, top_b)] = min(top_a, top_b)
                    out[0].append(a)
                    out[1].append(b)
        return pa.table({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64())})

    return (
        pairs.groupBy("bin").cogroup(needed_sets.groupBy("home")).applyInArrow(work, "a long, b long")
    )


def link(docs: DataFrame, text: str, table: DataFrame) -> DataFrame | None:
    """``(node, label)``: the component of every class that is linked with another one."""
    total = table.agg(F.sum("n")).first()[0] or 0
    n_buckets = max(12, int(total * (100 - PERCENT) // 100 // BUCKET))
    shared = docs.sparkSession.sparkContext.broadcast(_levels(table))
    postings = _postings(docs, text, shared, n_buckets)
    keys = materialize(_shared_keys(postings, n_buckets), "jaccard-keys")
    shared.destroy()
    # Shingles whose frequent buckets hold one class are no keys; the first pass drops them too.
    sizes = table.where(F.col("class").isNotNull()).select("class", "n").distinct()
    sizes = materialize(sizes.join(keys.select("class"), "class", "left_semi"), "jaccard-sizes")
    for _ in range(2):
        keys = materialize(_plausible(keys, sizes), "jaccard-keys")
    keys = materialize(_merged(keys), "jaccard-keys")
    if keys.isEmpty():
        return None
    sets = _bucketed(_sets(docs, text, keys.select("class").distinct()), "class", "sets")
    labels, before = None, None
    for number in range(ROUNDS + 1):
        marked = materialize(_labelled(keys, labels), "jaccard-open")
        size = marked.count()
        if not size:
            break
        last = number == ROUNDS or (before is not None and size > LEFT_OPEN * before)
        if last:
            needed_keys = materialize(_cheapest(marked, sizes), "jaccard-needed")
            size = needed_keys.count()
            pairs = materialize(_rest(needed_keys, sets, size), "jaccard-rest")
            similar = _verified_together(pairs, sets)
        else:
            pairs = materialize(_bounded(_led(marked, number), sets), "jaccard-led")
            similar = _verified(pairs, sets)
        links = materialize(similar, "jaccard-links")
        if not links.isEmpty():
            labels = _joined(labels, links)
        if last:
            break
        before = size
    return labels


def _joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` after further links; only links between different components are followed."""
    if labels is None:
        return materialize(components(links), "jaccard-labels")
    known = [labels.select(F.col("node").alias(c), F.col("label").alias(f"of_{c}")) for c in "ab"]
    ends = links.join(known[0], "a", "left").join(known[1], "b", "left")
    ends = materialize(
        ends.select("a", "b", *[F.coalesce(f"of_{c}", c).alias(f"of_{c}") for c in "ab"]),
        "jaccard-ends",
    )
    merged = components(ends.select(F.col("of_a").alias("a"), F.col("of_b").alias("b")))
    merged = materialize(merged, "jaccard-merged").toDF("label", "root")
    new = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    new = new.join(labels, "node", "left_anti").withColumn("label", F.col("node"))
    every = labels.unionByName(new).join(merged, "label", "left")
    return materialize(
        every.select("node", F.coalesce("root", "label").alias("label")), "jaccard-labels"
    )


def cluster(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, class, label, component_id)`` of every row of ``docs``.

    ``label`` names the component where no row of it has an id.
    """
    table = materialize(profiles(docs, doc_id, text), "jaccard-profiles")
    rows = table.where(F.col("block").isNull()).select("doc_id", "n", "class")
    filled = rows.where(F.col("class").isNotNull())
    labels = link(docs, text, table)
    least = filled.groupBy("class").agg(F.min("doc_id").alias("least"))
    if labels is None:
        of_class = least.select("class", "class", "least").toDF("class", "label", "component_id")
    else:
        marked = least.join(labels.select(F.col("node").alias("class"), "label"), "class", "left")
        marked = materialize(
            marked.select("class", "least", F.coalesce("label", "class").alias("label")),
            "jaccard-classes",
        )
        smallest = marked.groupBy("label").agg(F.min("least").alias("component_id"))
        of_class = marked.join(smallest, "label").select("class", "label", "component_id")
    blank = rows.where(F.col("class").isNull()).select(
        "doc_id", "n", "class", F.lit(None).cast("long").alias("label"), "doc_id"
    )
    out = ("doc_id", "n_shingles", "class", "label", "component_id")
    named = filled.join(of_class, "class").select("doc_id", "n", "class", "label", "component_id")
    return named.toDF(*out).unionByName(blank.toDF(*out))


def _class_column(texts: pa.Array) -> list:
    return [_class_of(s) if len(s) else None for s in shingle_sets(texts)]


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest id, and all without words.

    Of repeated rows with that id and the same words one stays. The columns stay as they are. A row
    with an id of its own is known by it; only the others have their texts read once more. Rows are
    left out by the ids that do not simply stay, the smaller list where most rows stay: while Spark
    broadcasts it, no text is shuffled.
    """
    found = materialize(cluster(docs), "jaccard-rows")
    known_by_id = F.col("doc_id").eqNullSafe(F.col("component_id"))
    groups = found.where(F.col("class").isNotNull())
    several = found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.bool_or(F.col("class").isNull() | known_by_id).alias("stays"),
    )
    others = several.where((F.col("rows") > 1) | ~F.col("stays")).withColumnRenamed("doc_id", "own")
    others = materialize(others, "jaccard-other-ids")
    own = F.col("doc_id").eqNullSafe(F.col("own"))
    kept = docs.join(others.select("own"), own, "left_anti")
    repeated_ids = others.where(F.col("rows") > 1).select("own")
    return kept.unionByName(_one_of_repeated(docs.join(repeated_ids, own, "left_semi"), groups))


def _one_of_repeated(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Of rows that share their ids those that :func:`keep_one` keeps."""
    kept = (
        groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("label", "component_id")
        .agg(F.min("class").alias("chosen"), F.count(F.lit(1)).alias("rows"))
    )
    rows = frames.numbered(docs)
    own, text = (rows.columns[docs.columns.index(c)] for c in ("doc_id", "text"))
    field = T.StructType([T.StructField("class", T.LongType())])
    marked = frames.append(rows, field, lambda batch: [_class_column(batch.column(text))], text)
    blank = marked.where(F.col("class").isNull()).select(*rows.columns)
    same = F.col(own).eqNullSafe(F.col("component_id")) & (F.col("class") == F.col("chosen"))
    chosen = marked.join(kept, same)
    single = chosen.where(F.col("rows") == 1).select(*rows.columns)
    repeated = chosen.where(F.col("rows") > 1).dropDuplicates([own, "class"]).select(*rows.columns)
    return blank.unionByName(single).unionByName(repeated).toDF(*docs.columns)
