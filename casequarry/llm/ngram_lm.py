"""Scoring texts with a smoothed n-gram model, as a weighted automaton with failure arcs.

States are the empty history (the root) and every known history of one word. A state has an arc for
each word that followed its history in the training texts, weighted with the smoothed probability;
for every other word its failure arc leads to the root and costs the mass left over:

    p(w | v) = (c(v w) + k * p(w)) / (c(v) + k)      arc v -> w, where c(v w) > 0
               k / (c(v) + k)                        failure arc of v
    p(w)     = (c(w) + 0.1) / (N + 0.1 * (V + 1))    arcs of the root

The strength ``k`` of the prior is the one of ``STRENGTHS`` that makes the training texts likeliest
when each token is left out of the counts that predict it.

The model grows with the corpus and is never held in one place. Tokens are numbered within shards of
bounded size; a shard asks for the counts of its own distinct n-grams, which are summed by hash
bucket over all shards, and gets back the part of the automaton that its texts can reach. Its texts
then pass through it from left to right. The state after a token depends on that token alone, so
many tokens are stepped at once.

Defined results: a null or blank text is one end token; without training tokens every known count
is 0 and the base model gives each token the same probability; repeated rows count and are scored
as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casequarry.llm import tokens
from casequarry.storage import materialize

# Additive smoothing of the base model.
ADDED = 0.1
STRENGTHS = (1.0, 8.0, 64.0, 512.0, 4096.0)
# Tokens of a shard; a longer text is a shard of its own.
SHARD_TOKENS = 2_500_000
# N-gram counts that one task adds up.
BUCKET_KEYS = 3_000_000
# Tokens that take a step together.
STEP_TOKENS = 1 << 18

_END = np.uint64(0xD6E8FEB86659FD93)
_LEFT, _RIGHT = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
_ONE = np.uint64(1)

SHARD = """shard long, n_tokens long, doc_ids array<{id}>, held array<boolean>,
    lengths array<int>, vocabulary binary, low binary, high binary"""


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values))


def _unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


class _Shard:
    """Numbered tokens of some texts; numbers are ranks by frequency within the shard."""

    def __init__(self, vocabulary: np.ndarray, numbers: np.ndarray, lengths, held):
        self.vocabulary = vocabulary
        self.numbers = numbers
        self.lengths = np.asarray(lengths, np.int64)
        self.held = np.asarray(held, bool)
        self.ends = np.cumsum(self.lengths)
        self.training = np.repeat(~self.held, self.lengths)

    def parts(self) -> Iterator["_Shard"]:
        """The texts a few at a time, in the numbers of the whole shard."""
        first = 0
        while first < len(self.lengths):
            begin = self.ends[first] - self.lengths[first]
            last = max(first + 1, int(np.searchsorted(self.ends, begin + STEP_TOKENS, "right")))
            numbers = self.numbers[begin : self.ends[last - 1]]
            lengths, held = self.lengths[first:last], self.held[first:last]
            yield _Shard(self.vocabulary, numbers, lengths, held)
            first = last

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Place of the second token and the code of every pair of neighbours in one text."""
        inner = np.ones(len(self.numbers), bool)
        inner[self.ends - self.lengths] = False
        place = np.flatnonzero(inner)
        size = len(self.vocabulary)
        return place, self.numbers[place - 1] * size + self.numbers[place]

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the distinct words, then pairs, their training counts, and the pair codes.

        Keys of words are odd and keys of pairs even.
        """
        size = len(self.vocabulary)
        words = np.bincount(self.numbers, weights=self.training, minlength=size)
        place, code = self.pairs()
        marked = np.sort((code << 1) | self.training[place])
        code = marked >> 1
        begin = tokens.distinct(code)
        pairs = np.add.reduceat(marked & 1, begin) if len(begin) else marked
        left, right = np.divmod(code[begin], size)
        hashed = tokens.mix(self.vocabulary[left] * _LEFT + self.vocabulary[right] * _RIGHT)
        keys = np.concatenate([self.vocabulary | _ONE, hashed & ~_ONE])
        return keys, np.concatenate([words, pairs]).astype(np.int64), code[begin]

    def row(self, shard: int, ids: pa.Array) -> pa.RecordBatch:
        low = self.numbers.astype(np.uint16)
        high = (self.numbers >> 16).astype(np.uint16)
        columns = [
            pa.array([shard], pa.int64()),
            pa.array([len(self.numbers)], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([self.held.tolist()], pa.list_(pa.bool_())),
            pa.array([self.lengths.tolist()], pa.list_(pa.int32())),
            *(pa.array([_packed(x)], pa.binary()) for x in (self.vocabulary, low, high)),
        ]
        names = ["shard", "n_tokens", "doc_ids", "held", "lengths", "vocabulary", "low", "high"]
        return pa.RecordBatch.from_arrays(columns, names=names)


def _shard_of(row: dict) -> _Shard:
    low = _unpacked(row["low"], np.uint16).astype(np.int64)
    high = _unpacked(row["high"], np.uint16).astype(np.int64)
    vocabulary = _unpacked(row["vocabulary"], np.uint64)
    return _Shard(vocabulary, low | (high << 16), row["lengths"], row["held"])


def _numbered(pieces: list, shard: int) -> pa.RecordBatch:
    ids = pa.concat_arrays([piece[0] for piece in pieces])
    held = np.concatenate([piece[1] for piece in pieces])
    lengths = np.concatenate([piece[2] for piece in pieces])
    hashes = np.concatenate([piece[3] for piece in pieces])
    order = np.argsort(hashes, kind="stable")
    begin = tokens.distinct(hashes[order])
    sizes = np.diff(np.concatenate([begin, [len(order)]]))
    by_size = np.argsort(-sizes, kind="stable")
    number = np.empty(len(begin), np.int64)
    number[by_size] = np.arange(len(begin))
    numbers = np.empty(len(order), np.int64)
    numbers[order] = np.repeat(number, sizes)
    return _Shard(hashes[order][begin][by_size], numbers, lengths, held).row(shard, ids)


def shards(rows: DataFrame) -> DataFrame:
    """Texts ``(doc_id, text, held)`` as rows of ``SHARD``, one per ``SHARD_TOKENS`` tokens."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        pieces, size = [], 0
        for batch in batches:
            for part in tokens.slices(batch):
                found = tokens.words(part.column("text"))
                ends = found.offsets[1:]
                hashes = np.insert(found.hashes, ends, _END)
                held = np.asarray(part.column("held").to_pylist(), bool)
                pieces.append((part.column("doc_id"), held, found.counts() + 1, hashes))
                size += len(hashes)
                if size >= SHARD_TOKENS:
                    yield _numbered(pieces, number)
                    pieces, size, number = [], 0, number + 1
        if pieces:
            yield _numbered(pieces, number)

    schema = SHARD.format(id=rows.schema["doc_id"].dataType.simpleString())
    return rows.select("doc_id", "text", "held").mapInArrow(work, schema)


def _buckets(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys by bucket, then key, and the bounds of the buckets.

    A bucket is a range of keys, so keys sorted once are in order.
    """
    order = np.argsort(keys, kind="stable")
    bounds = np.array([((b << 64) + n - 1) // n for b in range(1, n)], np.uint64)
    at = np.searchsorted(keys[order], bounds)
    return order, np.concatenate([[0], at, [len(keys)]]).astype(np.int64)


def _requests(table: DataFrame, n_buckets: int) -> DataFrame:
    """``(bucket, shard, keys, counts)``: what each shard counted, cut by bucket.

    Keys are sent as planes of their upper 16, middle 16 and lower 32 bits; the upper ones of
    sorted keys compress well, and so do the counts.
    """

    def work(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                keys, counts, _ = _shard_of(row).counts()
                order, at = _buckets(keys, n_buckets)
                keys, counts = keys[order], counts[order].astype(np.uint32)
                planes = (
                    (keys >> np.uint64(48)).astype(np.uint16),
                    (keys >> np.uint64(32)).astype(np.uint16),
                    keys.astype(np.uint32),
                    counts,
                )
                used = np.flatnonzero(np.diff(at))
                for some in np.array_split(used, max(1, len(used) // 16)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(some, pa.int32()),
                            pa.array([row["shard"]] * len(some), pa.int64()),
                            *(
                                pa.array([_packed(p[at[b] : at[b + 1]]) for b in some], pa.binary())
                                for p in planes
                            ),
                        ],
                        names=["bucket", "shard", "upper", "middle", "lower", "counts"],
                    )

    schema = "bucket int, shard long, upper binary, middle binary, lower binary, counts binary"
    columns = ["shard", "n_tokens", "held", "lengths", "vocabulary", "low", "high"]
    return table.select(*columns).mapInArrow(work, schema)


def _answers(requests: DataFrame) -> DataFrame:
    """Corpus counts for the keys of every request, and each bucket's distinct words and tokens."""

    def add_up(rows: pa.Table) -> pa.Table:
        parts = []
        for upper, middle, lower in zip(*(rows[c].to_pylist() for c in ("upper", "middle", "lower"))):
            keys = _unpacked(upper, np.uint16).astype(np.uint64) << np.uint64(48)
            keys |= _unpacked(middle, np.uint16).astype(np.uint64) << np.uint64(32)
            parts.append(keys | _unpacked(lower, np.uint32))
        counts = [_unpacked(x, np.uint32) for x in rows["counts"].to_pylist()]
        known, total = tokens.counted(np.concatenate(parts), np.concatenate(counts).astype(np.int64))
        word = (known & _ONE).astype(bool)
        stats = {"words": int((total[word] > 0).sum()), "tokens": int(total[word].sum())}
        out = [_packed(total[np.searchsorted(known, keys)]) for keys in parts]
        n = len(out)
        return pa.table(
            {
                "shard": rows["shard"],
                "bucket": rows["bucket"],
                "counts": pa.array(out, pa.binary()),
                "words": pa.array([stats["words"]] + [0] * (n - 1), pa.int64()),
                "tokens": pa.array([stats["tokens"]] + [0] * (n - 1), pa.int64()),
            }
        )

    schema = "shard long, bucket int, counts binary, words long, tokens long"
    return requests.groupBy("bucket").applyInArrow(add_up, schema)


class Automaton:
    """The states and arcs that the texts of one shard can reach."""

    def __init__(self, shard: _Shard, counts: np.ndarray, codes: np.ndarray, n: int, v: int):
        size = len(shard.vocabulary)
        self.of_word, self.of_arc, self.arcs = counts[:size], counts[size:], codes
        self.n, self.v = n, v

    def root(self, counts: np.ndarray, left_out: int = 0) -> np.ndarray:
        return (counts + ADDED - left_out) / (self.n - left_out + ADDED * (self.v + 1))

    def traverse(self, shard: _Shard) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: known tokens, base log10 probability, and one per strength, plain and left out."""
        begin = shard.ends - shard.lengths

        def per_text(values):
            return np.add.reduceat(values, begin)

        own = self.of_word[shard.numbers]
        base = self.root(own)
        place, code = shard.pairs()
        state = self.of_word[shard.numbers[place - 1]]
        arc = self.of_arc[np.searchsorted(self.arcs, code)]
        without = np.maximum(self.root(np.maximum(own, 1), 1), 1e-300)
        arc_without, state_without = np.maximum(arc - 1, 0), np.maximum(state - 1, 0)
        scores, left = [], []
        for k in STRENGTHS:
            weight = base.copy()
            weight[place] = (arc + k * base[place]) / (state + k)
            scores.append(per_text(np.log10(weight)))
            weight = without.copy()
            weight[place] = (arc_without + k * without[place]) / (state_without + k)
            left.append(per_text(np.log10(weight)))
        known = per_text((own > 0).astype(np.int64))
        return known, per_text(np.log10(base)), np.stack(scores, 1), np.stack(left, 1)


def _score_shard(n: int, v: int, n_buckets: int):
    def work(texts: pa.Table, answers: pa.Table) -> pa.Table:
        row = texts.to_pylist()[0]
        shard = _shard_of(row)
        keys, _, codes = shard.counts()
        order, at = _buckets(keys, n_buckets)
        counts = np.zeros(len(keys), np.int64)
        for bucket, found in zip(answers["bucket"].to_pylist(), answers["counts"].to_pylist()):
            counts[order[at[bucket] : at[bucket + 1]]] = _unpacked(found, np.int64)
        automaton = Automaton(shard, counts, codes, n, v)
        stepped = [automaton.traverse(part) for part in shard.parts()]
        known, base, scores, left = (np.concatenate(x) for x in zip(*stepped))
        return pa.table(
            {
                "doc_id": texts["doc_ids"][0].values,
                "held_out": pa.array(shard.held),
                "n_tokens": pa.array(shard.lengths),
                "n_known": pa.array(known),
                "train_tokens": pa.array(np.full(len(known), n, np.int64)),
                "base_score": pa.array(base),
                "scores": pa.array(scores.tolist(), pa.list_(pa.float64())),
                "left_out": pa.array(left.tolist(), pa.list_(pa.float64())),
            }
        )

    return work


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Learn from the texts of ``docs (doc_id, text)`` that are not held out, and score all; ids of any type.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, strength``.
    """
    rows = docs.select("doc_id", "text", held_out.alias("held"))
    table = materialize(shards(rows), "lm-shards")
    size = table.agg(F.sum("n_tokens")).first()[0] or 0
    n_buckets = max(12, -(-2 * size // BUCKET_KEYS))
    answers = materialize(_answers(_requests(table, n_buckets)), "lm-counts")
    total = answers.agg(F.sum("tokens").alias("n"), F.sum("words").alias("v")).first()
    scored = materialize(
        table.groupBy("shard")
        .cogroup(answers.select("shard", "bucket", "counts").groupBy("shard"))
        .applyInArrow(
            _score_shard(total["n"] or 0, total["v"] or 0, n_buckets),
            f"""doc_id {rows.schema["doc_id"].dataType.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long,
               base_score double, scores array<double>, left_out array<double>""",
        ),
        "lm-scores",
    )
    fits = scored.where(~F.col("held_out")).agg(
        *[F.sum(F.round(F.col("left_out")[i], 3)) for i in range(len(STRENGTHS))]
    )
    likely = [x if x is not None else 0.0 for x in fits.first()]
    best = max(range(len(STRENGTHS)), key=lambda i: likely[i])
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        F.col("scores")[best].alias("score"),
        F.lit(STRENGTHS[best]).alias("strength"),
    )
