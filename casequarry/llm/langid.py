"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent letter n-grams (one to three letters, with word edges)
of all training texts of a language. A document's own list is compared with every profile: the
distance of an n-gram is how far its rank is out of place, or the length of the list where the
profile lacks it. The nearest profile wins, ties go to the smaller name.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every
text if nothing could be learned; rows without lang or text are not learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casequarry.llm import frames, tokens
from casequarry.storage import materialize

RANKS = 400
UNKNOWN = "und"
# A text below this score resembles no profile; prose of a learned language lies far above it.
LEAST_SCORE = 0.25
# The profiles travel to every task: at most this many languages of ``RANKS`` n-grams each.
MAX_LANGUAGES = 10_000
# Distinct n-grams a task holds per language before it hands its counts on.
HELD = 1 << 20

RESULT = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
)

# Letters of Unicode lie below this code point, so three of them and a length fit into 56 bits.
_LETTER_BITS = 18
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        table = np.zeros(0x110000, bool)
        table[: 1 << _LETTER_BITS] = [chr(c).isalpha() for c in range(1 << _LETTER_BITS)]
        _letters.append(table)
    return _letters[0]


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, n-gram, count)`` of at most 256 texts, sorted by text and n-gram."""
    lowered = [(t or "").lower() for t in texts]
    points = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le"), np.uint32)
    sizes = np.array([len(t) + 1 for t in lowered], np.int64)
    text = np.concatenate([[0], np.repeat(np.arange(len(lowered)), sizes)])
    code = np.where(_is_letter()[points], points, 0).astype(np.uint64)
    used = np.concatenate([[True], (code[1:] != 0) | (code[:-1] != 0)])
    code, text = code[used], text[used].astype(np.uint64) << np.uint64(56)
    one, two, three = (np.uint64(n << 54) for n in (1, 2, 3))
    bits = np.uint64(_LETTER_BITS)
    pair = (code[:-1] << bits) | code[1:]
    triple = (pair[:-1] << bits) | code[2:]
    # The letter that is part of every n-gram gives the text; line ends separate texts.
    letter = code != 0
    either = letter[:-1] | letter[1:]
    owner = np.where(letter[1:], text[1:], text[:-1])
    keys = np.concatenate(
        [
            (text | one | code)[letter],
            (owner | two | pair)[either],
            (text[1:-1] | three | triple)[letter[1:-1]],
        ]
    )
    keys, counts = tokens.counted(keys)
    return (keys >> np.uint64(56)).astype(np.int64), keys & np.uint64((1 << 56) - 1), counts


def ranked(text: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of every text by falling count, then n-gram, and their ranks; ``RANKS`` at most."""
    most = np.uint64((1 << 24) - 1)
    falling = most - np.minimum(counts.astype(np.uint64), most)
    order = np.sort(
        (text.astype(np.uint64) << np.uint64(56))
        | (falling << np.uint64(32))
        | np.arange(len(text), dtype=np.uint64)
    )
    row = (order & np.uint64(0xFFFFFFFF)).astype(np.int64)
    begin = np.searchsorted(text, text[row])
    rank = np.arange(len(row)) - begin
    return row[rank < RANKS], rank[rank < RANKS]


def _groups(batch: pa.RecordBatch, column: str):
    """Texts of a batch, 256 at a time."""
    texts = batch.column(column)
    for low in range(0, len(texts), 256):
        yield low, texts.slice(low, 256).to_pylist()


def profiles(rows: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """``(lang, gram, rank)``: the most frequent n-grams of all rows of every language.

    Counts are summed inside the task, then by n-gram; only the best of each task reach the one
    task that ranks a language.
    """

    def count(batches):
        held: dict[str, list] = {}

        def merged(name):
            parts = held[name]
            keys = np.concatenate([p[0] for p in parts])
            return tokens.counted(keys, np.concatenate([p[1] for p in parts]))

        def emit(name):
            keys, counts = merged(name)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(keys), pa.string()),
                    pa.array(keys.astype(np.int64)),
                    pa.array(counts),
                ],
                names=["lang", "gram", "n"],
            )

        for batch in batches:
            for part in tokens.slices(batch, text):
                names = part.column(lang).to_pylist()
                for low, texts in _groups(part, text):
                    of_text, keys, counts = grams(texts)
                    own = np.array(names[low : low + len(texts)], object)
                    for name in set(own.tolist()):
                        chosen = (own == name)[of_text]
                        pieces = held.setdefault(name, [])
                        pieces.append(tokens.counted(keys[chosen], counts[chosen]))
                        if sum(len(p[0]) for p in pieces) > HELD:
                            held[name] = [merged(name)]
                            if len(held[name][0][0]) > HELD // 2:
                                yield emit(name)
                                del held[name]
        for name in list(held):
            yield emit(name)

    counted = rows.select(lang, text).mapInArrow(count, "lang string, gram long, n long")
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by_count = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    best = totals.withColumn("rank", F.row_number().over(by_count)).where(F.col("rank") <= RANKS)
    return best.select("lang", "gram", (F.col("rank") - 1).alias("rank"))


@dataclass(frozen=True)
class Model:
    languages: list[str]
    known: np.ndarray
    rank_in: np.ndarray

    def distances(self, text: np.ndarray, keys: np.ndarray, counts: np.ndarray, n: int):
        """Out-of-place distance of ``n`` texts to every language, and their list lengths."""
        row, rank = ranked(text, counts)
        keys, text = keys[row], text[row]
        place = np.searchsorted(self.known, keys)
        place[place == len(self.known)] = 0
        rank_in = self.rank_in[place]
        rank_in[self.known[place] != keys] = -1
        away = np.where(rank_in < 0, RANKS, np.abs(rank_in - rank[:, None]))
        begin = tokens.distinct(text)
        total = np.zeros((n, len(self.languages)), np.int64)
        length = np.zeros(n, np.int64)
        if len(begin):
            total[text[begin]] = np.add.reduceat(away, begin, axis=0)
            length[text[begin]] = np.diff(np.concatenate([begin, [len(text)]]))
        return total, length


def fit(rows: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """Learn from all rows that have a language and a text."""
    learned = rows.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    table = materialize(profiles(learned, lang, text), "language-profiles")
    if table.count() > MAX_LANGUAGES * RANKS:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; the label is not a language")
    found = table.toPandas()
    languages = sorted(found["lang"].unique())
    keys = found["gram"].to_numpy().astype(np.uint64)
    known, place = np.unique(keys, return_inverse=True)
    rank_in = np.full((len(known), len(languages)), -1, np.int32)
    of = {name: i for i, name in enumerate(languages)}
    rank_in[place, [of[name] for name in found["lang"]]] = found["rank"].to_numpy()
    return Model(languages, known, rank_in)


def _predict(model: Model, batch: pa.RecordBatch, text: str) -> list:
    names, scores = [], []
    for _, texts in _groups(batch, text):
        if not model.languages:
            names += [UNKNOWN] * len(texts)
            scores += [0.0] * len(texts)
            continue
        total, length = model.distances(*grams(texts), len(texts))
        best = total.argmin(axis=1)
        for i, (language, size) in enumerate(zip(best.tolist(), length.tolist())):
            names.append(model.languages[language] if size else UNKNOWN)
            scores.append(1 - float(total[i, language]) / (RANKS * size) if size else 0.0)
    return [names, scores]


def predict(
    rows: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``rows`` with ``lang_pred`` and ``score``, the share of the possible distance not used."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    return frames.append(rows, RESULT, lambda batch: _predict(shared.value, batch, text), text, keep)


def keep_identified(docs: DataFrame, held_out: Column) -> DataFrame:
    """The documents in a learned language; those without letters, or unlike every profile, go.

    A declared language that differs from the identified one is no reason to drop a document.
    """
    model = fit(docs.where(~held_out))
    rows = frames.numbered(docs)
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    kept = predict(rows, model, rows.columns[docs.columns.index("text")]).where(known)
    return kept.select(*rows.columns).toDF(*docs.columns)
