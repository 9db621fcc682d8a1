"""The parts that run inside tasks, without Spark."""

from __future__ import annotations

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from casequarry.llm import (
    components,
    count_rtree,
    decontaminate,
    frames,
    jaccard,
    langid,
    lsh_forest,
    pii,
    tokens,
    warc,
)
from casequarry.llm.count_rtree import RTree, count_vector, join
from casequarry.llm.fm_index import FmIndex, suffix_order


@pytest.mark.parametrize("window", [7, 50, 1 << 20])
@pytest.mark.parametrize("kind", ["space", "alnum"])
def test_words_of_random_texts(monkeypatch, window, kind):
    monkeypatch.setattr(tokens, "WINDOW", window)
    rng = random.Random(window)
    texts = [None, "", " ", "Ab aB", "x" * 90, "É é", "a\x1cb"]
    for _ in range(150):
        texts.append("".join(rng.choice("aBÉ-1Z \t\n") for _ in range(rng.randint(0, 60))))
    separators = tokens.SPACES if kind == "space" else tokens.NOT_ALNUM
    pattern = brute.SPACE_WORD if kind == "space" else brute.ALNUM_WORD
    found = tokens.words(pa.array(texts), separators)
    seen = {}
    for i, text in enumerate(texts):
        want = brute.words(text, pattern)
        assert len(found.of(i)) == len(want)
        for word, value in zip(want, found.of(i)):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_words_of_a_slice():
    texts = pa.array(["a b", "c d e", None, "f"]).slice(1, 3)
    assert tokens.words(texts).counts().tolist() == [3, 0, 1]


def test_windows_stay_inside_a_text():
    found = tokens.words(pa.array(["a b c d", "d a b c"]))
    value, complete = tokens.windows(found, 3)
    assert complete.tolist() == [True, True, False, False] * 2
    assert value[0] == value[5]
    assert len({value[0], value[1], value[4]}) == 3


def test_suffix_order_and_search():
    rng = np.random.default_rng(2)
    for _ in range(30):
        runs = [rng.integers(1, 4, rng.integers(1, 12)) for _ in range(rng.integers(1, 6))]
        text = np.concatenate([np.append(run, 0) for run in runs])
        order = suffix_order(text)
        assert sorted(order.tolist()) == list(range(len(text)))
        index = FmIndex(text, 4)
        phrase = rng.integers(1, 4, (5, 3))
        lengths = rng.integers(1, 4, 5)
        low, high = index.search(phrase, lengths)
        for p, n, a, b in zip(phrase, lengths, low, high):
            want = [i for i in range(len(text) - n + 1) if (text[i : i + n] == p[:n]).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_decontamination_of_random_texts():
    rng = random.Random(4)
    for _ in range(40):
        window = rng.choice([1, 2, 3, 5])
        vocabulary = ["a", "b", "C", "é", "d1"][: rng.randint(1, 5)]

        def text(n):
            return " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, n)))

        items = [(rng.choice([None, i, 7]), rng.choice([None, "", "..", text(12)])) for i in range(4)]
        texts = [rng.choice([None, "", text(40), text(3) + " zz " + text(20)]) for _ in range(12)]
        strings = pa.array([t for _, t in items], pa.string())
        model = decontaminate.phrases([i for i, _ in items], strings, window)
        batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
        columns = decontaminate._judge(model, batch, "text")
        found = [tuple(getattr(x, "item", lambda x=x: x)() for x in row) for row in zip(*columns[:5])]
        assert found == brute.contamination(texts, items, window)


def test_rtree_join_is_the_bound():
    rng = np.random.default_rng(1)

    def sets():
        out = []
        for _ in range(rng.integers(1, 120)):
            values = rng.integers(0, rng.choice([30, 200, 5000]), rng.integers(1, 60))
            out.append(np.unique(values.astype(np.uint64)))
        return out

    for _ in range(20):
        left, right = sets(), sets()
        a, b = (np.stack([count_vector(x) for x in s]) for s in (left, right))
        size_a, size_b = (np.array([len(x) for x in s]) for s in (left, right))
        i, j = join(RTree(a, size_a), RTree(b, size_b), 75)
        want = {
            (x, y)
            for x in range(len(left))
            for y in range(len(right))
            if 175 * np.minimum(a[x].astype(int), b[y]).sum() >= 75 * (size_a[x] + size_b[y])
            and 4 * size_a[x] >= 3 * size_b[y]
            and 4 * size_b[y] >= 3 * size_a[x]
        }
        assert set(zip(i.tolist(), j.tolist())) == want
        assert len(i) == len(want)


def test_flips_are_the_cheapest():
    margins = np.array([0.5, 0.1, 0.4, 0.2])
    every = []
    for mask in range(16):
        bits = tuple(i for i in range(4) if mask >> i & 1)
        every.append((sum(margins[i] ** 2 for i in bits), bits))
    want = [set(bits) for _, bits in sorted(every)[:6]]
    assert [set(x) for x in lsh_forest._flips(margins, 6)] == want


def test_expectation_maximisation_finds_the_reliable_labelers():
    good = {"pattern": 1, "check": 1, "gazetteer": 1, "context": -1, "edges": 1}
    bad = {"pattern": 0, "check": 0, "gazetteer": 1, "context": -1, "edges": 1}
    lucky = {"pattern": -1, "check": 1, "gazetteer": 1, "context": 1, "edges": 1}
    model = pii.learn([("card", good, 900), ("card", bad, 700), ("card", lucky, 30)])
    assert model.hits["card"]["check"] > 0.9 > 0.1 > model.false_hits["card"]["check"]
    assert model.weights["card"]["check"] > abs(model.weights["card"]["edges"])
    assert pii.learn([]).bias["card"] == 0


def test_frames_open_on_their_own():
    rows = {
        "page_id": [1, None, 3],
        "url": ["http://a/b c", None, "http://x"],
        "payload": [b"one", b"", "drei ü".encode() * 500],
        "digest": ["d1", "d2", "d3"],
        "record_type": ["response", "response", "revisit"],
        "refers_to": [None, None, 9],
    }
    batches = warc.bundle([pa.RecordBatch.from_pydict(rows)], frame_bytes=1)
    parts = [b.column(0)[0].as_py() for b in batches]
    content = b"".join(p + warc._SEEKABLE for p in parts)
    table = warc.seek_table(content)
    assert len(table) == 3
    headers, block, _ = warc.parse(warc.open_frame(content, table[1][0]), 0)
    assert "WARC-Target-URI" not in headers and block.endswith(b"\r\n\r\n")
    headers, block, _ = warc.parse(warc.open_frame(content, table[0][0]), 0)
    assert headers["WARC-Target-URI"] == "http://a/b%20c" and block.endswith(b"one")
    headers, _, _ = warc.parse(warc.open_frame(content, table[2][0]), 0)
    assert headers["WARC-Refers-To"] == "<urn:x-page:9>"


@pytest.mark.parametrize("n", range(8))
def test_slices_of_few_words(n):
    """A slice of fewer words than a shingle, alone and before a text that is a slice of its own."""
    short = " ".join(f"w{i}" for i in range(n))
    wanted = 0 if n == 0 else max(1, n - 4)
    assert [len(s) for s in jaccard.shingle_sets(pa.array([short]))] == [wanted]
    batch = pa.RecordBatch.from_arrays([pa.array([short, "x " * 40])], names=["text"])
    parts = list(tokens.slices(batch, limit=60))
    assert len(parts) == 2
    sizes = [len(s) for part in parts for s in jaccard.shingle_sets(part.column("text"))]
    assert sizes == [wanted, 1]


def test_jaccard_of_an_empty_table_and_tiny_partitions(spark):
    rows = [(1, "two words"), (2, "two words"), (3, "a"), (4, "b"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert jaccard.cluster(docs.limit(0)).collect() == []
    found = {r["doc_id"]: r["component_id"] for r in jaccard.cluster(docs.repartition(2)).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}


def test_count_vectors_at_the_limit_refute_nothing(monkeypatch):
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 4000).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, 3900)) for _ in range(3)]
    sets += [np.unique(np.concatenate([s[: len(s) * 9 // 10], rng.integers(0, 2**63, 40).astype(np.uint64)])) for s in sets]
    sizes = np.array([len(s) for s in sets])
    similar = {
        (i, j)
        for i in range(len(sets))
        for j in range(len(sets))
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))
    }
    assert {(i, i + 3) for i in range(3)} <= similar
    for limit in (65_535, 3):
        monkeypatch.setattr(count_rtree, "LIMIT", limit)
        vectors = np.stack([count_rtree.count_vector(s) for s in sets])
        assert vectors.max() <= limit
        trees = [count_rtree.RTree(vectors, sizes) for _ in range(2)]
        left, right = count_rtree.join(*trees, 75)
        assert similar <= set(zip(left.tolist(), right.tolist()))


def test_rounds_of_leaders_end_early(spark, monkeypatch):
    rng = random.Random(8)
    texts = []
    for group in range(12):
        body = [f"w{group}x{rng.randrange(400)}" for _ in range(60)]
        for _ in range(6):
            copy = list(body)
            copy[rng.randrange(60)] = f"n{rng.randrange(10**6)}"
            copy[rng.randrange(60)] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    numbers = brute.jaccard_components(texts)
    least = {n: min(i for i, m in enumerate(numbers) if m == n) for n in set(numbers)}
    want = {i: least[n] for i, n in enumerate(numbers)}
    for share in (0.0, 1.0):  # trees after the first round, and after all of them
        monkeypatch.setattr(jaccard, "LEFT_OPEN", share)
        found = {r["doc_id"]: r["component_id"] for r in jaccard.cluster(docs).collect()}
        assert found == want


def test_groups_of_copies_below_the_threshold_move_rows_in_proportion(spark, monkeypatch):
    """Many copies that share words with each other and are not similar; a few of them are."""
    monkeypatch.setattr(jaccard, "GROUP", 4)
    moved = {}

    def counted(rows, name, write=jaccard.materialize):
        written = write(rows, name)
        if name in ("jaccard-open", "jaccard-dealt"):
            moved[name] = written.count()
        return written

    monkeypatch.setattr(jaccard, "materialize", counted)
    rng = random.Random(4)
    body = [f"w{i}" for i in range(60)]
    texts = []
    for number in range(150):
        copy = [f"n{number}x{i}" if rng.random() < 0.12 else word for i, word in enumerate(body)]
        texts.append(" ".join(copy))
        if number % 20 == 0:
            texts.append(" ".join([*copy[:-1], "end"]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    numbers = brute.jaccard_components(texts)
    least = {n: min(i for i, m in enumerate(numbers) if m == n) for n in set(numbers)}
    found = {r["doc_id"]: r["component_id"] for r in jaccard.cluster(docs).collect()}
    assert found == {i: least[n] for i, n in enumerate(numbers)}
    assert len(least) > len(texts) / 2
    assert moved["jaccard-dealt"] < moved["jaccard-open"]


def test_only_texts_of_repeated_ids_are_read_again(spark, monkeypatch):
    asked = []

    def append(rows, *args, add=jaccard.frames.append, **named):
        asked.append(rows.count())
        return add(rows, *args, **named)

    monkeypatch.setattr(jaccard.frames, "append", append)
    rows = [(i, f"some words of text number {i} and no other") for i in range(6)]
    rows += [(6, rows[0][1]), (7, None), (5, "another text under a repeated id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(map(tuple, jaccard.keep_one(docs).collect()), key=str)
    assert kept == sorted([*rows[:6], *rows[7:]], key=str)
    assert asked == [2]


def test_rows_are_left_out_by_the_ids_that_do_not_stay(spark, monkeypatch):
    lists = {}

    def materialize(df, name, *args, write=jaccard.materialize):
        out = write(df, name, *args)
        lists[name] = out
        return out

    monkeypatch.setattr(jaccard, "materialize", materialize)
    rows = [(i, f"some words of text number {i} and no other") for i in range(40)]
    rows += [(50, rows[3][1]), (51, None), (None, rows[4][1]), (7, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = jaccard.keep_one(docs).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([*rows[:40], rows[41]], key=str)
    joined = [t for t in lists.values() if "own" in t.columns]
    assert [sorted((r["own"] for r in t.collect()), key=str) for t in joined] == [[50, 7, None]]


def _sent_to_python(plan):
    """Names and types of what the passes of a plan send to Python."""
    children = [plan.children().apply(i) for i in range(plan.children().size())]
    if plan.nodeName() == "MapInArrow":
        yield children[0].schema().simpleString()
    for child in children:
        yield from _sent_to_python(child)


@pytest.mark.parametrize("step", ["language", "classes", "benchmark"])
def test_rows_take_their_text_to_python_once(spark, step):
    rows = [(i, f"the cat and number {i} of the dogs sat there", "en", i % 3) for i in range(8)]
    # Columns named as those of the results, and ids that several rows have.
    docs = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, lang string, score long")
    if step == "language":
        kept = langid.keep_identified(docs, F.lit(False))
    elif step == "classes":
        kept = jaccard.keep_one(docs)
    else:
        items = spark.createDataFrame([("a", "nothing of it")], "item_id string, text string")
        kept = decontaminate.keep_clean(docs, items)
    sent = list(_sent_to_python(kept._jdf.queryExecution().optimizedPlan()))
    assert sent and all(x.count("string") == 2 for x in sent), sent
    assert kept.schema.simpleString() == docs.schema.simpleString()
    want = rows if step == "classes" else rows + rows[:2]
    assert sorted(map(tuple, kept.collect())) == sorted(want)


def test_stages_bound_the_bytes_of_batches_unless_the_session_does(spark, tmp_path):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["bytes"])

    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    items = spark.createDataFrame([("a", "nothing of it")], "item_id string, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    for stage in (corpus_pipeline.language_id, corpus_pipeline.ngram_jaccard, corpus_pipeline.decontaminated):
        session = spark.newSession()
        docs = session.range(6_000, numPartitions=1).selectExpr(
            "id as doc_id", "repeat('some words ', 200) as text", "'en' as lang"
        )
        stage(session, docs.limit(3), str(tmp_path))
        found = [r["bytes"] for r in docs.mapInArrow(sizes, "bytes long").collect()]
        assert len(found) > 1 and max(found) <= frames.BATCH_BYTES + 3_000
    session = spark.newSession()
    session.conf.set(limit, "1m")
    frames.bound_batches(session)
    assert session.conf.get(limit) == "1m"


def test_jaccard_steps_have_small_plans_that_spare_the_driver(spark, monkeypatch, capsys):
    rng = random.Random(5)
    texts = []
    for _ in range(6):
        text = [f"w{rng.randrange(10_000)}" for _ in range(120)]
        for _ in range(8):
            text = [w if rng.random() > 0.01 else f"v{rng.randrange(10_000)}" for w in text]
            texts.append(" ".join(text))
    exchanges = {}

    def planned(rows, name, *args, write=jaccard.materialize):
        capsys.readouterr()
        rows.explain()
        n = capsys.readouterr().out.count("Exchange")
        exchanges[name] = max(exchanges.get(name, 0), n)
        return write(rows, name, *args)

    for module in (jaccard, components):
        monkeypatch.setattr(module, "materialize", planned)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard.cluster(docs).collect()}
    first = {}
    for i, number in enumerate(brute.jaccard_components(texts)):
        assert found[i] == first.setdefault(number, i)
    assert exchanges["component-edges"] <= 6 and exchanges["jaccard-needed"] <= 6, exchanges
    assert exchanges["jaccard-dealt"] <= 8, exchanges


def test_jaccard_levels_hold_the_slots_once(spark):
    import tracemalloc

    texts = [" ".join(f"w{i % 5} x{i // 3}" for i in range(n)) for n in (9, 30, 200, 200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    table = jaccard.materialize(jaccard.profiles(docs), "levels")
    tracemalloc.start()
    try:
        level, frequent = jaccard._levels(table)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    counts = np.zeros(1 << jaccard.SLOT_BITS)
    for members in jaccard.shingle_sets(pa.array(texts)):
        np.add.at(counts, (members >> np.uint64(64 - jaccard.SLOT_BITS)).astype(np.int64), 1)
    assert level.tolist() == np.floor(np.log2(np.maximum(counts, 1))).astype(int).tolist()
    assert level.max() == 2 and not frequent.any()
    assert most < 16 << 20, most
