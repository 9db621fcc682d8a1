from __future__ import annotations

import datetime as dt
import math
import random
import re
from collections import Counter

import pytest

from casequarry.operators import bm25, postings
from casequarry.operators.splits import split_cases
from casequarry.storage import materialize


def tokens(text):
    return re.findall("[a-z0-9]+", text.lower())


def brute_force(docs, query, k, config=bm25.Bm25Config()):
    """Scores of one query over documents in train order."""
    bags = [Counter(tokens(t)) for t in docs]
    lengths = [sum(b.values()) for b in bags]
    mean_length = sum(lengths) / len(docs)
    df = Counter(t for b in bags for t in b)
    idf = {t: math.log(len(docs) - n + 0.5) - math.log(n + 0.5) for t, n in df.items()}
    floor = config.epsilon * sum(idf.values()) / len(idf)
    idf = {t: floor if v < 0 else v for t, v in idf.items()}
    scores = []
    for bag, length in zip(bags, lengths):
        norm = config.k1 * (1 - config.b + config.b * length / mean_length)
        scores.append(
            sum(idf.get(t, 0) * bag[t] * (config.k1 + 1) / (bag[t] + norm) for t in tokens(query))
        )
    return sorted(enumerate(scores), key=lambda s: (-round(s[1], 9), s[0]))[:k]


def corpus_frame(spark, docs):
    rows = [(f"d{i:03d}", dt.datetime(2024, 1, 1), 1, t) for i, t in enumerate(docs)]
    return spark.createDataFrame(rows, "case_id string, received timestamp, n long, text string")


def check(spark, docs, queries, k=5):
    config = bm25.Bm25Config(topk=k)
    corpus = bm25.build_corpus(corpus_frame(spark, docs), config)
    asked = spark.createDataFrame([(f"q{i}", q) for i, q in enumerate(queries)], "query_id string, text string")
    hits = bm25.topk(corpus, asked).orderBy("query_id", "rank").collect()
    for i, q in enumerate(queries):
        found = [(r["hit_id"], r["bm25_score"]) for r in hits if r["query_id"] == f"q{i}"]
        want = brute_force(docs, q, k, config)
        assert [h for h, _ in found] == [f"d{j:03d}" for j, _ in want], q
        assert [s for _, s in found] == pytest.approx([s for _, s in want])


def test_scores_and_order_equal_brute_force(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    docs = [" ".join(rng.choices(words, range(60, 0, -1), k=rng.randrange(1, 50))) for _ in range(80)]
    docs[40] = docs[41] = docs[7]
    check(spark, docs, [docs[7], "W3 w3, w59!", " ".join(rng.choices(words, k=20))])


def test_zero_scores_fill_up_in_train_order(spark):
    docs = ["red fee", "blue fee", "green card", "fee fee", "grey loan", "black bank"]
    check(spark, docs, ["green", "unknown words", "", "loan green"], k=4)


def test_zero_outranks_negative_scores(spark):
    docs = ["fee a", "fee a", "fee a", "fee b", "none"]
    check(spark, docs, ["fee a", "fee"], k=5)


def test_free_positions_behind_many_matches(spark, monkeypatch):
    """All documents but three hold the word; the free ones lie in several ranges."""
    monkeypatch.setattr(postings, "RANGE", 8)
    monkeypatch.setattr(postings, "BLOCK", 4)
    docs = ["other"] * 60
    for i in range(60):
        if i not in (5, 31, 58):
            docs[i] = "word other"
    index, weights, asked = index_of(spark, docs, {"q": "word", "all": "other", "none": "absent"})
    free = postings.free_positions(index, weights, asked, 4).orderBy("query_id", "doc").collect()
    found = {q: [r["doc"] for r in free if r["query_id"] == q and r["doc"] < 60] for q in ("q", "all", "none")}
    assert found == {"q": [5, 31, 58], "all": [], "none": [0, 1, 2, 3]}
    plan = postings.free_positions(index, weights, asked, 4)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def index_of(spark, docs, questions):
    corpus = bm25.build_corpus(corpus_frame(spark, docs))
    asked = spark.createDataFrame(list(questions.items()), "query_id string, text string")
    return corpus.postings, bm25.query_terms(corpus, asked), asked


def test_search_in_small_blocks_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK", 4)
    monkeypatch.setattr(postings, "SEEDS", 2)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(80)]
    docs = [" ".join(rng.choices(words, range(80, 0, -1), k=rng.randrange(1, 30))) for _ in range(150)]
    docs[90] = docs[91] = docs[10]
    check(spark, docs, [" ".join(rng.choices(words, k=rng.randrange(1, 12))) for _ in range(25)] + [docs[10]])


def rows_read(scan):
    """Rows that the scan of a plan without shuffles gave."""
    execution = scan._jdf.queryExecution()
    assert execution.executedPlan().execute().count() >= 0
    leaves = execution.executedPlan().collectLeaves()
    assert leaves.size() == 1
    return leaves.apply(0).metrics().apply("numOutputRows").value()


def test_only_folders_of_the_query_are_read(spark):
    docs = [f"word{i} word{i + 1} common" for i in range(400)]
    index, weights, _ = index_of(spark, docs, {"q": "word17 word300"})
    read = rows_read(postings.touched(index, weights).select("term", "block", "best"))
    own = {r["bucket"] for r in weights.select(postings.bucket_of(weights["term"]).alias("bucket")).collect()}
    inside = index.where(index["bucket"].isin(list(own))).count()
    assert len(own) <= 2 and read == inside < index.count() / 4


def test_blocks_that_cannot_reach_the_threshold_are_not_scored(spark, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK", 8)
    monkeypatch.setattr(postings, "SEEDS", 1)
    docs = [f"common text{i} of many words here" for i in range(400)]
    for i in range(80, 86):
        docs[i] = "rare common"
    index, weights, asked = index_of(spark, docs, {"q": "rare common"})
    scored = []
    original = postings.scores

    def seen(index, weights, blocks, gain):
        scored.append(blocks.count())
        return original(index, weights, blocks, gain)

    monkeypatch.setattr(postings, "scores", seen)
    check(spark, docs, ["rare common"])
    assert scored == [1, 0]  # of 50 blocks


def test_fewer_documents_than_asked_for(spark):
    check(spark, ["one", "two"], ["two"], k=5)


def test_retrieve_lists_repeated_documents(spark):
    rows = [
        (f"c{i:02d}", dt.datetime(2024, 1, 1) + dt.timedelta(days=i), f"fee number{i} card", i)
        for i in range(20)
    ]
    rows += [("c02", dt.datetime(2024, 1, 3), "special special fee", 100 + i) for i in range(2)]
    rows[-1] = ("c02", dt.datetime(2024, 1, 3), "latest special text", 102)
    rows.append(("q", dt.datetime(2025, 1, 1), "special   text", 103))
    cases = spark.createDataFrame(rows, "case_id string, received timestamp, text string, ingest_pos long")
    splits = materialize(split_cases(cases), "bm25-splits")
    test_ids = [
        r["case_id"]
        for r in splits.where("split = 'test'").orderBy("pos").collect()
        for _ in range(r["n"])
    ]
    config = bm25.Bm25Config(topk=4, num_queries=len(test_ids))
    hits = materialize(bm25.retrieve(cases, splits, config), "hits")
    assert sorted({r["query_id"] for r in hits.collect()}) == sorted(test_ids)
    asked = [r for r in hits.orderBy("rank").collect() if r["query_id"] == "q"]
    assert [r["hit_id"] for r in asked[:3]] == ["c02", "c02", "c02"]
    assert asked[0]["hit_snippet"] == "latest special text"
    assert asked[0]["query_snippet"] == "special text"
    nested = {r["query_id"]: r["topk"] for r in bm25.nested_hits(hits).collect()}
    assert [h["rank"] for h in nested["q"]] == [1, 2, 3, 4]
    assert nested["q"][0]["hit_id"] == "c02"


def test_plans_have_no_cross_join(spark):
    corpus = bm25.build_corpus(corpus_frame(spark, ["a b", "b c", "c d"]))
    asked = spark.createDataFrame([("q", "a")], "query_id string, text string")
    plan = bm25.topk(corpus, asked)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_no_posting_becomes_a_row_per_query(spark, monkeypatch):
    """Every posting of an open block was a row for every query with its term."""
    monkeypatch.setattr(postings, "BLOCK", 16)
    monkeypatch.setattr(postings, "QUERIES_AT_ONCE", 3)
    rng = random.Random(12)
    words = [f"w{i}" for i in range(40)]
    docs = [" ".join(rng.choices(words, range(40, 0, -1), k=rng.randrange(1, 30))) for _ in range(120)]
    docs[60:70] = [docs[3]] * 10
    queries = [" ".join(rng.choices(words, k=12)) for _ in range(10)] + [docs[3]]
    check(spark, docs, queries)
    index, weights, asked = index_of(spark, docs, {f"q{i}": q for i, q in enumerate(queries)})
    blocks = index.select("block").distinct().crossJoin(asked.select("query_id")).selectExpr("*", "2 AS wanted")
    blocks = materialize(blocks, "blocks")
    corpus = bm25.build_corpus(corpus_frame(spark, docs))
    found = postings.scores(index, weights, blocks, corpus.gain)
    assert "Inline" not in str(found._jdf.queryExecution().optimizedPlan().toString())
    per_block = found.groupBy("query_id", (found["doc"] / 16).cast("int")).count()
    assert per_block.agg({"count": "max"}).first()[0] == 2
