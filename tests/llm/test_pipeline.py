"""The stages after each other on the smallest sample tables, each against its own input."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import brute
import pytest

import corpus_pipeline

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="sample tables are absent")


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(SF_DIR)).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append(docs)
    return [(t.columns, t.collect()) for t in out]


def test_columns_stay(tables):
    for columns, _ in tables[1:-1]:
        assert columns == tables[0][0]


def test_languages(tables):
    (_, before), (_, after) = tables[:2]
    lettered = {r["doc_id"] for r in before if any(c.isalpha() for c in r["text"] or "")}
    assert {r["doc_id"] for r in after} == lettered


def test_lines(tables):
    (_, before), (_, after) = tables[1:3]
    old = {r["doc_id"]: r["text"] for r in before}
    assert sorted(old) == sorted(r["doc_id"] for r in after)
    for r in after:
        remaining = iter(old[r["doc_id"]].split("\n"))
        assert all(line in remaining for line in r["text"].split("\n"))
        assert r["n_chars"] == len(r["text"]) and r["text"].strip()


def test_groups(tables):
    (_, before), (_, after) = tables[2:4]
    numbers = brute.jaccard_components([r["text"] for r in before])
    first = {}
    for number, r in zip(numbers, before):
        first[number] = min(first.get(number, r["doc_id"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(first.values())


def test_clean(spark, tables):
    (_, before), (_, after) = tables[3:5]
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    judged = brute.contamination([r["text"] for r in before], [(r["item_id"], r["text"]) for r in items])
    want = {r["doc_id"] for r, (*_, bad) in zip(before, judged) if not bad}
    assert {r["doc_id"] for r in after} == want


def test_mix(tables):
    (_, before), (_, after) = tables[4:6]
    size = {r["doc_id"]: len(brute.words(r["text"])) for r in before}
    taken, target = Counter(), {}
    for r in after:
        assert r["size"] == size[r["doc_id"]] and 0 < r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()), rel=0.01)
