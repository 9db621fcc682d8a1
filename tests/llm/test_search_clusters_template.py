"""Ranked search, centroid clusters and page templates against plain Python on small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from casequarry.llm import centroids, ranked_search, template
from casequarry.llm.markup import host_of, parse

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


# Ranked search


def terms_of(text):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return [t.translate(lower) for t in TERM.findall(text or "")]


def ranked(docs, items, k=10):
    bags = [(i, Counter(terms_of(t)), len(terms_of(t))) for i, t in docs]
    bags = [b for b in bags if b[2]]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in items:
        scored = []
        for i, bag, n in bags:
            m = 100 - 75 + (75 * n * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in terms_of(text)
                if t in bag
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored)[:k], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=repr)


def searched(spark, docs, items, k=10):
    index = ranked_search.build(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    found = ranked_search.search(index, spark.createDataFrame(items, "item_id long, text string"), k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=repr)


def search_fixture():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)] + ["Straße", "ÀB", "don't", "x_y", "2024"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 40)))) for i in range(150)]
    docs += [(200 + i, docs[7][1]) for i in range(30)]  # copies tie
    docs += [(7, docs[7][1]), (None, docs[7][1]), (300, None), (301, ""), (302, "?! \n")]
    docs.append((303, " ".join(rng.choices(words, weights, k=50_000))))
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 25)))) for i in range(12)]
    items += [(50, docs[7][1]), (51, None), (52, ""), (53, "unknown"), (54, "w1 w1 W1")]
    items += [(None, "w3 w9"), (55, docs[303 - 303][1])]
    return docs, items


@pytest.mark.parametrize("shard", [1 << 20, 200])
def test_ranked_search_equals_brute_force(spark, monkeypatch, shard):
    docs, items = search_fixture()
    # Small shards are made by the tasks' copy of the limit, which travels with the closure.
    monkeypatch.setattr(ranked_search, "SHARD_TOKENS", shard)
    assert searched(spark, docs, items) == ranked(docs, items)


def test_search_in_blocks_and_steps(spark, monkeypatch):
    docs, items = search_fixture()
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 40)
    assert searched(spark, docs, items, k=3) == ranked(docs, items, k=3)


def test_best_first_search_of_one_shard_in_small_groups(monkeypatch):
    docs, items = search_fixture()
    bags = [(i, terms_of(t)) for i, t in docs if terms_of(t)]
    bags.sort(key=lambda b: (b[0] is None, b[0] or 0))
    vocabulary = sorted({t for _, ts in bags for t in ts})
    number = {t: j for j, t in enumerate(vocabulary)}
    lists = {t: [(d, ts.count(t)) for d, (_, ts) in enumerate(bags[:-1]) if t in ts] for t in vocabulary}
    vocabulary = [t for t in vocabulary if lists[t]]
    number = {t: j for j, t in enumerate(vocabulary)}
    starts = np.cumsum([0] + [len(lists[t]) for t in vocabulary])
    post = [p for t in vocabulary for p in lists[t]]
    tables = ranked_search._Tables(
        len(bags), starts, np.array([d for d, _ in post]), np.array([c for _, c in post])
    )
    asked = [[t for t in dict.fromkeys(terms_of(text)) if t in number] for _, text in items]
    weights = [[3 + len(t) for t in ts] for ts in asked]
    best = [ranked_search._Best(4) for _ in asked]
    ids = [i for i, _ in bags]
    told = [(np.array([number[t] for t in ts], int), np.array(w, int)) for ts, w in zip(asked, weights)]
    ranked_search._search_shard(tables, ids, told, best)
    for ts, w, b in zip(asked, weights, best):
        want = []
        for d, (i, _) in enumerate(bags):
            score = sum(v * c for t, v in zip(ts, w) for e, c in lists[t] if e == d)
            if score:
                want.append((-score, (i is None, i)))
        assert b.rows == sorted(want, key=lambda r: (r[0], r[1][0], r[1][1] or 0))[:4]


def test_range_maxima():
    rng = np.random.default_rng(1)
    starts, impact = np.array([0, 5, 6, 37]), rng.integers(0, 9, 37)
    docs = np.concatenate([np.arange(5), [3], np.arange(31)])
    tables = ranked_search._Tables(31, starts, docs, impact)
    for a, b in [(0, 1), (0, 5), (6, 37), (9, 20), (36, 37), (5, 6), (7, 23)]:
        want = a + int(impact[a:b].argmax())
        assert tables.first_maxima(np.array([a]), np.array([b]))[0] == want


def test_search_of_empty_tables_and_odd_columns(spark):
    docs = spark.createDataFrame([("a", "x y", 1, 2)], "doc_id string, text string, score int, rank int")
    items = spark.createDataFrame([("i", "x", 3)], "item_id string, text string, score int")
    index = ranked_search.build(docs)
    assert [r[:3] for r in ranked_search.search(index, items).collect()] == [("i", 1, "a")]
    assert ranked_search.search(index, items.limit(0)).collect() == []
    empty = ranked_search.build(docs.limit(0))
    assert (empty.n_docs, empty.n_terms) == (0, 0)
    assert ranked_search.search(empty, items).collect() == []


# Centroid clusters


def clustered(rows, k=16, rounds=3):
    kept = []
    for i, v in rows:
        if v is None or len(v) != 64 or any(c is None or not math.isfinite(c) for c in v):
            continue
        kept.append((i, [math.floor(64 * c) for c in v]))

    def order(row):
        i, x = row
        return (i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest(), x)

    centroids = [x for _, x in sorted(kept, key=order)[:k]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(x)[1] for _, x in kept]
        for j in range(len(centroids)):
            mine = [x for (_, x), c in zip(kept, own) if c == j]
            if mine:
                centroids[j] = [sum(c) // len(mine) for c in zip(*mine)]
    last = [nearest(x) for _, x in kept]
    sums = Counter()
    for d, j in last:
        sums[j] += d
    return sorted(
        (
            (i, j, d, sums[j], sum(sums.values()),
             hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
            for (i, _), (d, j) in zip(kept, last)
        ),
        key=repr,
    )


def found_clusters(spark, rows, **options):
    frame = spark.createDataFrame(
        [(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, cluster int"
    )
    return sorted(map(tuple, centroids.cluster(frame.repartition(3), **options).collect()), key=repr)


def vector_fixture(n=90, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 64))
    rows = [(i, (centres[i % 6] + rng.normal(size=64) * 0.3).tolist()) for i in range(n)]
    rows += [(3, rows[3][1]), (None, rows[4][1]), (500, rows[5][1]), (501, rows[5][1])]
    odd = [float("nan"), float("inf"), None]
    rows += [(600 + j, [bad] + rows[0][1][1:]) for j, bad in enumerate(odd)]
    rows += [(700, None), (701, []), (702, rows[0][1][:63]), (703, [0.0] * 64), (704, [-0.001] * 64)]
    return rows


@pytest.mark.parametrize("n", [90, 5, 0])
def test_clusters_equal_brute_force(spark, n):
    rows = vector_fixture(n) if n == 90 else [(i, v) for i, v in vector_fixture()[:n]]
    want = clustered(rows)
    assert found_clusters(spark, rows) == want
    assert len(want) == (n + 6 if n == 90 else n)


def test_equal_vectors_and_large_components(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(40)]
    rows += [(100 + i, [3.0 * 2**18 + i] * 64) for i in range(4)]  # products beyond 2^53
    assert found_clusters(spark, rows) == clustered(rows)
    with pytest.raises(ValueError, match="beyond"):
        found_clusters(spark, [(1, [2.0**40] * 64)])


def test_products_stay_exact_beyond_doubles():
    x, move = np.array([[2**27, -(2**27) + 1]]), np.array([2**27 - 1, 2**27])
    assert centroids._product(x, move)[0] == 2**27 * (2**27 - 1) + (1 - 2**27) * 2**27


# Page templates


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def page(rng, i, container="div class='box{}' id='post-{}'"):
    """A page of a host that knows no article element."""
    blocks = [words(rng, 30) for _ in range(rng.randint(2, 5))]
    links = "".join(f"<li><a href='/{words(rng, 1)}'>{words(rng, 2)}</a>" for _ in range(5))
    body = ""
    for block in blocks:
        first, second, rest = block.split(" ", 2)
        body += f"<p>{first} <b>{second}</b>\n {rest}</p>"
    source = (
        f"<html><head><title>{words(rng, 4)}</title><style>p{{}}</style></head><body>"
        f"<div class='x7'><ul>{links}</ul></div>"
        f"<script>var a='<p>no</p>';</script><!-- <p>no</p> -->"
        f"<div class='cookieNotice'><p>{words(rng, 12)}</p></div>"
        f"<{container.format(i, i)}><h2>Title &amp; {i}</h2>{body}<span>Share this story with all</span></div>"
        f"<div class='zz'>All rights kept by us</div>"
        f"<form><label>{words(rng, 2)}</label><textarea>no</textarea></form>"
        f"<section id='comments'><h3>Readers</h3><p>{words(rng, 40)}</p></section></body></html>"
    )
    return source, "\n".join([f"Title & {i}", *blocks])


def extracted(spark, rows, extra=False):
    schema = "page_id long, url string, html string"
    if extra:
        rows, schema = [(*r, "t", 1) for r in rows], schema + ", text string, host int"
    frame = spark.createDataFrame(rows, schema).repartition(3)
    found = template.extract(frame)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    out = found.collect()
    assert all(r["n_chars"] == len(r["text"]) for r in out)
    return {r["page_id"]: r["text"] for r in out}


def test_slots_of_a_template_without_article_elements(spark):
    rng = random.Random(2)
    pages = [page(rng, i) for i in range(30)]
    rows = [(i, f"https://Host.example:80/p{i}", html) for i, (html, _) in enumerate(pages)]
    found = extracted(spark, rows, extra=True)
    for i, (_, want) in enumerate(pages):
        # The span that stands on every page, and the line below, are template.
        assert found[i] == want


def test_small_hosts_share_a_template_and_articles_outweigh(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for i in range(40):
        text = [words(rng, 9) for _ in range(3)]
        rows.append((
            i,
            f"http://h{i % 20}.example/",
            f"<body><nav><p>{words(rng, 20)}</p></nav><article><header><h1>{text[0]}</h1></header>"
            f"<p>{text[1]}<br>{text[2]}<div class=ad>{words(rng, 9)}</div></article>"
            f"<aside>{words(rng, 30)}</aside><footer>&copy; {words(rng, 5)}",
        ))
        want[i] = f"{text[0]}\n{text[1]} {text[2]}"
    assert extracted(spark, rows) == want


def test_copies_keep_their_words(spark):
    html = "<body><article><h1>One text</h1><p>that stands on all pages of the host</p></article></body>"
    found = extracted(spark, [(i, "http://copies.example/a", html) for i in range(9)])
    assert set(found.values()) == {"One text\nthat stands on all pages of the host"}


def test_odd_pages(spark):
    long = "<p>word " * 60_000
    rows = [
        (1, None, None),
        (2, "not an address", ""),
        (3, "http://[bad", "no markup at all &lt;b&gt; &#233;&nbsp; x"),
        (4, "http://a.example", "<p>one<p>two <a href='x>y'>three</a><ul><li>four<li>five</ul>"),
        (5, "http://a.example", "a < b <3 <!-- open"),
        (6, "http://a.example", "<form><div>" + long),
        (7, "http://a.example", "<script>if (a</b) '</p>'"),
        (8, "http://a.example", "<p title='open>text</p> more <a href=\"" + "<" * 50_000),
        (9, "http://a.example", "<div hidden>no</div><div style='display: none'>no</div><div role=dialog>no</div>yes"),
        (None, None, "<p>x</p>"),
        (None, None, "<p>x</p>"),
    ]
    found = extracted(spark, rows)
    assert len(found) == 10
    assert (found[1], found[2], found[3]) == ("", "", "no markup at all <b> é x")
    assert found[4] == "one\ntwo three\nfour\nfive"
    assert found[5] == "a < b <3"
    assert found[6] == "\n".join(["word"] * 60_000)
    assert found[7] == "" and found[9] == "yes"
    assert extracted(spark, rows[:0] or [], extra=False) == {}


def test_parser_is_linear_and_names_hosts():
    for piece in ("<a ", "<p '", "<!--", "</", "<script>", "&amp", "<div>", "<li>"):
        parse(piece * 20_000)
    assert host_of("HTTP://User@WWW.Example.COM:8080/x") == "www.example.com"
    assert host_of(None) == host_of("/relative") == ""
