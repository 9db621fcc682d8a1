"""Main text of pages by the template that the pages of a host share.

1. Every page is a sequence of tokens: opened and closed elements and runs of text, each told apart by
   the elements it stands in. The vector of a token is how often it occurs on each page of the host. Per
   host and token the pages, occurrences and a hash of the vector are summed, before and after one
   shuffle; no page or vector moves.
2. Tokens of a host with the same vector on enough of its pages are an equivalence class. A class is valid
   if it has an element and ``CLASS`` tokens and stands inside one element of another class; the
   valid classes, nested by that element, are the template. What the template leaves open in one of its
   elements is a slot, and the words and linked words of every slot are counted over the host.
3. Slots of elements that the page's author names as something else (menus, adverts, comments ...) and
   slots of links are left out; if the host has article elements, their slots are the main ones, else
   those below the innermost element with most of the words. Each page is read again with the template
   of its host: the blocks in main slots are its text, without runs that belong to the template.

A host with fewer than ``PAGES`` pages has no vectors to compare; the template of all such pages taken
together serves. Templates are small (``FREQUENT`` bounds them by the length of a page) and join the
pages by host; a host with more than a hundredth of all pages is dealt out by a salt.

Defined results: null or empty html, and a page without text outside of the named elements, have an empty
text. Where more than half of the words of a page would go as template, the pages are copies, and the
words stay. Repeated rows are pages of their own. Parsing is linear in the page, of any length; an unclosed
tag or comment at the end is dropped.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casequarry.llm import tokens
from casequarry.llm.markup import ARTICLE, Page, host_of, parse, squeeze
from casequarry.storage import materialize

# Pages from which on a host has a template of its own.
PAGES = 4
# Share of the pages of a host on which the tokens of its template stand.
FREQUENT = 0.3
CLASS = 3
# Share of linked words from which on a slot is a menu, and of words that the main element holds.
LINKED, HELD = 0.5, 0.7
SALTS = 64
# Bytes of html that a task counts before it hands on sums.
STEP = 8 << 20

TAG, RUN, SLOT, PAGE = 0, 1, 2, 3
SUMS = ("pages", "total", "words", "linked")
STATS = (
    "host string, kind int, token long, path string, pages long, total long, vector long, "
    "words long, linked long"
)
TEMPLATE_TYPE = T.StructType(
    [
        T.StructField("elements", T.ArrayType(T.StringType())),
        T.StructField("runs", T.ArrayType(T.LongType())),
        T.StructField("main", T.ArrayType(T.StringType())),
    ]
)

# Parts of a path that are the form of a text, not a place.
_FORM = ("p", "h1", "h2", "h3", "h4", "h5", "h6", "ul", "ol", "li", "blockquote", "pre", "dl", "dt", "dd",
         "thead", "tbody", "tr", "td", "th", "figure", "figcaption", "b", "i", "span")


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(parts)) - (1 << 63)


@lru_cache(1 << 14)
def _tag_token(path: tuple[str, ...], kind: str) -> int:
    return _hash(_named(path), kind)


@lru_cache(1 << 14)
def _named(path: tuple[str, ...]) -> str:
    return "\n".join(path)


def _place(path: tuple[str, ...]) -> tuple[str, ...]:
    """The element that a block stands in, without paragraphs, lists and the like."""
    n = len(path)
    while n and path[n - 1].split(".")[0].split("#")[0] in _FORM:
        n -= 1
    return path[:n]


def _run_token(path: tuple[str, ...], text: str) -> int:
    return _hash(_named(path), "t", text)


def _tokens(page: Page) -> dict:
    """``{(kind, token): (path, occurrences)}`` of a page."""
    found: dict = {}
    for path, kind, text in page.tokens:
        if kind == "t":
            key, told = (RUN, _run_token(path, text)), ""
        else:
            told = _named(path)
            key = (TAG, _tag_token(path, kind))
        before = found.get(key)
        found[key] = (told, 1 if before is None else before[1] + 1)
    return found


def _statistics(pages: DataFrame) -> DataFrame:
    """Sums per host and token over some pages at a time; see ``STATS``."""

    def work(batches):
        part = TaskContext.get().partitionId() << 32
        sums: dict = {}
        number = size = 0

        def add(key, path, counts, vector=0):
            told = sums.get(key)
            if told is None:
                sums[key] = [path, *counts, vector]
                return
            for i, n in enumerate(counts, 1):
                told[i] += n
            told[5] ^= vector

        def handed():
            keys = list(sums)
            columns = [[k[i] for k in keys] for i in range(3)] + list(zip(*sums.values()))
            kinds = [pa.string(), pa.int32(), pa.int64(), pa.string()] + [pa.int64()] * 5
            names = ["host", "kind", "token", "path", *SUMS, "vector"]
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
            batch = pa.RecordBatch.from_arrays(arrays, names=names)
            return batch.select([f.split()[0] for f in STATS.split(", ")])

        for batch in batches:
            for url, source in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
                number += 1
                host, page = host_of(url), parse(source or "")
                add((host, PAGE, 0), "", (1, 0, 0, 0))
                found = _tokens(page)
                # Per page and count another number, so that equal vectors have equal sums.
                counts = np.fromiter((n for _, n in found.values()), np.uint64, len(found))
                vector = tokens.mix(tokens.mix(np.uint64(part + number) + np.zeros(1, np.uint64)) + counts)
                for (key, (path, n)), v in zip(found.items(), vector.view(np.int64).tolist()):
                    add((host, *key), path, (1, n, 0, 0), v)
                slots: dict = {}
                for block in page.blocks:
                    if not block.outside:
                        words = [(len(t.split()), linked) for t, linked in block.runs]
                        own = slots.setdefault(_named(_place(block.path)), [0, 0])
                        own[0] += sum(n for n, _ in words)
                        own[1] += sum(n for n, linked in words if linked)
                for path, (words, linked) in slots.items():
                    add((host, SLOT, _hash(path)), path, (1, 1, words, linked))
                size += len(source or "")
                if size >= STEP:
                    yield handed()
                    sums, size = {}, 0
        if sums:
            yield handed()

    parts = pages.select("url", "html").mapInArrow(work, STATS)
    return parts.groupBy("host", "kind", "token").agg(
        F.first("path").alias("path"),
        F.bit_xor("vector").alias("vector"),
        *[F.sum(c).alias(c) for c in SUMS],
    )


def _deduce(rows: list[tuple]) -> tuple[list[str], list[int], list[str]]:
    """``(elements, runs, main slots)`` of one host from its frequent tokens and its slots."""
    classes: dict = {}
    for kind, token, path, vector, *_ in rows:
        if kind in (TAG, RUN):
            classes.setdefault(vector, []).append((kind, token, path))
    classes = {
        v: members
        for v, members in classes.items()
        if len(members) >= CLASS and any(kind == TAG for kind, _, _ in members)
    }
    # Nest: the nearest enclosing element of another class must be one for the whole class.
    owner = {p: v for v, members in classes.items() for kind, _, p in members if kind == TAG}

    def around(path: str, own) -> str:
        while "\n" in path:
            path = path.rsplit("\n", 1)[0]
            if owner.get(path, own) != own:
                return path
        return ""

    valid = {
        v
        for v, members in classes.items()
        if len({around(p, v) for kind, _, p in members if kind == TAG}) == 1
    }
    elements = sorted({p for p, v in owner.items() if v in valid})
    runs = sorted({t for v in valid for kind, t, _ in classes[v] if kind == RUN})
    known = set(elements)
    slots: dict[str, list[int]] = {}
    for kind, _, path, _, words, linked in rows:
        if kind == SLOT:
            slot = slots.setdefault(slot_of(path, known), [0, 0])
            slot[0] += words
            slot[1] += linked
    texts = {s: w for s, (w, linked) in slots.items() if w and linked < LINKED * w}
    articles = [s for s in texts if in_article(s)]
    if articles:
        return elements, runs, sorted(articles)
    root, whole = "", sum(texts.values())
    while True:
        held: dict[str, int] = {}
        for s, w in texts.items():
            if s.startswith(root + "\n" if root else ""):
                rest = s[len(root) + 1 :] if root else s
                step = (root + "\n" if root else "") + rest.split("\n")[0]
                held[step] = held.get(step, 0) + w
        step = max(held, key=held.get, default=None)
        if step is None or not step or held[step] < HELD * whole:
            break
        root = step
    return elements, runs, sorted(s for s in texts if (s + "\n").startswith(root + "\n" if root else ""))


def slot_of(path: str, elements: set) -> str:
    """The innermost element of the template around a place."""
    while path and path not in elements:
        path = path.rsplit("\n", 1)[0] if "\n" in path else ""
    return path


@lru_cache(1 << 14)
def in_article(path: str) -> bool:
    return any(label.split(".")[0].split("#")[0] in ARTICLE for label in path.split("\n"))


def _templates(stats: DataFrame) -> DataFrame:
    """``(host, elements, runs, main)`` of every host that has enough pages."""
    counted = stats.where(F.col("kind") == PAGE).select("host", F.col("pages").alias("of"))
    # A host has one row per salt here, so that the many tokens of one host are several keys.
    dealt = counted.where(F.col("of") >= PAGES).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    frequent = (
        stats.where((F.col("kind") != PAGE) & (F.col("pages") >= 2))
        .withColumn("salt", F.pmod("token", F.lit(SALTS)).cast("int"))
        .join(dealt, ["host", "salt"])
        .where(F.col("pages") >= FREQUENT * F.col("of"))
    )

    @F.udf(TEMPLATE_TYPE)
    def deduce(rows):
        return _deduce([tuple(r) for r in rows])

    # A host has fewer frequent tokens than 1 / FREQUENT times the tokens of its mean page.
    row = F.struct("kind", "token", "path", "vector", "words", "linked")
    return frequent.groupBy("host").agg(F.sort_array(F.collect_list(row)).alias("rows")).select(
        "host", deduce("rows").alias("template")
    )


def main_text(page: Page, elements: set, runs: set, main: set) -> str:
    """Blocks of the main slots, one line each, without runs of the template."""
    # With no article text, a form may enclose the whole page.
    inside = [b for b in page.blocks if not b.outside] or [
        b for b in page.blocks if b.outside == "form"
    ]
    articles = [b for b in inside if b.article]
    chosen = articles or [
        b for b in inside if slot_of(_named(_place(b.path)), elements) in main
    ] or inside

    def text(block, template) -> str:
        kept = [
            t
            for t, _ in block.runs
            if not template or not t.strip() or _run_token(block.path, squeeze(t)) not in template
        ]
        return squeeze("".join(kept))

    whole = [text(b, None) for b in chosen]
    told = [text(b, runs) for b in chosen] if runs else whole
    if 2 * sum(map(len, told)) < sum(map(len, whole)):
        told = whole
    return "\n".join(t for t in told if t)


def extract(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every page."""
    source = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")
    )
    stats = materialize(_statistics(source), "page-tokens")
    counted = stats.where(F.col("kind") == PAGE).select("host", "pages")
    total = counted.agg(F.sum("pages")).first()[0] or 0
    # The pages of small hosts together are one more host, named by null.
    small = counted.where(F.col("pages") < PAGES).select("host")
    pooled = (
        stats.join(small, "host", "left_semi")
        .groupBy("kind", "token")
        .agg(
            F.first("path").alias("path"),
            F.bit_xor("vector").alias("vector"),
            *[F.sum(c).alias(c) for c in SUMS],
        )
        .select(F.lit("*").alias("host"), "kind", "token", "path", "vector", *SUMS)
    )
    own = materialize(_templates(stats), "page-templates")
    rest = _templates(pooled).select("template").first()
    rest = tuple(rest["template"]) if rest is not None else ([], [], [])
    # Fewer than a hundred hosts have more than a hundredth of the pages.
    hot = [r["host"] for r in counted.where(F.col("pages") * 100 > total).select("host").collect()]
    salts = F.when(F.col("host").isin(hot), SALTS).otherwise(1) if hot else F.lit(1)
    dealt = own.withColumn("salt", F.explode(F.sequence(F.lit(0), (salts - 1).cast("int"))))
    named = F.pandas_udf(lambda urls: urls.map(host_of), T.StringType())
    asked = source.withColumn("host", named("url")).withColumn(
        "salt", F.pmod(F.xxhash64("page_id", "url", F.length("html")), salts).cast("int")
    )
    joined = asked.join(dealt, ["host", "salt"], "left").select("page_id", "url", "html", "template")
    schema = T.StructType(
        [
            joined.schema["page_id"],
            joined.schema["url"],
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )

    def work(batches):
        last, sets = None, [set(x) for x in rest]
        for batch in batches:
            texts = []
            for source, template in zip(
                batch.column("html").to_pylist(), batch.column("template").to_pylist()
            ):
                told = tuple(template.values()) if template is not None else rest
                if told != last:
                    last, sets = told, [set(x) for x in told]
                texts.append(main_text(parse(source or ""), *sets))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=schema.fieldNames(),
            )

    found = joined.mapInArrow(work, schema)
    return found.select(
        F.col("page_id").alias(page_id), F.col("url").alias(url), "text", "n_chars"
    )
