"""Toxicity, hard negatives and lexical search: nulls, empty and very long texts, ties,
repeated rows, empty tables and clashing names, against brute force or held-out labels."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from decreta.llm import hard_negatives, lexical, toxicity

from .conftest import edge_rows, words


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def terms_of(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def ranked(docs, items, k):
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= set(terms_of(text))
    counts = [(i, Counter(terms_of(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, terms in wanted.items():
        scored = []
        for doc_id, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


ITEMS = [(1, words(1, 20)), (1, words(2, 10)), (2, "one TWO x"), (3, None), (4, ""), (None, words(2, 5) + " É ü"), (None, "words"), (5, words(7, 3000)), (6, "nowhere")]


@pytest.mark.parametrize(("k", "postings"), [(10, 1 << 20), (3, 1 << 20), (10, 40)])
def test_lexical_search_equals_brute_force(spark, edges, k, postings, monkeypatch):
    monkeypatch.setattr(lexical, "PAIRS_AT_A_TIME", 7)
    items = spark.createDataFrame([(*x, "c") for x in ITEMS], "item_id long, text string, score string")
    got = lexical.lexical_search(edges, items, k, postings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted_rows(got) == ranked([(r[0], r[1]) for r in edge_rows()], ITEMS, k)


def test_lexical_search_of_nothing(spark, edges, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.lexical_search(nothing, items).count() == 0
    assert lexical.lexical_search(edges, items.limit(0)).count() == 0


def test_scores_beyond_doubles_are_exact():
    index = lexical.Index(np.array([0, 1, 0]), np.array([0, 0, 1]), 2, 2)
    big = (1 << 60) + 1
    assert index.scores(np.array([0, 0]), np.array([0, 1]), np.array([big, 2]), 1).tolist() == [[big + 2, big]]


def mined(rows, positives, negatives, every):
    part = []
    for vec_id, label, v in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) or abs(256 * x) > 1 << 26 for x in v):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        part.append((vec_id, label, tuple(math.floor(256 * x) for x in v)))
    out = []
    for vec_id, label, v in {r for r in part if r[0] is not None and r[0] % every == 0}:
        others = [(-sum(a * b for a, b in zip(v, w)), i is None, i or 0, i, lab) for i, lab, w in part if i != vec_id and len(w) == len(v)]
        for p in sorted(x[:4] for x in others if x[4] == label)[:positives]:
            window = sorted(x[:4] for x in others if x[4] != label and 30 * -p[0] <= 100 * -x[0] <= 90 * -p[0])
            out += [(vec_id, p[3], r, x[3], -p[0], -x[0]) for r, x in enumerate(window[:negatives], 1)]
    return sorted(out, key=str)


VECTOR = "vec_id long, label int, embedding array<float>, a string, row string, low string"


def vector_rows(n=400, dim=6):
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(10)), (rng.normal(size=dim) + 0.7).astype(np.float32).tolist()) for i in range(n)]
    same = rows[20][2]
    rows += [(1000 + i, i % 3, same) for i in range(150)]  # a large group of equal vectors
    return rows + [(20, rows[20][1], same), rows[40], (None, 3, same), (None, 4, same), (41, None, same), (42, 1, None), (43, 1, [None] + [1.0] * 5),
                   (44, 1, [float("nan")] + [1.0] * 5), (45, 1, [float("inf")] + [1.0] * 5), (46, 1, [1e30] + [1.0] * 5), (60, 2, [1.0, 2.0]), (61, 2, [1.0, 1.0]),
                   (62, 3, [0.5, 0.5]), (80, 1, []), (81, 1, []), (82, 2, []), (-20, 4, [0.0] * 6), (100, 5, [-1.0] * 6), (2000, 5, [300.0] * 6)]


@pytest.mark.parametrize(("leaf", "group"), [(256, 1 << 16), (4, 50)])
def test_hard_negatives_equal_brute_force(spark, leaf, group, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAF_ROWS", leaf)
    monkeypatch.setattr(hard_negatives, "ROWS_PER_GROUP", group)
    rows = vector_rows()
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], VECTOR).repartition(3)
    got = hard_negatives.hard_negatives(df, anchor_every=20)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted_rows(got) == mined(rows, 5, 10, 20)
    assert hard_negatives.hard_negatives(df.limit(0)).count() == 0


def test_boxes_prune_and_keep_every_hit():
    rng = np.random.default_rng(2)
    v = np.floor(256 * np.concatenate([rng.normal(c, 0.05, (300, 8)) for c in range(6)]))
    ids, labels = np.arange(len(v)), np.arange(len(v)) % 4
    tree, seen = hard_negatives.pack(v, ids, labels), []

    def leaves(node):
        return [node] if node.rows is not None else [x for c in node.children for x in leaves(c)]

    assert all((n.low <= n.rows[0]).all() and (n.rows[0] <= n.high).all() for n in leaves(tree))
    assert sorted(np.concatenate([n.rows[1] for n in leaves(tree)]).tolist()) == ids.tolist()
    for low, high in ((-10**15, 10**15), (100_000, 900_000), (5, 4)):
        found = hard_negatives.search(tree, v[0], 0, 0, False, np.array([low]), np.array([high]), 10)
        scores = (v @ v[0]).astype(int)
        expected = sorted((-scores[i], i) for i in ids if labels[i] != 0 and low <= scores[i] <= high and i)[:10]
        assert [(-s, i) for _, s, i in found] == expected
        seen.append(len(found))
    assert seen[0] == 10 and seen[2] == 0


def toxic_rows():
    """Invented insults: three words, and a stem with changing endings; some labels missing."""
    rng = np.random.default_rng(9)
    rows, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        text = words(i, 60).split(" ")
        if toxic:
            bad = ["Grobnik", "zwerpa", "flumpo"] if i % 12 else [f"Trollex{e}" for e in ("an", "ero", "ist")]
            for w in bad:
                text.insert(int(rng.integers(len(text))), w)
        rows.append((i, " ".join(text), "en" if i % 2 else None, None, None, *["c"] * 11))
        if i % 10 != 9:
            labels.append((i, 1, int(toxic)))
    labels += [(None, 1, 1), (5, 1, None), (10**6, 0, 1)]
    return rows, labels


def test_toxicity_on_held_out_texts(spark):
    from .conftest import SCHEMA

    rows, labels = toxic_rows()
    extra = [(None, "Grobnik zwerpa flumpo", *[None] * 14), (700, None, *[None] * 14), (700, "", *[None] * 14), (701, words(3, 30_000), *[None] * 14)]
    docs = spark.createDataFrame(rows + extra, SCHEMA).repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    got = toxicity.toxicity(docs, marks, held).collect()
    assert len(got) == len(rows) + len(extra)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    assert all(r.predicted == (r.doc_id % 6 == 0) for r in got if r.doc_id is not None and r.doc_id < 600)
    odd = {r.doc_id: r for r in got if r.doc_id is None or r.doc_id >= 600}
    assert odd[None].predicted == 1 and not odd[None].held_out and odd[700].predicted == 0 and odd[701].predicted == 0
    # Labels of held-out rows change nothing.
    turned = [(i, q, 1 - t if i is not None and t is not None and _held(i) else t) for i, q, t in labels]
    again = toxicity.toxicity(docs, spark.createDataFrame(turned, "doc_id long, quality int, toxic int"), held)
    assert {(r.doc_id, r.predicted) for r in again.collect()} == {(r.doc_id, r.predicted) for r in got}


def _held(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 3 == 1


def test_toxicity_without_labels_or_documents(spark, edges, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(edges, none, F.lit(False)).collect()
    assert len(got) == len(edge_rows()) and {(r.score, r.predicted) for r in got} == {(0.0, 0)}
    bad = spark.createDataFrame([(1, 1, 1), (9, 1, 1)], "doc_id long, quality int, toxic int")
    assert {(r.score, r.predicted) for r in toxicity.toxicity(edges, bad, F.lit(None)).collect()} == {(1.0, 1)}
    assert toxicity.toxicity(nothing, none, F.lit(True)).count() == 0
    texts, feature = toxicity.found([None, "", "!!", "AB ab Ärger ärgern"])
    assert set(texts.tolist()) == {3} and len(feature) == 8
