import random

from corpus_pipeline import near_duplicates
from decreta.llm import near_copies
from tests.llm.conftest import words
from tests.llm.test_operators import components_of


def _docs():
    """Edited copies of two texts, at similarities on both sides of 0.8, and others."""
    rng, out = random.Random(8), []
    for base, n in ((900, 200), (901, 120)):
        for _ in range(150):
            text = words(base, n).split(" ")
            for at in rng.sample(range(n), rng.randint(0, 7)):
                text[at] = f"edit{rng.randrange(10**6)}"
            out.append(" ".join(text))
    out += [words(2000 + i, 60) for i in range(100)] + ["", None, " \n", "one two", "One  two", out[0]]
    return list(enumerate(out))


def test_stage_drops_edited_copies(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK", 16)
    rows = _docs()
    sets = [near_copies.shingles_of((t or "").encode()) for _, t in rows]
    near = lambda i, j: near_copies.jaccard(sets[i], sets[j]) >= 0.8 or not len(sets[i]) and not len(sets[j])
    groups = components_of(len(rows), near)
    expected = {min(i for i in range(len(rows)) if groups[i] == g) for g in set(groups)}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kept = near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(expected)


def test_stage_edges(spark, edges, nothing):
    rows = edges.collect()
    sets = [near_copies.shingles_of((r.text or "").encode()) for r in rows]
    near = lambda i, j: near_copies.jaccard(sets[i], sets[j]) >= 0.8 or not len(sets[i]) and not len(sets[j])
    assert near_copies.drop_near_copies(edges).count() == len(set(components_of(len(rows), near)))
    assert near_copies.drop_near_copies(nothing).count() == 0
