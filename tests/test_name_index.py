"""The name index against brute force: scores, ties, shards, long and empty names."""

import random

import pytest
from pyspark.sql import functions as F

from decreta.functions.similarity import common_lengths, sorted_tokens
from decreta.operators import name_index
from decreta.operators.matching import fuzzy_match
from decreta.operators.name_index import indexed_top

ENTRY = "choice string, canonical string, sport_id string, ord struct<pri:int,pos:bigint>"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def token_sort(a, b):
    a, b = sorted_tokens(a), sorted_tokens(b)
    return 2.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def trigram(a, b):
    def tri(x):
        x = "  " + x.lower().strip() + " "
        return {x[i:i + 3] for i in range(len(x) - 2)}

    s, t = tri(a), tri(b)
    inside = 0.15 if a.lower() in b.lower() or b.lower() in a.lower() else 0.0
    return min(1.0, len(s & t) / (len(s) + len(t) - len(s & t)) + inside + min(len(a), len(b)) / max(len(a), len(b), 1) * 0.1)


def made_up(seed, n):
    rng = random.Random(seed)
    words = ["спорт", "бокс", "Гребля", "на", "лыжах", "ski", "box", "Kung", "fu", "пауэрлифтинг"]
    names = {" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(n)}
    return sorted(names) + ["a", "", "x" * 90, ("long name " * 12).strip(), "ski  ski", "№ 1"]


@pytest.mark.parametrize(("scorer", "score"), [("trigram", trigram), ("token_sort", token_sort)])
@pytest.mark.parametrize(("entries", "share", "block"), [(50_000, 20_000, 256), (40, 30, 7)])
def test_index_equals_brute_force(spark, scorer, score, entries, share, block, monkeypatch):
    monkeypatch.setattr(name_index, "BLOCK_ENTRIES", block)
    choices = [(c, c.upper(), str(i % 9), (i % 2, i // 3)) for i, c in enumerate(made_up(1, 120))]
    names = made_up(2, 60) + ["spki box", "бокс спорт!", "zzz", "y" * 70, "box " * 30]
    asked = spark.createDataFrame([(n,) for n in names] + [(None,), ("zzz",)], "name string")
    got = {r.name: r for r in indexed_top(asked, spark.createDataFrame(choices, ENTRY), 4, scorer, entries, share).collect()}
    assert set(got) == set(names)
    for n in names:
        best = sorted((-score(n, c[0]), c[3], c[0], c[1], c[2]) for c in choices)[:4]
        assert [(round(t.neg, 12), tuple(t.ord), t.choice, t.canonical, t.sport_id) for t in got[n]._top] == [(round(b[0], 12), *b[1:]) for b in best], n
        assert 4 <= got[n].scored <= len(choices)


def test_few_pairs_are_scored(spark):
    rng = random.Random(4)
    names = sorted({"".join(rng.choices("abcdefghij", k=rng.randint(5, 30))) for _ in range(3000)})
    choices = spark.createDataFrame([(c, c, "1", (1, i)) for i, c in enumerate(names)], ENTRY)
    asked = spark.createDataFrame([(n[1:],) for n in names[:300]], "name string")
    for scorer in ("trigram", "token_sort"):
        assert indexed_top(asked, choices, 1, scorer).agg(F.sum("scored")).first()[0] < 0.05 * 300 * len(names)


def test_no_names_or_no_registry(spark):
    choices = spark.createDataFrame([], ENTRY)
    names = spark.createDataFrame([("a",)], "name string")
    for scorer in ("trigram", "token_sort"):
        got = fuzzy_match(names, choices, scorer=scorer, inline_limit=-1).first()
        assert (got.canonical_name, got.confidence, got.method, got.alternatives) == (None, 0.0, "not_found", [])
        assert fuzzy_match(names.limit(0), choices, scorer=scorer).count() == 0


def test_common_lengths_of_any_length():
    rng = random.Random(3)
    for n in (0, 1, 5, 63, 64, 65, 200):
        text = "".join(rng.choices("abcdé", k=n))
        others = ["".join(rng.choices("abcdefé", k=rng.choice([0, 1, 30, 64, 130]))) for _ in range(9)]
        assert common_lengths(text, others) == [lcs(text, o) for o in others]
        assert common_lengths(text, others[:1]) == [lcs(text, others[0])]
        assert common_lengths(text, []) == []
