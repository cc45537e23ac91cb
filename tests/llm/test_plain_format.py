import random

import pytest

from decreta.llm import secrets
from tests.llm.conftest import words


@pytest.mark.parametrize("share", [0.02, 1 / 3, 0.9])
def test_common_keyless_keys_are_found(spark, share):
    rng = random.Random(9)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows = [(i, f"{words(i, 30)} {i} in {1990 + i % 40} {hexes(40)}") for i in range(60)]
    keys = {1000 + i for i in range(600) if rng.random() < share}
    for i in range(1000, 1600):
        plain = f"mail{i}.{words(i % 9, 1)}example.com/contact" if i % 2 else str(rng.randrange(10**15, 10**16))
        rows.append((i, f"{words(i, 5)} {hexes(28) if i in keys else plain} end"))
    got = {r.doc_id: r.spans for r in secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = {i for i in range(1000, 1600) if "format" in got[i]}
    assert len(found & keys) >= 0.98 * len(keys) and not found - keys


def syllables(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(["th", "an", "er", "in", "on", "re", "ed", "nd", "ha", "at", "en"], k=rng.randint(1, 4))) for _ in range(n))


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"])
@pytest.mark.parametrize("share", [0.02, 1 / 3, 0.9])
def test_keys_of_one_case_are_found(spark, letters, share):
    rng = random.Random(5)
    key = lambda: "".join(rng.choice(letters) for _ in range(32))
    rows = [(i, f"{syllables(i, 30)} password: {key()} end") for i in range(200)]
    keys = {1000 + i for i in range(600) if rng.random() < share}
    for i in range(1000, 1600):
        plain = syllables(i, 8).replace(" ", "")[:40]  # words run together
        rows.append((i, f"{syllables(i, 5)} {key() if i in keys else plain} end"))
    got = {r.doc_id: r.spans for r in secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = {i for i in range(1000, 1600) if "format" in got[i]}
    assert len(found & keys) >= 0.98 * len(keys) and not found - keys


def test_candidates_overlap_no_base_span():
    text = "é password = " + "a" * 20 + " " + "b" * 16 + " " + "0a" * 20 + "zzzz AKIA" + "Q" * 20 + "x " + "C" * 17
    spans = secrets.find_spans([text.encode()])[0]
    for s in spans:
        assert text[s["value_start"]:s["end"]] == s["value"]
    assert [(s["kind"], s["value"]) for s in spans if s["kind"] == 3] == [(3, "b" * 16), (3, "C" * 17)]
    many = ("password=" + "k" * 12 + " ä " + "z" * 20 + " ") * 20_000
    assert len(secrets.find_spans([many.encode()])[0]) == 40_000
