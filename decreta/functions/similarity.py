"""Name similarity: trigram score in Catalyst, token-sort score on bit masks in an Arrow UDF."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from decreta.functions.text import strip

# What containment adds to a trigram similarity, and close lengths at most.
CONTAINMENT, LENGTH_WEIGHT = 0.15, 0.1


def trigrams(c: Column) -> Column:
    """Distinct character trigrams of the padded lower-case name.

    A capturing lookahead reads all overlapping windows in one native expression.
    """
    padded = F.concat(F.lit("  "), strip(F.lower(c)), F.lit(" "))
    return F.array_distinct(F.regexp_extract_all(padded, F.lit("(?s)(?=(.{3}))"), F.lit(1)))


def jaccard(shared: Column, size_a: Column, size_b: Column) -> Column:
    return shared / (size_a + size_b - shared)


def containment_bonus(a: Column, b: Column) -> Column:
    la, lb = F.lower(a), F.lower(b)
    return F.when(la.contains(lb) | lb.contains(la), CONTAINMENT).otherwise(0.0)


def length_bonus(a: Column, b: Column) -> Column:
    na, nb = F.length(a), F.length(b)
    return F.least(na, nb) / F.greatest(na, nb, F.lit(1)) * LENGTH_WEIGHT


def trigram_score(a: Column, b: Column, tri_a: Column, tri_b: Column) -> Column:
    """Trigram similarity plus what containment and close lengths add, at most 1."""
    shared = F.size(F.array_intersect(tri_a, tri_b)).cast("double")
    base = jaccard(shared, F.size(tri_a), F.size(tri_b))
    return F.least(F.lit(1.0), base + containment_bonus(a, b) + length_bonus(a, b))


def sorted_tokens(text: str) -> str:
    return " ".join(sorted(text.split()))


def common_lengths(text: str, others: list[str]) -> list[int]:
    """Length of the longest common subsequence of ``text`` with each other text.

    Each character of ``text`` has a mask of its places. One pass over another text keeps
    a word of bits, in which every zero is a step of the subsequence; texts of up to 64
    characters run side by side in 64-bit words, longer ones in whole numbers.
    """
    masks: dict[str, int] = {}
    for i, c in enumerate(text):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(text)) - 1
    if len(text) > 64 or len(others) < 4:
        out = []
        for other in others:
            v = full
            for c in other:
                u = v & masks.get(c, 0)
                v = (v + u | v - u) & full
            out.append(len(text) - v.bit_count())
        return out
    width = max(map(len, others), default=0)
    # Characters that the text has not leave the word as it is, as does the padding.
    places = np.zeros((width, len(others)), np.uint64)
    for j, other in enumerate(others):
        places[:len(other), j] = [masks.get(c, 0) for c in other]
    v = np.full(len(others), full, np.uint64)
    for row in places:
        u = v & row
        v = v + u | v - u
    return (len(text) - np.bitwise_count(v & np.uint64(full)).astype(np.int64)).tolist()


def token_sort_score(a: Column, b: Column) -> Column:
    """Similarity of two names with their words sorted: 2 x LCS / (len a + len b)."""

    def scores(x: pd.Series, y: pd.Series) -> pd.Series:
        left, right = [sorted_tokens(v) for v in x], [sorted_tokens(v) for v in y]
        return pd.Series([2.0 * common_lengths(p, [q])[0] / (len(p) + len(q)) if p or q else 1.0
                          for p, q in zip(left, right)], dtype="float64")

    scores.__annotations__ = {"x": pd.Series, "y": pd.Series, "return": pd.Series}
    return F.pandas_udf(scores, T.DoubleType())(a, b)
