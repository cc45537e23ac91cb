"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of up to ORDER bytes is counted on a bounded
sample of labelled documents. A byte is coded in the longest context that the language
knows; if it was never seen there, an escape is coded and the next shorter context tries,
without the bytes that the longer one has ruled out (method C, with exclusion). The
counts are frozen: the code length of a text is the sum over its bytes, and the language
with the shortest code wins.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from decreta.llm.batches import column, map_batches, raw

ORDER = 3
# Documents of each language that its tree is counted on, at most.
SAMPLE_PER_LANGUAGE = 1_000
# Slots of the table of known contexts, as a power of two.
TABLE_LOG2 = 20
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_PAD = b" " * ORDER  # what every text is taken to follow
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The last ORDER + 1 bytes at each byte of the texts as one number, and the end of
    each text among them."""
    buffer = np.frombuffer(b"".join(_PAD + t for t in texts), np.uint8).astype(np.uint32)
    code = np.zeros(len(buffer), np.uint32)
    for k in range(ORDER + 1):
        code[k:] |= buffer[:len(buffer) - k] << np.uint32(8 * k)
    ends = np.cumsum([len(t) + ORDER for t in texts])
    keep = np.ones(len(buffer), bool)
    for k in range(ORDER):
        keep[np.concatenate([[0], ends[:-1]]).astype(np.int64) + k] = False
    return code[keep], ends - ORDER * np.arange(1, len(texts) + 1)


class Tree:
    """Counts of one language: for each order the contexts and their next bytes."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        self.levels = []
        for order in range(ORDER, -1, -1):
            grams, where = np.unique(codes & np.uint32((1 << 8 * (order + 1)) - 1), return_inverse=True)
            n = np.bincount(where, counts, len(grams)) if len(grams) else np.zeros(0)
            contexts, of = np.unique(grams >> np.uint32(8), return_inverse=True)
            self.levels.append({"grams": grams, "counts": n, "contexts": contexts, "of": of,
                                "total": np.bincount(of, n, len(contexts)), "kinds": np.bincount(of, minlength=len(contexts)).astype(float)})
        for level, shorter, order in zip(self.levels, self.levels[1:], range(ORDER, 0, -1)):
            # What a context rules out in the next shorter one when it escapes.
            _, there = self._find(shorter["grams"], level["grams"] & np.uint32((1 << 8 * order) - 1))
            level["ruled_out"] = np.bincount(level["of"], shorter["counts"][there], len(level["contexts"]))

    @staticmethod
    def _find(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(known, wanted), max(0, len(known) - 1))
        return (known[at] == wanted) if len(known) else np.zeros(len(wanted), bool), at

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each code after the bytes before it."""
        out = np.zeros(len(codes))
        todo = np.arange(len(codes))
        less_total, less_kinds = np.zeros(len(codes)), np.zeros(len(codes))
        for order, level in zip(range(ORDER, -1, -1), self.levels):
            if not len(todo):
                break
            gram = codes[todo] & np.uint32((1 << 8 * (order + 1)) - 1)
            known, c = self._find(level["contexts"], gram >> np.uint32(8))
            seen, g = self._find(level["grams"], gram)
            kinds = np.where(known, level["kinds"][c] - less_kinds[todo], 0) if len(level["contexts"]) else np.zeros(len(todo))
            total = np.where(known, level["total"][c] - less_total[todo] + kinds, 1) if len(level["contexts"]) else np.ones(len(todo))
            # A context whose bytes are all ruled out says nothing.
            says = kinds > 0
            hit = seen & says
            out[todo[hit]] += np.log2(total[hit] / level["counts"][g[hit]])
            escape = says & ~seen
            out[todo[escape]] += np.log2(total[escape] / kinds[escape])
            if order:
                step = todo[known]
                less_total[step] = level["ruled_out"][c[known]] if len(level["contexts"]) else 0
                less_kinds[step] = level["kinds"][c[known]] if len(level["contexts"]) else 0
            else:
                less_kinds[todo] = len(level["grams"])
            todo = todo[~hit]
        out[todo] += np.log2(np.maximum(1, 256 - less_kinds[todo]))
        return out


class Model:
    """All trees, and the costs of every context that one of them knows in one table."""

    def __init__(self, trees: dict[str, Tree]):
        self.names = sorted(trees)
        self.trees = [trees[n] for n in self.names]
        size = 1 << TABLE_LOG2
        self.keys, self.full = np.zeros(size, np.uint32), np.zeros(size, bool)
        self.costs = np.zeros((size, len(self.names)), np.float32)
        counts = {}
        codes = np.unique(np.concatenate([t.levels[0]["grams"] for t in self.trees]))
        total = np.zeros(len(codes))
        for t in self.trees:
            found, at = Tree._find(t.levels[0]["grams"], codes)
            total[found] += t.levels[0]["counts"][at[found]]
        # Of codes with one slot the most frequent one has it; the trees serve the others.
        codes = codes[np.argsort(total, kind="stable")]
        slot = self._slot(codes)
        self.keys[slot], self.full[slot] = codes, True
        mine = np.flatnonzero(self.full)
        self.costs[mine] = np.stack([t.bits(self.keys[mine]) for t in self.trees], axis=1)

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (codes.astype(np.uint64) * _MIX >> np.uint64(64 - TABLE_LOG2)).astype(np.int64)

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text in each language."""
        codes, ends = _grams(texts)
        slot = self._slot(codes)
        costs = self.costs[slot]
        other = np.flatnonzero(~(self.full[slot] & (self.keys[slot] == codes)))
        if len(other):
            rare, where = np.unique(codes[other], return_inverse=True)
            costs[other] = np.stack([t.bits(rare) for t in self.trees], axis=1)[where]
        out = np.zeros((len(texts), len(self.names)))
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        some = np.flatnonzero(ends > starts)
        if len(some):
            out[some] = np.add.reduceat(costs, starts[some], axis=0, dtype=np.float64)
        return out


def _hash_bound(rows: int, wanted: int) -> int:
    """The 64-bit hash at or below which about ``wanted`` of ``rows`` lie."""
    return (1 << 63) - 1 if wanted >= rows else (1 << 64) * wanted // rows - (1 << 63)


def train_languages(docs: DataFrame, sample: int = SAMPLE_PER_LANGUAGE):
    """Trees from at most ``sample`` rows of each language (``doc_id, text, lang``, the
    rows to learn from), chosen by a hash of their id; ``None`` without any.

    The number of rows of each language, known from that column alone, says below which
    hash the sample lies, so that only about twice the sample is shuffled and ranked,
    however many rows or partitions there are. Where most texts of a language are null,
    its sample is smaller.
    """
    spark = docs.sparkSession
    known = docs.filter("lang IS NOT NULL")
    rows_of = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not rows_of:
        return None
    below = F.create_map(*[x for name, n in rows_of.items() for x in (F.lit(name), F.lit(_hash_bound(n, 2 * sample + 100)))])
    hashed = F.xxhash64(F.col("doc_id").cast("long"))
    order = Window.partitionBy("lang").orderBy("hash", "doc_id")
    chosen = known.filter((hashed <= F.element_at(below, F.col("lang"))) & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", "text", hashed.alias("hash")).withColumn(
        "rank", F.row_number().over(order)).filter(F.col("rank") <= sample)

    def count(key, table):
        # Whole documents, at most ``sample`` of them.
        codes, counts = np.unique(_grams([t.encode() for t in table.column("text").to_pylist()])[0], return_counts=True)
        return pa.table({"lang": [key[0].as_py()], "codes": [codes.tobytes()], "counts": [counts.astype(np.int64).tobytes()]})

    found = chosen.select("lang", "text").groupBy("lang").applyInArrow(count, "lang string, codes binary, counts binary").collect()
    if not found:
        return None
    trees = {r["lang"]: Tree(np.frombuffer(r["codes"], np.uint32), np.frombuffer(r["counts"], np.int64).astype(float)) for r in found}
    return spark.sparkContext.broadcast(Model(trees))


def predict_languages(docs: DataFrame, model) -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text of ``docs`` (``doc_id, text``).

    ``score``: share of the winner in the probabilities that the code lengths stand for.
    ``und`` with score 0 for texts that are null or have no letter, or without a model;
    of languages with equal code lengths the first in the alphabet wins.
    """
    def fn(batch):
        texts, names, scores = raw(batch), [], []
        lengths = model.value.code_lengths(texts) if model else np.zeros((len(texts), 1))
        best = lengths.argmin(axis=1)
        share = 1 / np.exp2(-np.minimum(1000, lengths - lengths.min(axis=1, keepdims=True))).sum(axis=1)
        for text, b, s in zip(texts, best.tolist(), share.tolist()):
            known = bool(model) and bool(_LETTER.search(text.decode()))
            names.append(model.value.names[b] if known else UNKNOWN)
            scores.append(s if known else 0.0)
        return {"doc_id": column(batch, "doc_id"), "lang_pred": names, "score": scores}

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fn, "doc_id long, lang_pred string, score double")
