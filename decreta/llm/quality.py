"""Quality rules: counts per text, and a calibrated logistic regression on n-grams.

The classifier reads hashed frequencies of words, word pairs and byte n-grams. It is
fitted on a bounded sample of labelled rows (``sample`` per class), its probability is
calibrated on a part of the sample that the weights have not seen, and every document is
scored in Arrow batches against fixed thresholds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from decreta.llm.batches import column, map_batches, pieces, raw, split_words, word_hashes

BUCKETS_LOG2 = 17
BYTE_NGRAMS = (3, 5)
# Bytes of text judged at a time: their n-grams take some eighty times as many.
PIECE_BYTES = 1 << 20
# Labelled rows of each class that the classifier is fitted on, at most. Spark cuts such a
# ranking before the shuffle up to spark.sql.optimizer.windowGroupLimitThreshold (1,000).
SAMPLE_PER_CLASS = 1_000
# A document is rejected below this probability of being good.
MIN_PROBABILITY = 0.2
MIN_WORDS, REPEAT_WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_MIX = np.uint64(0x9E3779B97F4A7C15)  # golden ratio, for multiplicative hashing
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, probability double")


class Batch:
    """Bytes and words of several texts side by side, each text apart from the next."""

    def __init__(self, texts: list[bytes]):
        pad = max(BYTE_NGRAMS)
        self.texts, self.n = texts, len(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(sizes + pad)[:-1]]).astype(np.int64) if self.n else sizes
        self.ends = self.starts + sizes
        self.bytes = np.frombuffer((b"\0" * pad).join([*texts, b""]), np.uint8)
        self.ids, self.vocabulary, self.n_words = split_words(texts)
        self.doc = np.repeat(np.arange(self.n), self.n_words)
        self.word_ends = np.cumsum(self.n_words)

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return total[self.ends] - total[self.starts]


def repeat_words(b: Batch, window: int = REPEAT_WINDOW) -> np.ndarray:
    """Words in windows of ``window`` words (a power of two) found twice or more in a text."""
    n, ids = len(b.ids), b.ids
    step = 1
    while step < window and len(ids) > step:
        ids = pd.factorize(ids[:-step] * np.int64(n + 1) + ids[step:])[0].astype(np.int64)
        step *= 2
    if step < window or not len(ids):
        return np.zeros(b.n, np.int64)
    doc, at = b.doc[:len(ids)], np.arange(len(ids))
    inside = at + window <= b.word_ends[doc]
    codes = pd.factorize(doc[inside] * np.int64(n + 1) + ids[inside])[0]
    twice = at[inside][np.bincount(codes)[codes] > 1] if len(codes) else at[:0]
    mark = np.zeros(n + 1, np.int64)
    np.add.at(mark, twice, 1)
    np.subtract.at(mark, twice + window, 1)
    return np.bincount(b.doc[np.cumsum(mark)[:n] > 0], minlength=b.n)


def base_numbers(b: Batch) -> dict[str, np.ndarray]:
    def dup_lines(text):
        lines = [x for x in text.split(b"\n") if x.strip()]
        return len(lines) - len(set(lines))

    points = b.per_text((b.bytes & 0xC0) != 0x80)
    repeated = repeat_words(b)
    return {
        "n_words": b.n_words, "word_chars": points - b.per_text(_SPACE[b.bytes]), "n_symbols": b.per_text(_SYMBOL[b.bytes]),
        "n_dup_lines": np.array([dup_lines(t) for t in b.texts], np.int64), "n_repeat_words": repeated,
        "base_failed": (b.n_words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * b.n_words),
    }


def features(b: Batch):
    """For each kind of n-gram: bucket of each occurrence and its text."""
    shift = np.uint64(64 - BUCKETS_LOG2 + 2)  # a quarter of the buckets for each kind

    def bucket(values, kind):
        return ((values * _MIX) >> shift).astype(np.int64) + (kind << (BUCKETS_LOG2 - 2))

    words = word_hashes(b.ids, b.vocabulary)
    yield bucket(words, 0), b.doc
    same = b.doc[:-1] == b.doc[1:]
    yield bucket((words[:-1] * np.uint64(31) + words[1:])[same], 1), b.doc[:-1][same]
    doc = np.repeat(np.arange(b.n), b.ends - b.starts)
    at = np.arange(len(doc)) + (b.starts - np.concatenate([[0], np.cumsum(b.ends - b.starts)[:-1]]))[doc] if b.n else doc
    for kind, n in enumerate(BYTE_NGRAMS, 2):
        value = np.zeros(len(b.bytes), np.uint64)
        for k in range(n):
            value[:len(value) - k] += b.bytes[k:].astype(np.uint64) << np.uint64(8 * k)
        yield bucket(value[at], kind), doc


def _margin(b: Batch, weights: np.ndarray) -> np.ndarray:
    """Weight of a text: for each kind of n-gram the mean over its occurrences."""
    out = np.zeros(b.n)
    for at, doc in features(b):
        out += np.bincount(doc, weights[at], b.n) / np.maximum(1, np.bincount(doc, minlength=b.n))
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _groups(texts: list[bytes]):
    """The texts in order, in groups of at most ``PIECE_BYTES`` or one text."""
    start = total = 0
    for i, t in enumerate(texts):
        if total and total + len(t) > PIECE_BYTES:
            yield texts[start:i]
            start, total = i, 0
        total += len(t)
    if texts:
        yield texts[start:]


def fit(texts: list[bytes], good: np.ndarray, base_rate: float, steps: int = 80) -> tuple[np.ndarray, float, float]:
    """Weights, slope and offset. Every third text calibrates, the others train.

    ``base_rate``: share of good rows among all labelled ones, as the sample is balanced.
    """
    held = np.arange(len(texts)) % 3 == 2
    rows, cols, vals, size, n = [], [], [], 1 << BUCKETS_LOG2, 0
    train = [t for t, h in zip(texts, held) if not h]
    for group in _groups(train):
        b = Batch(group)
        for where, doc in features(b):
            keys, counts = np.unique(doc * size + where, return_counts=True)
            owner = keys // size
            rows.append(owner + n)
            cols.append(keys % size)
            vals.append(counts / np.maximum(1, np.bincount(doc, minlength=b.n))[owner])
        n += b.n
    row, col, val = np.concatenate(rows), np.concatenate(cols), np.concatenate(vals)
    del rows, cols, vals
    y = good[~held].astype(float)
    share = np.where(y > 0, 1 / max(1, (y > 0).sum()), 1 / max(1, (y == 0).sum())) / 2
    w, m, v, rate = np.zeros(size), np.zeros(size), np.zeros(size), 2.0
    for step in range(1, steps + 1):
        g = (_sigmoid(np.bincount(row, w[col] * val, n)) - y) * share
        grad = np.bincount(col, g[row] * val, size) + 1e-7 * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    w = w.astype(np.float32)
    calibration = [t for t, h in zip(texts, held) if h]
    score = np.concatenate([_margin(Batch(group), w) for group in _groups(calibration)] or [np.zeros(0)])
    y = good[held]
    weight = np.where(y, base_rate / max(1, y.sum()), (1 - base_rate) / max(1, (~y).sum()))
    # Smoothed targets keep the slope finite where the classes separate.
    target = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    slope, offset = 1.0, 0.0
    for _ in range(100):  # Newton steps on two parameters
        p = _sigmoid(slope * score + offset)
        g, h = weight * (p - target), weight * p * (1 - p) + 1e-12
        a, c, d = (h * score * score).sum() + 1e-6, (h * score).sum(), h.sum() + 1e-6
        gs, go = (g * score).sum() + 1e-6 * slope, g.sum()
        det = a * d - c * c
        ds, do = (d * gs - c * go) / det, (a * go - c * gs) / det
        size_of_step = max(abs(ds), abs(do))
        scale = min(1.0, 2.0 / size_of_step) if size_of_step else 1.0
        slope, offset = slope - scale * ds, offset - scale * do
        if size_of_step < 1e-9:
            break
    return w, float(slope), float(offset)


def train_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_PER_CLASS):
    """Fit on at most ``sample`` labelled documents of each class, chosen by a hash of
    their id; ``None`` where a class has no labelled document. Null labels, ids without
    a document and null texts are left out; a document with both labels counts as bad."""
    spark = docs.sparkSession
    known = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    classes = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = Window.partitionBy("quality").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= sample)
    # At most 2 * sample ids, a proven bound.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")

    def run(_, table):
        frame = table.to_pandas().drop_duplicates("doc_id")
        frame = frame.iloc[np.argsort(frame["rank"].to_numpy() * 2 + frame["quality"].to_numpy(), kind="stable")]
        good = frame["quality"].to_numpy() == 1
        if good.all() or not good.any():
            return pa.table({"w": pa.array([], pa.binary()), "slope": pa.array([], pa.float64()), "offset": pa.array([], pa.float64())})
        w, slope, offset = fit([t.encode() for t in frame["text"]], good, classes.get(1, 0) / max(1, sum(classes.values())))
        return pa.table({"w": [w.tobytes()], "slope": [slope], "offset": [offset]})

    fitted = rows.groupBy(F.lit(0).alias("one")).applyInArrow(run, "w binary, slope double, offset double").collect()
    if not fitted:
        return None
    return spark.sparkContext.broadcast((np.frombuffer(fitted[0]["w"], np.float32), fitted[0]["slope"], fitted[0]["offset"]))


def judge(model, min_probability: float):
    """Function from texts to the columns of SCHEMA except ``doc_id``."""
    def fn(texts: list[bytes]) -> dict:
        b = Batch(texts)
        numbers = base_numbers(b)
        if model is None:
            p, kept = [None] * b.n, ~numbers["base_failed"]
        else:
            w, slope, offset = model.value
            p = _sigmoid(slope * _margin(b, w) + offset)
            kept = ~numbers["base_failed"] & (p >= min_probability)
        return numbers | {"probability": p, "kept": kept}

    return fn


def quality(docs: DataFrame, labels: DataFrame, min_probability: float = MIN_PROBABILITY, sample: int = SAMPLE_PER_CLASS) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``): the counts of SCHEMA, whether the
    base rules fail, the calibrated probability of being good, and ``kept``.

    Null texts have no word and fail. Without labelled rows of both classes there is no
    classifier: the probability is null and the base rules decide alone.
    """
    decide = judge(train_quality(docs, labels, sample), min_probability)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_batches(rows, lambda batch: decide(raw(batch)) | {"doc_id": column(batch, "doc_id")}, SCHEMA, limit=PIECE_BYTES)


def keep_good(docs: DataFrame, labels: DataFrame, min_probability: float = MIN_PROBABILITY, sample: int = SAMPLE_PER_CLASS) -> DataFrame:
    """The rows of ``docs`` that ``quality`` keeps, with all their columns."""
    decide = judge(train_quality(docs, labels, sample), min_probability)

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text", PIECE_BYTES):
                yield part.filter(pa.array(decide(raw(part))["kept"]))

    return docs.mapInArrow(run, docs.schema)
