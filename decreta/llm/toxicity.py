"""Toxicity by weak supervision.

Features are distinct words and word openings of four to eight characters, the latter
also where a text has them in two words or more. On the labelled texts each feature is
counted with either label; the strongest ones become voters: words and single openings
are the lexicon, openings found twice the patterns. A generative model is fitted to the
votes of all texts: expectation maximisation gives each voter's accuracy, starting from
the labelled counts, and voters that fire together more than their accuracies explain
are correlated and count as one. Its posterior labels train a linear
classifier on a bounded sample of labelled texts, which scores every text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from decreta.llm.batches import column, map_batches, record, split_words
from decreta.session import staged

# Features of the classifier, and of these the voters of either kind, at most.
FEATURES, VOTERS = 2_048, 64
# Labelled texts of each class that the classifier is fitted on, at most.
SAMPLE_PER_CLASS = 4_000
# A feature must occur in as many toxic texts, and be as many times more common there.
LEAST_TEXTS, LEAST_LIFT = 3, 4.0
# Least log likelihood ratio of a feature, so that chance among many features makes none.
LEAST_RATIO = 10.0
# Correlation of two voters among toxic texts from which they count as one.
CORRELATED = 0.5
# Levels of a group of voters: 1, 2 to 3, 4 to 7, 8 and more that fire.
LEVELS = 4
THRESHOLD = 0.7
OPENINGS = range(4, 9)

_LETTER = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_TWICE = 1  # last bit of a feature: an opening found in two words or more
SEEN = "doc_id long, held_out boolean, features array<int>"


def word_features(word: bytes) -> list[int]:
    """Hashes of a word and its openings; the last bit is free for ``_TWICE``."""
    out = [xxhash.xxh64_intdigest(b"=" + word) >> 2 << 1]
    text = word.decode()
    for n in OPENINGS:
        if len(text) < n:
            break
        out.append(xxhash.xxh64_intdigest(b"^" + text[:n].encode()) >> 2 << 1)
    return out


def found(texts: list[str | None], known: dict[int, int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``text, feature`` of each distinct feature of each text. Words are runs of letters
    in lower case, where every character beyond ASCII counts as one. With ``known``
    features are given by their numbers there and all others are left out."""
    codes, vocabulary, sizes = split_words([(t or "").lower().encode().translate(_LETTER) for t in texts])
    width = max(1, len(vocabulary))
    pairs = np.unique(np.repeat(np.arange(len(texts), dtype=np.int64), sizes) * width + codes)
    text, word = pairs // width, pairs % width
    own = [word_features(w) for w in vocabulary]
    if known is not None:
        own = [[f for f in fs if f in known or f + _TWICE in known] for fs in own]
    n = np.array([len(fs) for fs in own], np.int64)
    flat = np.array([f for fs in own for f in fs], np.int64)
    starts = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    times = n[word] if len(word) else n[:0]
    at = np.repeat(starts[word] - np.concatenate([[0], np.cumsum(times)[:-1]]).astype(np.int64), times) + np.arange(times.sum()) if len(word) else word
    names, code = np.unique(flat, return_inverse=True)
    keys, words = np.unique(np.repeat(text, times) * max(1, len(names)) + code[at], return_counts=True)
    text, feature = keys // max(1, len(names)), names[keys % max(1, len(names))] if len(names) else keys
    twice = words > 1
    text, feature = np.concatenate([text, text[twice]]), np.concatenate([feature, feature[twice] + _TWICE])
    if known is not None:
        feature = np.array([known.get(f, -1) for f in feature.tolist()], np.int64)
        text, feature = text[feature >= 0], feature[feature >= 0]
    return text, feature


def known_labels(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic``, once for each labelled id; with both labels it is toxic."""
    return labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("toxic").cast("int").alias("toxic"))


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, toxic, text`` of the documents with a label. A toxic text counts once, so
    that a group of copies makes no voters of its words; a clean text counts with all its
    copies, each of which would be a false alarm."""
    texts = docs.filter("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text", F.sha2("text", 256).alias("same"))
    both = texts.drop("text").join(labels, "doc_id").groupBy(
        "same", "toxic", F.when(F.col("toxic") == 0, F.col("doc_id")).alias("own")).agg(F.min("doc_id").alias("doc_id"))
    return texts.join(both.select("doc_id", "same", "toxic"), ["doc_id", "same"]).dropDuplicates(["doc_id", "same"]).select("doc_id", "toxic", "text")


def feature_counts(rows: DataFrame) -> DataFrame:
    """``feature, n0, n1``: labelled texts with the feature, by label; summed up in each
    batch before they are shuffled."""

    def run(batch):
        text, feature = found(column(batch, "text").to_pylist())
        toxic = column(batch, "toxic").to_numpy()
        names, code = np.unique(feature, return_inverse=True)
        y = toxic[text] if len(text) else text
        return {"feature": names, "n0": np.bincount(code[y == 0], minlength=len(names)), "n1": np.bincount(code[y == 1], minlength=len(names))}

    counted = map_batches(rows.select("toxic", "text"), run, "feature long, n0 long, n1 long")
    return counted.groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def strongest(counts: DataFrame, n0: int, n1: int, limit: int = FEATURES) -> list:
    """Up to ``limit`` features that speak for label 1: by the likelihood ratio of the
    two shares, ties by hash."""
    p1, p0, p = (F.col("n1") + 0.5) / (n1 + 1), (F.col("n0") + 0.5) / (n0 + 1), (F.col("n0") + F.col("n1") + 1) / (n0 + n1 + 2)
    ratio = (F.col("n1") + 0.5) * F.log(p1 / p) + (F.col("n0") + 0.5) * F.log(p0 / p)
    return counts.filter(F.col("n1") >= LEAST_TEXTS).withColumns({"lift": p1 / p0, "ratio": ratio}).filter(
        (F.col("lift") >= LEAST_LIFT) & (F.col("ratio") >= LEAST_RATIO)).orderBy(F.col("ratio").desc(), "feature").limit(limit).collect()


class Voters:
    """Generative model of the votes. A text is toxic with probability ``toxic``. Voters
    that are correlated among toxic texts make a group, which votes with a level: how many
    of its voters fire, in powers of two. A level has a rate in toxic and in other texts.
    That no voter at all fires is evidence, one group's silence is an abstention."""

    def __init__(self, m: int, toxic: float):
        self.m, self.toxic, self.group = m, toxic, np.arange(m)
        self.rate0 = self.rate1 = np.ones(m * LEVELS)
        self.silent = 0.0

    def symbols(self, features: Column) -> Column:
        """Number of each group that fires, times LEVELS, plus its level."""
        of = F.transform(F.filter(features, lambda i: i < self.m), lambda i: F.get(F.lit(self.group.tolist()), i))
        level = lambda g: F.least(F.lit(LEVELS - 1), F.log2(F.size(F.filter(of, lambda x: x == g))).cast("int"))
        return F.transform(F.array_distinct(of), lambda g: g * LEVELS + level(g))

    def posterior(self, symbols: Column) -> Column:
        """Probability of label 1 of a text with these symbols."""
        weights = F.lit(np.log(self.rate1 / self.rate0).tolist())
        votes = F.aggregate(symbols, F.lit(0.0), lambda total, i: total + F.get(weights, i))
        odds = F.when(F.size(symbols) > 0, votes).otherwise(F.lit(float(self.silent))) + F.lit(float(np.log(self.toxic / (1 - self.toxic))))
        return 1 / (1 + F.exp(-odds))

    def update(self, votes: DataFrame) -> None:
        """Rates from the expected counts of ``votes`` (symbols ``s``, expected label
        ``p``, and ``n``, which is 0 for rows that only correct others). Spark sums them."""
        k = self.m * LEVELS
        # Number k stands for all texts, k + 1 for those without a vote.
        marks = F.concat("s", F.when(F.size("s") > 0, F.array(F.lit(k))).otherwise(F.array(F.lit(k), F.lit(k + 1))))
        sums = np.zeros((k + 2, 2))
        for r in votes.select(F.explode(marks).alias("i"), "p", "n").groupBy("i").agg(F.sum("p").alias("p"), F.sum("n").alias("n")).collect():
            sums[r["i"]] = max(0.0, r["n"] - r["p"]), max(0.0, r["p"])
        self.rate0, self.rate1 = ((sums[:k, y] + 0.5) / (sums[k, y] + 1) for y in (0, 1))
        # One text's worth of either kind keeps the odds of silence finite.
        none = (sums[k + 1] + 1) / (sums[k] + 2)
        self.silent = float(np.log(none[1] / none[0]))


def label_model(seen: DataFrame, learned: DataFrame, m: int, toxic: float, rounds: int = 4) -> Voters:
    """Fit by expectation maximisation over the votes of all texts (``features`` of
    ``seen``), starting from the labelled ones (``features, toxic`` of ``learned``, which
    are part of ``seen``), which keep their label: first voter by voter, then with
    correlated voters in groups."""
    model = Voters(m, toxic)
    for grouped in (False, True):
        if grouped:
            model.group = groups(expected.select(F.filter("features", lambda i: i < m).alias("f"), "p", "n"), m)
        known = learned.select("features", model.symbols(F.col("features")).alias("s"), F.col("toxic").cast("double").alias("y"))
        model.update(known.select("s", F.col("y").alias("p"), F.lit(1).alias("n")))
        # A labelled text is in ``seen`` with its posterior; its second row puts the label in its place.
        votes = seen.select("features", model.symbols(F.col("features")).alias("s"), F.lit(None).cast("double").alias("y")).unionByName(known)
        for _ in range(rounds):
            p = model.posterior(F.col("s"))
            expected = votes.select("features", "s", F.coalesce(F.col("y") - p, p).alias("p"), F.col("y").isNull().cast("int").alias("n"))
            model.update(expected)
    return model


def groups(votes: DataFrame, m: int) -> np.ndarray:
    """Group of each of the ``m`` voters: the smallest voter that correlated pairs reach.
    At most voters squared numbers reach the driver."""
    pairs = votes.select("p", F.explode(F.flatten(F.transform("f", lambda i: F.transform("f", lambda j: F.struct(i.alias("i"), j.alias("j")))))).alias("ij"))
    both, texts = np.zeros((m, m)), max(1.0, votes.agg(F.sum("p")).first()[0] or 0.0)
    for r in pairs.groupBy("ij.i", "ij.j").agg(F.sum("p").alias("p")).collect():
        both[r["i"], r["j"]] = max(0.0, r["p"]) / texts
    fired = np.diag(both)
    spread = np.sqrt(np.maximum(fired * (1 - fired), 1e-12))
    linked = (both - np.outer(fired, fired)) / np.outer(spread, spread) > CORRELATED
    np.fill_diagonal(linked, True)
    group = np.arange(m)
    for _ in range(m):
        new = np.where(linked, group[None, :], m).min(axis=1)
        if (new == group).all():
            break
        group = new
    return group


def fit(votes: np.ndarray, target: np.ndarray, weight: np.ndarray, steps: int = 600, decay: float = 1e-6) -> np.ndarray:
    """Weights of a logistic regression on soft labels; the last one is the offset."""
    x = np.concatenate([votes, np.ones((len(votes), 1), np.float32)], axis=1)
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    pull = np.append(np.full(votes.shape[1], decay), 0.0)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32), -40, 40)))
        g = ((p - target) * weight).astype(np.float32) @ x + pull * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return w


def dense(lists: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(lists), width), np.float32)
    out[np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False)), lists.flatten().to_numpy()] = 1
    return out


def sampled(rows: DataFrame, sizes: dict[int, int], sample: int) -> DataFrame:
    """About ``sample`` rows of each label by a hash of the id, never more."""
    parts = []
    for y, n in sizes.items():
        share = min(1.0, 1.2 * sample / n)
        near = rows.filter((F.col("toxic") == y) & (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1))
        parts.append(near.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    return parts[0].unionByName(parts[1])


def toxicity(docs: DataFrame, labels: DataFrame, held_out, threshold: float = THRESHOLD, sample: int = SAMPLE_PER_CLASS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs`` (``doc_id, text``).

    ``held_out``: a condition on ``docs``; labels of its rows are never read. Only the
    text is scored. Null and empty texts fire no voter and get the score of such a text;
    rows with one doc_id are scored each, and a label holds for them all. Without
    labelled texts of both kinds, or without a feature that tells them apart, every
    score is the share of label 1 among labelled texts (0 without any). Other columns
    are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    known_ids = known_labels(labels)
    learn = staged(labelled_texts(rows.filter(~F.col("held_out")), known_ids), "labelled")
    sizes = {y: 0 for y in (0, 1)} | {r["toxic"]: r["n"] for r in learn.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = strongest(feature_counts(learn), sizes[0], sizes[1]) if all(sizes.values()) else []
    if not chosen:
        share = sizes[1] / max(1, sum(sizes.values()))
        return rows.select("doc_id", "held_out", F.lit(float(share)).alias("score"), F.lit(int(share >= threshold)).alias("predicted"))
    # The strongest of either kind vote: words and openings, and openings found in two words.
    lexicon, patterns = [[r for r in chosen if bool(r["feature"] & _TWICE) == kind] for kind in (False, True)]
    chosen = lexicon[:VOTERS] + patterns[:VOTERS] + lexicon[VOTERS:] + patterns[VOTERS:]
    known = spark.sparkContext.broadcast({r["feature"]: i for i, r in enumerate(chosen)})

    def see(batch):
        text, feature = found(column(batch, "text").to_pylist(), known.value)
        order = np.lexsort((feature, text))
        offsets = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=batch.num_rows))]).astype(np.int32)
        return {"doc_id": column(batch, "doc_id"), "held_out": column(batch, "held_out"),
                "features": pa.ListArray.from_arrays(offsets, pa.array(feature[order].astype(np.int32)))}

    seen = staged(map_batches(rows, see, SEEN), "features")
    n_voters = min(len(chosen), 2 * VOTERS)
    learned = staged(seen.filter(~F.col("held_out")).join(known_ids, "doc_id").select("doc_id", "toxic", "features"), "learned")
    model = label_model(seen, learned, n_voters, sizes[1] / sum(sizes.values()))
    width, weights_of = len(chosen), {y: n / max(1, min(n, sample)) for y, n in sizes.items()}

    def train(_, table):
        votes = dense(pa.concat_arrays(table.column("features").chunks), width)
        weight = np.array([weights_of[y] for y in table.column("toxic").to_pylist()])
        w = fit(votes, table.column("posterior").to_numpy(), weight / weight.sum())
        return pa.table({"w": pa.array([w.tolist()], pa.list_(pa.float64()))})

    posterior = model.posterior(model.symbols(F.col("features"))).alias("posterior")
    # At most twice ``sample`` ids, so the join is a broadcast of a bounded side.
    ids = F.broadcast(sampled(learn.select("doc_id", "toxic"), sizes, sample))
    training = learned.join(ids, ["doc_id", "toxic"]).dropDuplicates(["doc_id"]).select("toxic", "features", posterior)
    w = np.array(training.groupBy(F.lit(0).alias("one")).applyInArrow(train, "w array<double>").first()["w"])
    fitted = spark.sparkContext.broadcast(w)

    def score(batch):
        p = 1 / (1 + np.exp(-np.clip(scores_of(column(batch, "features"), fitted.value), -40, 40)))
        return {"doc_id": column(batch, "doc_id"), "held_out": column(batch, "held_out"), "score": p, "predicted": (p >= threshold).astype(np.int32)}

    schema = "doc_id long, held_out boolean, score double, predicted int"
    out = to_arrow_schema(StructType.fromDDL(schema))
    return seen.mapInArrow(lambda batches: (record(score(b), out) for b in batches), schema)


def scores_of(lists: pa.Array, w: np.ndarray) -> np.ndarray:
    text = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    return np.bincount(text, w[lists.flatten().to_numpy()], len(lists)) + w[-1]
