"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Texts with equal sets are one class. Classes meet by the Golay keys of their SimHash
fingerprints, at two bits or fewer, and in bands of a min-hash signature, as pairs at the
threshold may differ in more bits; each pair that meets in a band is compared by its whole sets, unless links found before join it already
or the signatures agree in too few places. A pair at the threshold is missed with
probability 1e-5. All Golay pairs are compared. Each bucket is first compared with one member, its pivot, in as many
rows as it has members. What the pivots leave apart is compared in blocks of bounded size.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from decreta.llm.batches import column, map_batches, raw, record
from decreta.llm.components import components
from decreta.llm.simhash import fingerprints_of, hamming_links, keep_least
from decreta.session import broadcast_checked, staged

# Words of a shingle and least similarity of near copies.
WORDS, SIMILARITY = 5, 0.8
# Bits in which the fingerprints of pairs proposed by Golay keys may differ.
MAX_BITS = 2
# Bands of a signature and values in each: a pair at 0.8 shares no band with probability
# (1 - 0.8 ** 5) ** 30 = 6.6e-6.
BANDS, BAND_ROWS = 30, 5
# Deviations by which a signature may agree in fewer places than expected at the threshold.
DEVIATIONS = 5.0
# Members of a block and bytes of their sets; a larger set is a block of its own.
BLOCK, BLOCK_BYTES = 128, 4 << 20
# Shingles mixed with all multipliers at a time.
STEP = 1024

_FACTORS = np.random.default_rng(20).integers(0, 2**31, (2, BANDS * BAND_ROWS), np.uint32) * np.uint32(2) + np.uint32(1)


def shingles_of(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct XXH64 values of the shingles of the text, A-Z lower-cased (fewer
    words: one shingle of all; none: empty)."""
    tokens = text.lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(tokens), 42)], np.uint64)
    parts = zip(*(tokens[k:] for k in range(words)))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, parts), repeat(42)), np.uint64))


def signature_of(shingles: np.ndarray) -> np.ndarray:
    """Low 16 bits of the least value under each multiplier; they name the shingle."""
    low = np.full(BANDS * BAND_ROWS, 2**32 - 1, np.uint32)
    for at in range(0, len(shingles), STEP):
        part = (shingles[at:at + STEP] >> np.uint64(32)).astype(np.uint32)
        np.minimum(low, ((part[:, None] ^ _FACTORS[0]) * _FACTORS[1]).min(axis=0), out=low)
    return low.astype(np.uint16)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(len(a) + len(b) - both, 1)


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def _prints(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, row, fp, node, signature`` of every row; ``fp`` is its SimHash, ``node``
    hashes the set, ``row`` the text. Texts without words have no signature."""
    def fn(batch):
        texts = raw(batch)
        sets = [shingles_of(x, words) for x in texts]
        return {"doc_id": column(batch, "doc_id"), "row": column(batch, "row"), "fp": fingerprints_of(texts).view(np.int64),
                "node": [_signed(xxhash.xxh64_intdigest(s.tobytes())) for s in sets],
                "signature": [signature_of(s).tobytes() if len(s) else None for s in sets]}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    return map_batches(rows, fn, "doc_id long, row long, fp long, node long, signature binary")


def _bands(classes: DataFrame) -> DataFrame:
    """``key, node``: one row for each band of each class."""
    out = to_arrow_schema(StructType.fromDDL("key long, node long"))

    def run(batches):
        for batch in batches:
            width = 2 * BAND_ROWS
            keys = [_signed(xxhash.xxh64_intdigest(s[i * width:(i + 1) * width], i))
                    for s in column(batch, "signature").to_pylist() for i in range(BANDS)]
            nodes = column(batch, "node").to_numpy(zero_copy_only=False)
            yield record({"key": np.array(keys, np.int64), "node": np.repeat(nodes, BANDS)}, out)

    return classes.select("node", "signature").filter("signature is not null").mapInArrow(run, "key long, node long")


def _sets(docs: DataFrame, nodes: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """``node, signature, shingles`` of the given classes, read from one text of each."""
    wanted = classes.join(nodes, "node").select("row", "node", "signature")
    texts = docs.select(F.xxhash64("text").alias("row"), "text").join(wanted.select("row"), "row", "left_semi").groupBy("row").agg(F.first("text").alias("text"))

    def fn(batch):
        return {"row": column(batch, "row"), "shingles": [shingles_of(x, words).tobytes() for x in raw(batch)]}

    return wanted.join(map_batches(texts, fn, "row long, shingles binary"), "row").select("node", "signature", "shingles")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``a, b`` of the pairs at the similarity or above; many may share their ``a``."""
    out = to_arrow_schema(StructType.fromDDL("a long, b long"))
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")).join(pairs.select("a").distinct(), "a")
    other = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))

    def run(batches):
        for batch in batches:
            left, right = column(batch, "left"), column(batch, "right")
            same = [jaccard(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)) >= similarity for x, y in zip(left, right)]
            at = np.flatnonzero(same)
            yield record({"a": column(batch, "a").take(at), "b": column(batch, "b").take(at)}, out)

    return pairs.join(other, "b").join(broadcast_checked(staged(one, "pivots")), "a").mapInArrow(run, "a long, b long")


def _block_links(a: list[dict], b: list[dict] | None, similarity: float):
    """Links between two blocks of a bucket, or within one, that join further parts."""
    all_ = a + (b or [])
    marks = np.array([np.frombuffer(x["signature"], np.uint16) for x in all_])
    sets = [np.frombuffer(x["shingles"], np.uint64) for x in all_]
    sizes = np.array([len(s) for s in sets])
    part = np.unique([x["component"] for x in all_], return_inverse=True)[1]
    places = BANDS * BAND_ROWS
    least = places * similarity - DEVIATIONS * (places * similarity * (1 - similarity)) ** 0.5
    for i in range(len(a)):
        start = i + 1 if b is None else len(a)
        alike = (marks[start:] == marks[i]).sum(axis=1) >= least
        fits = np.minimum(sizes[start:], sizes[i]) >= similarity * np.maximum(sizes[start:], sizes[i])
        for j in np.flatnonzero(alike & fits & (part[start:] != part[i])) + start:
            if part[i] != part[j] and jaccard(sets[i], sets[j]) >= similarity:
                part[part == part[j]] = part[i]
                yield all_[i]["node"], all_[j]["node"]


def _apart(members: DataFrame, sets: DataFrame, links: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: further links in the buckets whose members ``links`` do not join."""
    out = to_arrow_schema(StructType.fromDDL("a long, b long"))
    found = components(links)
    parts = staged(members.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component")), "parts")
    open_ = parts.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("key")
    rows = staged(parts.join(open_, "key").join(sets, "node"), "apart")
    count = rows.groupBy("key").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum(F.length("shingles")) / BLOCK_BYTES)).alias("blocks"))
    blocks = staged(rows.join(count, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).groupBy("key", "block").agg(
        F.collect_list(F.struct("node", "component", "signature", "shingles")).alias("rows")), "blocks")
    one = blocks.select("key", F.col("block").alias("i"), F.col("rows").alias("a"))
    other = blocks.select("key", F.col("block").alias("j"), F.col("rows").alias("b"))
    within = one.filter("size(a) > 1").select("a", F.lit(None).cast(other.schema["b"].dataType).alias("b"))
    between = one.join(other, "key").filter("i < j").select("a", "b")

    def run(batches):
        for batch in batches:
            links = [x for a, b in zip(batch.column(0), batch.column(1)) for x in _block_links(a.as_py(), b.as_py(), similarity)]
            pairs = np.array(links, np.int64).reshape(-1, 2)
            yield record({"a": pairs[:, 0], "b": pairs[:, 1]}, out)

    return within.unionByName(between).mapInArrow(run, "a long, b long")


def near_copy_links(docs: DataFrame, classes: DataFrame, words: int = WORDS, similarity: float = SIMILARITY,
                    golay: DataFrame | None = None) -> DataFrame:
    """``a, b``: links that connect all classes at the similarity or above; ``golay`` has
    pairs (``a, b``) to be compared besides those of the bands."""
    keys = staged(_bands(classes), "bands")
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = staged(keys.join(sizes, "key"), "buckets")
    nodes = members.select("node")
    if golay is not None:
        nodes = nodes.union(golay.select("a")).union(golay.select("b"))
    sets = staged(_sets(docs, nodes.distinct(), classes, words), "sets")
    # The pivot is the member that meets most others in all its buckets.
    weight = members.groupBy("node").agg(F.sum("n").alias("weight"))
    pivots = members.join(weight, "node").groupBy("key").agg(F.max(F.struct("weight", "node")).alias("p")).select("key", F.col("p.node").alias("a"))
    pairs = members.join(pivots, "key").filter("node <> a").select("a", F.col("node").alias("b"))
    if golay is not None:
        pairs = pairs.unionByName(golay)
    pairs = staged(pairs.distinct(), "pairs")
    links = staged(_verified(pairs, sets, similarity), "near")
    return links.unionByName(_apart(members, sets, links, similarity))


def _golay_pairs(prints: DataFrame, max_bits: int) -> DataFrame:
    """``a, b``: pairs of nodes that connect all whose SimHash fingerprints differ in
    ``max_bits`` or fewer, found by Golay keys. The smallest node of a fingerprint stands
    for it towards other fingerprints."""
    nodes = staged(prints.filter("signature is not null").select("fp", "node").distinct(), "fingerprints")
    least = staged(nodes.groupBy("fp").agg(F.min("node").alias("least")), "fingerprint-classes")
    same = nodes.join(least, "fp").filter("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    end = lambda name: least.select(F.col("fp").alias(name), F.col("least").alias(f"_{name}"))
    near = hamming_links(least.select("fp"), max_bits).join(end("a"), "a").join(end("b"), "b")
    return same.unionByName(near.select(F.col("_a").alias("a"), F.col("_b").alias("b"))).filter("a <> b")


def drop_near_copies(docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY,
                     max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each group of near copies and all its columns, as
    ``keep_least`` picks it. Null texts and texts without words are copies of each other."""
    prints = staged(_prints(docs, words), "shingles")
    classes = staged(prints.groupBy("node").agg(F.min(F.struct("row", "signature")).alias("r")).select("node", "r.row", "r.signature"), "classes")
    golay = staged(_golay_pairs(prints, max_bits), "golay-pairs")
    found = components(near_copy_links(docs, classes, words, similarity, golay))
    grouped = prints.select("doc_id", "row", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return keep_least(docs, grouped)
