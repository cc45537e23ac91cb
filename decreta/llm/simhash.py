"""SimHash near-duplicates by Golay-code fuzzy hashing.

A fingerprint of 64 bits is cut into three segments. Two fingerprints with ``r`` or
fewer differing bits, ``r <= 2``, agree exactly in one segment at least (pigeonhole) and
differ by at most two bits in the next. The next segment is decoded with the perfect
binary Golay code [23, 12, 7]: a word and its 23 neighbours at one bit decode to between
one and six codewords, and two words at up to two bits have a neighbour in common, so
they share a codeword. Joining on (exact segment, codeword) therefore loses no pair.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from decreta.llm.batches import column, map_batches, raw, record
from decreta.llm.components import components
from decreta.session import staged

# Generator polynomial of the binary Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GOLAY_POLYNOMIAL = 0b110001110101
CODE_BITS, DATA_BITS = 23, 12
# First bit and width of each segment of a fingerprint.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# A bucket with more fingerprints than this is dealt anew by finer keys.
BUCKET = 256
# Cuts of a fingerprint for the finer keys: all but two of 16 parts of 4 bits, so that
# such a bucket has 256 different fingerprints at most.
FINE_PARTS = 16


def _remainder(words: np.ndarray) -> np.ndarray:
    """Syndrome: remainder of the word's polynomial by the generator, 11 bits."""
    left = words.astype(np.uint32)
    for bit in range(CODE_BITS - 1, 10, -1):
        left = np.where(left >> bit & 1, left ^ np.uint32(GOLAY_POLYNOMIAL << (bit - 11)), left)
    return left


def _leaders() -> np.ndarray:
    """The error pattern of at most three bits for each of the 2048 syndromes."""
    ones = np.uint32(1) << np.arange(CODE_BITS, dtype=np.uint32)
    two = (ones[:, None] ^ ones[None, :]).ravel()
    errors = np.unique(np.concatenate([[np.uint32(0)], ones, two, (two[:, None] ^ ones[None, :]).ravel()]))
    table = np.zeros(1 << 11, np.uint32)
    table[_remainder(errors)] = errors
    return table


_LEADERS = _leaders()


def golay_keys(words: np.ndarray) -> np.ndarray:
    """Codewords near each 23-bit word: 24 columns, repeats included."""
    flips = np.concatenate([[0], 1 << np.arange(CODE_BITS)]).astype(np.uint32)
    near = words.astype(np.uint32)[:, None] ^ flips[None, :]
    return near ^ _LEADERS[_remainder(near)]


def fingerprints_of(texts: list[bytes], words: int = 3) -> np.ndarray:
    """SimHash of each text, unsigned.

    Lower-cases A-Z, takes shingles of ``words`` words with repeats (fewer words: one
    shingle of all; none: zero). A bit is 1 if it is set in over half the XXH64 values.
    """
    hashes, counts = [], []
    for text in texts:
        tokens = text.lower().split()
        if not tokens:
            counts.append(0)
        elif len(tokens) < words:
            hashes.append(xxhash.xxh64_intdigest(b" ".join(tokens), 42))
            counts.append(1)
        else:
            parts = zip(*(tokens[k:] for k in range(words)))
            hashes.extend(map(xxhash.xxh64_intdigest, map(b" ".join, parts), repeat(42)))
            counts.append(len(tokens) - words + 1)
    out, end = np.zeros(len(texts), np.uint64), 0
    values = np.array(hashes, np.uint64)
    for i, n in enumerate(counts):
        if n:
            mine, ones = values[end:end + n], np.zeros(64, np.int64)
            for at in range(0, n, 1 << 16):  # a very long text in steps
                bits = np.unpackbits(mine[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += bits.sum(axis=0, dtype=np.int64)
            out[i] = np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]
            end += n
    return out


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id, row, fp``: one row per row of ``docs``; null text counts as empty. ``row``
    is a hash of the text."""
    def fn(batch):
        return {"doc_id": column(batch, "doc_id"), "row": column(batch, "row"), "fp": fingerprints_of(raw(batch), words).view(np.int64)}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    return map_batches(rows, fn, "doc_id long, row long, fp long")


def _segment_keys(fps: DataFrame) -> DataFrame:
    """``key, fp``: (segment number, exact segment, codeword of the next segment)."""
    out = to_arrow_schema(StructType.fromDDL("key long, fp long"))

    def run(batches):
        for batch in batches:
            fp = column(batch, "fp").to_numpy(zero_copy_only=False).view(np.uint64)
            cut = [(fp >> np.uint64(at)) & np.uint64((1 << width) - 1) for at, width in SEGMENTS]
            for i in range(len(SEGMENTS)):
                codes = np.sort(golay_keys(cut[(i + 1) % len(SEGMENTS)]), axis=1)
                new = np.ones(codes.shape, bool)
                new[:, 1:] = codes[:, 1:] != codes[:, :-1]
                key = np.uint64(i << 60) | (cut[i][:, None] << np.uint64(CODE_BITS)) | codes.astype(np.uint64)
                at = np.nonzero(new)[0]
                yield record({"key": key[new].view(np.int64), "fp": fp[at].view(np.int64)}, out)

    return fps.mapInArrow(run, "key long, fp long")


def _fine_keys(fps: DataFrame) -> DataFrame:
    """``key, fp``: the fingerprint without two of its parts, for each choice of two.

    Two fingerprints at up to two bits are equal without the parts that hold those bits.
    The removed parts are zeroed and their numbers take the place of the first one.
    """
    width = 64 // FINE_PARTS
    pairs = [(p, q) for p in range(FINE_PARTS) for q in range(p + 1, FINE_PARTS)]
    masks = [~(((1 << width) - 1) << (p * width) | ((1 << width) - 1) << (q * width)) & (2**64 - 1) for p, q in pairs]
    signed = [m - 2**64 if m >= 2**63 else m for m in masks]
    options = F.array(*[F.struct(F.lit(i).alias("cut"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("rest"))
                        for i, m in enumerate(signed)])
    return fps.select("fp", F.explode(options).alias("k")).select(
        F.struct("k.cut", "k.rest").alias("key"), "fp")


def _spanning(buckets: DataFrame, max_bits: int) -> DataFrame:
    """``a, b``: for each bucket of bounded size, links enough to connect what is linked
    there: of all pairs that hold, those that join two parts not joined before."""
    out = to_arrow_schema(StructType.fromDDL("a long, b long"))

    def links(values: np.ndarray):
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= max_bits
        todo, n = np.ones(len(values), bool), len(values)
        for root in range(n):
            if not todo[root]:
                continue
            todo[root], stack = False, [root]
            while stack:
                at = stack.pop()
                for to in np.flatnonzero(near[at] & todo):
                    todo[to] = False
                    stack.append(int(to))
                    yield values[at], values[to]

    def run(batches):
        for batch in batches:
            found = [x for fps in batch.column(0).to_pylist() for x in links(np.array(fps, np.int64).view(np.uint64))]
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield record({"a": pairs[:, 0], "b": pairs[:, 1]}, out)

    return buckets.select("fps").mapInArrow(run, "a long, b long")


def _bounded(keys: DataFrame, sizes: DataFrame) -> DataFrame:
    return keys.join(sizes, "key").groupBy("key").agg(F.collect_list("fp").alias("fps"))


def hamming_links(fps: DataFrame, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """``a, b``: links that connect all distinct fingerprints at ``max_bits`` or fewer.

    ``fps`` has distinct ``fp``. Not every pair is returned, only enough of them that the
    components are those of all pairs. Buckets beyond ``bucket`` are dealt anew by finer
    keys whose buckets have at most 256 fingerprints, so no group is unbounded.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the keys hold for at most 2 differing bits")
    keys = staged(_segment_keys(fps), "golay-keys")
    sizes = staged(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "golay-buckets")
    small = _bounded(keys, sizes.filter(F.col("n") <= bucket).select("key"))
    hot = keys.join(sizes.filter(F.col("n") > bucket).select("key"), "key").select("fp").distinct()
    fine = _fine_keys(hot)
    twice = fine.groupBy("key").agg(F.collect_list("fp").alias("fps")).filter("size(fps) > 1")
    return _spanning(small.select("fps").unionByName(twice.select("fps")), max_bits)


def _grouped(docs: DataFrame, words: int, max_bits: int, bucket: int) -> DataFrame:
    """``doc_id, row, fp, component, component_id`` of every row of ``docs``."""
    prints = staged(fingerprints(docs, words), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    found = components(hamming_links(classes.select("fp"), max_bits, bucket))
    joined = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), "low")
    least = joined.groupBy("component").agg(F.min("low").alias("component_id"))
    return prints.join(joined.select("fp", "component").join(least, "component"), "fp")


def simhash_components(docs: DataFrame, words: int = 3, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """SimHash near-duplicate groups of ``docs`` (``doc_id, text``, further columns unused).

    Returns ``doc_id, fingerprint, component_id, kept`` for every row: fingerprints of 16
    hex digits, the smallest doc_id reachable by links of at most ``max_bits`` bits, and
    whether the row is that document. Null and empty texts have fingerprint zero and link
    with each other. Repeated rows stay and agree; a null doc_id is never the smallest
    while the group has another. An empty table gives an empty result.
    """
    return _grouped(docs, words, max_bits, bucket).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def keep_least(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """``docs`` with one row of each ``component`` of ``grouped`` (``doc_id, row, component``
    of every row) and all its columns: the row with the smallest doc_id (a null one only if
    the group has no other), of equal ids the one with the smallest hash of its text, of
    equal rows any one."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    rows = grouped.groupBy("component", "doc_id", "row").agg(F.count(F.lit(1)).alias("copies"))
    best = rows.groupBy("component").agg(F.min_by(F.struct(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), F.col("copies").alias("_copies")), order).alias("b"))
    same = docs["doc_id"].eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_row"))
    left = docs.join(best.select("b.*"), same)
    # Only rows that repeat an id and a text have to be brought together.
    again = left.filter("_copies > 1").dropDuplicates(["_id", "_row"])
    return left.filter("_copies = 1").unionByName(again).select(docs.columns)


def drop_near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, as ``keep_least`` picks it."""
    return keep_least(docs, _grouped(docs, words, max_bits, bucket))
