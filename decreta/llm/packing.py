"""Best-fit packing of documents into sequences, certified by lower bounds.

Pieces are dealt to partitions of a bounded number of pieces and packed by best-fit
decreasing. Dual feasible functions bound the number of bins that any packing of the same
pieces needs. A partition that meets its bound is settled. Partitions with a gap settle
their full bins, exchange the pieces of the others and pack again.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from decreta.llm.batches import column, map_batches, raw, record
from decreta.llm.encoding import encoder
from decreta.session import staged

CAPACITY = 2048
# Bytes of text encoded at a time: a worker holds the parts of one such stretch as objects.
TEXT_BYTES = 1 << 20
# Pieces of a partition on average, and rounds of exchange.
PARTITION_PIECES, ROUNDS = 40_000, 3
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = "id long, length long, bin long, offset long, bins long, bound long, fill long"


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each piece, and the number of bins. Longest first, each piece
    goes to the fullest bin that still holds it."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, count = 0, 0  # bit r: some bin has r places left
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = mask >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            at = free[left].pop()
            if not free[left]:
                mask ^= 1 << left
        else:
            left, at, count = capacity, count, count + 1
        bins[i], offsets[i] = at, capacity - left
        free[left - size].append(at)
        mask |= 1 << (left - size)
    return bins, offsets, count


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs, by two families of dual feasible functions."""
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1)
    number = np.concatenate([[0], np.cumsum(counts)])  # pieces shorter than s
    total = np.concatenate([[0], np.cumsum(counts * np.arange(capacity + 1))])
    # Sizes over capacity - a count as full bins, sizes below a as nothing.
    a = np.arange(0, capacity // 2 + 1)
    large = number[-1] - number[capacity - a + 1]
    middle = total[capacity - a + 1] - total[a]
    best = int(np.max(large + -(-middle // capacity)))
    # Sizes rounded down to k-ths, those on a border kept as they are.
    sizes = np.arange(capacity + 1)
    for k in range(1, 33):
        border = sizes * (k + 1) % capacity == 0
        scaled = np.where(border, sizes * k, (sizes * (k + 1) // capacity) * capacity)
        best = max(best, int(-(-(counts * scaled).sum() // (capacity * k))))
    return best


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, ids: bool = False) -> DataFrame:
    """The pieces of every row's tokens: PIECE, with ``ids`` (array) on request."""
    schema = PIECE + (", ids array<int>" if ids else "")

    def fn(batch):
        tokens, counts = encoder(tokenizer).with_end([t.decode() for t in raw(batch)], end_id)
        ends = np.cumsum(counts)
        cuts = -(-counts // capacity)
        row = np.repeat(np.arange(len(counts)), cuts)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        start = piece * capacity
        length = np.minimum(capacity, counts[row] - start)
        begin = (ends - counts)[row] + start
        data = tokens.astype("<u4")
        out = {
            "doc_id": column(batch, "doc_id").take(pa.array(row)), "piece": piece, "start": start, "length": length,
            "ids_crc32": [zlib.crc32(data[b:b + n]) for b, n in zip(begin.tolist(), length.tolist())],
        }
        if ids:
            out["ids"] = pa.array([data[b:b + n].astype(np.int32) for b, n in zip(begin.tolist(), length.tolist())], pa.list_(pa.int32()))
        return out

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), fn, schema, limit=TEXT_BYTES)


def _pack(parts: DataFrame, capacity: int) -> DataFrame:
    """Best-fit decreasing within each ``part``: PACKED for each ``id, length``."""
    out = to_arrow_schema(StructType.fromDDL("part long, " + PACKED))

    def run(key, table):
        lengths = table.column("length").to_numpy()
        bins, offsets, count = best_fit_decreasing(lengths, capacity)
        fill = np.bincount(bins, lengths, count).astype(np.int64)
        same = lambda x: np.full(len(lengths), x, np.int64)
        return pa.Table.from_batches([record({
            "part": same(key[0].as_py()), "id": table.column("id").combine_chunks(), "length": lengths, "bin": bins, "offset": offsets,
            "bins": same(count), "bound": same(lower_bound(lengths, capacity)), "fill": fill[bins]}, out)])

    return parts.groupBy("part").applyInArrow(run, "part long, " + PACKED)


def pack(pieces: DataFrame, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """``id, sequence_id, offset, certified`` for rows ``id, length`` (1 to ``capacity``).

    ``certified``: the partition that packed the row has as many bins as its lower bound.
    A full piece is a sequence of its own. Every round of exchange deals the loose bins of
    the partitions with a gap to about as many partitions anew, by another hash, and the
    new packing is taken if it needs fewer bins.
    """
    full = pieces.filter(F.col("length") >= capacity).selectExpr(
        "id", "-1 - id AS sequence_id", "0L AS offset", "true AS certified")

    def dealt(rows: DataFrame, salt: int) -> DataFrame:
        # About as many parts as the pieces, or their tokens, ask for.
        n = rows.count()
        parts = max(1, -(-n // partition_pieces))
        return rows.withColumn("part", F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(parts)))

    def settled(rows: DataFrame, salt: int, certified: str) -> DataFrame:
        return rows.selectExpr("id", f"{salt + 1} * (1L << 56) + part * (1L << 32) + bin AS sequence_id", "offset", f"{certified} AS certified")

    result, open_ = full, pieces.filter(F.col("length") < capacity).select("id", "length")
    now = staged(_pack(dealt(open_, 0), capacity), "packed")
    for salt in range(rounds + 1):
        gap = F.col("bins") > F.col("bound")
        loose = now.filter(gap & (F.col("fill") < capacity))
        before = loose.select("part", "bin").distinct().count() if salt < rounds else 0
        after, better = None, False
        if before > 1:
            after = staged(_pack(dealt(loose.select("id", "length"), salt + 1), capacity), "packed")
            better = after.select("part", "bin").distinct().count() < before
        if not better:
            return result.unionByName(settled(now, salt, "bins <= bound"))
        result = result.unionByName(settled(now.filter(~gap | (F.col("fill") >= capacity)), salt, "true"))
        now = after
    return result


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, ids: bool = False, **sizes) -> DataFrame:
    """Pieces of all rows of ``docs`` (``doc_id, text``) and their places in sequences.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified``
    and, on request, ``ids``. Null and empty texts are one piece with the end id alone;
    rows that repeat an id are packed each. Only documents longer than ``capacity`` are
    cut. An empty table gives an empty result.
    """
    pieces = staged(pieces_of(docs, tokenizer, end_id, capacity, ids).withColumn("id", F.monotonically_increasing_id()), "pieces")
    places = pack(pieces.select("id", "length"), capacity, **sizes)
    return pieces.join(places, "id").drop("id")
