"""Token ids in bit-packed segments: each id takes the fewest bits its vocabulary needs.

A table of segments is written with Spark, one binary value per segment, so that commits
are atomic on any file system and a lost task writes its segments again. A segment holds
whole documents and describes itself:

    b"BITS" | version u1 | bits u1 | block u4 | documents u4 | ids u8 | start in shard u8
    null ids, one bit per document | doc ids i8 each | ids per document u8 each
    byte offset of each block u8, and the end | blocks, little-endian bit order

Every block has ``block`` ids (the last one may have fewer) and starts on a byte, so any
id is found from its block's offset without reading what comes before.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from decreta.llm.batches import column, record, text_parts
from decreta.llm.encoding import encoder

_HEAD = struct.Struct("<4sBBIIQQ")
MAGIC, VERSION = b"BITS", 1
BLOCK_IDS, SEGMENT_IDS = 4096, 1 << 18
SEGMENT = "shard int, segment int, n_ids long, payload binary"
TOKENS = "shard int, doc_id long, start long, n_tokens long, ids_crc32 long"


def _places(bits: int):
    """For each of 64 ids side by side: its word of 64 bits, its shift there, and whether
    it goes on in the next word. So many ids fill just ``bits`` words."""
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        yield j, word, np.uint64(shift), np.uint64(64 - shift) if shift + bits > 64 else None


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids of up to 32 bits, ``bits`` each, from the lowest bit of the first byte on."""
    rows = -(-len(ids) // 64)
    padded = np.zeros(rows * 64, np.uint64)
    padded[:len(ids)] = ids
    columns, words = np.ascontiguousarray(padded.reshape(rows, 64).T), np.zeros((bits, rows), np.uint64)
    for j, word, shift, rest in _places(bits):
        words[word] |= columns[j] << shift
        if rest is not None:
            words[word + 1] |= columns[j] >> rest
    return np.ascontiguousarray(words.T).astype("<u8").tobytes()[:-(-len(ids) * bits // 8)]


def unpack_bits(data: bytes, bits: int, first: int, count: int) -> np.ndarray:
    """Ids ``first`` to ``first + count`` of packed ``data``; ids of up to 32 bits."""
    begin = first // 64
    rows = max(0, -(-(first + count) // 64) - begin)
    held = np.zeros(rows * bits * 8, np.uint8)
    mine = np.frombuffer(data, np.uint8)[begin * bits * 8:][:len(held)]
    held[:len(mine)] = mine
    words, columns = np.ascontiguousarray(held.view("<u8").reshape(rows, bits).T), np.empty((64, rows), np.uint64)
    for j, word, shift, rest in _places(bits):
        columns[j] = words[word] >> shift
        if rest is not None:
            columns[j] |= words[word + 1] << rest
    ids = (columns & np.uint64((1 << bits) - 1)).astype(np.uint32)
    return np.ascontiguousarray(ids.T).ravel()[first - begin * 64:][:count]


def write_segment(doc_ids: list, counts: np.ndarray, ids: np.ndarray, bits: int, start: int, block: int = BLOCK_IDS) -> bytes:
    starts = np.arange(0, len(ids), block)
    if block * bits % 8 == 0:  # blocks end on bytes, so they lie side by side as packed at once
        blocks, sizes = [pack_bits(ids, bits)], -(-(np.minimum(starts + block, len(ids)) - starts) * bits // 8)
    else:
        blocks = [pack_bits(ids[i:i + block], bits) for i in starts.tolist()]
        sizes = [len(b) for b in blocks]
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype("<u8")
    nulls = np.packbits(np.array([d is None for d in doc_ids], bool), bitorder="little")
    return b"".join([
        _HEAD.pack(MAGIC, VERSION, bits, block, len(doc_ids), len(ids), start), nulls.tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.asarray(counts, "<u8").tobytes(), offsets.tobytes(), *blocks])


class Segment:
    """A written segment: documents, counts, and ids by position."""

    def __init__(self, payload: bytes):
        magic, version, self.bits, self.block, docs, self.n_ids, self.start = _HEAD.unpack_from(payload)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a segment of bit-packed ids")
        at = _HEAD.size
        null = np.unpackbits(np.frombuffer(payload, np.uint8, -(-docs // 8), at), bitorder="little")[:docs]
        at += -(-docs // 8)
        ids = np.frombuffer(payload, "<i8", docs, at).tolist()
        self.doc_ids = [None if n else d for d, n in zip(ids, null)]
        self.counts = np.frombuffer(payload, "<u8", docs, at + 8 * docs).astype(np.int64)
        at += 16 * docs
        n_blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(payload, "<u8", n_blocks + 1, at).astype(np.int64)
        self.data = memoryview(payload)[at + 8 * (n_blocks + 1):]

    def ids(self, first: int, count: int) -> np.ndarray:
        """``count`` ids from position ``first``: only the blocks that hold them are read."""
        parts, end = [], min(first + count, self.n_ids)
        if self.block * self.bits % 8 == 0 and first < end:  # blocks without gaps are read as one
            k, last = first // self.block, (end - 1) // self.block
            return unpack_bits(bytes(self.data[self.offsets[k]:self.offsets[last + 1]]), self.bits, first - k * self.block, end - first)
        while first < end:
            k = first // self.block
            n = min(end, (k + 1) * self.block) - first
            parts.append(unpack_bits(bytes(self.data[self.offsets[k]:self.offsets[k + 1]]), self.bits, first % self.block, n))
            first += n
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode whole texts (null: empty), append ``end_id`` to each, and write segments in
    ascending ``doc_id`` order (nulls first; rows with one id by their text)."""
    spark = docs.sparkSession
    bits = max(1, int(max(encoder(tokenizer).vocabulary - 1, end_id)).bit_length())
    out = to_arrow_schema(StructType.fromDDL(SEGMENT))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    ordered = rows.repartitionByRange(shards, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        shard, number, start = TaskContext.get().partitionId(), 0, 0
        doc_ids, counts, parts, held = [], [], [], 0
        for batch in batches:
            for part, texts in text_parts(batch):
                ids, n = encoder(tokenizer).with_end(texts, end_id)
                for doc_id, mine in zip(column(part, "doc_id").to_pylist(), np.split(ids, np.cumsum(n)[:-1])):
                    if held and held + len(mine) > segment_ids:
                        yield record(row(shard, number, doc_ids, counts, parts, held, start), out)
                        number, start = number + 1, start + held
                        doc_ids, counts, parts, held = [], [], [], 0
                    doc_ids.append(doc_id)
                    counts.append(len(mine))
                    parts.append(mine)
                    held += len(mine)
        if doc_ids:
            yield record(row(shard, number, doc_ids, counts, parts, held, start), out)

    def row(shard, number, doc_ids, counts, parts, held, start):
        payload = write_segment(doc_ids, np.array(counts), np.concatenate(parts), bits, start)
        return {"shard": [shard], "segment": [number], "n_ids": [held], "payload": [payload]}

    ordered.mapInArrow(run, SEGMENT).write.option("compression", "none").parquet(path)


def read_tokens(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and, on request, ``ids`` of every document in
    the segments under ``path``. ``start``: ids of all documents before it."""
    segments = spark.read.schema(SEGMENT).parquet(path)
    schema = TOKENS + (", ids array<int>" if ids else "")
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for shard, payload in zip(column(batch, "shard").to_pylist(), column(batch, "payload")):
                s = Segment(payload.as_py())
                ends = np.cumsum(s.counts)
                tokens = np.split(s.ids(0, s.n_ids).astype("<u4"), ends[:-1])
                columns = {"shard": [shard] * len(ends), "doc_id": s.doc_ids, "start": s.start + ends - s.counts, "n_tokens": s.counts,
                           "ids_crc32": [zlib.crc32(t) for t in tokens]}
                if ids:
                    columns["ids"] = pa.array([t.astype(np.int32) for t in tokens], pa.list_(pa.int32()))
                yield record(columns, out)

    # One row per shard, which the writer's number of partitions bounds.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = segments.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    read = segments.select("shard", "payload").mapInArrow(run, schema).join(F.broadcast(bases), "shard")
    return read.select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if ids else []))
