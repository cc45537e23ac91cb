"""Substring deduplication: windows of words that an earlier document also holds.

Every window of ``window`` words has an anchor, the word n-gram in it with the smallest
hash. Neighbouring windows with one anchor form a segment, so the segments of a document
split its windows, and equal windows of different documents have equal anchors. Segments
are dealt to shards by their anchor; each shard builds an FM-index of its segments and
streams them through it for the matching intervals.

Equal segments are one class, for which only the smallest document must be searched on.
A bucket with many classes (a frequent passage in many surroundings) is dealt anew: its
windows are halved by their distance to the anchor, and each half goes by the words that
all its windows share. In the last round these words are the whole window, so that equal
segments are all that is left, and no bucket grows with a frequent passage.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from decreta.llm.batches import column, map_batches, pieces, raw, record, split_words, word_hashes
from decreta.llm.fm_index import FMIndex
from decreta.session import staged

WINDOW, GRAM = 50, 16
# Bytes of text whose words are held at a time.
TEXT_BYTES = 1 << 20
# Segment classes of a bucket beyond which it is dealt anew, and words of a shard.
BUCKET, SHARD_WORDS = 1_000, 200_000
_BASE = 0x9E3779B97F4A7C15  # an odd multiplier, for polynomial hashes modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
_POSITION_BITS = np.uint64(30)
SEGMENT = "key long, cls long, doc_id long, row long, at int, n int, anchor int"
PART = "root_key long, root_cls long, key long, cls long, owner long, at int, anchor int, low int, high int, words binary"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Hash of any stretch of a word sequence, from one pass over it."""

    def __init__(self, words: np.ndarray):
        n = len(words) + 1
        power, back = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
        power[0] = back[0] = 1
        self.back = np.multiply.accumulate(back)
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(words * np.multiply.accumulate(power)[:-1], dtype=np.uint64)])

    def __call__(self, start: np.ndarray, length) -> np.ndarray:
        value = (self.sums[start + length] - self.sums[start]) * self.back[start]
        return _mix(value + np.asarray(length).astype(np.uint64) * np.uint64(_BASE))


def _anchors(grams: np.ndarray, span: int) -> np.ndarray:
    """For each position the leftmost smallest value among it and the next ``span - 1``."""
    packed = (grams >> _POSITION_BITS << _POSITION_BITS) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= span:
        packed = np.minimum(packed[:-width], packed[width:])
        width *= 2
    packed = np.minimum(packed[:len(packed) - (span - width)], packed[span - width:])
    return (packed & ((np.uint64(1) << _POSITION_BITS) - np.uint64(1))).astype(np.int64)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def segments(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """The segments of every document of at least ``window`` words."""
    span = window - gram + 1

    def fn(batch):
        texts = raw(batch)
        codes, vocabulary, n_words = split_words(texts)
        empty = {c: np.zeros(0, np.int64) for c in ("key", "cls", "doc_id", "row", "at", "n", "anchor")}
        if len(codes) < window:
            return empty
        hashes = Hasher(word_hashes(codes, vocabulary))
        first = np.cumsum(n_words) - n_words
        doc = np.repeat(np.arange(len(texts)), n_words)
        place = np.arange(len(codes) - gram + 1)
        anchor = _anchors(hashes(place, gram), span)
        start = np.arange(len(codes) - window + 1)
        inside = doc[start] == doc[start + window - 1]
        start, anchor = start[inside], anchor[:len(inside)][inside]
        if not len(start):
            return empty
        new = np.ones(len(start), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
        begin = np.flatnonzero(new)
        a, p = start[begin], anchor[begin]
        n = np.diff(np.append(begin, len(start))) + window - 1
        who = doc[a]
        return {
            "key": _signed(hashes(p, gram)), "cls": _signed(hashes(a, n)), "at": a - first[who], "n": n, "anchor": p - first[who],
            "doc_id": column(batch, "doc_id").take(pa.array(who)), "row": column(batch, "row").take(pa.array(who)),
        }

    return map_batches(docs, fn, SEGMENT, limit=TEXT_BYTES)


def _words_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` segments (``key, cls, doc_id, row, at, n, anchor``) with their words' hashes.

    A document's segments are never more than its words, so its list is bounded by it.
    """
    lists = wanted.groupBy("doc_id", "row").agg(F.collect_list(F.struct("key", "cls", "at", "n", "anchor")).alias("segments"))
    schema = "key long, cls long, owner long, anchor int, words binary"
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text", TEXT_BYTES):
                lists_, codes = column(part, "segments"), split_words(raw(part))
                counts, values = np.diff(lists_.offsets.to_numpy()), lists_.flatten()
                s = {c: values.field(c).to_numpy() for c in ("key", "cls", "at", "n", "anchor")}
                words, first = word_hashes(*codes[:2]), np.repeat(np.cumsum(codes[2]) - codes[2], counts)
                yield record({
                    "key": s["key"], "cls": s["cls"], "owner": np.repeat(column(part, "doc_id").to_numpy(), counts),
                    "anchor": s["anchor"] - s["at"], "words": [words[a:a + n].tobytes() for a, n in zip(first + s["at"], s["n"])]}, out)

    return docs.join(lists, ["doc_id", "row"]).select("doc_id", "text", "segments").mapInArrow(run, schema)


def _halves(rows: DataFrame, window: int) -> DataFrame:
    """Each row's windows halved by how far before the anchor they begin."""
    schema = PART
    out = to_arrow_schema(StructType.fromDDL(schema))
    columns = [f.name for f in StructType.fromDDL(schema)]

    def split(r):
        words, middle = np.frombuffer(r["words"], np.uint64), (r["low"] + r["high"]) // 2
        h = Hasher(words)
        for low, high in ((r["low"], middle), (middle + 1, r["high"])):
            begin = max(0, r["anchor"] - high)
            last = min(len(words) - window, r["anchor"] - low)
            if low <= high and begin <= last:
                n = last - begin + window
                core = h(np.array([r["anchor"] - low]), np.array([window - high + low])) ^ _mix(np.array([low * 1000 + high + 1], np.uint64))
                yield r | {"key": int(_signed(core)[0]), "cls": int(_signed(h(np.array([begin]), np.array([n])))[0]), "at": r["at"] + begin,
                           "anchor": r["anchor"] - begin, "low": low, "high": high, "words": words[begin:begin + n].tobytes()}

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2_000):
                made = [x for r in batch.slice(at, 2_000).to_pylist() for x in split(r)]
                yield record({c: [x[c] for x in made] for c in columns}, out)

    return rows.select(columns).mapInArrow(run, schema)


def _search(parts: DataFrame, window: int) -> DataFrame:
    """Per shard: index its segments, stream them, report what an earlier document holds."""
    schema = "key long, cls long, start int, end int"
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(_, table):
        table = table.combine_chunks()
        keys, classes, owners = (table.column(c).to_numpy() for c in ("key", "cls", "owner"))
        buffers = table.column("words").to_pylist()
        lengths = np.array([len(b) // 8 for b in buffers], np.int64)
        words = np.frombuffer(b"".join(buffers), np.uint64)
        index = FMIndex(words, lengths, owners, window)
        seg, at = [], []
        for lanes, starts, least in index.least_owners(words, lengths):
            earlier = least < owners[lanes]
            seg.append(lanes[earlier])
            at.append(starts[earlier])
        seg, at = np.concatenate(seg), np.concatenate(at)
        order = np.lexsort((at, seg))
        seg, at = seg[order], at[order]
        new = np.ones(len(seg), bool)
        new[1:] = (seg[1:] != seg[:-1]) | (at[1:] != at[:-1] + 1)
        begin = np.flatnonzero(new)
        stop = np.append(begin[1:], len(seg)) - 1 if len(seg) else begin
        return pa.Table.from_batches([record({"key": keys[seg[begin]], "cls": classes[seg[begin]], "start": at[begin], "end": at[stop] + window}, out)])

    return parts.select("shard", "key", "cls", "owner", "words").groupBy("shard").applyInArrow(run, schema)


def _intervals_of_classes(rows: DataFrame, window: int, bucket: int, shard_words: int) -> DataFrame:
    """``root_key, root_cls, start, end``: stretches of each segment class that are covered
    by windows of a class with a smaller owner. ``rows``: PART, one row per class."""
    parts, results = rows, []
    while True:
        parts = staged(parts, "segment-parts")
        size = F.length("words") / 8
        classes = staged(parts.groupBy("key", "cls").agg(F.min("owner").alias("least"), F.max("owner").alias("most"), F.first(size).alias("n")), "part-classes")
        buckets = staged(classes.groupBy("key").agg(
            F.count(F.lit(1)).alias("n_classes"), F.sum("n").alias("n_words"), F.min("least").alias("first"), F.max("most").alias("last"),
        ).filter("first < last"), "part-buckets")
        small = F.col("n_classes") <= bucket
        total = buckets.agg(F.sum(F.when(small & (F.col("n_classes") > 1), F.col("n_words"))).alias("words"),
                            F.max("n_classes").alias("most")).first()
        live = staged(parts.join(classes.join(buckets.select("key", "n_classes"), "key").select("key", "cls", "least", "n_classes"), ["key", "cls"]), "live-parts")
        results.append(live.filter("owner > least").selectExpr("root_key", "root_cls", "at AS start", "CAST(at + length(words) / 8 AS INT) AS end"))
        open_ = live.filter("owner = least AND n_classes > 1")
        if total["words"]:
            shards = max(1, -(-int(total["words"]) // shard_words))
            # Of parts with the same words and owner any one stands for all.
            one = open_.filter(small).groupBy("key", "cls").agg(F.first("owner").alias("owner"), F.first("words").alias("words"))
            hits = _search(one.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))), window)
            results.append(staged(open_.filter(small).drop("words").join(hits, ["key", "cls"]).selectExpr(
                "root_key", "root_cls", "CAST(at + start AS INT) AS start", "CAST(at + end AS INT) AS end"), "matches"))
        if not total["most"] or total["most"] <= bucket:
            return functools.reduce(DataFrame.unionByName, results)
        parts = _halves(open_.filter(~small & (F.col("low") < F.col("high"))), window)


def repeated_intervals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bucket: int = BUCKET, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``doc_id, row, start, end``: stretches of words, end exclusive, covered by windows
    that also start in a document with a smaller id. They may overlap.

    ``docs``: ``doc_id`` (not null), ``row`` (tells rows with one id apart), ``text``. The
    texts are dealt out once, to read the words of the classes that are searched.
    """
    every = staged(segments(docs, window, gram), "segments")
    keys = staged(every.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").select("key"), "shared-keys")
    shared = staged(every.join(keys, "key"), "shared-segments")
    classes = staged(shared.groupBy("key", "cls").agg(F.min(F.struct("doc_id", "row", "at", "n", "anchor")).alias("rep")), "segment-classes")
    owned = staged(shared.join(classes.select("key", "cls", F.col("rep.doc_id").alias("owner")), ["key", "cls"]), "owned-segments")
    several = classes.groupBy("key").agg(F.count(F.lit(1)).alias("n_classes")).filter("n_classes > 1").select("key")
    wanted = classes.join(staged(several, "several-classes"), "key").select("key", "cls", "rep.*")
    parts = _words_of(docs, wanted).selectExpr(
        "key AS root_key", "cls AS root_cls", "key", "cls", "owner", "0 AS at", "anchor", "0 AS low", f"{window - gram} AS high", "words")
    inner = _intervals_of_classes(parts, window, bucket, shard_words).withColumnsRenamed({"root_key": "key", "root_cls": "cls"})
    return owned.filter("doc_id > owner").selectExpr("doc_id", "row", "at AS start", "at + n AS end").unionByName(
        owned.filter("doc_id = owner").join(inner, ["key", "cls"]).selectExpr("doc_id", "row", "at + start AS start", "at + end AS end"))


def covered(intervals: list | None, n: int) -> np.ndarray:
    """Which of ``n`` words the intervals cover."""
    if not intervals:
        return np.zeros(n, bool)
    mark = np.zeros(n + 1, np.int64)
    ends = np.array([(x["start"], x["end"]) for x in intervals], np.int64)
    np.add.at(mark, ends[:, 0], 1)
    np.subtract.at(mark, ends[:, 1], 1)
    return np.cumsum(mark)[:n] > 0


def with_intervals(docs: DataFrame, window: int = WINDOW, **sizes) -> DataFrame:
    """``docs`` with a column ``_repeats``: the covered stretches, null where there are none.

    Rows keep all their columns. A row with a null id is neither cut nor a source.
    """
    known = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "text")
    found = repeated_intervals(known, window, **sizes)
    lists = found.groupBy(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).agg(F.collect_list(F.struct("start", "end")).alias("_repeats"))
    same = (docs["doc_id"] == F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_row"))
    return docs.join(lists, same, "left").select(*docs.columns, "_repeats")


def substring_dedup(docs: DataFrame, window: int = WINDOW, **sizes) -> DataFrame:
    """Remove each word covered by a window of ``window`` words that also starts in a
    document with a smaller id; windows are judged on the input.

    One row per row of ``docs``: ``doc_id, n_words, n_removed, kept_sha256`` (of the kept
    words, joined by one space). Null texts have no words. Of rows that repeat an id, each
    is judged against smaller ids only, so equal rows agree.
    """
    def fn(batch):
        texts, repeats = raw(batch), column(batch, "_repeats").to_pylist()
        n, removed, digest = [], [], []
        for text, intervals in zip(texts, repeats):
            words = text.split()
            gone = covered(intervals, len(words))
            n.append(len(words))
            removed.append(int(gone.sum()))
            digest.append(hashlib.sha256(b" ".join([w for w, g in zip(words, gone.tolist()) if not g] if intervals else words)).hexdigest())
        return {"doc_id": column(batch, "doc_id"), "n_words": n, "n_removed": removed, "kept_sha256": digest}

    with_ = with_intervals(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), window, **sizes)
    return map_batches(with_, fn, "doc_id long, n_words long, n_removed long, kept_sha256 string")


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def without_words(text: bytes, gone: np.ndarray) -> bytes:
    """The text without some of its words: what stays keeps its white space, and a space
    stands for each stretch that goes."""
    spans, out = [m.span() for m in _WORD.finditer(text)], []
    edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=1, append=1))
    for first, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
        out.append(text[spans[first][0]:spans[stop - 1][1]])
    return b" ".join(out)


def remove_repeats(docs: DataFrame, window: int = WINDOW, **sizes) -> DataFrame:
    """``docs`` without the words that ``substring_dedup`` removes, with all columns.

    A document that loses its last word goes; ``n_chars``, if there, is counted anew where
    the text changed.
    """
    schema, names = to_arrow_schema(docs.schema), docs.columns

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text", TEXT_BYTES):
                repeats = column(part, "_repeats").to_pylist()
                hit = [i for i, x in enumerate(repeats) if x]
                columns = {c: column(part, c).to_pylist() if c in ("text", "n_chars") else column(part, c) for c in names}
                stay, texts = np.ones(part.num_rows, bool), raw(part.take(pa.array(hit, pa.int64()))) if hit else []
                for i, text in zip(hit, texts):
                    left = without_words(text, covered(repeats[i], len(text.split())))
                    stay[i] = bool(left)
                    columns["text"][i] = left.decode()
                    if "n_chars" in columns:
                        columns["n_chars"][i] = len(columns["text"][i])
                yield record(columns, schema).filter(pa.array(stay))

    return with_intervals(docs, window, **sizes).mapInArrow(run, docs.schema)
