"""Secret scans: fixed patterns, and formats inferred from the credentials they find.

The base patterns label credentials by kind. From a bounded sample of each kind a
probabilistic automaton is inferred. The plain format comes from the words of all texts
that are too short to be candidates, so it does not depend on how many secrets there are.
Every further candidate string is scored by its likelihood under the credential formats
against the plain one; those well above it are added as spans of the kind ``format``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from decreta.llm.automata import Automaton
from decreta.llm.batches import column, map_batches, raw
from decreta.session import staged

# The base patterns in listed order, and the characters of a credential.
ASSIGN = rb"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = rb"AKIA[A-Z0-9]+"
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "format")
ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"

# Candidates have this many characters at least. Values of each kind that an automaton is
# inferred from at most, and their longest length. Bits by which a candidate must be
# likelier as a credential, in all and for each character.
MIN_CANDIDATE, SAMPLE, SAMPLE_LENGTH = 16, 300, 128
MIN_BITS, MIN_BITS_PER_CHARACTER = 24.0, 0.75
# Weights of a character after the one before it, of the character alone and of any
# character, in the plain format.
PLAIN_WEIGHTS = (0.8, 0.1, 0.1)

_ASSIGN, _ACCESS, _HEX = re.compile(ASSIGN), re.compile(ACCESS), re.compile(rb"[0-9a-f]{%d,}" % MIN_HEX)
_IN_ALPHABET = np.zeros(256, bool)
_IN_ALPHABET[list(ALPHABET)] = True
# Codes of the characters; EDGE stands before the first and after the last one.
EDGE = len(ALPHABET)
_CODES = np.full(256, EDGE, np.int64)
_CODES[list(ALPHABET)] = np.arange(EDGE)
SPAN = "struct<kind: int, start: long, end: long, value_start: long, value: string>"
FOUND = f"doc_id long, key long, spans array<{SPAN}>"
SCANNED = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def base_spans(text: bytes) -> list[tuple[int, int, int, int]]:
    """``kind, start, end, start of the value`` in bytes, leftmost for each kind."""
    found, lower = [], text.lower()
    if any(k in lower for k in KEYWORDS):
        found += [(0, m.start(), m.end(), m.start(1)) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= MIN_ASSIGN]
    if b"AKIA" in text:
        found += [(1, m.start(), m.end(), m.start()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    return found


def _runs(texts: list[bytes]) -> list[list[tuple[int, int]]]:
    """Stretches of credential characters of at least MIN_CANDIDATE in each text."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    inside = _IN_ALPHABET[np.frombuffer(b"\0".join([*texts, b""]), np.uint8)].view(np.int8)
    edges = np.flatnonzero(np.diff(inside, prepend=np.int8(0), append=np.int8(0)))
    starts, ends = edges[::2], edges[1::2]
    long_ = ends - starts >= MIN_CANDIDATE
    first = np.cumsum(sizes) - sizes
    owner = np.searchsorted(first, starts[long_], side="right") - 1
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    for i, a, b in zip(owner.tolist(), (starts[long_] - first[owner]).tolist(), (ends[long_] - first[owner]).tolist()):
        out[i].append((a, b))
    return out


def find_spans(texts: list[bytes]) -> list[list[dict]]:
    """Base spans and, as kind 3, every other stretch of credential characters of each
    text, in code points."""
    out = []
    for text, runs in zip(texts, _runs(texts)):
        found = base_spans(text)
        for a, b in runs:
            if b - a >= MIN_HEX:
                found += [(2, m.start(), m.end(), m.start()) for m in _HEX.finditer(text, a, b)]
        # A candidate overlaps no base span: of those that start before its end, none reaches into it.
        found.sort(key=lambda x: x[1])
        starts, reach = [s for _, s, _, _ in found], list(accumulate((e for _, _, e, _ in found), max))
        for a, b in runs:
            before = bisect_left(starts, b)
            if not before or reach[before - 1] <= a:
                found.append((3, a, b, a))
        if text.isascii():
            point = lambda at: at
        else:
            points = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
            point = lambda at: int(points[at])  # noqa: B023, E731
        out.append([{"kind": k, "start": point(s), "end": point(e), "value_start": point(v), "value": text[v:e].decode()} for k, s, e, v in sorted(found, key=lambda x: (x[1], x[0]))])
    return out


class PlainFormat:
    """Strings as the words of a corpus spell them: each character by the one before it,
    from ``counts`` by code of both. Digits alone are never dearer than a number."""

    def __init__(self, counts: np.ndarray):
        choices = EDGE + 1
        pair, alone, any_ = PLAIN_WEIGHTS
        before, single = counts.sum(axis=1, keepdims=True), counts.sum(axis=0)
        uniform = np.full(choices, 1 / choices)
        one = single / single.sum() if single.sum() else uniform
        after = np.where(before > 0, counts / np.maximum(before, 1), one)
        self.cost = -np.log2(pair * after + alone * one + any_ * uniform)

    def bits(self, text: str) -> float:
        codes = _CODES[np.frombuffer(text.encode(), np.uint8)]
        total = float(self.cost[np.append(EDGE, codes), np.append(codes, EDGE)].sum())
        return min(total, (len(text) + 1) * np.log2(11)) if text.isdigit() else total


def count_pairs(texts: list[bytes]) -> np.ndarray:
    """Pairs of codes in the stretches of credential characters that are too short to be
    candidates, outside base spans."""
    blanked = []
    for text in texts:
        if spans := base_spans(text):
            text = bytearray(text)
            for _, a, b, _ in spans:
                text[a:b] = b" " * (b - a)
        blanked.append(bytes(text))
    codes = _CODES[np.frombuffer(b"\0".join([b"", *blanked, b""]), np.uint8)]
    inside = (codes != EDGE).view(np.int8)
    edges = np.flatnonzero(np.diff(inside, prepend=np.int8(0), append=np.int8(0)))
    for a, b in zip(edges[::2][(long_ := edges[1::2] - edges[::2] >= MIN_CANDIDATE)].tolist(), edges[1::2][long_].tolist()):
        codes[a:b] = EDGE
    pairs = np.bincount(codes[:-1] * (EDGE + 1) + codes[1:], minlength=(EDGE + 1) ** 2).reshape(EDGE + 1, EDGE + 1)
    pairs[EDGE, EDGE] = 0
    return pairs


def plain_format(docs: DataFrame) -> PlainFormat:
    """The plain format of all texts of ``docs``."""
    def fn(batch):
        pairs = count_pairs(raw(batch)).ravel()
        at = np.flatnonzero(pairs)
        return {"pair": at, "n": pairs[at]}

    counts = np.zeros((EDGE + 1) ** 2)
    for r in map_batches(docs.select("text"), fn, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        counts[r["pair"]] = r["n"]  # one row for each pair of characters
    return PlainFormat(counts.reshape(EDGE + 1, EDGE + 1))


def infer_formats(found: DataFrame, sample: int = SAMPLE):
    """Automata by kind from at most ``sample`` distinct labelled values of each, chosen
    by hash. ``None`` without labelled credentials."""
    values = found.select(F.explode("spans").alias("s")).select("s.kind", "s.value").filter(
        (F.col("kind") != 3) & (F.length("value") <= SAMPLE_LENGTH)).distinct()
    order = Window.partitionBy("kind").orderBy(F.xxhash64("value"), "value")
    rows = values.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= sample).orderBy("kind", "rank").collect()
    examples: dict[int, list[str]] = {}
    for r in rows:  # at most 3 * sample short strings
        examples.setdefault(r["kind"], []).append(r["value"])
    return {kind: Automaton(texts, len(ALPHABET)) for kind, texts in examples.items()} or None


def is_credential(value: str, formats: dict) -> bool:
    """Whether the likeliest credential format beats the plain one (3; without one: uniform
    over the alphabet) by MIN_BITS and by MIN_BITS_PER_CHARACTER."""
    plain = formats[3].bits(value) if 3 in formats else (len(value) + 1) * np.log2(len(ALPHABET) + 1)
    gain = plain - min(a.bits(value) for kind, a in formats.items() if kind != 3)
    return gain >= MIN_BITS and gain >= MIN_BITS_PER_CHARACTER * len(value)


def secret_spans(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, key, spans`` for every row: base spans, and candidates that an inferred
    format accepts. ``key`` is a hash of the text."""
    def fn(batch):
        return {"doc_id": column(batch, "doc_id"), "key": column(batch, "key"), "spans": find_spans(raw(batch))}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), "text")
    found = staged(map_batches(rows, fn, FOUND), "spans")
    formats = infer_formats(found, sample)
    if formats:
        formats[3] = plain_format(docs)
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(formats)

    def score(batch):
        model = known.value
        spans = [[s for s in row if s["kind"] != 3 or model and is_credential(s["value"], model)] for row in column(batch, "spans").to_pylist()]
        return {"doc_id": column(batch, "doc_id"), "key": column(batch, "key"), "spans": spans}

    # Rows without a candidate pass as they are; the others are scored in Arrow batches.
    open_ = F.exists("spans", lambda s: s["kind"] == 3)
    scored = map_batches(found.filter(open_).withColumn("text", F.lit("")), score, FOUND)
    return found.filter(~open_).unionByName(scored)


def scan_secrets(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Secrets in every whole text of ``docs`` (``doc_id, text``; null: empty): SCANNED.

    ``base_sha256`` covers the base spans as ``kind:start:end``, in code points, by start
    and kind; ``spans`` has all of them. Rows that repeat an id are scanned each. Without
    labelled credentials in the table only the base patterns hold.
    """
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != 3)
    return secret_spans(docs, sample).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


# The text with each value replaced; overlapping values count as one.
REDACTED = """aggregate(array_sort(transform(_spans, s -> struct(s.value_start AS a, s.end AS b))),
  struct('' AS done, 0L AS at),
  (r, s) -> struct(IF(s.a >= r.at, concat(r.done, substr(text, CAST(r.at + 1 AS INT), CAST(s.a - r.at AS INT)), {mark}), r.done) AS done,
    greatest(r.at, s.b) AS at),
  r -> concat(r.done, substr(text, CAST(r.at + 1 AS INT))))"""


def redact_secrets(docs: DataFrame, mark: str = "[secret]", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with each secret's value replaced by ``mark``; all rows and columns stay,
    and ``n_chars``, if there, is counted anew where the text changed."""
    hits = secret_spans(docs, sample).filter("size(spans) > 0").dropDuplicates(["doc_id", "key"]).select(
        F.col("doc_id").alias("_id"), F.col("key").alias("_key"), F.col("spans").alias("_spans"))
    same = (F.xxhash64(docs["text"]) == F.col("_key")) & docs["doc_id"].eqNullSafe(F.col("_id"))
    found, quoted = F.col("_spans").isNotNull(), "'" + mark.replace("\\", "\\\\").replace("'", "\\'") + "'"
    out = docs.join(hits, same, "left").withColumn("text", F.when(found, F.expr(REDACTED.format(mark=quoted))).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(found, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)
