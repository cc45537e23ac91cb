"""Ranked lexical search, reversed: the items are indexed and the documents stream by.

Benchmark items are few and documents many, so the inverted index is built over the
terms of the items and broadcast. Every document is read once: its counts of item terms
are written to a staged table, which also gives the corpus statistics (documents, terms,
documents with a term). A second pass sends the staged counts through the index, adds up
all item scores of a batch side by side and keeps the best documents of each item in a
bounded heap per task; the heaps are merged by a window that Spark limits before the
shuffle. Items come in blocks whose index has a bounded number of postings.

A term is a maximal run of digits, letters and characters beyond ASCII, with only A-Z
lower-cased. In UTF-8 every byte of a character beyond ASCII is 0x80 or more, so terms
are cut on bytes.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from decreta.llm.batches import column, map_batches, raw, record, split_words
from decreta.session import staged

# Postings of the items that are indexed and broadcast at a time.
INDEX_POSTINGS = 1 << 20
# Scores (documents x items) and postings worked on at a time inside a task.
SCORES_AT_A_TIME, PAIRS_AT_A_TIME = 1 << 21, 1 << 22

_TERM = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
COUNTS = "doc_id long, n long, terms array<int>, tfs array<long>"
TOPS = "item int, score long, doc_id long"


def term_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """``doc, term, tf`` of every distinct term of every text, the terms, terms per text."""
    codes, vocabulary, sizes = split_words([t.translate(_TERM) for t in texts])
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    width = max(1, len(vocabulary))
    keys, tf = np.unique(doc * width + codes, return_counts=True)
    return keys // width, keys % width, tf.astype(np.int64), vocabulary, sizes


def count_documents(docs: DataFrame, terms) -> DataFrame:
    """COUNTS of each row of ``docs``: all its terms with repeats, and the count of each
    term that ``terms`` (a broadcast map from a term to its number) knows."""

    def run(batch):
        doc, term, tf, vocabulary, sizes = term_counts(raw(batch))
        known = np.array([terms.value.get(w, -1) for w in vocabulary], np.int64)
        keep = known[term] >= 0 if len(term) else np.zeros(0, bool)
        doc, term, tf = doc[keep], known[term[keep]] if len(term) else term, tf[keep]
        offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(sizes)))]).astype(np.int32)
        return {"doc_id": column(batch, "doc_id"), "n": sizes,
                "terms": pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                "tfs": pa.ListArray.from_arrays(offsets, pa.array(tf))}

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, COUNTS)


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term`` (bytes), each once. Rows with one item_id are one item, which
    has the terms of them all."""

    def run(batch):
        doc, term, _, vocabulary, _ = term_counts(raw(batch))
        ids = column(batch, "item_id")
        return {"item_id": ids.take(pa.array(doc)), "term": pa.array([vocabulary[t] for t in term.tolist()], pa.binary())}

    kind = items.schema["item_id"].dataType.simpleString()
    return map_batches(items.select("item_id", "text"), run, f"item_id {kind}, term binary").distinct()


class Index:
    """Inverted index of one block of items: for each term its weight and its items."""

    def __init__(self, item: np.ndarray, term: np.ndarray, n_items: int, n_terms: int):
        order = np.argsort(term, kind="stable")
        self.items, self.n_items = item[order].astype(np.int64), n_items
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=n_terms))]).astype(np.int64)

    def scores(self, doc: np.ndarray, term: np.ndarray, gain: np.ndarray, n_docs: int) -> np.ndarray:
        """Sum of the gains of the terms that document and item share, exact in 64 bits."""
        out = np.zeros(n_docs * self.n_items, np.int64)
        sizes = self.starts[term + 1] - self.starts[term]
        cuts = np.searchsorted(np.cumsum(sizes), np.arange(PAIRS_AT_A_TIME, max(1, sizes.sum()), PAIRS_AT_A_TIME))
        for part in np.split(np.arange(len(term)), np.unique(cuts)):
            if not len(part):
                continue
            n = sizes[part]
            first = np.repeat(self.starts[term[part]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
            key = np.repeat(doc[part] * self.n_items, n) + self.items[first + np.arange(n.sum())]
            value = np.repeat(gain[part], n)
            if gain[part].sum(dtype=float) < 2.0**53:  # sums of doubles are exact up to here
                out += np.bincount(key, value, len(out)).astype(np.int64)
            else:
                np.add.at(out, key, value)
        return out.reshape(n_docs, self.n_items)


class Heaps:
    """The ``k`` best documents of each item so far: highest score, then smallest id, nulls last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.zeros(n_items, np.int64)
        self.top = pd.DataFrame({"item": np.zeros(0, np.int64), "score": np.zeros(0, np.int64), "last": np.zeros(0, bool), "doc_id": np.zeros(0, np.int64)})

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """A document that only equals the worst of a full heap may still have the smaller id."""
        doc, item = np.nonzero((scores >= self.least[None, :]) & (scores > 0))
        if not len(doc):
            return
        new = pd.DataFrame({"item": item, "score": scores[doc, item], "last": null[doc], "doc_id": ids[doc]})
        both = pd.concat([self.top, new], ignore_index=True).sort_values(
            ["item", "score", "last", "doc_id"], ascending=[True, False, True, True], kind="stable")
        place = both.groupby("item").cumcount()
        self.top = both[place < self.k].reset_index(drop=True)
        full = both[place == self.k - 1]
        self.least[full["item"].to_numpy()] = full["score"].to_numpy()


def gains(tf: np.ndarray, n: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` of each count."""
    if 90 * int(n.max(initial=0)) * n_docs < 1 << 63:
        m = 10 + 90 * n * n_docs // n_terms
    else:
        m = np.array([10 + 90 * int(x) * n_docs // n_terms for x in n], np.int64)
    return weight * (1_000_000_000 * tf // (1000 * tf + 8 * m))


def search_block(counts: DataFrame, index, weights, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """TOPS: the best ``k`` documents of each item in each task."""
    out = to_arrow_schema(StructType.fromDDL(TOPS))

    def run(batches):
        found, chunk = None, max(1, SCORES_AT_A_TIME // max(1, index.value.n_items))
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                part = batch.slice(at, chunk)
                found = found or Heaps(index.value.n_items, k)
                lists, tfs = column(part, "terms"), column(part, "tfs")
                doc = np.repeat(np.arange(part.num_rows, dtype=np.int64), lists.value_lengths().to_numpy(zero_copy_only=False))
                term, tf = lists.flatten().to_numpy(), tfs.flatten().to_numpy()
                n = column(part, "n").to_numpy()
                gain = gains(tf, n[doc], weights.value[term], n_docs, n_terms)
                ids = column(part, "doc_id")
                found.add(index.value.scores(doc, term, gain, part.num_rows), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))
        if found is not None and len(top := found.top):
            yield record({"item": top["item"].to_numpy(), "score": top["score"].to_numpy(),
                          "doc_id": pa.array(top["doc_id"].to_numpy(), pa.int64(), mask=top["last"].to_numpy())}, out)

    return counts.mapInArrow(run, TOPS)


def numbered(table: pa.Table, name: str) -> tuple[np.ndarray, pa.Array]:
    """Number of each row's value, and the values; null is a value of its own."""
    values = pa.concat_arrays(table.column(name).chunks).dictionary_encode("encode")
    return values.indices.to_numpy().astype(np.int64), values.dictionary


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 10, index_postings: int = INDEX_POSTINGS) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents (``doc_id, text``) of
    each item (``item_id, text``) with a score above 0; equal scores by ascending id.

    Null and empty texts have no term: such a document never ranks and does not count as
    one, such an item returns nothing. Rows with one doc_id are documents of their own,
    each with its rank; a null doc_id comes last among equals. Rows with one item_id,
    also null, are one item. Empty tables give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    wanted = staged(item_terms(items), "item-terms")
    blocks = -(-wanted.count() // index_postings)
    kind = wanted.schema["item_id"].dataType.simpleString()
    result = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in range(blocks):
        # An item is whole in its block; a block has about ``index_postings`` rows.
        rows = wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toArrow().combine_chunks()
        if not rows.num_rows:
            continue
        item, ids = numbered(rows, "item_id")
        term, words = numbered(rows, "term")
        known = spark.sparkContext.broadcast({w: i for i, w in enumerate(words.to_pylist())})
        counts = staged(count_documents(docs, known), "term-counts")
        total = counts.filter("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        n_docs, n_terms = total["docs"], total["terms"] or 1
        df = np.zeros(len(words), np.int64)
        # One row for each term of the block.
        for t, n in counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).toArrow().to_pandas().itertuples(index=False):
            df[t] = n
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        index = Index(item, term, len(ids), len(words))
        tops = search_block(counts, spark.sparkContext.broadcast(index), spark.sparkContext.broadcast(weights), n_docs, n_terms, k)
        best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = tops.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        # At most ``index_postings`` items and their numbers.
        names = spark.createDataFrame(pa.table({"item": pa.array(np.arange(len(ids)), pa.int32()), "item_id": ids}))
        result = result.unionByName(ranked.join(F.broadcast(names), "item").select(
            F.col("item_id").cast(kind).alias("item_id"), "rank", "doc_id", "score"))
    return result
