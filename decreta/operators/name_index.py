"""The most similar registry names of each name, without scoring all pairs.

Names and registry meet in groups: a shard of the registry with a share of the names, all
dealt out by Spark. A group lays its shard out once, in blocks of entries of like size,
and answers its names one after the other: every block has an upper bound of the scores
it can give, blocks are visited from the highest bound on, and the visit ends at the
first bound below the k-th best score found. Inside a block an entry is scored only if
its own bound reaches that score. No bound is ever exceeded by rounding (``_SLACK``), and
entries that only equal the k-th score are scored too, so that ties follow the registry.

``trigram``: posting lists of trigrams. Entries are numbered by their number of trigrams,
so that a block is one slice of every list. Rare trigrams come first: if none of the
first few is in a block, no entry there can reach the score needed. Shared trigrams are
counted from the slices; only the containment bonus is left to be tested per entry.

``token_sort``: lengths and character counts bound the longest common subsequence, which
is then computed for many entries at once on bit masks of the name's characters.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from decreta.functions.similarity import CONTAINMENT, LENGTH_WEIGHT, common_lengths, sorted_tokens, trigrams

# Registry entries that a group lays out, and names that it answers.
SHARD_ENTRIES, SHARE_NAMES = 50_000, 20_000
BLOCK_ENTRIES = 4_096
_SLACK = 1e-9
FOUND = "name string, best array<struct<neg:double,pri:int,pos:bigint,choice:string>>, scored bigint"


class Best:
    """The k best entries so far: by score, then registry order, then spelling."""

    def __init__(self, k: int):
        self.k, self.heap, self.scored = k, [], 0

    @property
    def least(self) -> float:
        """Score that an entry must reach to matter."""
        return self.heap[0][0] if len(self.heap) == self.k else -1.0

    def add(self, score: float, pri: int, pos: int, rank: int, choice: str) -> None:
        self.scored += 1
        item = (score, -pri, -pos, -rank, choice)
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, item)
        elif item > self.heap[0]:
            heapq.heapreplace(self.heap, item)

    def rows(self) -> list[dict]:
        return [{"neg": -s, "pri": -p, "pos": -o, "choice": c} for s, p, o, _, c in sorted(self.heap, reverse=True)]


class Shard:
    """Entries in ascending size, cut into blocks."""

    def __init__(self, frame: pd.DataFrame, size: np.ndarray):
        order = np.lexsort((frame["pos"], frame["pri"], size))
        frame = frame.iloc[order]
        self.size = size[order]
        self.pri, self.pos = (frame[c].to_numpy(np.int64) for c in ("pri", "pos"))
        self.choice, self.frame = frame["choice"].tolist(), frame
        self.rank = np.empty(len(frame), np.int64)
        self.rank[np.array(sorted(range(len(frame)), key=self.choice.__getitem__), np.int64)] = np.arange(len(frame))
        self.starts = np.arange(0, len(frame), BLOCK_ENTRIES)
        self.ends = np.minimum(self.starts + BLOCK_ENTRIES, len(frame))
        self.least, self.most = self.size[self.starts], self.size[self.ends - 1]

    def blocks(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Blocks from the highest bound on: the size in the block that is nearest to
        ``size``, and the order."""
        nearest = np.clip(size, self.least, self.most)
        ratio = np.minimum(nearest, size) / np.maximum(1, np.maximum(nearest, size))
        return ratio, np.argsort(-ratio, kind="stable")

    def give(self, best: Best, entries: np.ndarray, scores: list[float]) -> None:
        for e, s in zip(entries.tolist(), scores):
            best.add(s, int(self.pri[e]), int(self.pos[e]), int(self.rank[e]), self.choice[e])


class TrigramShard(Shard):
    columns = ("low", "tri")

    def __init__(self, frame: pd.DataFrame):
        super().__init__(frame, frame["tri"].map(len).to_numpy(np.int64))
        lists = self.frame["tri"].tolist()
        codes, values = pd.factorize(np.array([t for ts in lists for t in ts], object))
        self.code = {t: i for i, t in enumerate(values)}
        owner = np.repeat(np.arange(len(lists)), self.size)
        order = np.lexsort((owner, codes))
        self.postings = owner[order]
        self.at = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(values)))]).astype(np.int64)
        self.low = self.frame["low"].tolist()
        self.length = np.array([len(x) for x in self.low], np.int64)

    def answer(self, row: dict, best: Best) -> None:
        low, n = row["low"], len(row["tri"])
        known = sorted((self.code[t] for t in row["tri"] if t in self.code), key=lambda c: (self.at[c + 1] - self.at[c], c))
        lists = [self.postings[self.at[c]:self.at[c + 1]] for c in known]
        ratio, order = self.blocks(n)
        for b in order.tolist():
            if ratio[b] + CONTAINMENT + LENGTH_WEIGHT < best.least - _SLACK:
                break
            start, end = int(self.starts[b]), int(self.ends[b])
            parts = [x[slice(*np.searchsorted(x, (start, end)))] for x in lists]
            need = best.least - CONTAINMENT - LENGTH_WEIGHT - _SLACK
            if need > 0:
                # So many trigrams must be shared; those not known here are missing already.
                shared = int(np.ceil(need / (1 + need) * (n + self.least[b]) - _SLACK))
                if not any(len(p) for p in parts[:max(0, len(parts) - shared + 1)]):
                    continue
            count = np.bincount(np.concatenate(parts) - start, minlength=end - start) if parts else np.zeros(end - start, np.int64)
            length, size = self.length[start:end], self.size[start:end]
            base = count / np.maximum(1, n + size - count)
            close = np.minimum(length, len(low)) / np.maximum(1, np.maximum(length, len(low))) * LENGTH_WEIGHT
            bound = base + CONTAINMENT + close
            left = np.flatnonzero(bound >= best.least - _SLACK)
            left = left[np.argsort(-bound[left], kind="stable")]
            while len(left):  # a few at a time, as each raises the score needed
                left = left[bound[left] >= best.least - _SLACK]
                now, left = left[:best.k], left[best.k:]
                inside = [CONTAINMENT if low in self.low[start + e] or self.low[start + e] in low else 0.0 for e in now.tolist()]
                self.give(best, now + start, np.minimum(1.0, base[now] + np.array(inside) + close[now]).tolist())


class TokenSortShard(Shard):
    columns = ("text",)

    def __init__(self, frame: pd.DataFrame):
        texts = [sorted_tokens(t) for t in frame["text"]]
        frame = frame.assign(sorted=texts)
        super().__init__(frame, np.array([len(t) for t in texts], np.int64))
        self.texts = self.frame["sorted"].tolist()
        letters = sorted(set("".join(self.texts)))
        self.letter = {c: i for i, c in enumerate(letters)}
        self.counts = np.zeros((len(self.texts), len(letters)), np.uint16)
        codes = np.array([self.letter[c] for t in self.texts for c in t], np.int64)
        np.add.at(self.counts, (np.repeat(np.arange(len(self.texts)), self.size), codes), 1)

    def answer(self, row: dict, best: Best) -> None:
        text = sorted_tokens(row["text"])
        mine = np.zeros(len(self.letter), np.uint16)
        for c in text:
            if c in self.letter:
                mine[self.letter[c]] += 1
        used = np.flatnonzero(mine)
        ratio, order = self.blocks(len(text))
        for b in order.tolist():
            # 2 * LCS / (n + m), with LCS at most the shorter length
            if 2 * ratio[b] / (1 + ratio[b]) < best.least - _SLACK and len(text):
                break
            start, end = int(self.starts[b]), int(self.ends[b])
            total = self.size[start:end] + len(text)
            common = np.minimum(self.counts[start:end][:, used], mine[used]).sum(axis=1, dtype=np.int64)
            bound = np.where(total > 0, 2.0 * common / np.maximum(1, total), 1.0)
            left = np.flatnonzero(bound >= best.least - _SLACK)
            left = left[np.argsort(-bound[left], kind="stable")]
            take = best.k
            while len(left):
                left = left[bound[left] >= best.least - _SLACK]
                now, left, take = left[:take], left[take:], 4 * take
                shared = common_lengths(text, [self.texts[start + e] for e in now.tolist()])
                scores = [2.0 * s / t if t else 1.0 for s, t in zip(shared, total[now].tolist())]
                self.give(best, now + start, scores)


SHARDS = {"trigram": TrigramShard, "token_sort": TokenSortShard}


def indexed_top(names: DataFrame, choices: DataFrame, k: int, scorer: str = "trigram",
                shard_entries: int = SHARD_ENTRIES, share_names: int = SHARE_NAMES) -> DataFrame:
    """``name, _top, scored``: the best ``k`` of ``choices`` (``choice, canonical,
    sport_id, ord``) for each distinct ``name``, and how many were scored for it.

    Every name meets every shard once. Shards have about ``shard_entries`` entries and
    are copied to every share of about ``share_names`` names, so a group is bounded.
    """
    spark = names.sparkSession
    distinct = names.select("name").filter("name IS NOT NULL").distinct()
    n_names, n_entries = distinct.count(), choices.count()
    shards = max(1, -(-n_entries // shard_entries))
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = max(1, -(-n_names // share_names), -(-wide // shards))

    def laid_out(df: DataFrame, name: str):
        return {"low": F.lower(name), "tri": trigrams(F.col(name)), "text": F.col(name)}

    kind = SHARDS[scorer]
    entries = choices.select("choice", F.col("ord.pri").alias("pri"), F.col("ord.pos").alias("pos"),
                             *[c.alias(n) for n, c in laid_out(choices, "choice").items() if n in kind.columns])
    stored = entries.select("*", F.pmod(F.xxhash64("choice"), F.lit(shards)).alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"),
                            F.lit(0).alias("asked"), F.lit(None).cast("string").alias("name"))
    empty = [F.lit(None).cast(t).alias(n) for n, t in (("choice", "string"), ("pri", "int"), ("pos", "bigint"))]
    asked = distinct.select(*empty, *[c.alias(n) for n, c in laid_out(distinct, "name").items() if n in kind.columns],
                            F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard"),
                            F.pmod(F.xxhash64("name"), F.lit(shares)).cast("int").alias("share"), F.lit(1).alias("asked"), "name")
    both = stored.unionByName(asked).repartition(shards * shares, "shard", "share").sortWithinPartitions("shard", "share", "asked")
    out = to_arrow_schema(StructType.fromDDL(FOUND))

    def run(batches):
        group, held, index = None, [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = pd.DataFrame({c: table.column(c).to_numpy() for c in ("shard", "share", "asked")})
            for key, part in keys.groupby(["shard", "share", "asked"], sort=False):
                rows = table.slice(part.index[0], len(part))
                if key[:2] != group:
                    group, held, index = key[:2], [], None
                if key[2] == 0:
                    held.append(rows)
                    continue
                if index is None and held:
                    index, held = kind(pa.concat_tables(held).to_pandas()), []
                found = []
                for row in rows.select(["name", *kind.columns]).to_pylist():
                    best = Best(k)
                    if index is not None:
                        index.answer(row, best)
                    found.append({"name": row["name"], "best": best.rows(), "scored": best.scored})
                yield pa.RecordBatch.from_pylist(found, schema=out)

    found = both.mapInArrow(run, FOUND)
    tops = found.groupBy("name").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"), F.sum("scored").alias("scored"))
    # What else is known of an entry joins by its spelling: at most k rows for each name.
    shown = tops.select("name", F.posexplode("best").alias("place", "b")).select("name", "place", "b.neg", "b.choice").join(choices, "choice")
    lists = shown.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("place", "neg", "ord", "choice", "canonical", "sport_id"))).alias("_all"))
    top = F.transform("_all", lambda x: F.struct(*[x[c].alias(c) for c in ("neg", "ord", "choice", "canonical", "sport_id")]))
    return tops.select("name", "scored").join(lists, "name", "left").select("name", top.alias("_top"), "scored")
