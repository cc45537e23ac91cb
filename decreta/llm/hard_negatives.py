"""Hard negatives by exact inner products, found in STR-packed R-trees.

Rows are dealt to groups of bounded size. The task of a group sorts its rows into tiles,
dimension by dimension, packs the tiles into leaves of one label and the leaves into a
tree of minimum bounding boxes, and answers the anchors that stream by in blocks. A box
gives an interval of the inner product, coordinate by coordinate; a best-first queue
leaves out boxes whose interval misses every score window or lies strictly below the
worst of the k rows found (at equal score: whose ids are all larger).

First a part of the rows answers each anchor. What it finds bounds the k-th best score
from below, so that in the pass over all rows a group returns only rows that can still
count; no row is left out by it.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from decreta.llm.batches import column, record
from decreta.session import staged

LEAF_ROWS, FANOUT = 256, 16
# Rows that one task holds as a tree, and the share of rows that gives the first bounds.
ROWS_PER_GROUP, BOUND_SHARE = 1 << 16, 16
# Scaled components beyond this could give scores beyond 64 bits.
LARGEST = 1 << 26
SCALE, POSITIVES, NEGATIVES = 256, 5, 10
NO_FLOOR = -(1 << 62)
FOUND = "a long, slot int, score long, id long"
_LAST = np.iinfo(np.int64).max  # stands for a null id, which comes last among equals


@dataclass
class Node:
    """A box: per-coordinate bounds, smallest id, label, and its children or rows."""

    low: np.ndarray
    high: np.ndarray
    least_id: int
    label: object
    children: list | None
    rows: tuple[np.ndarray, np.ndarray] | None  # vectors, ids
    lows: np.ndarray | None = None  # of the children, as matrices
    highs: np.ndarray | None = None


def tiles(vectors: np.ndarray, size: int) -> list[np.ndarray]:
    """Sort-tile-recursive order: row numbers in tiles of at most ``size`` rows. The
    dimension of the largest spread is cut first; each cut makes equal slabs."""
    done, work = [], [np.arange(len(vectors))]
    while work:
        rows = work.pop()
        if len(rows) <= size:
            done.append(rows)
            continue
        pages = -(-len(rows) // size)
        slabs = max(2, round(pages ** (1 / max(1, vectors.shape[1]))))
        spread = np.ptp(vectors[rows], axis=0) if vectors.shape[1] else np.zeros(1)
        if spread.max() > 0:
            rows = rows[np.argsort(vectors[rows, int(spread.argmax())], kind="stable")]
        step = -(-pages // slabs) * size
        work += [rows[i:i + step] for i in range(0, len(rows), step)]
    return done


def above(children: list[Node]) -> Node:
    lows, highs = np.stack([c.low for c in children]), np.stack([c.high for c in children])
    labels = {c.label for c in children}
    return Node(lows.min(axis=0), highs.max(axis=0), min(c.least_id for c in children),
                labels.pop() if len(labels) == 1 else None, children, None, lows, highs)


def pack(vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> Node:
    """The tree over rows of one dimension; boxes hold one label as far up as they can."""
    tops = []
    for label in np.unique(labels):
        mine = np.flatnonzero(labels == label)
        mine = mine[np.argsort(ids[mine], kind="stable")]  # equal vectors stay by id
        level = []
        for t in tiles(vectors[mine], LEAF_ROWS):
            v, i = vectors[mine[t]], ids[mine[t]]
            level.append(Node(v.min(axis=0), v.max(axis=0), int(i.min()), label.item(), None, (v, i)))
        while len(level) > 1:
            groups = tiles(np.stack([(n.low + n.high) / 2 for n in level]), FANOUT)
            level = [above([level[k] for k in g]) for g in groups]
        tops += level
    return above(tops)


def search(tree: Node, anchor: np.ndarray, own: int, label, same: bool, low: np.ndarray, high: np.ndarray, k: int) -> list:
    """Rows of the anchor's label (``same``) or of others, for each window ``low`` to
    ``high`` the ``k`` best: highest score first, then smallest id. ``own``: the anchor's
    id, which never counts. Returns (window, score, id)."""
    plus, minus = np.maximum(anchor, 0), np.minimum(anchor, 0)
    best: list[list] = [[] for _ in low]  # sorted (-score, id)
    floor, wide = low.copy(), high.max()

    def wanted(least: np.ndarray, most: np.ndarray, least_id: np.ndarray) -> np.ndarray:
        """Boxes that a window still needs: as most x windows."""
        need = (least[:, None] <= high) & (most[:, None] >= floor)
        for p, found in enumerate(best):
            if len(found) == k:  # a box that only equals the worst must have a smaller id
                need[:, p] &= (most > -found[-1][0]) | (least_id < found[-1][1])
        return need.any(axis=1)

    count = 0
    queue = [(0, 0, tree, NO_FLOOR, -NO_FLOOR)]
    while queue:
        _, _, node, least, most = heapq.heappop(queue)
        if count and not wanted(np.array([least]), np.array([most]), np.array([node.least_id]))[0]:
            continue
        if node.rows is not None:
            vectors, ids = node.rows
            scores = (vectors @ anchor).astype(np.int64)
            for p in range(len(low)):
                hit = np.flatnonzero((scores >= floor[p]) & (scores <= high[p]) & (ids != own))
                if not len(hit):
                    continue
                if len(hit) > k:
                    hit = hit[np.lexsort((ids[hit], -scores[hit]))[:k]]
                best[p] = sorted(best[p] + list(zip((-scores[hit]).tolist(), ids[hit].tolist())))[:k]
                if len(best[p]) == k:
                    floor[p] = max(floor[p], -best[p][-1][0])
            continue
        mine = np.array([c.label is None or (c.label == label) == same for c in node.children])
        least = node.lows @ plus + node.highs @ minus
        most = node.highs @ plus + node.lows @ minus
        least_id = np.array([c.least_id for c in node.children])
        for i in np.flatnonzero(mine & wanted(least, most, least_id)):
            count += 1
            heapq.heappush(queue, (-min(most[i], wide), count, node.children[i], least[i], most[i]))
    return [(p, -s, i) for p, found in enumerate(best) for s, i in found]


def quantised(rows: DataFrame) -> DataFrame:
    """``vec_id, label, v``: the rows that take part, with scaled integer components."""
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE))
    sound = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double") * SCALE) <= LARGEST))
    shifted = F.when(F.pmod(F.col("vec_id"), F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.expr("try_cast(label AS BIGINT)").alias("label"), "embedding").filter(
        F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(sound, F.lit(False))).select(
        "vec_id", shifted.alias("label"), F.transform(x, lambda c: c.cast("int")).alias("v"))


def ask(rows: DataFrame, anchors: DataFrame, n_rows: int, same: bool, k: int) -> DataFrame:
    """FOUND: for each window of each anchor the ``k`` best rows of each group of rows.

    ``anchors``: ``a, vec_id, label, v, low, high`` with one window per array element.
    Every group gets all anchors in blocks, after its own rows.
    """
    spark = rows.sparkSession
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // ROWS_PER_GROUP))
    none = F.lit(None).cast("array<long>")
    stored = rows.select(F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("g"), F.lit(0).alias("kind"),
                         F.lit(None).cast("long").alias("a"), "vec_id", "label", "v", none.alias("low"), none.alias("high"))
    asked = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.lit(1).alias("kind"), "a", "vec_id", "label", "v", "low", "high")
    both = stored.unionByName(asked).repartition(groups, "g").sortWithinPartitions("g", "kind")
    out = to_arrow_schema(StructType.fromDDL(FOUND))

    def run(batches):
        group, held, trees = None, [], None
        for batch in batches:
            g, kind = column(batch, "g").to_numpy(), column(batch, "kind").to_numpy()
            cuts = np.flatnonzero((np.diff(g) != 0) | (np.diff(kind) != 0)) + 1
            for part in (batch.slice(i, j - i) for i, j in zip([0, *cuts], [*cuts, len(g)]) if j > i):
                if column(part, "g")[0].as_py() != group:
                    group, held, trees = column(part, "g")[0].as_py(), [], None
                if column(part, "kind")[0].as_py() == 0:
                    held.append(part)
                    continue
                if trees is None:
                    trees, held = plant(held), []
                yield record(answers(trees, part, same, k), out)

    return both.mapInArrow(run, FOUND)


def vectors_of(part: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
    lists = column(part, "v")
    sizes = lists.value_lengths().to_numpy()
    return sizes, np.split(lists.flatten().to_numpy(), np.cumsum(sizes)[:-1])


def plant(held: list[pa.RecordBatch]) -> dict[int, Node]:
    """A tree for each dimension among the rows. Doubles hold the scores exactly where
    they stay below 2**53; else the trees keep integers."""
    trees = {}
    if not held:
        return trees
    table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    sizes, vectors = vectors_of(table)
    ids, labels = column(table, "vec_id").fill_null(_LAST).to_numpy(), column(table, "label").to_numpy()
    for size in np.unique(sizes):
        mine = np.flatnonzero(sizes == size)
        v = np.concatenate([vectors[i] for i in mine]).reshape(len(mine), size).astype(np.int64)
        exact = int(size) * max(1, int(np.abs(v).max(initial=0))) * LARGEST < 1 << 53
        trees[int(size)] = pack(v.astype(np.float64) if exact else v, ids[mine], labels[mine])
    return trees


def answers(trees: dict[int, Node], part: pa.RecordBatch, same: bool, k: int) -> dict:
    sizes, vectors = vectors_of(part)
    windows = zip(column(part, "low").to_pylist(), column(part, "high").to_pylist())
    a, slot, score, ids = [], [], [], []
    own, labels, keys = column(part, "vec_id").to_pylist(), column(part, "label").to_pylist(), column(part, "a").to_pylist()
    for i, (low, high) in enumerate(windows):
        tree = trees.get(int(sizes[i]))
        if tree is None or not low:
            continue
        anchor = vectors[i].astype(tree.low.dtype)
        for p, s, found in search(tree, anchor, own[i], labels[i], same, np.array(low), np.array(high), k):
            a.append(keys[i]), slot.append(p), score.append(s), ids.append(found)
    ids = np.array(ids, np.int64)
    return {"a": a, "slot": slot, "score": score, "id": pa.array(ids, pa.int64(), mask=ids == _LAST)}


def best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("a", "slot").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(rows: DataFrame, anchors: DataFrame, n_rows: int, same: bool, k: int) -> DataFrame:
    """The ``k`` best rows of each window of each anchor, over all groups."""
    some = rows.filter(F.pmod(F.xxhash64("row", F.lit(1)), F.lit(BOUND_SHARE)) == 0)
    first = best(ask(some, anchors, -(-n_rows // BOUND_SHARE), same, k), k).filter(F.col("rank") == k)
    reached = first.groupBy("a").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("reached"))
    bounded = anchors.join(reached, "a", "left").withColumn("low", F.transform(
        "low", lambda x, i: F.greatest(x, F.col("reached")[i]))).drop("reached")
    return best(ask(rows, staged(bounded, "anchors"), n_rows, same, k), k)


def hard_negatives(vectors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, anchor_every: int = 100) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Rows (``vec_id, label, embedding``) with a null label (or one that is no number), a null vector, or a null or
    non-finite component take no part, nor do rows with a component beyond 2**18, whose
    scores might not fit 64 bits. Rows with a null id are never anchors and come last
    among equals. An anchor's other rows are those with another id; rows that repeat an
    id count each, and an anchor that is repeated exactly is asked once. Only vectors of
    the anchor's length are compared. Empty tables give an empty result.
    """
    rows = staged(quantised(vectors).withColumn("row", F.monotonically_increasing_id()), "rows")
    n_rows = rows.count()
    picked = rows.filter(F.pmod(F.col("vec_id"), F.lit(anchor_every)) == 0).select("vec_id", "label", "v").distinct()
    anchors = staged(picked.withColumn("a", F.monotonically_increasing_id()), "anchors")
    open_ended = anchors.withColumns({"low": F.array(F.lit(NO_FLOOR).cast("long")), "high": F.array(F.lit(-NO_FLOOR).cast("long"))})
    near = nearest(rows, open_ended, n_rows, True, positives).select("a", F.col("rank").alias("p"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    near = staged(near, "positives")
    # At most ``positives`` windows per anchor, in whole numbers: 30 p <= 100 n <= 90 p.
    score = F.col("positive_score")
    window = near.filter(score >= 0).select("a", "p", F.expr("(30 * positive_score + 99) div 100").alias("low"), F.expr("90 * positive_score div 100").alias("high")).filter("low <= high")
    windows = window.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("p", "low", "high"))).alias("w"))
    asked = staged(anchors.join(windows, "a").select("a", "vec_id", "label", "v", "w.p", "w.low", "w.high"), "windows")
    far = nearest(rows, asked.drop("p"), n_rows, False, negatives)
    slots = asked.select("a", F.col("vec_id").alias("anchor_id"), F.posexplode("p").alias("slot", "p"))
    return far.join(slots, ["a", "slot"]).join(near, ["a", "p"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
