"""Near-duplicate vectors by p-stable hashing, checked by exact cosines.

Normalised vectors at cosine ``c`` are at the Euclidean distance sqrt(2 - 2c). Each table
hashes a vector by several Gaussian projections, shifted and cut into steps of a fixed
width. The number of projections follows the number of vectors, so that unrelated
vectors seldom meet, and the number of tables follows from it, so that a pair at the
threshold is missed with a fixed probability at every size.

Vectors in one bucket are compared in blocks. A pair counts in the first table in which
it meets, so each link is counted once, and only counts and enough links to connect the
bucket leave a task, never all pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegralType, StructType

from decreta.llm.batches import column, record
from decreta.llm.components import components
from decreta.session import staged

MIN_COSINE, STEP, MISS, SEED = 0.98, 2.0, 1e-5, 7
# Vectors of a block; larger buckets are compared block against block.
BLOCK = 1024
ROWS = 2_000


def _same_step(distance: float, step: float) -> float:
    """Probability that one projection puts two vectors at ``distance`` in one step."""
    r = step / distance
    return math.erf(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def parameters(n: int, min_cosine: float = MIN_COSINE, step: float = STEP, miss: float = MISS) -> tuple[int, int]:
    """Projections of a table, and tables: unrelated vectors (at a right angle) meet with
    a probability of 1 / n, a pair at the threshold is missed with probability ``miss``."""
    near, far = _same_step(math.sqrt(2 - 2 * min_cosine), step), _same_step(math.sqrt(2), step)
    k = max(4, math.ceil(math.log(max(2, n)) / -math.log(far)))
    return k, math.ceil(math.log(miss) / math.log1p(-(near**k)))


def _clean(vectors: pa.Array) -> list[bytes | None]:
    """Each vector's doubles as bytes; null for one that links with nothing."""
    out = []
    for v in vectors:
        values = v.values if v.is_valid else None
        if values is None or not len(values) or values.null_count:
            out.append(None)
            continue
        x = values.to_numpy(zero_copy_only=False).astype(np.float64)
        # Adding zero makes the two zeros one.
        out.append((x + 0.0).tobytes() if np.isfinite(x).all() and x.any() else None)
    return out


def _unit(vectors: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def table_keys(unit: np.ndarray, labels: np.ndarray, k: int, tables: int, step: float) -> np.ndarray:
    """Key of each vector in each table; vectors of another label or size have others."""
    size = unit.shape[1]
    random = np.random.default_rng([SEED, size])
    keys = np.empty((len(unit), tables), np.uint64)
    for t in range(tables):
        cells = np.floor((unit @ random.standard_normal((size, k)) + random.uniform(0, step, k)) / step).astype(np.int64)
        key = _mix(labels.astype(np.int64).view(np.uint64) + np.uint64(t * 1_000_003 + size))
        for j in range(k):
            key = _mix(key * np.uint64(31) + cells[:, j].view(np.uint64))
        keys[:, t] = key
    return keys


def _hashed(classes: DataFrame, k: int, tables: int, step: float) -> DataFrame:
    """``node, copies, vector, keys`` for each class of equal vectors."""
    schema = "node long, copies long, vector binary, keys array<long>"
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                vectors, labels = column(part, "vector").to_pylist(), column(part, "label").to_numpy()
                keys = np.empty((len(vectors), tables), np.uint64)
                sizes = np.array([len(v) for v in vectors])
                for size in np.unique(sizes):
                    mine = np.flatnonzero(sizes == size)
                    keys[mine] = table_keys(_unit([vectors[i] for i in mine]), labels[mine], k, tables, step)
                yield record({"node": column(part, "node"), "copies": column(part, "copies"), "vector": column(part, "vector"),
                              "keys": pa.array(list(keys.view(np.int64)), pa.list_(pa.int64()))}, out)

    return classes.select("node", "copies", "label", "vector").mapInArrow(run, schema)


def _compare(table: int, side: np.ndarray, nodes, copies, vectors, keys, min_cosine: float):
    """Links counted in this bucket: their numbers by member, and enough to connect them."""
    unit = _unit(vectors)
    left = np.flatnonzero(side != 1)
    right = np.flatnonzero(side != 0)
    near = unit[left] @ unit[right].T >= min_cosine
    near &= nodes[left][:, None] != nodes[right][None, :]
    for t in range(table):  # met before
        near &= keys[left, t][:, None] != keys[right, t][None, :]
    links = np.zeros(len(nodes), np.int64)
    links[left] += near @ copies[right]
    if (side != 2).any():
        links[right] += near.T @ copies[left]
    full = np.zeros((len(nodes), len(nodes)), bool)
    full[np.ix_(left, right)] = near
    full |= full.T
    todo, edges = links > 0, []
    for root in np.flatnonzero(todo).tolist():
        if not todo[root]:
            continue
        todo[root], stack = False, [root]
        while stack:
            at = stack.pop()
            for to in np.flatnonzero(full[at] & todo).tolist():
                todo[to] = False
                stack.append(to)
                edges.append((int(nodes[at]), int(nodes[to])))
    return [(int(nodes[i]), None, int(links[i])) for i in np.flatnonzero(links)] + [(a, b, 0) for a, b in edges]


def _links(hashed: DataFrame, min_cosine: float, block: int) -> DataFrame:
    """``node, other, links``: counts (``other`` null) and connecting links of all buckets."""
    meet = hashed.select("node", F.posexplode("keys").alias("t", "key"))
    sizes = staged(meet.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "vector-buckets")
    blocks = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.hash("node"), blocks)
    # Each member goes to the comparisons of its block with every block of the bucket.
    placed = meet.join(sizes, ["t", "key"]).select(
        "node", "t", "key", mine.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("with"),
    ).select("node", "t", "key", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"),
             F.when(F.col("own") == F.col("with"), 2).when(F.col("own") < F.col("with"), 0).otherwise(1).alias("side"))
    # The comparison of a block with itself serves i = j alone.
    full = placed.join(hashed, "node")
    ordered = full.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")
    schema = "node long, other long, links long"
    out = to_arrow_schema(StructType.fromDDL(schema))
    names = ("t", "key", "i", "j", "side", "node", "copies", "vector", "keys")

    def run(batches):
        held: list[tuple] = []

        def done(rows):
            if len(rows) < 2:
                return []
            side, nodes, copies = (np.array([r[c] for r in rows], np.int64) for c in (4, 5, 6))
            return _compare(rows[0][0], side, nodes, copies, [r[7] for r in rows], np.array([r[8] for r in rows]), min_cosine)

        found = []
        for batch in batches:
            for row in zip(*(column(batch, c).to_pylist() for c in names)):
                if held and held[0][:4] != row[:4]:
                    found += done(held)
                    held = []
                held.append(row)
            if found:
                yield record({c: [x[i] for x in found] for i, c in enumerate(("node", "other", "links"))}, out)
                found = []
        found = done(held)
        yield record({c: [x[i] for x in found] for i, c in enumerate(("node", "other", "links"))}, out)

    return ordered.select(*names).mapInArrow(run, schema)


def near_vectors(rows: DataFrame, min_cosine: float = MIN_COSINE, step: float = STEP, miss: float = MISS, block: int = BLOCK) -> DataFrame:
    """Near-duplicate groups of ``rows`` (``vec_id, embedding, label``).

    Vectors link at a cosine of ``min_cosine`` or more, in double precision, if their
    labels are equal and not null and they have as many components. A label that is no
    whole number is compared by the 64-bit hash of its text. Null and zero vectors
    and those with null or non-finite components link with nothing. One row per row:
    ``vec_id, n_links`` (other rows linked directly, equal ones included), ``component_id``
    (smallest vec_id that links reach, itself included), ``kept`` (whether it is that one).
    """
    schema = "vec_id long, label long, vector binary"
    # Whole numbers stand for themselves, labels of any other type for their hash.
    label = F.col("label")
    whole = isinstance(rows.schema["label"].dataType, IntegralType)
    label = label.cast("long") if whole else F.when(label.isNotNull(), F.xxhash64(label.cast("string")))
    out = to_arrow_schema(StructType.fromDDL(schema))

    def clean(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                yield record({"vec_id": column(part, "vec_id"), "label": column(part, "label"), "vector": _clean(column(part, "embedding"))}, out)

    read = staged(rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), "embedding").mapInArrow(clean, schema)
                  .withColumn("node", F.when(F.col("label").isNotNull() & F.col("vector").isNotNull(), F.xxhash64("label", "vector"))), "vectors")
    sound = read.filter("node IS NOT NULL")
    classes = staged(sound.groupBy("node").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"),
                                               F.first("label").alias("label"), F.first("vector").alias("vector")), "vector-classes")
    k, tables = parameters(classes.count(), min_cosine, step, miss)
    hashed = staged(_hashed(classes, k, tables, step), "hashed-vectors")
    found = staged(_links(hashed, min_cosine, block), "vector-links")
    counts = found.filter("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = classes.select("node", "low", "copies").join(parts, "node", "left").join(counts, "node", "left").select(
        "node", "low", F.coalesce("component", "node").alias("component"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    least = named.groupBy("component").agg(F.min("low").alias("least"))
    known = named.join(least, "component").select("node", "links", "least")
    return sound.join(known, "node").select("vec_id", F.col("links").alias("n_links"), F.col("least").alias("component_id")).unionByName(
        read.filter("node IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
