"""First-of-key, latest-of-key and neighbour operators that survive hot keys.

``row_number() <= k`` is planned by Spark with a window-group limit on both sides of
the shuffle, so a key holding a third of all rows sends at most ``k`` rows per map
task. Running values (forward fill, previous value) are split into bounded chunks of
the order and carried over chunk borders by a small second pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows of each key in ``order``, numbered from 1."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Distinct rows by ``keys`` keeping the first occurrence in ``order``."""
    return top_per_key(df, keys, order, 1, "_first").drop("_first")


def latest_per_key(df: DataFrame, keys: Sequence[str], at: str, *tie: Column) -> DataFrame:
    """Newest row of each key."""
    return keep_first(df, keys, [F.col(at).desc_nulls_last(), *tie])


def running_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column,
                  value: Column, out: str, include_current: bool = True,
                  descending: bool = False) -> DataFrame:
    """Last non-null ``value`` seen so far within each key, in ``order``.

    ``chunk`` must grow with ``order`` (a month of a timestamp, a position divided by
    a constant): the window runs per key and chunk, so a hot key is spread over many
    tasks, and the value at each chunk's end is carried into the later chunks through
    one small row per key and chunk.
    """
    asc = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    rows = df.withColumns({"_chunk": chunk, "_value": value})
    ordered = [asc(c) for c in order]
    inner = Window.partitionBy(*keys, "_chunk").orderBy(*ordered)
    frame = inner.rowsBetween(
        Window.unboundedPreceding, Window.currentRow if include_current else -1
    )
    here = rows.withColumn("_here", F.last("_value", ignorenulls=True).over(frame))
    position = F.struct(*order)
    filled = F.when(F.col("_value").isNotNull(), position)
    pick = F.min_by if descending else F.max_by
    ends = rows.groupBy(*keys, "_chunk").agg(pick("_value", filled).alias("_end"))
    outer = (
        Window.partitionBy(*keys).orderBy(asc("_chunk"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        ends.withColumn("_carried", F.last("_end", ignorenulls=True).over(outer))
        .filter(F.col("_carried").isNotNull())
        .drop("_end")
    )
    # Null keys and chunks are groups of the windows, so they must meet here too.
    names = [*keys, "_chunk"]
    carried = carried.select(*[F.col(c).alias(f"_at_{c}") for c in names], "_carried")
    same = [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in names]
    return (
        here.join(carried, same, "left")
        .withColumn(out, F.coalesce("_here", "_carried"))
        .drop("_chunk", "_value", "_here", "_carried", *[f"_at_{c}" for c in names])
    )


def forward_fill(df: DataFrame, keys: Sequence[str], position: str, value: Column, out: str,
                 chunk_rows: int = 100_000) -> DataFrame:
    """A heading's value applies to the rows below it, up to the next heading."""
    chunk = F.floor(F.col(position) / chunk_rows)
    return running_value(df, keys, [position], chunk, value, out)


def fill_repeat_marks(df: DataFrame, keys: Sequence[str], position: str, column: str,
                      mark: str, chunk_rows: int = 100_000) -> DataFrame:
    """Replace repeat marks by the value of the nearest row above that has one."""
    c = F.col(column)
    value = F.when(~c.rlike(mark), c)
    filled = forward_fill(df, keys, position, value, "_filled", chunk_rows)
    return filled.withColumn(
        column, F.when(c.rlike(mark), F.coalesce(F.col("_filled"), c)).otherwise(c)
    ).drop("_filled")


def change_status(snapshots: DataFrame, key: str, at: str, fingerprint: str,
                  chunk: str = "hour") -> DataFrame:
    """``first``, ``unchanged`` or ``changed`` of each snapshot against the last known one.

    ``chunk`` is the time unit a page's snapshots are split by, so that a page polled
    far more often than the rest is still spread over tasks.
    """
    span = F.date_trunc(chunk, F.col(at))
    seen = running_value(snapshots, [key], [at], span, F.col(fingerprint), "previous",
                         include_current=False)
    return seen.withColumn(
        "change",
        F.when(F.col("previous").isNull(), "first")
        .when(F.col("previous") == F.col(fingerprint), "unchanged")
        .otherwise("changed"),
    )


def close_intervals(names: DataFrame, key: str, valid_from: str = "valid_from",
                    valid_to: str = "valid_to") -> DataFrame:
    """Rename history: an interval ends where the next name of the key starts."""
    # An open start sorts before every date, so it gets the earliest chunk.
    year = F.coalesce(F.year(valid_from), F.lit(0))
    nxt = running_value(names, [key], [valid_from], year, F.col(valid_from), valid_to,
                        include_current=False, descending=True)
    return nxt


def page_of_results(df: DataFrame, order: Sequence[Column], limit: int, offset: int = 0,
                    max_limit: int = 200) -> DataFrame:
    """One page of an ordered result; the page size is bounded."""
    if not 0 < limit <= max_limit:
        raise ValueError(f"limit must be between 1 and {max_limit}")
    return df.orderBy(*order).offset(offset).limit(limit)
