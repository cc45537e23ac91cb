"""Table changes as pure functions: old snapshot and changes in, new snapshot out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decreta import constants as K
from decreta.operators.ordering import keep_first


def natural_id(*parts: Column | str) -> Column:
    """Deterministic row id from the natural key, so re-runs are idempotent."""
    cols = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("\x1f", *cols), 256)


def insert_absent(table: DataFrame, incoming: DataFrame, keys: Sequence[str],
                  order: Sequence[Column]) -> DataFrame:
    """Append incoming rows whose key is not stored; of equal keys the first one wins."""
    fresh = keep_first(incoming, keys, order).join(table.select(*keys), list(keys), "left_anti")
    return table.unionByName(fresh.select(table.columns))


def partial_update(table: DataFrame, updates: DataFrame, key: str, columns: Sequence[str],
                   order: Sequence[Column] = (), stamps: dict[str, Column] | None = None) -> DataFrame:
    """Overwrite only the supplied (non-null) fields of the keyed rows.

    ``stamps`` are expressions over the updated row, applied to touched rows only.
    Several updates of one key: the first in ``order`` wins, of equal ones (or without an
    order) the one with the largest values, so that no row is ever doubled.
    """
    ties = [F.col(c).desc_nulls_last() for c in columns]
    ups = keep_first(updates, [key], [*order, *ties])
    ups = ups.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_touched"))
    joined = table.join(ups, key, "left")
    fields = {c: F.coalesce(f"_new_{c}", c) for c in columns}
    out = joined.withColumns(fields)
    for name, value in (stamps or {}).items():
        out = out.withColumn(name, F.when(F.col("_touched"), value).otherwise(F.col(name)))
    return out.select(table.columns)


def update_orders(orders: DataFrame, updates: DataFrame, as_of: Column) -> DataFrame:
    """Status and metadata of orders; ``extracted`` stamps the extraction time."""
    fields = ["status", "file_hash", "ocr_method", "ocr_confidence", "page_count", "error_message"]
    present = [f for f in fields if f in updates.columns]
    stamp = {"extracted_at": F.when(F.col("_new_status") == "extracted", as_of)
             .otherwise(F.col("extracted_at"))}
    return partial_update(orders, updates, "id", present, stamps=stamp)


def replace_rows(table: DataFrame, incoming: DataFrame, key: str,
                 touched: DataFrame | None = None) -> DataFrame:
    """Drop all rows of the touched keys and put the incoming ones in their place."""
    keys = (touched if touched is not None else incoming).select(key).distinct()
    return table.join(keys, key, "left_anti").select(table.columns).unionByName(
        incoming.select(table.columns)
    )


def upsert(table: DataFrame, incoming: DataFrame, keys: Sequence[str], update: Sequence[str],
           order: Sequence[Column]) -> DataFrame:
    """Insert new keys, overwrite ``update`` columns of stored ones; one shuffle."""
    ups = keep_first(incoming, keys, order)
    rest = [c for c in table.columns if c not in keys]
    old = table.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in rest], F.lit(True).alias("_stored"))
    new = ups.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in rest], F.lit(True).alias("_given"))
    joined = old.join(new, list(keys), "full_outer")

    def value(c: str) -> Column:
        if c in update:
            return F.when(F.col("_given"), F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}"))
        return F.when(F.col("_stored"), F.col(f"_old_{c}")).otherwise(F.col(f"_new_{c}"))

    return joined.select(*[F.col(c) if c in keys else value(c).alias(c) for c in table.columns])


def scd2_import(current: DataFrame, incoming: DataFrame, key: str, value: str,
                effective: Column) -> DataFrame:
    """Import a registry version into a validity history.

    ``current`` has ``key, value, valid_from, valid_to``; ``incoming`` one row per key.
    A changed value closes the open row at ``effective`` and opens a new one; a key
    that is gone keeps its history and is closed; an unchanged key is left alone.
    """
    open_rows = current.filter(F.col("valid_to").isNull())
    closed = current.filter(F.col("valid_to").isNotNull())
    new = incoming.select(key, F.col(value).alias("_new"), F.lit(True).alias("_given"))
    both = open_rows.withColumn("_open", F.lit(True)).join(new, key, "full_outer")
    same = F.coalesce(F.col("_open") & F.col("_given"), F.lit(False)) & F.col(value).eqNullSafe(F.col("_new"))
    day = effective.cast("date")
    old_row = F.when(
        F.col("_open"),
        F.struct(F.col(value).alias(value), F.col("valid_from").alias("valid_from"),
                 F.when(~same, day).cast("date").alias("valid_to")),
    )
    new_row = F.when(
        F.col("_given") & ~same,
        F.struct(F.col("_new").alias(value), day.alias("valid_from"),
                 F.lit(None).cast("date").alias("valid_to")),
    )
    rows = both.select(
        key, F.explode(F.array_compact(F.array(old_row, new_row))).alias("_row")
    ).select(key, "_row.*")
    cols = [key, value, "valid_from", "valid_to"]
    return closed.select(cols).unionByName(rows.select(cols))


# --- guarded transitions ------------------------------------------------------------
def approve(orders: DataFrame, ids: DataFrame) -> DataFrame:
    """Approve the named orders; only extracted ones move."""
    named = ids.select("id").distinct().withColumn("_named", F.lit(True))
    ok = F.col("_named") & (F.col("status") == "extracted")
    return orders.join(named, "id", "left").withColumn(
        "status", F.when(ok, F.lit("approved")).otherwise(F.col("status"))
    ).select(orders.columns)


def reject(orders: DataFrame, reasons: DataFrame) -> DataFrame:
    """Reject the named orders with a reason."""
    named = reasons.select(
        "id", F.coalesce("reason", F.lit("Rejected by admin")).alias("error_message"),
        F.lit("rejected").alias("status"),
    )
    return partial_update(orders, named, "id", ["status", "error_message"])


def requeue(orders: DataFrame, ids: DataFrame) -> DataFrame:
    """Put the named orders back into the queue and clear their error."""
    named = ids.select("id").distinct().withColumn("_named", F.lit(True))
    again = F.coalesce(F.col("_named"), F.lit(False))
    return orders.join(named, "id", "left").withColumns({
        "status": F.when(again, F.lit("new")).otherwise(F.col("status")),
        "error_message": F.when(~again, F.col("error_message")),
    }).select(orders.columns)


def create_source(sources: DataFrame, incoming: DataFrame) -> DataFrame:
    return insert_absent(sources, incoming, ["code"], [F.col("name")])


def update_source(sources: DataFrame, updates: DataFrame, columns: Sequence[str],
                  as_of: Column) -> DataFrame:
    """Full update or toggle of sources, with the modification stamp."""
    return partial_update(sources, updates, "code", columns, stamps={"updated_at": as_of})


def delete_unused(sources: DataFrame, codes: DataFrame, orders: DataFrame) -> DataFrame:
    """Delete the named sources, except those that have orders."""
    used = orders.select(F.col("source_id").alias("id")).distinct()
    free = sources.join(codes.select("code").distinct(), "code", "left_semi").join(used, "id", "left_anti")
    return sources.join(free.select("code"), "code", "left_anti")


def note_check(sources: DataFrame, checks: DataFrame, as_of: Column) -> DataFrame:
    """Page hash, etag and time of a source check; a missing value keeps the old one."""
    ups = checks.select(
        "code", F.col("page_hash").alias("last_page_hash"), F.col("etag").alias("last_etag")
    )
    return partial_update(sources, ups, "code", ["last_page_hash", "last_etag"],
                          stamps={"last_checked_at": as_of})
