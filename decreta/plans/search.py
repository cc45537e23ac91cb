"""Search, listings and details over the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from decreta.operators.ordering import page_of_results
from decreta.operators.relational import assignments_full, contains_text, log_enriched, where_all
from decreta.session import broadcast_checked


def search_assignments(assignments: DataFrame, orders: DataFrame, sources: DataFrame, q: str | None = None,
                       sport: str | None = None, source: str | None = None, limit: int = 50,
                       offset: int = 0) -> DataFrame:
    """Assignment rows by person or sport text and source, newest first.

    Text filters touch the rows before any join.
    """
    rows = where_all(
        assignments,
        (contains_text("fio", q) | contains_text("fio_normalized", q)) if q else None,
        contains_text("sport", sport) if sport else None,
    )
    full = assignments_full(rows, orders, sources)
    full = where_all(full, F.col("source_code") == source if source else None)
    return page_of_results(full, [F.col("created_at").desc_nulls_first(), F.col("id")], limit, offset)


def list_orders(orders: DataFrame, sources: DataFrame, assignments: DataFrame, status: str | None = None,
                source: str | None = None, search: str | None = None, limit: int = 50,
                offset: int = 0) -> DataFrame:
    """Orders with their row counts, newest first.

    The page is cut before rows are counted, so only its orders' rows are read into
    the aggregate.
    """
    src = sources.select(F.col("id").alias("source_id"), F.col("code").alias("source_code"),
                         F.col("name").alias("source_name"))
    picked = where_all(
        orders.join(broadcast_checked(src), "source_id"),
        F.col("status") == status if status else None,
        F.col("source_code") == source if source else None,
        (contains_text("order_number", search) | contains_text("title", search)) if search else None,
    )
    page = page_of_results(picked, [F.col("created_at").desc_nulls_first(), F.col("id")], limit, offset)
    ids = page.select(F.col("id").alias("order_id"))
    counts = assignments.select("order_id").join(F.broadcast(ids), "order_id", "left_semi").groupBy(
        F.col("order_id").alias("id")).agg(F.count(F.lit(1)).alias("record_count"))
    return page.join(counts, "id", "left").na.fill(0, ["record_count"])


def order_detail(order_id, orders: DataFrame, sources: DataFrame, assignments: DataFrame,
                 log: DataFrame) -> dict[str, DataFrame]:
    """One order with its rows and its log, each in time order."""
    src = sources.select(F.col("id").alias("source_id"), F.col("code").alias("source_code"),
                         F.col("name").alias("source_name"))
    return {
        "order": orders.filter(F.col("id") == order_id).join(broadcast_checked(src), "source_id"),
        "assignments": assignments.filter(F.col("order_id") == order_id).orderBy("created_at", "row_no"),
        "logs": log.filter(F.col("order_id") == order_id).orderBy("created_at", "id"),
    }


def search_log(log: DataFrame, sources: DataFrame, orders: DataFrame, source: str | None = None,
               level: str | None = None, stage: str | None = None, limit: int = 100) -> DataFrame:
    """Log entries with source and order, newest first."""
    rows = where_all(log, F.col("level") == level if level else None, F.col("stage") == stage if stage else None)
    full = where_all(log_enriched(rows, sources, orders), F.col("source_code") == source if source else None)
    return page_of_results(full, [F.col("created_at").desc_nulls_first(), F.col("id")], limit, 0, 500)
