"""Dashboard, operational metrics and quality of the stored tables.

Every figure is a global or per-source aggregate with map-side partial aggregation.
Counts of rows per source never fan out orders: rows are counted per order first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decreta.operators.ordering import latest_per_key
from decreta.operators.relational import within_last
from decreta.session import broadcast_checked


def _status(name: str) -> Column:
    return F.col("status") == name


# --- dashboard ------------------------------------------------------------------------
def source_counts(sources: DataFrame) -> DataFrame:
    risk = lambda r: F.count_if(F.col("risk_class") == r)
    return sources.agg(
        F.count(F.lit(1)).alias("total"), F.count_if("active").alias("active"),
        risk("green").alias("green"), risk("amber").alias("amber"), risk("red").alias("red"),
    )


def order_counts(orders: DataFrame, as_of: Column) -> DataFrame:
    named = ["new", "downloaded", "extracted", "approved", "failed"]
    return orders.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(_status(s)).alias(s) for s in named],
        F.count_if(within_last("created_at", as_of, "24 HOURS")).alias("last_24h"),
        F.count_if(within_last("created_at", as_of, "7 DAYS")).alias("last_7d"),
    )


def distinct_totals(assignments: DataFrame, approximate: bool = False) -> DataFrame:
    """Rows, distinct sports and distinct people; sketches when ``approximate``."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    return assignments.agg(
        F.count(F.lit(1)).alias("total"), distinct("sport").alias("sports_count"),
        distinct("fio_normalized").alias("unique_people"),
    )


def last_errors(log: DataFrame, n: int = 5) -> DataFrame:
    return log.filter(F.col("level") == "error").orderBy(F.col("created_at").desc(), F.col("id").desc()).limit(n)


def dashboard(sources: DataFrame, orders: DataFrame, assignments: DataFrame, log: DataFrame,
              as_of: Column) -> dict[str, DataFrame]:
    return {
        "sources": source_counts(sources), "orders": order_counts(orders, as_of),
        "assignments": distinct_totals(assignments), "recent_errors": last_errors(log),
    }


# --- per source --------------------------------------------------------------------------
def rows_per_order(assignments: DataFrame) -> DataFrame:
    return assignments.groupBy("order_id").agg(F.count(F.lit(1)).alias("record_count"))


def source_stats(sources: DataFrame, orders: DataFrame, assignments: DataFrame) -> DataFrame:
    """Per source: orders by status, assignment rows, newest order date.

    Orders are unique by id, so distinct counts over the joined rows become plain
    counts over orders; sources without orders keep zero counts.
    """
    counted = orders.select("id", "source_id", "status", "order_date").join(
        rows_per_order(assignments).withColumnRenamed("order_id", "id"), "id", "left"
    )
    per_source = counted.groupBy("source_id").agg(
        F.count_if(_status("extracted")).alias("orders_ok"),
        F.count_if(_status("new")).alias("orders_pending"),
        F.count_if(_status("failed")).alias("orders_failed"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_assignments"),
        F.max("order_date").alias("last_order_date"),
    )
    filled = ["orders_ok", "orders_pending", "orders_failed", "total_assignments"]
    return sources.select(F.col("id").alias("source_id"), "code", "name", "region", "risk_class", "active").join(
        per_source, "source_id", "left"
    ).na.fill(0, filled)


def source_summary(sources: DataFrame, orders: DataFrame, assignments: DataFrame) -> DataFrame:
    """Per source over extracted orders only: orders, rows, newest date; largest first."""
    done = orders.filter(_status("extracted"))
    stats = source_stats(sources, done, assignments)
    return stats.select(
        "code", "name", "region", F.col("orders_ok").alias("orders_count"),
        F.col("total_assignments").alias("assignments_count"), "last_order_date",
    ).orderBy(F.col("assignments_count").desc_nulls_first(), "code")


def failure_rate(sources: DataFrame, orders: DataFrame, as_of: Column, span: str = "7 DAYS") -> DataFrame:
    """Failure percentage of each active source over a recent span, worst first.

    A source without orders in the span shows one empty row's rate: 0 failed of 1.
    """
    recent = orders.filter(within_last("created_at", as_of, span)).groupBy("source_id").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(_status("extracted")).alias("ok"),
        F.count_if(_status("failed")).alias("failed"),
    )
    active = sources.filter("active").select(F.col("id").alias("source_id"), "code", "name", "risk_class")
    joined = active.join(recent, "source_id", "left").na.fill(0, ["ok", "failed"]).na.fill(1, ["_n"])
    return joined.select(
        "code", "name", "risk_class", "ok", "failed",
        F.round(F.lit(100.0) * F.col("failed") / F.col("_n"), 1).alias("fail_pct"),
    ).orderBy(F.col("fail_pct").desc_nulls_first(), "code")


def source_quality(orders: DataFrame, assignments: DataFrame, log: DataFrame | None = None) -> DataFrame:
    """Quality figures per source over its orders.

    Coverage and scan rate are shares of orders, completeness shares of rows, link rot
    the share of orders whose download failed according to the log.
    """
    share = lambda cond: F.avg(cond.cast("double"))
    done = F.col("status").isin("extracted", "approved")
    filled = {f: F.count_if(F.col(f).isNotNull() & (F.col(f).cast("string") != ""))
              for f in ("fio", "sport", "birth_date", "rank_category")}
    per_order = assignments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("confidence").alias("_conf"), F.count("confidence").alias("_nconf"),
        *[c.alias("_has_" + f) for f, c in filled.items()],
    ).withColumnRenamed("order_id", "id")
    base = orders.select("id", "source_id", "status", "ocr_method").join(per_order, "id", "left")
    if log is not None:
        rotten = log.filter((F.col("level") == "error") & (F.col("stage") == "download")).select(
            F.col("order_id").alias("id")).distinct().withColumn("_rot", F.lit(1.0))
        base = base.join(rotten, "id", "left").na.fill(0.0, ["_rot"])
    else:
        base = base.withColumn("_rot", F.lit(0.0))
    rows = F.coalesce("_rows", F.lit(0))
    total = F.sum("_rows")
    completeness = [x for f in filled for x in (F.lit(f), F.sum("_has_" + f) / total)]
    return base.groupBy("source_id").agg(
        share(done).alias("coverage"),
        share(F.coalesce(F.col("ocr_method") == "tesseract", F.lit(False))).alias("ocr_rate"),
        F.create_map(*completeness).alias("field_completeness"),
        F.avg(rows).alias("avg_row_yield"), F.min(rows).cast("int").alias("min_row_yield"),
        F.max(rows).cast("int").alias("max_row_yield"), F.avg("_rot").alias("link_rot_rate"),
        (F.sum("_conf") / F.sum("_nconf")).alias("avg_confidence"),
        F.count(F.lit(1)).cast("int").alias("sample_size"),
    )


def latest_quality(quality: DataFrame, sources: DataFrame) -> DataFrame:
    """Newest quality row of each source, with its code and name."""
    src = sources.select(F.col("id").alias("source_id"), F.col("code").alias("source_code"),
                         F.col("name").alias("source_name"))
    newest = latest_per_key(quality, ["source_id"], "measured_at", F.col("id"))
    return newest.join(broadcast_checked(src), "source_id")


# --- operational -----------------------------------------------------------------------
def daily_throughput(orders: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Per day of extraction: orders, pages, mean pages, mean confidence; the ``days``
    newest days, newest first (a span of days from noon to noon touches one more)."""
    return (
        orders.filter(within_last("extracted_at", as_of, f"{days} DAYS"))
        .groupBy(F.to_date("extracted_at").alias("dt"))
        .agg(
            F.count(F.lit(1)).alias("orders_processed"), F.sum("page_count").alias("pages_total"),
            F.avg("page_count").alias("avg_pages"), F.avg("ocr_confidence").alias("avg_confidence"),
        )
        .orderBy(F.col("dt").desc()).limit(days)
    )


def backlog(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count_if(_status("new")).alias("queue_new"),
        F.count_if(_status("downloaded")).alias("queue_downloaded"),
        F.count_if(_status("failed")).alias("queue_failed"),
        F.count_if(_status("extracted")).alias("pending_review"),
        F.count_if(_status("approved")).alias("approved_total"),
        F.min(F.when(_status("new"), F.col("created_at"))).alias("oldest_new"),
    )


def text_quality(orders: DataFrame, as_of: Column, span: str = "7 DAYS") -> DataFrame:
    method = lambda m: F.count_if(F.col("ocr_method") == m)
    return orders.filter(within_last("extracted_at", as_of, span)).agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("page_count").alias("total_pages"),
        F.avg("ocr_confidence").alias("avg_confidence"), F.min("ocr_confidence").alias("min_confidence"),
        F.count_if(F.col("ocr_confidence") < 0.6).alias("low_confidence_count"),
        method("tesseract").alias("tesseract_count"), method("pypdf").alias("pypdf_count"),
    )


def assignment_stats(assignments: DataFrame, as_of: Column, span: str = "30 DAYS") -> DataFrame:
    kind = lambda t: F.count_if(F.col("assignment_type") == t)
    act = lambda a: F.count_if(F.col("action") == a)
    return assignments.filter(within_last("created_at", as_of, span)).agg(
        F.count(F.lit(1)).alias("total"), F.count_distinct("sport").alias("unique_sports"),
        F.count_distinct("fio_normalized").alias("unique_persons"),
        kind("sport_rank").alias("ranks"), kind("judge_category").alias("judges"),
        act("assignment").alias("assignments"), act("confirmation").alias("confirmations"),
        act("refusal").alias("refusals"), F.avg("confidence").alias("avg_extraction_confidence"),
    )


def export_readiness(orders: DataFrame, sources: DataFrame) -> DataFrame:
    src = sources.select(F.col("id").alias("source_id"), "inn")
    return orders.filter(_status("approved")).join(broadcast_checked(src), "source_id").agg(
        F.count(F.lit(1)).alias("ready"), F.count_if(F.col("inn").isNotNull()).alias("with_inn"),
        F.count_if(F.col("signed_by").isNotNull()).alias("with_signer"),
    )


def operational_metrics(sources: DataFrame, orders: DataFrame, assignments: DataFrame,
                        as_of: Column) -> dict[str, DataFrame]:
    return {
        "throughput": daily_throughput(orders, as_of), "backlog": backlog(orders),
        "error_rates": failure_rate(sources, orders, as_of), "ocr": text_quality(orders, as_of),
        "assignments": assignment_stats(assignments, as_of),
        "exchange_readiness": export_readiness(orders, sources),
    }


def kpi(orders: DataFrame, assignments: DataFrame) -> DataFrame:
    """Headline figures: approved rows, pages, mean confidence, failure and text-layer shares."""
    counted = orders.select("id", "status", "page_count", "ocr_confidence", "ocr_method").join(
        rows_per_order(assignments).withColumnRenamed("order_id", "id"), "id", "left")
    conf = F.when(F.col("ocr_confidence") != 0, F.col("ocr_confidence"))
    method = F.when(F.coalesce("ocr_method", F.lit("")) != "", (F.col("ocr_method") == "pypdf").cast("double"))
    return counted.agg(
        F.coalesce(F.sum(F.when(_status("approved"), F.col("record_count"))), F.lit(0)).alias("records"),
        F.coalesce(F.sum("page_count"), F.lit(0)).alias("pages"),
        F.round(F.coalesce(F.avg(conf), F.lit(0.0)) * 100, 1).alias("confidence_pct"),
        F.round(F.coalesce(F.avg(_status("failed").cast("double")), F.lit(0.0)) * 100, 1).alias("fail_pct"),
        F.round(F.coalesce(F.avg(method), F.lit(0.0)) * 100, 0).alias("text_layer_pct"),
    )


def kpi_by_source(sources: DataFrame, orders: DataFrame, assignments: DataFrame) -> DataFrame:
    """Orders, failures, failure share and rows of each source, worst first."""
    counted = orders.select("id", "source_id", "status").join(
        rows_per_order(assignments).withColumnRenamed("order_id", "id"), "id", "left")
    per = counted.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(_status("failed")).alias("failed"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("records"))
    return sources.select(F.col("id").alias("source_id"), "code", "risk_class").join(per, "source_id", "left").na.fill(
        0, ["total", "failed", "records"]).select(
        "code", "risk_class", "total", "failed",
        F.when(F.col("total") > 0, F.col("failed") / F.col("total")).otherwise(0.0).alias("fail_share"), "records",
    ).orderBy(F.col("fail_share").desc(), "code")


def run_metrics(steps: DataFrame) -> DataFrame:
    """Per order over its step rows: records, matches, duration, failed steps."""
    detail = lambda k: F.try_element_at("details", F.lit(k)).try_cast("bigint")
    return steps.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("steps"), F.count_if(F.col("level") == "error").alias("failed_steps"),
        F.max(detail("records")).alias("records"), F.sum(detail("matched")).alias("matched"),
        F.sum(detail("unmatched")).alias("unmatched"), F.sum(detail("duration_ms")).alias("duration_ms"),
    )
