"""Queries over the stored model: joins, filters, checks, aggregates, pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from decreta.operators import relational as R
from decreta.operators.ordering import latest_per_key, page_of_results
from decreta.plans import metrics as M
from decreta.plans import orders as P
from decreta.plans import search as S_
from decreta.plans.exchange import exchange, to_json_rows
from decreta.queries import model as m
from decreta.queries.model import A, AS_OF, L, LOG_AS_OF, O, S, with_sql

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


_AS_OF, _LOG_AS_OF = f"TIMESTAMP '{AS_OF}'", f"TIMESTAMP '{LOG_AS_OF}'"
_PER_ORDER = "per_order AS (SELECT order_id, COUNT(*) AS n FROM asg GROUP BY order_id)"


# --- joins -----------------------------------------------------------------------------
@query("source_stats", with_sql(S, O, A, then="""
SELECT s.code, s.region,
  COUNT(DISTINCT o.id) FILTER (WHERE o.status = 'extracted') AS orders_ok,
  COUNT(DISTINCT o.id) FILTER (WHERE o.status = 'new') AS orders_pending,
  COUNT(DISTINCT o.id) FILTER (WHERE o.status = 'failed') AS orders_failed,
  COUNT(a.id) AS total_assignments, MAX(o.order_date) AS last_order_date
FROM src s LEFT JOIN ord o ON o.source_id = s.id LEFT JOIN asg a ON a.order_id = o.id
GROUP BY s.id, s.code, s.region"""))
def source_stats(spark, d):
    return M.source_stats(m.sources(spark, d), m.orders(spark, d), m.assignments(spark, d)).select(
        "code", "region", "orders_ok", "orders_pending", "orders_failed", "total_assignments", "last_order_date")


@query("source_summary", with_sql(S, O, A, then="""
SELECT s.code, s.name, s.region, COUNT(DISTINCT o.id) AS orders_count, COUNT(a.id) AS assignments_count,
  MAX(o.order_date) AS last_order_date
FROM src s LEFT JOIN ord o ON o.source_id = s.id AND o.status = 'extracted' LEFT JOIN asg a ON a.order_id = o.id
GROUP BY s.id, s.code, s.name, s.region"""))
def source_summary(spark, d):
    return M.source_summary(m.sources(spark, d), m.orders(spark, d), m.assignments(spark, d))


@query("assignments_full", with_sql(S, O, A, then="""
SELECT a.id, a.fio, a.birth_date, a.assignment_type, a.rank_category, a.sport, a.action,
  o.order_number, o.order_date, o.order_type, s.name AS issuing_body, s.region, a.created_at
FROM asg a JOIN ord o ON a.order_id = o.id JOIN src s ON o.source_id = s.id"""))
def assignments_full(spark, d):
    full = R.assignments_full(m.assignments(spark, d), m.orders(spark, d), m.sources(spark, d))
    return full.select("id", "fio", "birth_date", "assignment_type", "rank_category", "sport", "action",
                       "order_number", "order_date", "order_type", "issuing_body", "region", "created_at")


@query("log_enriched", with_sql(S, O, L, then="""
SELECT l.id, l.level, l.stage, l.message, l.created_at, s.code AS source_code, o.order_number
FROM log l LEFT JOIN src s ON l.source_id = s.id LEFT JOIN ord o ON l.order_id = o.id"""))
def log_enriched(spark, d):
    return R.log_enriched(m.log(spark, d), m.sources(spark, d), m.orders(spark, d)).select(
        "id", "level", "stage", "message", "created_at", "source_code", "order_number")


@query("attachments_of_orders", with_sql(O, then="""
SELECT p.id, p.order_number, c.id AS attachment_id, c.file_url AS attachment_url
FROM ord p LEFT JOIN ord c ON c.parent_id = p.id WHERE p.parent_id IS NULL"""))
def attachments_of_orders(spark, d):
    orders = m.orders(spark, d).withColumn("attachment_num", F.lit(1))
    return R.with_attachments(orders).select("id", "order_number", "attachment_id", "attachment_url")


@query("stored_orders_lookup", with_sql(O, then="""
SELECT i.order_number, i.order_date, i.source_id,
  EXISTS (SELECT 1 FROM ord o WHERE o.source_id = i.source_id AND o.order_number = i.order_number
          AND o.order_date = i.order_date) AS stored
FROM (SELECT source_id, CASE WHEN id % 3 = 0 THEN 'X-' || id ELSE order_number END AS order_number, order_date FROM ord) i"""))
def stored_orders_lookup(spark, d):
    orders = m.orders(spark, d)
    incoming = orders.selectExpr(
        "source_id", "CASE WHEN id % 3 = 0 THEN concat('X-', id) ELSE order_number END AS order_number", "order_date")
    keys = ["source_id", "order_number", "order_date"]
    old = R.already_stored(incoming, orders, keys).withColumn("stored", F.lit(True))
    return old.unionByName(R.not_stored(incoming, orders, keys).withColumn("stored", F.lit(False)))


@query("issuing_details", with_sql(S, O, then="""
SELECT o.id, CASE WHEN s.id % 4 <> 0 THEN 'Body of ' || s.code ELSE s.code END AS issuing_body,
  CASE WHEN s.id % 4 <> 0 THEN 'распоряжение' ELSE 'приказ' END AS default_order_type
FROM ord o JOIN src s ON o.source_id = s.id"""))
def issuing_details(spark, d):
    src = m.sources(spark, d)
    described = src.filter("id % 4 <> 0").select("code", F.struct(
        F.concat(F.lit("Body of "), F.col("code")).alias("issuing_body"),
        F.lit("распоряжение").alias("order_type")).alias("meta"))
    coded = m.orders(spark, d).join(src.select(F.col("id").alias("source_id"), F.col("code").alias("source_code")), "source_id")
    return R.issuing_details(coded, described).select("id", "issuing_body", "default_order_type")


# --- filters and pages ---------------------------------------------------------------
@query("search_rows", with_sql(S, O, A, then="""
SELECT a.id, a.fio, a.sport, a.action, a.confidence, o.order_number, o.order_date, s.code AS source_code
FROM asg a JOIN ord o ON a.order_id = o.id JOIN src s ON o.source_id = s.id
WHERE (a.fio ILIKE '%fam12%' OR a.fio_normalized ILIKE '%fam12%') AND a.sport ILIKE '%SPORT 1%'
ORDER BY a.created_at DESC NULLS FIRST, a.id LIMIT 50 OFFSET 10"""))
def search_rows(spark, d):
    return S_.search_assignments(m.assignments(spark, d), m.orders(spark, d), m.sources(spark, d),
                                 q="fam12", sport="SPORT 1", limit=50, offset=10).select(
        "id", "fio", "sport", "action", "confidence", "order_number", "order_date", "source_code")


@query("order_page", with_sql(S, O, A, then="""
SELECT o.id, o.order_number, o.status, s.code AS source_code,
  (SELECT COUNT(*) FROM asg a WHERE a.order_id = o.id) AS record_count
FROM ord o JOIN src s ON o.source_id = s.id
WHERE o.status = 'extracted' AND (o.order_number ILIKE '%n-1%' OR o.title ILIKE '%n-1%')
ORDER BY o.created_at DESC NULLS FIRST, o.id LIMIT 100"""))
def order_page(spark, d):
    return S_.list_orders(m.orders(spark, d), m.sources(spark, d), m.assignments(spark, d),
                          status="extracted", search="n-1", limit=100).select(
        "id", "order_number", "status", "source_code", "record_count")


@query("log_page", with_sql(S, O, L, then="""
SELECT l.id, l.stage, l.message, s.code AS source_code, o.order_number
FROM log l LEFT JOIN src s ON l.source_id = s.id LEFT JOIN ord o ON l.order_id = o.id
WHERE l.level = 'error' ORDER BY l.created_at DESC NULLS FIRST, l.id LIMIT 100"""))
def log_page(spark, d):
    return S_.search_log(m.log(spark, d), m.sources(spark, d), m.orders(spark, d), level="error").select(
        "id", "stage", "message", "source_code", "order_number")


@query("orders_in_range", with_sql(O, then="""
SELECT id, order_number, order_date FROM ord WHERE order_date BETWEEN DATE '1997-03-01' AND DATE '1998-02-28'"""))
def orders_in_range(spark, d):
    return R.where_all(m.orders(spark, d), R.within_dates("order_date", "1997-03-01", "1998-02-28")).select(
        "id", "order_number", "order_date")


@query("recent_orders", with_sql(O, then=f"""
SELECT id, status, created_at > {_AS_OF} - INTERVAL 24 HOUR AS last_day, created_at > {_AS_OF} - INTERVAL 7 DAY AS last_week
FROM ord WHERE created_at > {_AS_OF} - INTERVAL 30 DAY"""))
def recent_orders(spark, d):
    at = m.moment(AS_OF)
    return m.orders(spark, d).filter(R.within_last("created_at", at, "30 DAYS")).select(
        "id", "status", R.within_last("created_at", at, "24 HOURS").alias("last_day"),
        R.within_last("created_at", at, "7 DAYS").alias("last_week"))


@query("checkable_sources", with_sql(S, then="SELECT id, code, risk_class FROM src WHERE active AND risk_class <> 'red'"))
def checkable_sources(spark, d):
    return R.checkable_sources(m.sources(spark, d)).select("id", "code", "risk_class")


@query("newest_orders_page", with_sql(O, then="""
SELECT id, order_number, created_at FROM ord ORDER BY created_at DESC NULLS FIRST, id LIMIT 50 OFFSET 100"""))
def newest_orders_page(spark, d):
    return page_of_results(m.orders(spark, d).select("id", "order_number", "created_at"),
                           [F.col("created_at").desc_nulls_first(), F.col("id")], 50, 100)


@query("last_errors", with_sql(L, then="""
SELECT id, source_id, stage, message, created_at FROM log WHERE level = 'error'
ORDER BY created_at DESC, id DESC LIMIT 5"""))
def last_errors(spark, d):
    return M.last_errors(m.log(spark, d)).select("id", "source_id", "stage", "message", "created_at")


@query("work_queue", with_sql(O, then="""
SELECT id, order_number, status FROM ord WHERE status IN ('new', 'downloaded') ORDER BY created_at, id LIMIT 50"""))
def work_queue(spark, d):
    return P.work_queue(m.orders(spark, d), 50).select("id", "order_number", "status")


# --- checks ----------------------------------------------------------------------------
_CATEGORIES = ["звание", "разряд", "юношеский_разряд", "иное"]
_MODEL_SQL = f"""sports AS (SELECT p_partkey AS id, CAST(p_partkey % 6 AS INTEGER) AS section FROM part WHERE p_partkey % 3 = 0),
ranks AS (SELECT p_partkey AS id, ({_CATEGORIES})[1 + p_size % 4] AS category FROM part),
names AS (SELECT p_partkey AS id, p_partkey - p_partkey % 3 AS sport_id, 'v' || p_size AS version FROM part),
versions AS (SELECT DISTINCT 'v' || p_size AS id FROM part WHERE p_size % 10 <> 0),
marked AS (SELECT id, order_id, CAST(replace(sport, 'sport ', '') AS BIGINT) AS sport_id, CASE WHEN row_no % 7 <> 0 THEN rank_category END AS rank_category FROM asg)"""


def _model(spark, d):
    """All tables that have rules or references, with some rows that break them."""
    part = m.table(spark, d, "part")
    names = part.selectExpr("p_partkey AS id", "p_partkey - p_partkey % 3 AS sport_id", "concat('v', p_size) AS source_version_id")
    rows = m.assignments(spark, d).withColumns({
        "sport_id": F.replace("sport", F.lit("sport "), F.lit("")).cast("bigint"), "rank_category": F.when(F.col("row_no") % 7 != 0, F.col("rank_category"))})
    supplier = m.table(spark, d, "supplier").selectExpr("s_suppkey AS id", "s_suppkey % 30 AS source_id", "s_suppkey * 3 AS order_id")
    return {
        "registry_sources": m.sources(spark, d), "orders": m.orders(spark, d), "assignments": rows, "processing_log": m.log(spark, d),
        "quality_metrics": m.table(spark, d, "customer").selectExpr("c_custkey AS id", "c_custkey % 30 AS source_id"), "golden_sets": supplier,
        "sports": part.filter("p_partkey % 3 = 0").selectExpr("p_partkey AS id", "CAST(p_partkey % 6 AS INT) AS section"),
        "rank_dictionary": part.select(F.col("p_partkey").alias("id"), F.element_at(F.array(*map(F.lit, _CATEGORIES)), (F.col("p_size") % 4 + 1).cast("int")).alias("category")),
        "sport_registry_versions": part.filter("p_size % 10 <> 0").selectExpr("concat('v', p_size) AS id").distinct(),
        "sport_names": names, "sport_disciplines": names.drop("source_version_id"),
    }


@query("rule_violations", with_sql(S, O, L, A, _MODEL_SQL, then="""
SELECT 'orders' AS tbl, CAST(id AS VARCHAR) AS id, 'order_type' AS rule FROM ord WHERE order_type NOT IN ('приказ', 'распоряжение')
UNION ALL SELECT 'orders', CAST(id AS VARCHAR), 'ocr_method' FROM ord WHERE ocr_method NOT IN ('pypdf', 'pdfminer', 'tesseract', 'vision')
UNION ALL SELECT 'registry_sources', CAST(id AS VARCHAR), 'source_type' FROM src WHERE source_type NOT IN ('pdf_portal', 'json_embed', 'html_table')
UNION ALL SELECT 'processing_log', CAST(id AS VARCHAR), 'level' FROM log WHERE level NOT IN ('info', 'warn', 'error')
UNION ALL SELECT 'assignments', id, 'rank_category' FROM marked WHERE rank_category IS NULL
UNION ALL SELECT 'sports', CAST(id AS VARCHAR), 'section' FROM sports WHERE section NOT IN (1, 2, 3, 4)
UNION ALL SELECT 'rank_dictionary', CAST(id AS VARCHAR), 'category' FROM ranks WHERE category = 'иное'"""))
def rule_violations(spark, d):
    return R.all_violations(_model(spark, d))


def _missing_sql(reference, rows, column, parent):
    return f"""SELECT '{reference}' AS reference, CAST(r.id AS VARCHAR) AS id, CAST(r.{column} AS VARCHAR) AS key FROM {rows} r
WHERE r.{column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.id = r.{column})"""


@query("orphan_check", with_sql(O, L, S, A, _MODEL_SQL, "quality AS (SELECT c_custkey AS id, c_custkey % 30 AS source_id FROM customer)",
                                "golden AS (SELECT s_suppkey AS id, s_suppkey % 30 AS source_id, s_suppkey * 3 AS order_id FROM supplier)", then="\nUNION ALL ".join([
    _missing_sql("orders.source_id", "ord", "source_id", "src"), _missing_sql("orders.parent_id", "ord", "parent_id", "ord"),
    _missing_sql("assignments.order_id", "marked", "order_id", "ord"), _missing_sql("assignments.sport_id", "marked", "sport_id", "sports"),
    _missing_sql("processing_log.order_id", "log", "order_id", "ord"), _missing_sql("processing_log.source_id", "log", "source_id", "src"),
    _missing_sql("quality_metrics.source_id", "quality", "source_id", "src"), _missing_sql("golden_sets.source_id", "golden", "source_id", "src"),
    _missing_sql("golden_sets.order_id", "golden", "order_id", "ord"), _missing_sql("sport_names.sport_id", "names", "sport_id", "sports"),
    _missing_sql("sport_names.source_version_id", "names", "version", "versions"), _missing_sql("sport_disciplines.sport_id", "names", "sport_id", "sports")])))
def orphan_check(spark, d):
    return R.all_orphans(_model(spark, d))


# --- aggregates --------------------------------------------------------------------------
@query("dashboard_counts", with_sql(S, O, then=f"""
SELECT (SELECT COUNT(*) FROM src) AS sources, (SELECT COUNT(*) FILTER (WHERE active) FROM src) AS active_sources,
  (SELECT COUNT(*) FILTER (WHERE risk_class = 'red') FROM src) AS red, COUNT(*) AS total,
  COUNT(*) FILTER (WHERE status = 'new') AS "new", COUNT(*) FILTER (WHERE status = 'downloaded') AS downloaded,
  COUNT(*) FILTER (WHERE status = 'extracted') AS extracted, COUNT(*) FILTER (WHERE status = 'approved') AS approved,
  COUNT(*) FILTER (WHERE status = 'failed') AS failed,
  COUNT(*) FILTER (WHERE created_at > {_AS_OF} - INTERVAL 24 HOUR) AS last_24h,
  COUNT(*) FILTER (WHERE created_at > {_AS_OF} - INTERVAL 7 DAY) AS last_7d FROM ord"""))
def dashboard_counts(spark, d):
    src = M.source_counts(m.sources(spark, d)).select(
        F.struct("total", "active", "red").alias("s")).scalar()
    counts = M.order_counts(m.orders(spark, d), m.moment(AS_OF)).withColumn("_s", src)
    return counts.select(F.col("_s.total").alias("sources"), F.col("_s.active").alias("active_sources"),
                         F.col("_s.red").alias("red"), "total", "new", "downloaded", "extracted", "approved",
                         "failed", "last_24h", "last_7d")


@query("distinct_totals", with_sql(A, then="""
SELECT COUNT(*) AS total, COUNT(DISTINCT sport) AS sports_count, COUNT(DISTINCT fio_normalized) AS unique_people FROM asg"""))
def distinct_totals(spark, d):
    return M.distinct_totals(m.assignments(spark, d))


@query("daily_throughput", with_sql(O, then=f"""
SELECT CAST(extracted_at AS DATE) AS dt, COUNT(*) AS orders_processed, CAST(SUM(page_count) AS BIGINT) AS pages_total,
  ROUND(AVG(page_count), 6) AS avg_pages, ROUND(AVG(ocr_confidence), 6) AS avg_confidence
FROM ord WHERE extracted_at > {_AS_OF} - INTERVAL 30 DAY GROUP BY 1 ORDER BY dt DESC LIMIT 30"""))
def daily_throughput(spark, d):
    return M.daily_throughput(m.orders(spark, d), m.moment(AS_OF)).withColumns({
        "avg_pages": F.round("avg_pages", 6), "avg_confidence": F.round("avg_confidence", 6)})


@query("backlog", with_sql(O, then="""
SELECT COUNT(*) FILTER (WHERE status = 'new') AS queue_new, COUNT(*) FILTER (WHERE status = 'downloaded') AS queue_downloaded,
  COUNT(*) FILTER (WHERE status = 'failed') AS queue_failed, COUNT(*) FILTER (WHERE status = 'extracted') AS pending_review,
  COUNT(*) FILTER (WHERE status = 'approved') AS approved_total, MIN(created_at) FILTER (WHERE status = 'new') AS oldest_new FROM ord"""))
def backlog(spark, d):
    return M.backlog(m.orders(spark, d))


@query("failure_rate", with_sql(S, O, then=f"""
SELECT s.code, s.name, s.risk_class, COUNT(*) FILTER (WHERE o.status = 'extracted') AS ok,
  COUNT(*) FILTER (WHERE o.status = 'failed') AS failed,
  ROUND(100.0 * COUNT(*) FILTER (WHERE o.status = 'failed') / COUNT(*), 1)::DOUBLE AS fail_pct
FROM src s LEFT JOIN ord o ON o.source_id = s.id AND o.created_at > {_AS_OF} - INTERVAL 7 DAY
WHERE s.active GROUP BY s.id, s.code, s.name, s.risk_class"""))
def failure_rate(spark, d):
    return M.failure_rate(m.sources(spark, d), m.orders(spark, d), m.moment(AS_OF))


@query("quality_stats", with_sql(O, then=f"""
SELECT COUNT(*) AS total_orders, CAST(SUM(page_count) AS BIGINT) AS total_pages, ROUND(AVG(ocr_confidence), 6) AS avg_confidence,
  MIN(ocr_confidence) AS min_confidence, COUNT(*) FILTER (WHERE ocr_confidence < 0.6) AS low_confidence_count,
  COUNT(*) FILTER (WHERE ocr_method = 'tesseract') AS tesseract_count, COUNT(*) FILTER (WHERE ocr_method = 'pypdf') AS pypdf_count
FROM ord WHERE extracted_at > {_AS_OF} - INTERVAL 7 DAY"""))
def quality_stats(spark, d):
    return M.text_quality(m.orders(spark, d), m.moment(AS_OF)).withColumn("avg_confidence", F.round("avg_confidence", 6))


@query("assignment_stats", with_sql(A, then=f"""
SELECT COUNT(*) AS total, COUNT(DISTINCT sport) AS unique_sports, COUNT(DISTINCT fio_normalized) AS unique_persons,
  COUNT(*) FILTER (WHERE assignment_type = 'sport_rank') AS ranks, COUNT(*) FILTER (WHERE assignment_type = 'judge_category') AS judges,
  COUNT(*) FILTER (WHERE action = 'assignment') AS assignments, COUNT(*) FILTER (WHERE action = 'confirmation') AS confirmations,
  COUNT(*) FILTER (WHERE action = 'refusal') AS refusals, ROUND(AVG(confidence), 6) AS avg_extraction_confidence
FROM asg WHERE created_at > {_AS_OF} - INTERVAL 30 DAY"""))
def assignment_stats(spark, d):
    return M.assignment_stats(m.assignments(spark, d), m.moment(AS_OF)).withColumn(
        "avg_extraction_confidence", F.round("avg_extraction_confidence", 6))


@query("export_readiness", with_sql(S, O, then="""
SELECT COUNT(*) AS ready, COUNT(*) FILTER (WHERE s.inn IS NOT NULL) AS with_inn, COUNT(*) FILTER (WHERE o.signed_by IS NOT NULL) AS with_signer
FROM ord o JOIN src s ON o.source_id = s.id WHERE o.status = 'approved'"""))
def export_readiness(spark, d):
    return M.export_readiness(m.orders(spark, d), m.sources(spark, d))


@query("source_quality", with_sql(O, A, L, "po AS (SELECT order_id, COUNT(*) AS n, SUM(confidence) AS conf, COUNT(sport) AS n_sport FROM asg GROUP BY 1)",
 "rot AS (SELECT DISTINCT order_id FROM log WHERE level = 'info' AND stage = 'download' AND order_id IS NOT NULL)", then="""
SELECT o.source_id, ROUND(AVG(CASE WHEN o.status IN ('extracted', 'approved') THEN 1.0 ELSE 0.0 END), 6) AS coverage,
  ROUND(AVG(CASE WHEN o.ocr_method = 'tesseract' THEN 1.0 ELSE 0.0 END), 6) AS ocr_rate,
  ROUND(CAST(SUM(po.n_sport) AS DOUBLE) / SUM(po.n), 6) AS sport_completeness, ROUND(AVG(COALESCE(po.n, 0)), 6) AS avg_row_yield,
  CAST(MIN(COALESCE(po.n, 0)) AS INTEGER) AS min_row_yield, CAST(MAX(COALESCE(po.n, 0)) AS INTEGER) AS max_row_yield,
  ROUND(AVG(CASE WHEN rot.order_id IS NOT NULL THEN 1.0 ELSE 0.0 END), 6) AS link_rot_rate,
  ROUND(SUM(po.conf) / SUM(po.n), 6) AS avg_confidence, CAST(COUNT(*) AS INTEGER) AS sample_size
FROM ord o LEFT JOIN po ON po.order_id = o.id LEFT JOIN rot ON rot.order_id = o.id GROUP BY o.source_id"""))
def source_quality(spark, d):
    faults = m.log(spark, d).filter("level = 'info'").withColumn("level", F.lit("error"))
    q = M.source_quality(m.orders(spark, d), m.assignments(spark, d), faults)
    return q.select("source_id", *[F.round(c, 6).alias(c) for c in ("coverage", "ocr_rate")],
                    F.round(F.col("field_completeness")["sport"], 6).alias("sport_completeness"),
                    F.round("avg_row_yield", 6).alias("avg_row_yield"), "min_row_yield", "max_row_yield",
                    F.round("link_rot_rate", 6).alias("link_rot_rate"),
                    F.round("avg_confidence", 6).alias("avg_confidence"), "sample_size")


@query("batch_summary", with_sql(O, A, _PER_ORDER, then="""
SELECT COUNT(*) FILTER (WHERE o.status <> 'failed') AS ok, COUNT(*) FILTER (WHERE o.status = 'failed') AS failed,
  CAST(SUM(CASE WHEN o.status <> 'failed' AND o.id % 7 <> 0 THEN COALESCE(p.n, 0) ELSE 0 END) AS BIGINT) AS records_saved
FROM ord o LEFT JOIN per_order p ON p.order_id = o.id"""))
def batch_summary(spark, d):
    per = M.rows_per_order(m.assignments(spark, d)).withColumnRenamed("order_id", "id")
    done = m.orders(spark, d).join(per, "id", "left").na.fill(0, ["record_count"]).select(
        F.when(F.col("status") == "failed", "failed").otherwise("extracted").alias("status"),
        (F.col("id") % 7 == 0).alias("skipped"), F.col("record_count").alias("records"))
    return P.batch_summary(done)


@query("doc_confidence", with_sql(A, then="""
SELECT order_id, COUNT(*) AS records, ROUND(COALESCE(AVG(confidence), 0), 6) AS avg_confidence FROM asg GROUP BY order_id"""))
def doc_confidence(spark, d):
    from decreta.plans.extract import document_confidence
    return document_confidence(m.assignments(spark, d), "order_id").withColumn(
        "avg_confidence", F.round("avg_confidence", 6))


@query("kpi", with_sql(O, A, _PER_ORDER, then="""
SELECT CAST(SUM(CASE WHEN o.status = 'approved' THEN COALESCE(p.n, 0) ELSE 0 END) AS BIGINT) AS records, CAST(SUM(o.page_count) AS BIGINT) AS pages,
  ROUND(AVG(CASE WHEN o.ocr_confidence <> 0 THEN o.ocr_confidence END) * 100, 1) AS confidence_pct,
  ROUND(AVG(CASE WHEN o.status = 'failed' THEN 1.0 ELSE 0.0 END) * 100, 1) AS fail_pct,
  ROUND(AVG(CASE WHEN o.ocr_method = 'pypdf' THEN 1.0 ELSE 0.0 END) * 100, 0) AS text_layer_pct
FROM ord o LEFT JOIN per_order p ON p.order_id = o.id"""))
def kpi(spark, d):
    return M.kpi(m.orders(spark, d), m.assignments(spark, d))


@query("kpi_by_source", with_sql(S, O, A, _PER_ORDER, then="""
SELECT s.code, s.risk_class, COUNT(o.id) AS total, COUNT(*) FILTER (WHERE o.status = 'failed') AS failed,
  ROUND(COALESCE(CAST(COUNT(*) FILTER (WHERE o.status = 'failed') AS DOUBLE) / NULLIF(COUNT(o.id), 0), 0), 6) AS fail_share,
  CAST(COALESCE(SUM(p.n), 0) AS BIGINT) AS records
FROM src s LEFT JOIN ord o ON o.source_id = s.id LEFT JOIN per_order p ON p.order_id = o.id GROUP BY s.id, s.code, s.risk_class"""))
def kpi_by_source(spark, d):
    return M.kpi_by_source(m.sources(spark, d), m.orders(spark, d), m.assignments(spark, d)).withColumn(
        "fail_share", F.round("fail_share", 6))


@query("run_metrics", """
SELECT CAST(user_id AS BIGINT) AS order_id, COUNT(*) AS steps, COUNT(*) FILTER (WHERE event_type = 'error') AS failed_steps,
  MAX(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS records,
  CAST(SUM(CASE WHEN event_type = 'purchase' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END) AS BIGINT) AS matched
FROM events GROUP BY user_id""")
def run_metrics(spark, d):
    k = F.get_json_object("props", "$.k")
    steps = m.table(spark, d, "events").select(
        F.col("user_id").alias("order_id"), F.col("event_type").alias("level"),
        F.create_map(F.lit("records"), k, F.lit("matched"), F.when(F.col("event_type") == "purchase", k)).alias("details"))
    return M.run_metrics(steps).select("order_id", "steps", "failed_steps", "records", "matched")


@query("latest_per_source", with_sql(S, L, then="""
SELECT source_id, id, created_at, value, source_code FROM (
  SELECT l.*, s.code AS source_code, ROW_NUMBER() OVER (PARTITION BY l.source_id ORDER BY l.created_at DESC, l.id) AS rn
  FROM log l JOIN src s ON l.source_id = s.id) WHERE rn = 1"""))
def latest_per_source(spark, d):
    quality = m.log(spark, d).withColumnRenamed("created_at", "measured_at")
    return M.latest_quality(quality, m.sources(spark, d)).select(
        "source_id", "id", F.col("measured_at").alias("created_at"), "value", "source_code")


@query("latest_per_user", """
SELECT user_id, event_id, ts, event_type FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1""")
def latest_per_user(spark, d):
    return latest_per_key(m.table(spark, d, "events").select("user_id", "event_id", "ts", "event_type"),
                          ["user_id"], "ts", F.col("event_id"))


# --- nested export --------------------------------------------------------------------------
_ITEM_SQL = """to_json({'lastName': split_part(fio, ' ', 1), 'firstName': split_part(fio, ' ', 2),
  'middleName': CASE WHEN len(string_split(fio, ' ')) > 2 THEN split_part(fio, ' ', 3) END,
  'birthDate': strftime(birth_date, '%Y-%m-%d'), 'sport': sport, 'rank': rank_category})"""


@query("nested_export", with_sql(S, O, A, f"""items AS (
  SELECT order_id, BOOL_OR(action = 'assignment') AS assignment,
    '[' || string_agg({_ITEM_SQL}, ',' ORDER BY created_at, row_no, id) || ']' AS items FROM asg GROUP BY order_id)""", then="""
SELECT o.id, o.order_number AS "order", strftime(o.order_date, '%Y-%m-%d') AS "issueDate", s.inn AS "issuedBy",
  o.signed_by AS "signedBy", COALESCE(i.assignment, FALSE) AS assignment, COALESCE(i.items, '[]') AS items
FROM ord o JOIN src s ON o.source_id = s.id LEFT JOIN items i ON i.order_id = o.id WHERE o.status = 'approved'"""))
def nested_export(spark, d):
    docs = exchange(m.orders(spark, d), m.assignments(spark, d), m.sources(spark, d))
    return docs.select("id", "order", "issueDate", F.col("issuedBy"), "signedBy", "assignment",
                       F.to_json("items", {"ignoreNullFields": "false"}).alias("items"))


@query("json_rows", with_sql(A, then="""
SELECT CAST(to_json({'order_id': order_id, 'row_no': row_no, 'fio': fio, 'sport': sport, 'action': action}) AS VARCHAR) AS json FROM asg"""))
def json_rows(spark, d):
    return to_json_rows(m.assignments(spark, d).select("order_id", "row_no", "fio", "sport", "action"))


@query("log_entries", with_sql(L, then="""
SELECT order_id, level, stage, message FROM (
  SELECT order_id, level, stage, repeat(message || ' ', 150) AS message FROM log)"""))
def log_entries(spark, d):
    entries = m.log(spark, d).withColumn("message", F.repeat(F.concat("message", F.lit(" ")), 150))
    return P.log_entries(entries).select("order_id", "level", "stage", "message")


@query("order_detail", with_sql(S, O, A, L, then="""
SELECT a.order_id, s.code AS source_code, a.id, a.row_no, (SELECT COUNT(*) FROM log WHERE log.order_id = a.order_id) AS n_logs
FROM asg a JOIN ord o ON a.order_id = o.id JOIN src s ON o.source_id = s.id WHERE a.order_id = (SELECT min(o_orderkey) FROM orders)"""))
def order_detail_query(spark, d):
    """Everything about the oldest key: its head, its rows, its log entries."""
    first = m.table(spark, d, "orders").agg(F.min("o_orderkey")).first()[0]
    found = S_.order_detail(first, m.orders(spark, d), m.sources(spark, d), m.assignments(spark, d), m.log(spark, d))
    logs = found["logs"].groupBy("order_id").agg(F.count(F.lit(1)).alias("n_logs"))
    head = found["order"].select(F.col("id").alias("order_id"), "source_code").join(logs, "order_id", "left").na.fill(0, ["n_logs"])
    return found["assignments"].select("order_id", "id", "row_no").join(head, "order_id")
