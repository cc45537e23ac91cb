"""The given tables seen as the stored model, in Spark and as SQL text.

A nation is a source, an order a published order, a line item an assignment row and an
event a log entry. Each ``*_SQL`` constant is a common table expression that says the
same thing in SQL, for the checks in ``__spark_entry__``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-08-01 00:00:00"
LOG_AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def moment(text: str):
    return F.expr(f"TIMESTAMP_NTZ'{text}'")


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "n_nationkey AS id", "n_name AS code", "n_name AS name", "r_name AS region",
        "CASE n_nationkey % 3 WHEN 0 THEN 'green' WHEN 1 THEN 'amber' ELSE 'red' END AS risk_class",
        "n_nationkey % 7 <> 3 AS active",
        "CASE WHEN n_nationkey % 2 = 0 THEN 7700000000 + n_nationkey END AS inn",
        "CASE n_nationkey % 5 WHEN 0 THEN 'json_embed' WHEN 1 THEN 'rss' ELSE 'pdf_portal' END AS source_type",
    )


SOURCES_SQL = """src AS (
  SELECT n_nationkey AS id, n_name AS code, n_name AS name, r_name AS region,
    CASE n_nationkey % 3 WHEN 0 THEN 'green' WHEN 1 THEN 'amber' ELSE 'red' END AS risk_class,
    n_nationkey % 7 <> 3 AS active,
    CASE WHEN n_nationkey % 2 = 0 THEN 7700000000 + n_nationkey END AS inn,
    CASE n_nationkey % 5 WHEN 0 THEN 'json_embed' WHEN 1 THEN 'rss' ELSE 'pdf_portal' END AS source_type
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

_ORDER_EXPRS = [
    "o_orderkey AS id", "c_nationkey AS source_id",
    "concat('N-', o_orderkey) AS order_number", "CAST(o_orderdate AS DATE) AS order_date",
    "CASE WHEN o_orderkey % 2 = 0 THEN 'приказ' ELSE 'распоряжение' END AS order_type",
    "concat('О присвоении ', o_orderpriority) AS title",
    "concat('https://host', o_orderkey % 9, '.example.org/docs/', o_orderkey) AS source_url",
    "CASE WHEN o_orderkey % 3 = 0 THEN concat('https://host', o_orderkey % 9, '.example.org/files/', o_orderkey, '.pdf') END AS file_url",
    """CASE o_orderstatus WHEN 'F' THEN 'failed'
         WHEN 'P' THEN CASE WHEN o_orderpriority = '2-HIGH' THEN 'downloaded' ELSE 'new' END
         ELSE CASE WHEN o_orderpriority = '1-URGENT' THEN 'approved' ELSE 'extracted' END END AS status""",
    "CASE WHEN o_orderstatus = 'F' THEN concat('fault ', o_orderkey % 5) END AS error_message",
    "o_orderdate AS created_at",
    "CASE WHEN o_orderstatus = 'O' THEN o_orderdate + INTERVAL 1 DAY END AS extracted_at",
    "CAST(1 + o_orderkey % 20 AS INT) AS page_count",
    "CAST(o_orderkey % 101 AS DOUBLE) / 100 AS ocr_confidence",
    "CASE o_orderkey % 4 WHEN 0 THEN 'tesseract' WHEN 1 THEN 'vision' ELSE 'pypdf' END AS ocr_method",
    "CASE WHEN o_custkey % 4 <> 0 THEN concat('Signer ', o_custkey % 10) END AS signed_by",
    "CASE WHEN o_orderkey % 6 = 1 THEN o_orderkey - 1 END AS parent_id",
]


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).selectExpr(*_ORDER_EXPRS)


ORDERS_SQL = "ord AS (SELECT " + ", ".join(_ORDER_EXPRS) + " FROM orders JOIN customer ON o_custkey = c_custkey)"

_ROW_EXPRS = [
    "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INT)) AS id",
    "l_orderkey AS order_id", "l_linenumber AS row_no",
    "concat('Fam', l_suppkey % 500, ' Im', l_partkey % 40, CASE WHEN l_partkey % 3 = 0 THEN '' ELSE concat(' Otch', l_partkey % 30) END) AS fio",
    "upper(concat('Fam', l_suppkey % 500, ' Im', l_partkey % 40, CASE WHEN l_partkey % 3 = 0 THEN '' ELSE concat(' Otch', l_partkey % 30) END)) AS fio_normalized",
    "date_add(DATE '1960-01-01', CAST((l_partkey * 7 + l_suppkey) % 16000 AS INT)) AS birth_date",
    "CASE WHEN l_linestatus = 'O' THEN 'sport_rank' ELSE 'judge_category' END AS assignment_type",
    "concat('rank ', l_linenumber) AS rank_category",
    "CASE WHEN l_partkey % 11 <> 0 THEN concat('sport ', l_partkey % 97) END AS sport",
    "CASE l_returnflag WHEN 'A' THEN 'assignment' WHEN 'R' THEN 'refusal' ELSE 'confirmation' END AS action",
    "round(1 - l_discount, 2) AS confidence", "l_shipdate AS created_at",
]


def assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_ROW_EXPRS)


ASSIGNMENTS_SQL = "asg AS (SELECT " + ", ".join(_ROW_EXPRS).replace(
    "date_add(DATE '1960-01-01', CAST((l_partkey * 7 + l_suppkey) % 16000 AS INT))",
    "DATE '1960-01-01' + CAST((l_partkey * 7 + l_suppkey) % 16000 AS INT)",
) + " FROM lineitem)"

_LOG_EXPRS = [
    "event_id AS id", "CAST(user_id % 30 AS INT) AS source_id",
    "CASE WHEN event_id % 5 <> 0 THEN event_id * 2 END AS order_id",
    "CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'warn' WHEN 'click' THEN 'debug' ELSE 'info' END AS level",
    "CASE event_type WHEN 'view' THEN 'download' ELSE event_type END AS stage",
    "concat(event_type, ' ', props) AS message", "props AS details", "ts AS created_at", "value",
]


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*_LOG_EXPRS)


LOG_SQL = "log AS (SELECT " + ", ".join(_LOG_EXPRS) + " FROM events)"


def with_sql(*ctes: str, then: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + then


S, O, A, L = SOURCES_SQL, ORDERS_SQL, ASSIGNMENTS_SQL, LOG_SQL
