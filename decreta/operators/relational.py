"""Joins, filters and checks over the stored tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from decreta import constants as K
from decreta.operators.ordering import keep_first
from decreta.session import broadcast_checked, shuffled


# --- predicates ---------------------------------------------------------------
def contains_text(column: str, text: str) -> Column:
    """Case-insensitive substring test; ``%`` and ``_`` in the text stay wildcards."""
    return F.col(column).ilike(f"%{text}%")


def where_all(df: DataFrame, *conditions: Column | None) -> DataFrame:
    """Apply the filters that were given; ``None`` stands for an unset one."""
    given = [c for c in conditions if c is not None]
    return df.filter(reduce(lambda a, b: a & b, given)) if given else df


def within_dates(column: str, start: str | None, end: str | None) -> Column | None:
    """Inclusive date range with either end open."""
    c, parts = F.col(column), []
    if start:
        parts.append(c >= F.lit(start).cast("date"))
    if end:
        parts.append(c <= F.lit(end).cast("date"))
    return reduce(lambda a, b: a & b, parts) if parts else None


def within_last(column: str, as_of: Column, span: str) -> Column:
    """Strictly newer than ``as_of`` minus an interval such as ``7 DAYS``."""
    return F.col(column) > as_of - F.expr(f"INTERVAL {span}")


def checkable_sources(sources: DataFrame) -> DataFrame:
    """Active sources that may be read automatically."""
    return sources.filter(F.col("active") & (F.coalesce("risk_class", F.lit("green")) != "red"))


# --- joins ----------------------------------------------------------------------
def assignments_full(assignments: DataFrame, orders: DataFrame, sources: DataFrame) -> DataFrame:
    """Every assignment with its order and issuing body."""
    src = sources.select(
        F.col("id").alias("source_id"), F.col("code").alias("source_code"),
        F.col("name").alias("issuing_body"), "region",
    )
    head = orders.select(
        F.col("id").alias("order_id"), "source_id", "order_number", "order_date", "order_type"
    )
    return assignments.join(head, "order_id").join(broadcast_checked(src), "source_id")


def log_enriched(log: DataFrame, sources: DataFrame, orders: DataFrame) -> DataFrame:
    """Log entries with source code and order number where they have one."""
    src = sources.select(F.col("id").alias("source_id"), F.col("code").alias("source_code"))
    num = orders.select(F.col("id").alias("order_id"), "order_number")
    return join_known(log.join(broadcast_checked(src), "source_id", "left"), num, "order_id")


def join_known(df: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join whose rows without a key are spread over the tasks by their other values:
    they match nothing, and mostly null keys would meet in one task. ``df`` is read once."""
    # A variant or a map has no hash.
    others = [f.name for f in df.schema.fields if f.name != key and isinstance(f.dataType, AtomicType) and f.dataType.typeName() != "variant"]
    spread = F.when(F.col(key).isNull(), F.xxhash64(*others) if others else F.lit(0)).otherwise(0)
    known = right.withColumn("_spread", F.lit(0).cast("bigint"))
    return df.withColumn("_spread", spread.cast("bigint")).join(known, [key, "_spread"], "left").drop("_spread")


def new_documents(discovered: DataFrame, known: DataFrame) -> DataFrame:
    """Documents whose page URL and file URL are both unknown to their source.

    ``known`` has ``source_code, source_url, file_url``; both URLs become one key
    column, so each test is an equi anti-join instead of a disjunction.
    """
    urls = (
        known.select("source_code", F.explode(F.array("source_url", "file_url")).alias("url"))
        .filter(F.col("url").isNotNull() & (F.col("url") != ""))
        .distinct()
    )
    docs = discovered.withColumn("_key", F.coalesce("file_url", "url"))
    fresh = docs.join(urls.withColumnRenamed("url", "_key"), ["source_code", "_key"], "left_anti")
    return fresh.join(urls, ["source_code", "url"], "left_anti").drop("_key")


def name_as_of(rows: DataFrame, names: DataFrame, key: str, at: str) -> DataFrame:
    """Attach the name valid at each row's date: ``valid_from <= date < valid_to``."""
    n = names.select(F.col(key).alias("_key"), F.col("name").alias("valid_name"),
                     "valid_from", "valid_to")
    covers = (
        (F.col(key) == F.col("_key"))
        & (F.coalesce(F.col("valid_from") <= F.col(at), F.lit(True)))
        & (F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to")))
    )
    return rows.join(broadcast_checked(n), covers, "left").drop("_key", "valid_from", "valid_to")


def with_attachments(orders: DataFrame) -> DataFrame:
    """Main documents with each of their attachments (self-join on the parent)."""
    child = orders.filter(F.col("parent_id").isNotNull()).select(
        F.col("parent_id").alias("_parent"), F.col("id").alias("attachment_id"),
        F.col("attachment_num"), F.col("file_url").alias("attachment_url"),
    )
    main = orders.filter(F.col("parent_id").isNull()).drop("attachment_num")
    return main.join(child, F.col("id") == F.col("_parent"), "left").drop("_parent")


def already_stored(incoming: DataFrame, orders: DataFrame, on: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is stored. A semi join needs no distinct keys, and nearly all are
    distinct: an aggregation would hold a map of all of them."""
    keys = orders.select(*on).dropna()
    return incoming.join(shuffled(keys), list(on), "left_semi")


def not_stored(incoming: DataFrame, orders: DataFrame, on: Sequence[str]) -> DataFrame:
    keys = orders.select(*on).dropna()
    return incoming.join(shuffled(keys), list(on), "left_anti")


def issuing_details(orders: DataFrame, sources: DataFrame) -> DataFrame:
    """Issuing body and order type of the source, the code and a default when unknown."""
    src = sources.select(F.col("code").alias("source_code"),
                         F.col("meta.issuing_body").alias("_body"),
                         F.col("meta.order_type").alias("_type"))
    return orders.join(broadcast_checked(src), "source_code", "left").select(
        "*",
        F.coalesce("_body", "source_code").alias("issuing_body"),
        F.coalesce("_type", F.lit(K.ORDER_TYPES[0])).alias("default_order_type"),
    ).drop("_body", "_type")


def url_policy(df: DataFrame, url: str, allowed_hosts: DataFrame) -> DataFrame:
    """Verdict per URL: web scheme, no user info, host on the list (column ``host``)."""
    from decreta.functions.pages import url_authority, url_host, url_scheme
    from decreta.functions.text import strip

    u = strip(F.col(url))
    hosts = allowed_hosts.select(F.lower(F.col("host")).alias("_host")).distinct()
    checked = df.withColumns({"_host": url_host(u), "_auth": url_authority(u), "_scheme": url_scheme(u)})
    known = hosts.withColumn("_known", F.lit(True))
    reason = (
        F.when(~F.coalesce(F.col("_scheme"), F.lit("")).isin("http", "https"), "scheme")
        .when(F.col("_auth") == "", "no host")
        .when(F.col("_auth").contains("@"), "user info")
        .when(F.col("_host") == "", "no host")
        .when(F.col("_known").isNull(), "host not allowed")
    )
    return (
        checked.join(broadcast_checked(known), "_host", "left")
        .withColumns({"url_reject": reason, "url_host": F.col("_host")})
        .withColumn("url_allowed", F.col("url_reject").isNull())
        .drop("_host", "_auth", "_scheme", "_known")
    )


# --- checks ---------------------------------------------------------------------
def rule_violations(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """One row per broken rule. A rule that evaluates to null counts as kept."""
    broken = F.array_compact(F.array(*[
        F.when(~ok, F.lit(name)) for name, ok in rules.items()
    ]))
    return df.select(F.col(key), F.explode(broken).alias("rule"))


def order_rules() -> dict[str, Column]:
    c = F.col
    return {
        "order_number": c("order_number").isNotNull(),
        "order_date": c("order_date").isNotNull(),
        "order_type": c("order_type").isin(K.ORDER_TYPES),
        "status": c("status").isin(K.ORDER_STATUSES),
        "ocr_method": c("ocr_method").isin(K.TEXT_METHODS),
    }


def assignment_rules() -> dict[str, Column]:
    c = F.col
    return {
        "fio": c("fio").isNotNull(),
        "assignment_type": c("assignment_type").isin(K.ASSIGNMENT_TYPES),
        "rank_category": c("rank_category").isNotNull(),
        "action": c("action").isin(K.ACTIONS),
        "confidence": c("confidence").between(0, 1),
    }


def source_rules() -> dict[str, Column]:
    c = F.col
    return {
        "source_type": c("source_type").isin(K.SOURCE_TYPES),
        "risk_class": c("risk_class").isin(K.RISK_CLASSES),
        "name": c("name").isNotNull(),
    }


def log_rules() -> dict[str, Column]:
    return {"level": F.col("level").isin(K.LOG_LEVELS), "message": F.col("message").isNotNull()}


def sport_rules() -> dict[str, Column]:
    return {"section": F.col("section").isin(K.REGISTRY_SECTIONS)}


def rank_rules() -> dict[str, Column]:
    return {"category": F.col("category").isin(K.RANK_CATEGORIES)}


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-null reference points nowhere."""
    keys = parent.select(F.col(parent_key).alias(foreign_key))
    return child.filter(F.col(foreign_key).isNotNull()).join(keys, foreign_key, "left_anti")


# Every reference of the model: table and column, and the table whose ids it names.
REFERENCES = [
    ("orders", "source_id", "registry_sources"), ("orders", "parent_id", "orders"),
    ("assignments", "order_id", "orders"), ("assignments", "sport_id", "sports"),
    ("processing_log", "order_id", "orders"), ("processing_log", "source_id", "registry_sources"),
    ("quality_metrics", "source_id", "registry_sources"),
    ("golden_sets", "source_id", "registry_sources"), ("golden_sets", "order_id", "orders"),
    ("sport_names", "sport_id", "sports"), ("sport_names", "source_version_id", "sport_registry_versions"),
    ("sport_disciplines", "sport_id", "sports"),
]


def all_orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """``reference, id, key``: rows whose non-null reference points nowhere, for every
    reference whose two tables are given (each with ``id``).

    All references are tagged rows of one table, all ids of the named tables another.
    Distinct keys are taken before the one anti-join between them, so a key that most
    rows name is one row there; the few missing keys then find their rows.
    """
    wanted = [(t, c, p) for t, c, p in REFERENCES if t in tables and p in tables]
    text = lambda c: F.col(c).cast("string")
    refs = reduce(DataFrame.unionByName, [
        tables[t].filter(F.col(c).isNotNull()).select(
            F.lit(f"{t}.{c}").alias("reference"), F.lit(p).alias("parent"), text("id").alias("id"), text(c).alias("key"))
        for t, c, p in wanted])
    ids = reduce(DataFrame.unionByName, [
        tables[p].select(F.lit(p).alias("parent"), text("id").alias("key")) for p in dict.fromkeys(p for _, _, p in wanted)])
    missing = refs.select("parent", "key").distinct().join(ids, ["parent", "key"], "left_anti")
    return refs.join(missing, ["parent", "key"]).select("reference", "id", "key")


def all_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """``tbl, id, rule`` of every broken rule of the tables given (each with ``id``)."""
    parts = [rule_violations(tables[t], "id", rules()).select(F.lit(t).alias("tbl"), F.col("id").cast("string").alias("id"), "rule")
             for t, rules in RULES.items() if t in tables]
    return reduce(DataFrame.unionByName, parts)


RULES = {
    "orders": order_rules, "assignments": assignment_rules, "registry_sources": source_rules,
    "processing_log": log_rules, "sports": sport_rules, "rank_dictionary": rank_rules,
}


def first_links(links: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """Links distinct by key, keeping the first seen."""
    return keep_first(links, keys, list(order))


def document_links(links: DataFrame, url: str = "url", pattern: str | None = None) -> DataFrame:
    """Links that lead to document files, optionally also matching ``pattern``."""
    lower = F.lower(F.col(url))
    is_file = lower.contains(".pdf") | lower.contains("/media/docs/")
    extra = F.col(url).rlike("(?iuU)" + pattern) if pattern else None
    return where_all(links, is_file, extra)
