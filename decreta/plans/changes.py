"""Change detection over landed list pages."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from decreta.functions.dates import normalize_date_text, parse_dmy
from decreta.functions.pages import page_fingerprint
from decreta.operators.links import extract_embedded_json, extract_links
from decreta.operators.mutations import natural_id, note_check
from decreta.operators.ordering import keep_first
from decreta.operators.relational import new_documents
from decreta.session import broadcast_checked, staged


class Changes(NamedTuple):
    checks: DataFrame       # one row per source: status, hashes, counts
    discovered: DataFrame   # distinct documents found per source
    new_orders: DataFrame   # order rows to insert, status "new"
    sources: DataFrame      # registry with updated check bookkeeping


def expand_list_pages(sources: DataFrame) -> DataFrame:
    """Every list URL of every source with its further pages from the template."""
    more = F.when(
        F.col("detect.pagination").isNotNull() & (F.coalesce("detect.max_pages", F.lit(1)) > 1),
        F.col("detect.max_pages"),
    ).otherwise(1)
    listed = sources.select(
        F.col("code").alias("source_code"), "detect.pagination", more.alias("_n"),
        F.posexplode("detect.list_urls").alias("list_no", "list_url"),
    )
    pages = listed.select("*", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("page_no"))
    url = F.when(F.col("page_no") == 1, F.col("list_url")).otherwise(F.concat(
        "list_url", F.replace(F.col("pagination"), F.lit("{n}"), F.col("page_no").cast("string"))
    ))
    return pages.select("source_code", "list_no", "page_no", url.alias("url"))


def discover(pages: DataFrame, sources: DataFrame) -> DataFrame:
    """Documents found on all pages, distinct per source, first occurrence kept.

    ``pages`` has ``source_code, list_no, page_no, url, html``; patterns come from each
    source's own configuration.
    """
    cfg = sources.select(
        F.col("code").alias("source_code"), "source_type", "detect.link_regex", "detect.order_number_regex",
        "detect.order_date_regex", "detect.title_regex", "detect.js_var",
    )
    listed = pages.join(broadcast_checked(cfg), "source_code")
    keep = ("source_code", "list_no", "page_no")
    cols = [*keep, "page_url", "pos", "url", "file_url", "title", "order_number", "order_date", "order_type"]
    html = extract_links(
        listed.filter(F.col("source_type") != "json_embed"), F.col("link_regex"), keep,
        F.col("order_number_regex"), F.col("order_date_regex"), F.col("title_regex"),
    ).select(cols)
    embedded = extract_embedded_json(
        listed.filter(F.col("source_type") == "json_embed"), F.coalesce("js_var", F.lit("$obj")), keep
    ).select(cols)
    key = html.unionByName(embedded).withColumn("_key", F.coalesce("file_url", "url"))
    return keep_first(key, ["source_code", "_key"],
                      [F.col("list_no"), F.col("page_no"), F.col("pos")]).drop("_key")


def detect_changes(pages: DataFrame, sources: DataFrame, orders: DataFrame, as_of: Column) -> Changes:
    """Compare landed pages with what is known and report one status per source.

    ``sources`` needs ``id, code, source_type, risk_class, active, detect,
    last_page_hash``; ``orders`` the stored orders. Red and inactive sources and those
    without a pattern are skipped; a source whose pages did not land is an error.
    """
    allowed = sources.filter(F.col("active") & (F.coalesce("risk_class", F.lit("green")) != "red")
                             & (F.size(F.coalesce(F.col("detect.list_urls"), F.array())) > 0))
    landed = pages.join(broadcast_checked(allowed.select(F.col("code").alias("source_code"))),
                        "source_code", "left_semi")
    # Of several snapshots of a page the newest counts.
    newest = [F.col("seen_at").desc_nulls_last()] if "seen_at" in pages.columns else []
    landed = keep_first(landed, ["source_code", "list_no", "page_no"], [*newest, F.xxhash64("html"), F.col("url")])
    found = staged(discover(landed, allowed), "discovered")
    codes = broadcast_checked(sources.select(F.col("id").alias("source_id"), F.col("code").alias("source_code")))
    known = orders.join(codes, "source_id").select("source_code", "source_url", "file_url")
    fresh = staged(new_documents(found, known), "fresh")

    first_page = landed.filter((F.col("list_no") == 0) & (F.col("page_no") == 1)).select(
        "source_code", page_fingerprint(F.col("html")).alias("page_hash"),
        F.col("etag") if "etag" in pages.columns else F.lit(None).cast("string").alias("etag"),
    )
    per_source = lambda df, name: df.groupBy("source_code").agg(F.count(F.lit(1)).alias(name))
    status = (
        F.when(~F.col("active") | (F.col("risk_class") == "red") | ~F.col("_listed"), "skipped")
        .when(F.col("page_hash").isNull(), "error")
        .when(F.col("links_new") > 0, "new_docs")
        .when(F.col("page_hash_changed"), "changed")
        .otherwise("unchanged")
    )
    base = sources.select(
        F.col("code").alias("source_code"), "active", F.coalesce("risk_class", F.lit("green")).alias("risk_class"),
        "last_page_hash", (F.size(F.coalesce(F.col("detect.list_urls"), F.array())) > 0).alias("_listed"),
    )
    checks = (
        base.join(first_page, "source_code", "left")
        .join(per_source(found, "links_total"), "source_code", "left")
        .join(per_source(fresh, "links_new"), "source_code", "left")
        .na.fill(0, ["links_total", "links_new"])
        .withColumn("page_hash_changed", F.coalesce(F.col("last_page_hash") != F.col("page_hash"), F.lit(False)))
        .withColumn("status", status)
        .select("source_code", "status", "page_hash", "etag", "page_hash_changed", "links_total", "links_new")
    )
    new_orders = fresh.join(codes, "source_code").select(
        natural_id("source_code", F.coalesce("file_url", "url")).alias("id"), "source_id", "source_code",
        "order_number", parse_dmy(normalize_date_text(F.col("order_date"))).alias("order_date"),
        F.col("order_date").alias("order_date_raw"), "order_type", "title",
        F.col("url").alias("source_url"), "file_url", F.lit("new").alias("status"),
        as_of.alias("created_at"),
    )
    noted = checks.filter(F.col("page_hash").isNotNull()).select(
        F.col("source_code").alias("code"), "page_hash", "etag")
    updated = note_check(sources, noted, as_of) if "last_etag" in sources.columns else sources
    return Changes(checks, found, new_orders, updated)


def check_summary(checks: DataFrame) -> DataFrame:
    """Totals over all checked sources."""
    return checks.agg(
        F.count(F.lit(1)).alias("sources"), F.sum("links_new").alias("links_new"),
        F.count_if(F.col("status") == "error").alias("errors"),
    )
