"""Source registry, reference dictionaries and registry sheets."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from decreta import constants as K
from decreta.functions.pages import url_host
from decreta.schemas import REGISTRY_SHEET, SOURCE
from decreta.session import broadcast_checked, staged


def builtin_sources(spark: SparkSession) -> DataFrame:
    """The sources shipped with the package, as nested rows."""
    rows = spark.createDataFrame([(json.dumps(s, ensure_ascii=False),) for s in K.SOURCES], "j string")
    return rows.select(F.from_json("j", SOURCE).alias("s")).select("s.*")


def read_sources(spark: SparkSession, path: str) -> DataFrame:
    """Stored source configurations, one JSON object per line."""
    return spark.read.schema(SOURCE).json(path)


def active_sources(sources: DataFrame) -> DataFrame:
    return sources.filter("active")


def sources_by_risk(sources: DataFrame, risk: str) -> DataFrame:
    return sources.filter(F.col("risk_class") == risk)


def resolve_source_config(stored: DataFrame, builtin: DataFrame) -> DataFrame:
    """Flat working configuration: the stored one if it lists URLs, else the built-in."""
    cols = ["code", "source_type", "risk_class", "active", "download", "detect", "meta"]
    tag = lambda df, p: df.select("code", *[F.col(c).alias(p + c) for c in cols[1:]], F.lit(True).alias(p + "has"))
    both = tag(stored, "s_").join(tag(builtin, "b_"), "code", "full_outer")
    usable = F.coalesce(F.size("s_detect.list_urls") > 0, F.lit(False))
    pick = lambda c: F.when(usable, F.col("s_" + c)).otherwise(F.col("b_" + c))
    detect, download = pick("detect"), pick("download")
    flat = {f: detect[f] for f in ("list_urls", "link_regex", "title_regex", "order_date_regex",
                                   "order_number_regex", "pagination", "js_var")}
    return both.select(
        "code", F.when(usable, "stored").when(F.col("b_has"), "builtin").otherwise("none").alias("origin"),
        *[v.alias(k) for k, v in flat.items()],
        F.coalesce(detect["max_pages"], F.lit(1)).alias("max_pages"),
        F.coalesce(download["method"], F.lit("httpx")).alias("method"),
        F.coalesce(download["base_url"], F.lit("")).alias("base_url"),
        download["antibot"].alias("antibot"), download["wait_selector"].alias("wait_selector"),
        F.coalesce(pick("source_type"), F.lit("pdf_portal")).alias("source_type"),
        F.coalesce(F.col("s_risk_class"), F.col("b_risk_class"), F.lit("green")).alias("risk_class"),
        F.coalesce(F.col("s_active"), F.col("b_active")).alias("active"),
    )


def allowed_hosts(sources: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Hosts that may be read: fixed ones, those of the sources' URLs, and ``extra``."""
    spark = sources.sparkSession
    fixed = spark.createDataFrame([(h,) for h in K.ALLOWED_HOSTS], "host string")
    urls = sources.select(F.explode(F.concat(
        F.array("download.base_url"), F.coalesce("detect.list_urls", F.array().cast("array<string>")))).alias("u"))
    hosts = fixed.unionByName(urls.select(url_host(F.col("u")).alias("host")))
    if extra is not None:
        hosts = hosts.unionByName(extra.select(
            F.lower(F.btrim(F.trim("host"), F.lit("."))).alias("host")))
    return hosts.filter(F.coalesce("host", F.lit("")) != "").distinct()


def reference_dim(spark: SparkSession, name: str) -> DataFrame:
    """One of the reference dictionaries: positions, honorary titles or ranks."""
    basis, since = K.DICTIONARY_BASIS[name]
    if name == "ranks":
        df = spark.createDataFrame(K.RANKS, "code string, name string, category string, rank_order int")
    else:
        rows = {"specialist_positions": K.SPECIALIST_POSITIONS, "honorary_titles": K.HONORARY_TITLES}[name]
        df = spark.createDataFrame(rows, "code string, name string")
    return df.withColumns({
        "source_doc": F.lit(basis), "effective_from": F.lit(since).cast("date"),
        "effective_to": F.lit(None).cast("date"),
    })


def read_sport_registry(spark: SparkSession, csv_dir: str) -> DataFrame:
    """Exported registry sheets: one CSV per sheet, the sheet name being the file name.

    Row numbers come from the leading ``row_no`` column of the export, as a distributed
    read keeps no line order of its own.
    """
    ddl = REGISTRY_SHEET.split(", ", 1)[1]
    rows = spark.read.schema(ddl).option("header", "true").csv(csv_dir)
    sheet = F.regexp_extract(F.url_decode(F.col("_metadata.file_name")), r"^(.*?)(?:\.csv)?$", 1)
    return rows.select(sheet.alias("sheet"), *rows.columns)


def number_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_no, value``: the lines of text files numbered from 0 in each file.

    A file is read in splits by many tasks. Lines are numbered inside their split; the
    counts of the splits, one small row each, give every split its offset in the file.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), "value")
    held = staged(lines, "numbered-lines")
    splits = held.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return held.join(broadcast_checked(offsets), ["file", "block"]).select(
        "file", (F.col("offset") + F.col("id") - F.col("first")).alias("line_no"), "value")


def read_sheet_exports(spark: SparkSession, csv_dir: str) -> DataFrame:
    """Exported registry sheets without row numbers: CSV files with a header line, one
    line for each row. The sheet is the name of the folder ``sheet=...`` or of the file.
    Forward fill of sports needs the order of rows, which comes from their place in the file."""
    cells = ", ".join(c for c in REGISTRY_SHEET.split(", ") if c.startswith("c"))
    place = F.url_decode(F.col("file"))
    sheet = F.coalesce(F.nullif(F.regexp_extract(place, "sheet=([^/]+)/", 1), F.lit("")), F.regexp_extract(place, r"([^/]*?)(?:\.csv)?$", 1))
    rows = number_lines(spark, csv_dir).filter("line_no > 0")
    return rows.select(sheet.alias("sheet"), F.col("line_no").cast("int").alias("row_no"), F.from_csv("value", F.lit(cells)).alias("c")).select("sheet", "row_no", "c.*")
