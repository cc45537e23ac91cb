"""Landed files: document bytes, list pages, fingerprints, admission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from decreta import constants as K
from decreta.schemas import PAGE


def read_documents(spark: SparkSession, path: str, glob: str = "*.pdf",
                   max_bytes: int | None = None) -> DataFrame:
    """Order files as ``path, length, modificationTime, content``.

    A size limit is pushed into the scan, so oversized files are never opened.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(path))
    return files.filter(F.col("length") <= max_bytes) if max_bytes else files


def land_documents(df: DataFrame, folder: str, path: str = "path", content: str = "content") -> None:
    """Land document files packed: rows of ``path, length, modificationTime, content``, as
    :func:`read_documents` gives them, many to a Parquet file.

    A folder with a file for each document costs the driver a rename and a listing for
    each; packed, the number of files follows the number of tasks.
    """
    c = F.col(content)
    df.select(F.col(path).cast("string").alias("path"), F.octet_length(c).cast("bigint").alias("length"),
              F.current_timestamp().alias("modificationTime"), c.alias("content")).write.parquet(folder)


def read_landed(spark: SparkSession, folder: str, max_bytes: int | None = None) -> DataFrame:
    """Document files as :func:`land_documents` packed them; with a size limit, those up to it."""
    files = spark.read.schema("path string, length bigint, modificationTime timestamp, content binary").parquet(folder)
    return files.filter(F.col("length") <= max_bytes) if max_bytes else files


def with_file_hash(df: DataFrame, column: str = "content") -> DataFrame:
    """SHA-256 of the bytes and the short names made of its prefix."""
    digest = F.sha2(F.col(column), 256)
    return df.withColumn("file_hash", digest).withColumns({
        "file_name": F.concat(F.substring("file_hash", 1, 16), F.lit(".pdf")),
        "short_hash": F.substring("file_hash", 1, 12),
    })


def admit_documents(df: DataFrame, column: str = "content", max_bytes: int = K.MAX_DOCUMENT_BYTES,
                    pages: Column | None = None, max_pages: int | None = None) -> DataFrame:
    """Reject reason per document: not a PDF, too large, too many pages; null admits."""
    c = F.col(column)
    magic = F.substring(c, 1, 4) == F.lit(b"%PDF")
    reason = F.when(~F.coalesce(magic, F.lit(False)), "not a PDF").when(F.octet_length(c) > max_bytes, "too large")
    if pages is not None and max_pages is not None:
        reason = reason.when(F.coalesce(pages > max_pages, F.lit(False)), "too many pages")
    return df.withColumn("reject_reason", reason)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """List pages landed as Parquet."""
    return spark.read.schema(PAGE).parquet(path)


def read_html_files(spark: SparkSession, path: str) -> DataFrame:
    """List pages landed as files, one page each, with their path."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
