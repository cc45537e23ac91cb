"""Continuous forms of the batch jobs, as Structured Streaming queries.

State that must last (known pages, stored orders) lives in the store's tables and is
changed inside ``foreachBatch`` by the same functions the batch jobs use. A round writes
the rows it changes, not the tables; every commit carries the query and the number of the
batch, so a batch replayed after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from decreta.functions.pages import page_fingerprint
from decreta.operators.ordering import keep_first
from decreta.operators.relational import not_stored
from decreta.plans.changes import detect_changes
from decreta.plans.orders import apply_processed, process_orders, processed_orders
from decreta.session import shuffled
from decreta.sources.store import Store

_PAGES = "source_code string, list_no int, page_no int, url string, html string, etag string"


def _start(stream: DataFrame, body: Callable[[DataFrame, int], None], checkpoint: str,
           once: bool, interval: str) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id that Spark gave the query when its checkpoint began; a new checkpoint counts anew."""
    return spark.read.text(f"{checkpoint}/metadata").first()[0]


def watch_pages(spark: SparkSession, landed: str, store: Store, checkpoint: str, as_of: Callable[[], Column],
                files_per_batch: int = 1000, once: bool = False, interval: str = "300 seconds") -> StreamingQuery:
    """Detect new documents on landing list pages and queue them as orders."""
    stream = spark.readStream.schema(_PAGES).option("maxFilesPerTrigger", files_per_batch).parquet(landed)

    def body(pages: DataFrame, number: int) -> None:
        batch = (_query_id(spark, checkpoint), number)
        sources, orders = store.read("registry_sources"), store.read("orders")
        keyed = sources.withColumn("id", F.col("code"))
        found = detect_changes(pages, keyed, orders, as_of())
        # Ids come from content, so a replayed batch finds its own orders and adds none.
        once_each = keep_first(found.new_orders, ["id"], [F.col("created_at")])
        store.append("orders", not_stored(once_each, orders, ["id"]), batch)
        checked = pages.select(F.col("source_code").alias("code")).distinct()
        store.put("registry_sources", found.sources.select(sources.columns).join(checked, "code", "left_semi"), batch=batch)

    return _start(stream, body, checkpoint, once, interval)


def keep_state_on_disk(spark: SparkSession, memory_mb: int = 512) -> None:
    """Queries started from now on keep their state in RocksDB: executors hold a bounded
    part of it in memory, and each round writes its changes to the checkpoint."""
    store = "spark.sql.streaming.stateStore"
    spark.conf.set(f"{store}.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set(f"{store}.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set(f"{store}.rocksdb.boundedMemoryUsage", "true")
    spark.conf.set(f"{store}.rocksdb.maxMemoryUsageMB", str(memory_mb))


def distinct_documents(files: DataFrame, watermark: str | None = None, at: str = "landed_at") -> DataFrame:
    """Exactly-once intake by content hash.

    With a ``watermark`` the state is bounded and copies landing further apart than it
    pass again; without one, every hash is remembered, on disk.
    """
    keep_state_on_disk(files.sparkSession)
    if watermark is None:
        return files.dropDuplicates(["file_hash"])
    return files.withWatermark(at, watermark).dropDuplicatesWithinWatermark(["file_hash"])


class PageHistory(StatefulProcessor):
    """Snapshots of one page that have arrived so far, as a list state.

    A round reads and writes the lists of the pages it touches. Rows come out for each
    new snapshot and for the one after it, whose status may have turned; ``version``, the
    number of snapshots known, tells which row is the later word.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getListState("seen", "at timestamp, page_hash string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = dict(self.seen.get()) if self.seen.exists() else {}
        # A snapshot that is known stays as it is; of equal times the smallest hash counts.
        fresh: dict = {}
        for frame in rows:
            for at, page_hash in zip((t.to_pydatetime() for t in frame["at"]), frame["page_hash"]):
                if at not in known:
                    fresh[at] = min(page_hash, fresh.get(at, page_hash))
        if not fresh:
            return
        self.seen.appendList(list(fresh.items()))
        known |= fresh
        times, out = sorted(known), []
        for before, at in zip([None, *times], times):
            if at in fresh or before in fresh:
                change = "first" if before is None else "unchanged" if known[before] == known[at] else "changed"
                out.append((key[0], at, known[at], change, len(times)))
        yield pd.DataFrame(out, columns=["key", "at", "page_hash", "change", "version"])


def track_page_changes(stream: DataFrame, target: str, checkpoint: str, key: str = "url", at: str = "seen_at",
                       once: bool = False, interval: str = "300 seconds") -> StreamingQuery:
    """Write the change status of every snapshot, also of those that arrive late.

    ``stream`` has ``key, at, html``; rows without a key or a time have no history and are
    left out. The snapshots of a page are state of the query, kept by page in RocksDB. A
    late snapshot also corrects the one after it; :func:`page_changes` reads the last word
    on each.
    """
    keep_state_on_disk(stream.sparkSession)
    marked = stream.select(F.col(key).alias("key"), F.col(at).alias("at"), page_fingerprint(F.col("html")).alias("page_hash"))
    # A null page has a fingerprint of its own, so that it can be compared.
    ready = marked.filter("key IS NOT NULL AND at IS NOT NULL").withColumn("page_hash", F.coalesce("page_hash", F.lit("")))
    told = ready.groupBy("key").transformWithStateInPandas(
        PageHistory(), "key string, at timestamp, page_hash string, change string, version bigint", "append", "None")
    writer = told.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start(target)


def page_changes(spark: SparkSession, target: str, key: str = "url", at: str = "seen_at") -> DataFrame:
    """Status of every snapshot that :func:`track_page_changes` has seen, corrected by the
    snapshots that came later."""
    written = spark.read.schema("key string, at timestamp, page_hash string, change string, version bigint").parquet(target)
    last = keep_first(written, ["key", "at"], [F.col("version").desc()])
    return last.select(F.col("key").alias(key), F.col("at").alias(at), "page_hash", "change")


def daily_counts(events: DataFrame, at: str = "created_at", watermark: str = "1 day") -> DataFrame:
    """Entries per calendar day and level, with the mean of ``value``."""
    return events.withWatermark(at, watermark).groupBy(F.window(at, "1 day").alias("w"), "level").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")
    ).select(F.col("w.start").alias("start"), "level", "n", "total")


def sliding_counts(events: DataFrame, at: str = "created_at", length: str = "24 hours", step: str = "1 hour",
                   watermark: str = "1 day") -> DataFrame:
    """Entries per sliding window and level."""
    return events.withWatermark(at, watermark).groupBy(F.window(at, length, step).alias("w"), "level").agg(
        F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "level", "n")


def drain_orders(spark: SparkSession, landed_texts: str, store: Store, checkpoint: str, allowed_hosts: DataFrame,
                 registry: DataFrame | None, aliases: DataFrame | None, as_of: Callable[[], Column],
                 files_per_batch: int = 50, once: bool = False, interval: str = "30 seconds") -> StreamingQuery:
    """Process pending orders as their texts land, a bounded number of files per round."""
    ddl = ("order_id string, text string, file_hash string, page_count int, ocr_method string, "
           "ocr_confidence double")
    stream = spark.readStream.schema(ddl).option("maxFilesPerTrigger", files_per_batch).parquet(landed_texts)

    def body(texts: DataFrame, number: int) -> None:
        batch = (_query_id(spark, checkpoint), number)
        orders = store.read("orders")
        once_each = keep_first(texts, ["order_id"], [F.col("file_hash")])
        waiting = orders.join(shuffled(once_each.select(F.col("order_id").alias("id"))), "id", "left_semi")
        done = process_orders(
            waiting, once_each, store.read("registry_sources").withColumn("id", F.col("code")),
            allowed_hosts, registry, aliases, as_of(), stored_orders=orders,
        )
        # Only what the round changes is written: the rows of its orders, then the orders.
        changed = orders.join(shuffled(done.updates.select("id")), "id", "left_semi")
        new_orders, _ = apply_processed(changed, done.rows, done, as_of())
        store.put("assignments", done.rows, processed_orders(done), batch)
        # The log before the orders: a stop in between repeats the round, whose log is in the ledger.
        store.append("processing_log", not_stored(done.log, store.read("processing_log"), ["id"]), batch)
        store.put("orders", new_orders, batch=batch)

    return _start(stream, body, checkpoint, once, interval)
