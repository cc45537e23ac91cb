"""Streams with lasting state: late snapshots, restarts, intake over several runs."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from decreta.functions.pages import page_fingerprint
from decreta.operators.ordering import change_status, keep_first
from decreta.streaming import jobs as J

PAGE = "url string, seen_at timestamp, html string"


def test_late_snapshots_equal_the_batch_form(spark, tmp_path):
    rng = random.Random(6)
    start = datetime(2024, 1, 1)
    rows = [(f"u{i % 7}", start + timedelta(hours=rng.randint(0, 60)), f"<p>{rng.randint(0, 2)}</p>") for i in range(150)]
    rows += [("u1", start, None), (None, start, "<p>x</p>"), ("u1", None, "<p>x</p>"), rows[0], rows[1]]
    rng.shuffle(rows)
    at = {}
    for wave in range(3):  # each run starts again from the checkpoint
        part = rows[wave::3]
        spark.createDataFrame(part, PAGE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(PAGE).parquet(str(tmp_path / "in"))
        J.track_page_changes(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), once=True).awaitTermination()
        prints = spark.createDataFrame(part, PAGE).filter("url IS NOT NULL AND seen_at IS NOT NULL").select(
            "url", "seen_at", F.coalesce(page_fingerprint(F.col("html")), F.lit("")).alias("page_hash")).collect()
        for r in sorted(prints, key=lambda r: r.page_hash):
            at.setdefault((r.url, r.seen_at), r.page_hash)
    known = spark.createDataFrame([(*k, v) for k, v in at.items()], "url string, seen_at timestamp, page_hash string")
    expected = change_status(keep_first(known, ["url", "seen_at"], [F.col("page_hash")]), "url", "seen_at", "page_hash").select("url", "seen_at", "page_hash", "change")
    got = J.page_changes(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    # The last round told of the pages it touched, not of all that came before.
    assert spark.read.parquet(str(tmp_path / "out")).count() < 3 * got.count()


def test_intake_remembers_over_restarts_on_disk(spark, tmp_path):
    for run in range(2):
        spark.range(3000 * (run + 1)).select(F.concat(F.lit("h"), F.col("id") % (1000 * (run + 1))).alias("file_hash")).write.mode("append").parquet(str(tmp_path / "in"))
        files = spark.readStream.schema("file_hash string").parquet(str(tmp_path / "in"))
        query = J.distinct_documents(files).writeStream.outputMode("append").format("parquet").trigger(availableNow=True).option(
            "checkpointLocation", str(tmp_path / "ckpt")).start(str(tmp_path / "out"))
        query.awaitTermination()
        state = query.lastProgress["stateOperators"][0]
        assert state["numRowsTotal"] == 1000 * (run + 1) and any(k.startswith("rocksdb") for k in state["customMetrics"])
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == got.distinct().count() == 2000
