"""Session, staging and size-check helpers shared by every job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is copied to every task only below this many bytes.
SMALL_SIDE_BYTES = 32 * 1024 * 1024


def local_session(app: str = "decreta", cores: str = "*", **conf: str) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints and staged tables.

    Only a session that names none (a local test) gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not named:
        named = tempfile.mkdtemp(prefix="spark-decreta-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several branches read the same expensive intermediate table. Files
    survive the loss of any executor, and every branch prunes columns on re-read.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan; runs no job."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_checked(df: DataFrame, limit: int = SMALL_SIDE_BYTES) -> DataFrame:
    """Hint a broadcast only when the estimated size is within ``limit``.

    Beyond it the plan is left to a shuffled join, which AQE splits on skew.
    """
    return F.broadcast(df) if estimated_bytes(df) <= limit else df


def shuffled(df: DataFrame) -> DataFrame:
    """Mark a side of a join that has rows for every document or order: it is never copied whole.

    Catalyst judges a side by the bytes of its files. Running ids and equal texts pack so well
    that rows within its limit take a hundred times as much in the driver, which gathers them.
    """
    return df.hint("merge")
