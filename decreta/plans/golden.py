"""Golden sets: expected against actual results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def golden_check(expected: DataFrame, actual: DataFrame, key: str = "doc_id") -> DataFrame:
    """Row-count difference per file: pass up to 2, warn up to 5, else fail.

    ``expected`` and ``actual`` have ``key`` and ``record_count``.
    """
    joined = expected.select(key, F.col("record_count").alias("expected_count")).join(
        actual.select(key, F.col("record_count").alias("actual_count")), key, "full_outer"
    ).na.fill(0, ["expected_count", "actual_count"])
    delta = F.col("actual_count") - F.col("expected_count")
    return joined.withColumn("delta", delta).withColumns({
        "match": F.col("delta") == 0,
        "status": F.when(F.abs("delta") <= 2, "pass").when(F.abs("delta") <= 5, "warn").otherwise("fail"),
    })


def golden_diff(expected: DataFrame, actual: DataFrame, key: Sequence[str],
                compare: Sequence[str]) -> DataFrame:
    """Row-level difference: missing, unexpected and changed rows with the changed fields."""
    e = expected.select(*key, F.struct(*compare).alias("expected"))
    a = actual.select(*key, F.struct(*compare).alias("actual"))
    both = e.join(a, list(key), "full_outer")
    fields = F.array_compact(F.array(*[
        F.when(~F.col(f"expected.{c}").eqNullSafe(F.col(f"actual.{c}")), F.lit(c)) for c in compare]))
    return both.withColumns({
        "change": F.when(F.col("actual").isNull(), "missing").when(F.col("expected").isNull(), "unexpected")
                   .when(F.size(fields) > 0, "changed"),
        "fields": F.when(F.col("expected").isNotNull() & F.col("actual").isNotNull(), fields),
    }).filter(F.col("change").isNotNull())


def expected_snapshot(actual: DataFrame, key: str = "doc_id") -> DataFrame:
    """Current results saved as the next expected counts."""
    return actual.groupBy(key).agg(F.count(F.lit(1)).cast("int").alias("record_count"))
