"""Counts and times of the steps of a run, taken while the steps write their tables."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from decreta.session import staged

STEP = "stage string, duration_ms long, counts map<string,long>"


class StepLog:
    """Clock and counters of one run.

    ``write`` stages a table and observes counts over its rows in the same job, so no
    row is read again to be counted. A step's time runs from the end of the step before
    it: jobs that the plan of a step starts while it is built belong to the step.
    """

    def __init__(self):
        self._since = time.monotonic()
        self._steps: list[tuple[str, int, dict[str, int]]] = []

    def write(self, df: DataFrame, stage: str, **counts: Column) -> DataFrame:
        """``df``, staged; ``counts`` are conditions whose rows are counted."""
        seen = Observation(f"step-{stage}")
        # The observed name must not clash with a column of the table.
        measures = [F.count_if(c).alias(f"n_{name}") for name, c in counts.items()]
        out = staged(df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *measures), stage)
        now = time.monotonic()
        found = {name.removeprefix("n_"): int(n or 0) for name, n in seen.get.items()}
        self._steps.append((stage, int(1000 * (now - self._since)), found))
        self._since = now
        return out

    def duration(self, stage: str) -> int:
        """Milliseconds of a step; 0 where it did not run."""
        return sum(ms for name, ms, _ in self._steps if name == stage)

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per step: ``stage, duration_ms, counts``."""
        return spark.createDataFrame(self._steps, STEP)
