"""Run log: one row per step, appended to a log table at the end of a run; counters of the steps beside it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry_spark.schema import RUN_COUNTERS, RUN_LOG


class RunLog:
    """Collects step outcomes; ``flush`` appends them in one small write."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark = spark
        self.path = path
        self.rows: list[tuple[str, str, str, str, str]] = []
        self.flushed = 0
        self.counters: list[tuple[str, str, str, str, int]] = []

    def add(self, country: str, step: str, status: str, message: str = "") -> None:
        now = dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
        self.rows.append((now, country, step, status, str(message)))

    def count(self, country: str, step: str, **counters: int) -> None:
        """Counters of a step: a row each in the table beside the log."""
        now = dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
        self.counters += [(now, country, step, name, int(n)) for name, n in counters.items()]

    def table(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, RUN_LOG)

    def failed(self) -> list[str]:
        return sorted({country for _, country, _, status, _ in self.rows if status == "FAILED"})

    def flush(self) -> None:
        new = self.rows[self.flushed:]
        if self.path and new:
            self.spark.createDataFrame(new, RUN_LOG).coalesce(1).write.mode("append").parquet(self.path)
            self.flushed = len(self.rows)
        if self.path and self.counters:
            self.spark.createDataFrame(self.counters, RUN_COUNTERS).coalesce(1).write.mode("append").parquet(counters_path(self.path))
            self.counters = []


def counters_path(path: str) -> str:
    """Where the counters of a log are."""
    return f"{path}_counters"


def failed_steps(log: DataFrame) -> DataFrame:
    """Countries and steps that failed, with how often."""
    return (
        log.filter(F.col("status") == "FAILED")
        .groupBy("country", "step")
        .agg(F.count(F.lit(1)).alias("n"), F.max("timestamp").alias("last"))
    )
