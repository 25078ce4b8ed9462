"""Session for local work; on a cluster use the session the cluster gives."""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import SparkSession


# The JVM never compiles methods above this size; rows then run interpreted, several
# times slower. With the limit Spark generates many small methods for such plans.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


@contextmanager
def small_methods(spark: SparkSession):
    """Run wide projections as compiled code; the session's setting is restored after."""
    key, limit = METHOD_LIMIT
    before = spark.conf.get(key)
    spark.conf.set(key, limit)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def more_partitions(spark: SparkSession, n: int | None):
    """Run jobs with ``n`` shuffle partitions, if given and more than the session has; the settings are restored after.

    Unlike a repartition by key it leaves adaptive execution free to join and to split the partitions; it does not bring
    them together again. Files are read in as many tasks, so that one does not buffer, and spill, many partitions' worth of
    rows for a shuffle; small files stay whole.
    """
    key = "spark.sql.shuffle.partitions"
    settings = {key: str(max(int(spark.conf.get(key)), n or 0))}
    if n:
        scan = "spark.sql.files.minPartitionNum"
        settings[scan] = str(max(int(spark.conf.get(scan, None) or spark.sparkContext.defaultParallelism), n))
        settings["spark.sql.adaptive.coalescePartitions.enabled"] = "false"
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, value in settings.items():
        spark.conf.set(k, value)
    try:
        yield
    finally:
        for k, value in before.items():
            if value is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, value)


def local_session(
    name: str = "registry_spark",
    cores: str | int = "*",
    checkpoint_dir: str | None = None,
    warehouse: str | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", os.environ.get("SHUFFLE_PARTITIONS", "8"))
        .config("spark.sql.adaptive.enabled", "true")
        .config(*METHOD_LIMIT)
        .config("spark.driver.memory", os.environ.get("DRIVER_MEMORY", "8g"))
    )
    if checkpoint_dir:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    if warehouse:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
