"""Joins on keys of which some hold very many rows: the heavy ones are found by a sketch and dealt out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry_spark.sources.shared import written

# A sketch of TRACKED items is off by less than a 4,000th of all rows, so no key above a LISTED-th is missed.
TRACKED, LISTED = 8_192, 1_000
KEY_TYPES = {"string", "tinyint", "smallint", "int", "bigint", "date"}


def heavy_keys(facts: DataFrame, key: str, *, share: float | None = None) -> DataFrame:
    """Keys with more than ``share`` of all rows, and in how many parts of that size: heavy_key (text), parts.

    One frequent-items sketch over the key column, merged from those of the tasks; the list holds at most LISTED
    keys. ``share`` is a shuffle partition's part of the rows unless given, and never below a LISTED-th. The list is
    written: both sides of a join must read the same one.
    """
    if share is None:
        share = 1 / int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    floor = max(share, 1 / LISTED)
    item = F.col(f"`{key}`").cast("string")
    counted = facts.select(item.alias("k")).filter("k IS NOT NULL").agg(
        F.expr(f"approx_top_k(k, {LISTED}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n"))
    rows = counted.select("n", F.explode("top").alias("t")).select(
        F.col("t.item").alias("heavy_key"), F.ceil(F.col("t.count") / (F.col("n") * floor)).cast("int").alias("parts"))
    return written(rows.filter("parts > 1"))


def dealt(facts: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    """``facts`` with ``__part``: rows of a heavy key in turn over its parts, all others in part 0.

    ``facts`` must be a table as read, so that a task that runs again meets its rows in the same order.
    """
    known = facts.join(F.broadcast(heavy), F.col(f"`{key}`").cast("string") == F.col("heavy_key"), "left")
    turn = F.pmod(F.monotonically_increasing_id(), F.coalesce("parts", F.lit(1))).cast("int")
    return known.withColumn("__part", turn).drop("heavy_key", "parts")


def copied(other: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    """``other`` with ``__part``: rows of a heavy key once a part, all others once."""
    known = other.join(F.broadcast(heavy), F.col(f"`{key}`").cast("string") == F.col("heavy_key"), "left")
    part = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    return known.withColumn("__part", part).drop("heavy_key", "parts")


def join_heavy(facts: DataFrame, other: DataFrame, key: str, *, share: float | None = None) -> DataFrame:
    """Inner join on ``key`` in which no task gets more than ``share`` of the facts for one key.

    The result does not depend on what the sketch finds. ``facts`` is written first, with the columns it has; give
    it only those needed. NULL keys match nothing. Keys are of one type on both sides, of those in KEY_TYPES, whose
    values are equal when their texts are.
    """
    kinds = {df.schema[key].dataType.simpleString() for df in (facts, other)}
    if len(kinds) > 1 or not kinds <= KEY_TYPES:
        raise ValueError(f"keys of types {sorted(kinds)} cannot be joined by parts")
    table = written(facts.filter(F.col(f"`{key}`").isNotNull()))
    heavy = heavy_keys(table, key, share=share)
    return dealt(table, key, heavy).join(copied(other, key, heavy), [key, "__part"]).drop("__part")
