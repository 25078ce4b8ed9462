"""Consecutive numbers without bringing a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registry_spark.operators.lookups import partitions_of

CHUNK = 10_000


def number_rows(
    df: DataFrame,
    order_by: list[str],
    *,
    within: list[str] = (),
    name: str = "n",
    digits: int = 3,
    collapse: bool = True,
    finer: int = 1,
) -> DataFrame:
    """Number the rows 1..n per ``within`` group.

    Order: MD5 of the order columns' text, then the order columns. The first ``digits``
    hexadecimal digits cut each group, however large, into 16**digits buckets of
    even size; as they lead the order, their number changes no result (use 4 or more
    for groups beyond some terabytes). Cells, 16 to a bucket, are counted by a narrow aggregate, the running
    total of the buckets gives each its first number, and rows are ranked inside their
    bucket. Every number is a function of the rows alone, so a task that runs
    twice gives the same numbers and nothing has to be pinned between passes.

    Whole rows are shuffled once, without the hash, which is taken again where they arrive; a task holds
    about ``PART_BYTES`` of the files, however much is numbered (``partitions_of``). The sort with the hash takes over ten
    times that. ``finer`` partitions are for jobs that also read in small tasks (``session.more_partitions``), since a
    shuffle into very many partitions buffers what a task reads; it changes no number.

    ``order_by`` must tell different rows apart. Equal rows are interchangeable and fall into one cell: with
    ``collapse`` cells of more than ``CHUNK`` rows are counted again in 16 parts each (a group of 600 million distinct rows has none with
    three digits, and adaptive execution then leaves that pass out), and the rows of parts still as large (none up to 10 billion)
    are counted before the shuffle, cut into chunks that
    fall into different buckets, and expanded again after numbering, so that a row
    copied very often does not end up in one task. Leave it off when rows are
    known to be distinct. NULL and empty group values share one sequence.
    """
    groups = [f"__group{i}" for i in range(len(within))]
    columns = [F.col(f"`{c}`") for c in df.columns]
    parts = partitions_of(df, 16**digits // 4, finer)

    def hashed(chunk: Column) -> Column:
        return F.md5(F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in order_by], chunk.cast("string")))

    rows = df.select(
        *columns,
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(g) for c, g in zip(within, groups)],
        F.substring(hashed(F.lit(0)), 1, digits + 2).alias("__part"),
    ).withColumn("__cell", F.substring("__part", 1, digits + 1))
    cells = rows.groupBy(*groups, "__cell").agg(F.count(F.lit(1)).alias("__size"))
    bucket = F.substring("__cell", 1, digits).alias("__bucket")
    single = [F.lit(0).alias("__chunk"), F.lit(1).cast("bigint").alias("__size")]
    kept = [*columns, *groups]
    if collapse:
        crowded = F.broadcast(cells.filter(F.col("__size") > CHUNK).select(*groups, "__cell"))
        inner = rows.select(*groups, "__cell", "__part").join(crowded, [*groups, "__cell"], "left_semi")
        inner = inner.groupBy(*groups, "__cell", "__part").agg(F.count(F.lit(1)).alias("__size"))
        full = F.broadcast(inner.filter(F.col("__size") > CHUNK).select(*groups, "__part"))
        chunks = (
            rows.join(full, [*groups, "__part"], "left_semi")
            .groupBy(*kept)
            .agg(F.count(F.lit(1)).alias("__copies"))
            .withColumn("__chunk", F.explode(F.sequence(F.lit(0), F.expr(f"CAST((__copies - 1) div {CHUNK} AS INT)"))))
            .withColumn("__size", F.least(F.lit(CHUNK), F.col("__copies") - F.col("__chunk") * CHUNK).cast("bigint"))
            .withColumn("__bucket", F.substring(hashed(F.col("__chunk")), 1, digits))
            .drop("__copies")
        )
        seldom = rows.join(full, [*groups, "__part"], "left_anti").select(*kept, *single, bucket)
        rows = seldom.unionByName(chunks)
        few = [counted.filter(F.col("__size") <= CHUNK).select(*groups, bucket, "__size") for counted in (cells, inner)]
        sizes = few[0].unionByName(few[1]).unionByName(chunks.select(*groups, "__bucket", "__size"))
    else:
        rows = rows.select(*kept, *single, bucket)
        sizes = cells.select(*groups, bucket, "__size")

    before = Window.partitionBy(*groups).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sizes.groupBy(*groups, "__bucket")
        .agg(F.sum("__size").alias("__in_bucket"))
        .select(*groups, "__bucket", F.coalesce(F.sum("__in_bucket").over(before), F.lit(0)).alias("__start"))
    )
    keys = [*groups, "__bucket"]
    dealt = (rows.repartition(parts, *keys) if parts else rows.repartition(*keys)).withColumn("__hash", hashed(F.col("__chunk")))
    order = [F.col("__hash"), *[F.col(f"`{c}`") for c in order_by], F.col("__chunk")]
    inside = Window.partitionBy(*keys).orderBy(*order)
    if collapse:
        earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
        rank = F.coalesce(F.sum("__size").over(earlier), F.lit(0))
        earlier_rows = F.col("__start") + F.col("__rank")
        number = F.explode(F.sequence(earlier_rows + 1, earlier_rows + F.col("__size")))
    else:
        rank = F.row_number().over(inside)
        number = (F.col("__start") + F.col("__rank")).cast("bigint")
    ranked = dealt.withColumn("__rank", rank)
    return ranked.join(starts, keys).select(*columns, number.alias(name))
