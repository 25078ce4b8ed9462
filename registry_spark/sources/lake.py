"""Published tables: partitioned datasets, monthly snapshots, lake tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry_spark.schema import PUBLISHED, SLIM_SERVICE_COLUMNS
from registry_spark.sources.versions import VersionedTable

# Text as it is: a header, doubled quotes, blanks around values kept.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_partitions(df: DataFrame, path: str, column: str, file_format: str = "parquet") -> None:
    """Replace the partitions present in ``df`` and leave the others alone."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column)
    if file_format == "csv":
        writer = writer.options(**CSV)
    writer.format(file_format).save(path)


def write_country_tables(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    write_partitions(df, path, "country", file_format)


def write_snapshot(df: DataFrame, path: str, month: dt.date) -> str:
    """Monthly snapshot: this month is replaced, earlier months are kept."""
    label = month.strftime("%Y-%m")
    write_partitions(df.withColumn("snapshot_month", F.lit(label)), path, "snapshot_month")
    return f"{path}/snapshot_month={label}"


def empty_country(df: DataFrame, path: str, country: str, *, column: str = "country") -> None:
    """Leave a country's partition without rows; ``df`` gives the columns."""
    df.limit(0).drop(column).write.mode("overwrite").parquet(f"{path}/{column}={country}")


def replace_table(df: DataFrame, name: str, path: str | None = None, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def bucketed_table(df: DataFrame, name: str, keys: list[str], buckets: int, path: str) -> DataFrame:
    """A table dealt and sorted by ``keys``, which joins and aggregates by these keys read without a shuffle.

    Rows are dealt to the buckets before they are written, so there is one file a bucket. For state that every run
    joins with, such as the identifier registry; take as many buckets as the joins have shuffle partitions, or a multiple.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def point_table(spark: SparkSession, name: str, path: str) -> None:
    """Replace a table by one over files that are already written: no second copy.

    A table that has these columns already is moved to the files in one step, so that readers never miss it;
    ``point_view`` does that for any columns.
    """
    columns = spark.read.parquet(path).schema.simpleString()
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType == "VIEW":
            point_view(spark, name, path)
            return
        if spark.table(name).schema.simpleString() == columns:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, path=path, source="parquet")


def point_view(spark: SparkSession, name: str, path: str) -> None:
    """Let a name stand for files that are already written, whatever their columns, by one change of the catalog.

    A table of that name, as earlier releases left, is dropped once.
    """
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")


def publish(
    df: DataFrame, name: str, root: str, *, partition_by: str | None = None, check: Callable[[DataFrame], None] | None = None
) -> DataFrame:
    """Write ``df`` aside, let ``check`` look at the files, then point the name at them.

    A job or check that fails leaves the name as it was. The list of versions below ``root`` tells the last
    published files of every name, also to another session (``restore``).
    """
    path = aside(name, root)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return publish_files(df.sparkSession, name, root, path, check=check)


def aside(name: str, root: str) -> str:
    """A new folder for files of a published name, which nobody reads before ``publish_files``."""
    return f"{root}/{name}/{uuid.uuid4().hex}"


def publish_files(
    spark: SparkSession, name: str, root: str, path: str, *, check: Callable[[DataFrame], None] | None = None
) -> DataFrame:
    """As ``publish``, of files that are already written aside, by one job or several: no second copy."""
    if check is not None:
        check(spark.read.parquet(path))
    now = dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    VersionedTable(spark, f"{root}/versions", PUBLISHED).update(lambda _: spark.createDataFrame([(name, path, now)], PUBLISHED))
    point_view(spark, name, path)
    return spark.table(name)


def restore(spark: SparkSession, root: str) -> list[str]:
    """Point every published name at its last files, as after a restart of the catalog; files never published stay unseen."""
    table = VersionedTable(spark, f"{root}/versions", PUBLISHED)
    last = {}
    for commit in table.commits():
        for row in table.staged(commit["data"]).collect():  # one row a publication
            last[row["name"]] = row["path"]
    for name, path in last.items():
        point_view(spark, name, path)
    return sorted(last)


def write_slim_services(df: DataFrame, path: str, countries: list[str] | None = None) -> None:
    """The slim table, partition by partition if the countries are known: a constant country spares the sort of whole rows by it."""
    slim = df.select(*SLIM_SERVICE_COLUMNS)
    if countries is None:
        write_partitions(slim, path, "country_iso")
    for iso in countries or ():
        write_partitions(slim.filter(F.col("country_iso") == iso).withColumn("country_iso", F.lit(iso)), path, "country_iso")


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def stored_bytes(spark: SparkSession, path: str) -> DataFrame:
    """Files and megabytes under a path, from file metadata only."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("length")
    )
    return files.agg(F.count(F.lit(1)).alias("files"), (F.sum("length") / F.lit(1e6)).alias("mb"))


def size_saving(spark: SparkSession, columnar: str, text: str) -> DataFrame:
    """Percent by which the snapshot is smaller than the text copy."""
    a = stored_bytes(spark, columnar).select(F.col("mb").alias("snapshot_mb"))
    b = stored_bytes(spark, text).select(F.col("mb")).scalar()
    return a.withColumn("text_mb", b).withColumn(
        "pct_smaller", F.round((F.lit(1.0) - F.col("snapshot_mb") / F.col("text_mb")) * 100, 1)
    )


def list_tables(spark: SparkSession) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables())
