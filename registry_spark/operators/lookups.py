"""Left joins from long fact tables to lookup tables with one row per key."""

from __future__ import annotations

from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METHODS = ("auto", "broadcast", "shuffle")
# Bytes of files, as stored, whose rows one task of a shuffle should hold.
PART_BYTES = 16 << 20


def spread(df: DataFrame) -> DataFrame:
    """Rows of a table as read dealt out evenly when it has fewer files than cores, else unchanged.

    For steps that cost much per row over a small table in few files; a large
    table has more files than cores and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def partitions_of(df: DataFrame, most: int, finer: int = 1) -> int | None:
    """Partitions for a shuffle of all rows, by the size of the files that ``df`` reads; at most ``most``.

    None when the session's number is enough, or nothing is read from files; else ``finer`` times as many,
    for tasks that hold rows much wider than in the files. Only file metadata is looked at.
    """
    files = df.inputFiles()
    if not files:
        return None
    stored = df.sparkSession.read.format("binaryFile").load([unquote(f) for f in files]).agg(F.sum("length")).first()[0] or 0
    wanted = -(-stored // PART_BYTES)
    return min(most, wanted * finer) if min(most, wanted) > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[tuple[str, str]],
    *,
    null_safe: bool = False,
    method: str = "auto",
) -> DataFrame:
    """Add the lookup's other columns to every fact row; no match leaves them NULL.

    ``on`` pairs fact columns with lookup columns; the lookup has one row per key. With ``null_safe`` a NULL key
    matches a NULL key. Facts are read once and no job runs while the plan is built. Methods:

    * ``auto`` - the optimizer decides by its statistics, and again by the sizes seen when the join runs;
    * ``broadcast`` - the lookup is bounded by construction; facts are not shuffled;
    * ``shuffle`` - the lookup is known to be large: a merge join. Partitions that a frequent
      key or NULL keys make large are split by adaptive execution, with the few lookup rows that go with them repeated.
    """
    if method not in METHODS:
        raise ValueError(f"unknown join method: {method}")
    fact_keys = [f for f, _ in on]
    keys = [f"__key{i}" for i in range(len(on))]
    payload = [c for c in lookup.columns if c not in {l for _, l in on}]
    clash = {c.lower() for c in facts.columns} & {c.lower() for c in payload}
    if clash:
        raise ValueError(f"lookup columns already in the facts: {sorted(clash)}")
    table = lookup.select(
        *[F.col(f"`{l}`").alias(k) for (_, l), k in zip(on, keys)],
        *[F.col(f"`{c}`") for c in payload],
    )

    def match(safe: bool) -> Column:
        tests = [(F.col(f"`{f}`"), F.col(k)) for f, k in zip(fact_keys, keys)]
        return reduce(lambda x, y: x & y, [a.eqNullSafe(b) if safe else a == b for a, b in tests])

    if method != "auto":
        table = table.hint("broadcast" if method == "broadcast" else "merge")
    return facts.join(table, match(null_safe), "left").drop(*keys)


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """One row per key, the smallest by ``order_by``.

    An aggregate with a map-side combine, so a key with very many copies is
    reduced where it is read; a window would bring all its rows into one task.
    The remaining columns break ties.
    """
    rest = [c for c in df.columns if c not in {*keys, *order_by}]
    ranked = F.struct(*[F.col(f"`{c}`") for c in [*order_by, *rest]])
    return (
        df.groupBy(*keys)
        .agg(F.min(ranked).alias("__first"))
        .select(*keys, "__first.*")
        .select(*[F.col(f"`{c}`") for c in df.columns])
    )
