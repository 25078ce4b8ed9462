"""Exact top-k search by inner product in tiles (operator 7)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry_spark.llm.tasks import ship

# Rows of a tile: queries by candidates.
QUERY_ROWS, SHARD_ROWS = 1_024, 4_096
FAN_IN = 32
EXACT = float(2**53)
LONG = 2**63 - 1


def usable(vectors: DataFrame, id: str, vector: str, transform) -> DataFrame:
    """id and transformed components; vectors that are NULL or hold a NULL or non-finite component are left out."""
    x = F.col(f"`{vector}`")
    bad = lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == F.lit(math.inf))
    good = x.isNotNull() & F.col(f"`{id}`").isNotNull() & ~F.exists(x, bad)
    return vectors.filter(F.coalesce(good, F.lit(False))).select(
        F.col(f"`{id}`").cast("long").alias("id"), F.transform(x, lambda v: transform(v.cast("double")).cast("double")).alias("v")
    )


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten(), np.float64).reshape(-1, dims)


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """All inner products of whole numbers, exact; beyond a long they stop at its ends."""
    bound = np.abs(queries).max(initial=0) * np.abs(shard).max(initial=0) * max(queries.shape[1], 1)
    if bound < EXACT:
        return (queries @ shard.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m.tolist()], object).reshape(m.shape)
    return np.clip(whole(queries) @ whole(shard).T, -LONG, LONG).astype(np.int64)


def tile_top(query_ids: np.ndarray, shard_ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best candidates of each query of a tile, ties to the smaller id; rows (query, candidate, score).

    ``shard_ids`` ascend. A partial selection finds each query's k-th score; only candidates from that score on are sorted.
    """
    scores = scores.copy()
    own = query_ids[:, None] == shard_ids[None, :]
    least = np.iinfo(np.int64).min
    scores[own] = least
    if scores.shape[1] > k:
        limit = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    else:
        limit = np.full(len(scores), least)
    q, c = np.nonzero((scores >= limit[:, None]) & ~own)
    value = scores[q, c]
    order = np.lexsort((c, -value, q))
    q, c, value = q[order], c[order], value[order]
    starts = np.searchsorted(q, np.arange(len(query_ids)))
    best = np.arange(len(q)) - starts[q] < k
    return query_ids[q[best]], shard_ids[c[best]], value[best]


def top_k(
    vectors: DataFrame, queries: Column, k: int, *, id: str = "vec_id", vector: str = "embedding", transform=lambda v: v
) -> DataFrame:
    """query_id, rank, ``id``, score: each query's ``k`` largest inner products with all other rows.

    ``queries`` selects the query rows by their columns; ``transform`` gives each component as a whole number held in a
    double. Ties go to the smaller id. Rows with the query's id are no candidates; vectors of different length do not
    meet; rows repeated with equal id and vector count once. Unusable vectors (``usable``) and rows
    without an id take no part. Fewer candidates than ``k`` give fewer rows, an empty table none.

    Queries are cut into groups and candidates into shards by a hash of the id; every pair of
    them is one tile of bounded size in one task, and the lists of a query are merged ``FAN_IN`` at a time.
    """
    spark = ship(vectors.sparkSession)
    columns = [F.col(f"`{id}`").alias(id), F.col(f"`{vector}`").alias(vector)]
    rows = usable(vectors.select(*columns), id, vector, transform).distinct()
    asked = usable(vectors.filter(queries).select(*columns), id, vector, transform).distinct()
    n, m = rows.count(), asked.count()
    shards, groups = max(1, -(-n // SHARD_ROWS)), max(1, -(-m // QUERY_ROWS))
    place = lambda parts, seed: F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.lit(parts)).cast("int")
    cell = ["group", "shard", "dims"]
    left = asked.select(
        "id", "v", F.size("v").alias("dims"), place(groups, 1).alias("group"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    )
    right = rows.select(
        "id", "v", F.size("v").alias("dims"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"), place(shards, 2).alias("shard")
    )

    def tile(key, a: pa.Table, b: pa.Table) -> pa.Table:
        dims = key[2].as_py()
        b = b.sort_by("id")
        parts = [
            tile_top(
                np.array(part.column("id")), np.array(b.column("id")),
                products(matrix(part.column("v"), dims), matrix(b.column("v"), dims)) if dims else np.zeros((part.num_rows, b.num_rows), np.int64), k,
            )
            for part in (a.slice(i, QUERY_ROWS) for i in range(0, a.num_rows if b.num_rows else 0, QUERY_ROWS))
        ]
        q, c, s = (np.concatenate([p[i] for p in parts] or [np.zeros(0, np.int64)]) for i in range(3))
        return pa.table({"query_id": q, "candidate": c, "score": s, "shard": np.full(len(q), key[1].as_py(), np.int32)})

    lists = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(tile, "query_id long, candidate long, score long, shard int")
    entry = F.struct((-F.col("score")).alias("minus"), F.col("candidate").alias("candidate"))
    merged = lists.groupBy("query_id", "shard").agg(F.slice(F.sort_array(F.collect_list(entry)), 1, k).alias("best"))
    while shards > 1:
        shards = -(-shards // FAN_IN)
        merged = merged.groupBy("query_id", F.expr(f"shard div {FAN_IN}").cast("int").alias("shard")).agg(
            F.slice(F.sort_array(F.flatten(F.collect_list("best"))), 1, k).alias("best")
        )
    return merged.select("query_id", F.posexplode("best").alias("place", "entry")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("entry.candidate").alias(id), (-F.col("entry.minus")).alias("score")
    )
