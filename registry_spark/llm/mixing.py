"""Mixing sources to target weights by a low-discrepancy schedule (operator 2).

Each source's documents are put in hash order and their words cut into blocks of equal
size. Slot j of the mix goes to the source whose share of [0, 1) holds the j-th van der
Corput point; its rank among the slots of that source tells which block it takes, the
blocks being repeated in order when a source is to be taken more than once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registry_spark.llm.tasks import arrow, record
from registry_spark.sources.shared import written

WEIGHTS, SHARE, LIMIT = (5.0, 2.0, 1.0), 1.5, 2.0
BLOCK = 4_096
BUCKET_ROWS = 500
SLOTS_PER_TASK = 1 << 20
# Sources whose list goes through the driver (``Mix``); longer lists are worked out as tables (``TableMix``).
MAX_SOURCES = 100_000
# Points of a source that become slots at once.
PIECE_POINTS = 1 << 16
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(
    sizes: list[int], weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT
) -> list[float]:
    """Words to take of each source: ``share`` of all words by repeating weights, none above ``limit`` times its size."""
    wish = [weights[i % len(weights)] for i in range(len(sizes))]
    targets = [0.0] * len(sizes)
    rest, open_ = min(share, limit) * sum(sizes), set(range(len(sizes)))
    while open_:
        unit = rest / sum(wish[i] for i in open_)
        full = {i for i in open_ if unit * wish[i] > limit * sizes[i]}
        if not full:
            for i in open_:
                targets[i] = unit * wish[i]
            break
        for i in full:
            targets[i] = float(limit * sizes[i])
            rest -= targets[i]
        open_ -= full
    return [max(0.0, t) for t in targets]


@dataclass
class Source:
    """A source's size in words, its target, and what follows from them."""

    name: str | None
    size: int
    target: float

    @property
    def quota(self) -> int:
        return min(round(self.target), round(LIMIT * self.size)) if self.size else 0

    def slots(self, block: int) -> int:
        """Blocks that hold the first ``quota`` words of the source said over and over."""
        if not self.quota:
            return 0
        passes, rest = divmod(self.quota, self.size)
        return passes * -(-self.size // block) + -(-rest // block)


def count_below(n: int, limits: np.ndarray, bits: int) -> np.ndarray:
    """How many of the first ``n`` van der Corput points, as integers of ``bits`` bits, lie below each limit."""
    out = np.zeros(len(limits), np.int64)
    done = 0
    for b in range(bits, -1, -1):
        if n >> b & 1:
            # The 2**b numbers from ``done`` on reverse to r, r + step, r + 2 step, ...
            step = 1 << (bits - b)
            r = int(reverse_bits(np.array([done], np.int64), bits)[0]) if b < bits else 0
            out += np.clip(-((r - limits) // step), 0, 1 << b)
            done += 1 << b
    return out


def reverse_bits(x: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros_like(x)
    for b in range(bits):
        out |= ((x >> b) & 1) << (bits - 1 - b)
    return out


def schedule(spark: SparkSession, sources: list[Source], block: int = BLOCK) -> DataFrame:
    """Slots of the mix: slot, source (its place in ``sources``), rank, block, n (words taken from the block's start).

    The rank of a slot needs no shuffle: how many earlier points fell to a source has a
    closed form. Points give every source its number of slots but for a few; those beyond
    are left out, those missing are appended at the end.
    """
    size = np.array([s.size for s in sources], np.int64)
    quota = np.array([s.quota for s in sources], np.int64)
    need = np.array([s.slots(block) for s in sources], np.int64)
    total = int(need.sum())
    bits = max(1, (max(total, 1) - 1).bit_length())
    edges = [0]
    for n in need.tolist():
        edges.append(edges[-1] + n)
    limits = np.array([(e << bits) // max(total, 1) for e in edges], np.int64)
    given = np.diff(count_below(total, limits, bits))
    missing = np.concatenate(([0], np.cumsum(np.maximum(need - given, 0))))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        slots = np.array(batch.column(0), np.int64)
        by_point, appended = slots[slots < total], slots[slots >= total] - total
        source = np.searchsorted(limits[1:], reverse_bits(by_point, bits), "right")
        rank = np.zeros(len(by_point), np.int64)
        if len(by_point):
            # The slots of a batch follow one another.
            order = np.argsort(source, kind="stable")
            counts = np.bincount(source, minlength=len(need))
            inside = np.arange(len(order)) - np.repeat(np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
            rank[order] = inside
            rank += np.diff(count_below(int(by_point[0]), limits, bits))[source]
        late = np.searchsorted(missing[1:], appended, "right")
        source, rank = np.concatenate((source, late)), np.concatenate((rank, given[late] + appended - missing[late]))
        used = rank < need[source]
        slots, source, rank = slots[used], source[used], rank[used]
        blocks = -(-size[source] // block)
        turn, number = rank // blocks, rank % blocks
        start = number * block
        n = np.minimum(np.minimum(block, size[source] - start), quota[source] - turn * size[source] - start)
        yield record(slot=slots, source=source, rank=rank, block=number, n=n)

    count = total + int(missing[-1])
    slots = spark.range(0, count, 1, max(1, -(-count // SLOTS_PER_TASK)))
    return arrow(slots, run, "slot long, source long, rank long, block long, n long")


def sized(documents: DataFrame, *, id: str, text: str, source: str, seed: int = 0) -> DataFrame:
    """Narrow rows: id, source, size in words, and the hash that orders a source's documents."""
    return documents.select(
        F.col(f"`{id}`").alias("id"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        shuffle_key(id, text, seed).alias("hash"),
    )


def shuffle_key(id: str, text: str, seed: int = 0) -> Column:
    return F.xxhash64(F.lit(seed), F.col(f"`{id}`"), F.col(f"`{text}`"))


class Mix:
    """The mix of a table of documents.

    Rows with a NULL source are a source of their own, the last. NULL and empty texts have
    no words and are never taken; equal rows are separate documents. An empty table gives
    an empty mix. Other columns are not read.
    """

    def __init__(
        self, documents: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK,
        rows: DataFrame | None = None,
    ):
        spark = documents.sparkSession
        self.block = block
        rows = written(sized(documents, id=id, text=text, source=source)) if rows is None else rows
        totals = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows")).limit(MAX_SOURCES + 1).collect()
        if len(totals) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources")
        totals.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
        targets = source_targets([r["size"] for r in totals])
        self.sources = [Source(r["source"], r["size"], t) for r, t in zip(totals, targets)]
        listed = spark.createDataFrame(
            [(i, s.name, s.size, s.target) for i, s in enumerate(self.sources)],
            "number long, name string, source_size long, target double",
        )
        bits = max(0, (sum(r["rows"] for r in totals) // BUCKET_ROWS).bit_length())
        self.rows = rows.join(F.broadcast(listed), F.col("source").eqNullSafe(F.col("name"))).select(
            "id", F.col("number").alias("source"), "source_size", "target", "size", "hash",
            (F.shiftright("hash", 64 - bits) if bits else F.lit(0).cast("long")).alias("bucket"),
        )
        self.slots = schedule(spark, self.sources, block)

    def offsets(self) -> DataFrame:
        """Documents with words, each with the number of words of its source before it."""
        some = self.rows.filter("size > 0")
        before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        starts = some.groupBy("source", "bucket").agg(F.sum("size").alias("inside")).select(
            "source", "bucket", F.coalesce(F.sum("inside").over(before), F.lit(0)).alias("start")
        )
        inside = Window.partitionBy("source", "bucket").orderBy("hash", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
        running = some.withColumn("running", F.sum("size").over(inside) - F.col("size"))
        return running.join(starts, ["source", "bucket"]).withColumn("offset", F.col("start") + F.col("running"))

    def pieces(self) -> DataFrame:
        """Documents cut at block ends: block, first and last word of the piece in its block (end exclusive)."""
        last = F.expr(f"(offset + size - 1) div {self.block}")
        first = F.expr(f"offset div {self.block}")
        cut = self.offsets().withColumn("block", F.explode(F.sequence(first, last)))
        base = F.col("block") * self.block
        return cut.withColumn("first", F.greatest(F.col("offset") - base, F.lit(0))).withColumn(
            "last", F.least(F.col("offset") + F.col("size") - base, F.lit(self.block))
        )

    def taken_pieces(self) -> DataFrame:
        """The mix: every piece with each slot that takes words of it; slot NULL where none does."""
        joined = self.pieces().join(self.slots.select("slot", "source", "block", "n"), ["source", "block"], "left")
        words = F.greatest(F.least("last", "n") - F.col("first"), F.lit(0))
        return joined.withColumn("words", F.when(F.col("slot").isNull(), F.lit(0)).otherwise(words))

    def taken(self) -> DataFrame:
        """Per document: id, size, source_size, target, hash, taken."""
        keys = ["id", "size", "source_size", "target", "hash"]
        with_words = self.taken_pieces().groupBy("source", "offset", *keys).agg(F.sum("words").alias("taken"))
        without = self.rows.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))
        return with_words.select(*keys, "taken").unionByName(without.select(*keys, "taken"))


def numbered_sources(rows: DataFrame) -> tuple[DataFrame, int]:
    """Sources in order of name, NULL last: name, size, rows, number, part; and how many rows there are.

    Names are dealt by range and sorted; counts of those few parts give each its first number.
    """
    spark = rows.sparkSession
    totals = rows.groupBy(F.col("source").alias("name")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    order = [F.col("name").isNull(), F.col("name")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = written(totals.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id()))
    ordered = ordered.withColumn("part", F.shiftright("id", 33)).withColumn("inside", F.col("id").bitwiseAND((1 << 33) - 1))
    counts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows")).orderBy("part").collect()
    first = running(spark, [(r["part"], r["n"]) for r in counts])
    out = ordered.join(F.broadcast(first), "part").withColumn("number", F.col("inside") + F.col("before")).drop("id", "inside", "before")
    return out, sum(r["rows"] for r in counts)


def running(spark: SparkSession, counts: list[tuple[int, int]]) -> DataFrame:
    """part, and the sum of the counts of the parts before it."""
    before, out = 0, []
    for part, n in counts:
        out.append((part, before))
        before += n
    return spark.createDataFrame(out, "part long, before long")


def with_running(table: DataFrame, column: str, name: str) -> tuple[DataFrame, int]:
    """The table with the sum of ``column`` over the sources of smaller number, and the sum of all."""
    counts = [(r["part"], r["n"]) for r in table.groupBy("part").agg(F.sum(column).alias("n")).orderBy("part").collect()]
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    out = table.join(F.broadcast(running(table.sparkSession, counts)), "part")
    return out.withColumn(name, F.sum(column).over(inside) - F.col(column) + F.col("before")).drop("before"), sum(n for _, n in counts)


def table_targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """``sources`` with the target that ``source_targets`` gives; sums over open and full sources, round by round.

    The unit of words a weight grows from round to round, so a source once full stays full.
    """
    wish = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    some = sources.withColumn("wish", wish)
    full = lambda unit: F.lit(unit) * F.col("wish") > F.lit(limit) * F.col("size")
    sums = lambda closed: some.agg(
        F.sum(F.when(~closed, F.col("wish"))).alias("wish"), F.sum(F.when(closed, F.col("size"))).alias("full"),
        F.count(F.when(closed, 1)).alias("n"), F.sum("size").alias("all"),
    ).first()
    unit, closed, seen = 0.0, F.lit(False), -1
    while True:
        now = sums(closed)
        if now["n"] == seen or not now["wish"]:
            break
        seen = now["n"]
        unit = max(unit, (min(share, limit) * now["all"] - limit * (now["full"] or 0)) / now["wish"])
        closed = full(unit)
    open_target = F.greatest(F.lit(0.0), F.lit(unit) * F.col("wish"))
    return some.withColumn("target", F.when(closed, F.lit(limit) * F.col("size")).otherwise(open_target)).drop("wish")


def counts_below(n: np.ndarray, limits: np.ndarray, bits: int) -> np.ndarray:
    """``count_below`` with an own number of points for each limit."""
    out = np.zeros(len(limits), np.int64)
    for b in range(bits, -1, -1):
        some = (n >> b & 1).astype(bool)
        step = 1 << (bits - b)
        r = reverse_bits((n[some] >> (b + 1)) << (b + 1), bits) if b < bits else 0
        out[some] += np.clip(-((r - limits[some]) // step), 0, 1 << b)
    return out


def table_schedule(sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """What ``schedule`` gives, from a table of sources (number, size, target, part): every source says which slots its points are."""

    def needs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = [Source(None, s, t) for s, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield record(
            part=batch.column(0), number=batch.column(1), size=batch.column(2),
            quota=pa.array([s.quota for s in rows], pa.int64()), need=pa.array([s.slots(block) for s in rows], pa.int64()),
        )

    columns = "part long, number long, size long, quota long, need long"
    some, total = with_running(written(arrow(sources.select("part", "number", "size", "target"), needs, columns)), "need", "edge")
    bits = max(1, (max(total, 1) - 1).bit_length())

    def given(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        limit = lambda edges: np.array([(e << bits) // max(total, 1) for e in edges], np.int64)
        edge, need = batch.column(5).to_pylist(), batch.column(4).to_pylist()
        low, high = limit(edge), limit([e + n for e, n in zip(edge, need)])
        own = count_below(total, high, bits) - count_below(total, low, bits)
        yield record(
            **dict(zip(batch.schema.names[:5], batch.columns)), low=low, high=high, given=own, missing=np.maximum(np.array(need, np.int64) - own, 0)
        )

    own = written(arrow(some.select("part", "number", "size", "quota", "need", "edge"), given, f"{columns}, low long, high long, given long, missing long"))
    own, _ = with_running(own, "missing", "late")
    # Points, then the slots appended at the end, in pieces.
    things = F.col("high") - F.col("low") + F.col("missing")
    pieces = own.filter("need > 0").withColumn("things", things).withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(things - 1) div {PIECE_POINTS}")))
    )
    names = ["number", "size", "quota", "need", "low", "high", "given", "late", "things", "piece"]
    tasks = max(1, -(-total // SLOTS_PER_TASK))
    pieces = pieces.select(*names).repartition(tasks, "number", "piece")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        column = {n: np.array(batch.column(i), np.int64) for i, n in enumerate(names)}
        length = np.minimum(column["things"] - column["piece"] * PIECE_POINTS, PIECE_POINTS)
        cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(length) // (1 << 20))) + 1).tolist(), len(length)]
        for a, b in zip(cuts, cuts[1:]):
            n = length[a:b]
            at = lambda name: np.repeat(column[name][a:b], n)  # noqa: B023,E731
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + at("piece") * PIECE_POINTS
            point = at("low") + place
            late = point - at("high")
            by_point = late < 0
            slot = np.where(by_point, reverse_bits(np.where(by_point, point, 0), bits), total + at("late") + late)
            rank = at("given") + late
            p, low, high = slot[by_point], at("low")[by_point], at("high")[by_point]
            rank[by_point] = counts_below(p, high, bits) - counts_below(p, low, bits)
            used = (rank < at("need")) & ((slot < total) | ~by_point)
            source, slot, rank = at("number")[used], slot[used], rank[used]
            size, quota = at("size")[used], at("quota")[used]
            blocks = -(-size // block)
            turn, number = rank // blocks, rank % blocks
            start = number * block
            yield record(slot=slot, source=source, rank=rank, block=number, n=np.minimum(np.minimum(block, size - start), quota - turn * size - start))

    return arrow(pieces, run, "slot long, source long, rank long, block long, n long")


class TableMix(Mix):
    """The mix of a table of documents of any number of sources: what ``Mix`` gives, with sources and slots as tables."""

    def __init__(
        self, documents: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK,
        rows: DataFrame | None = None,
    ):
        self.block = block
        rows = written(sized(documents, id=id, text=text, source=source)) if rows is None else rows
        numbered, n_rows = numbered_sources(rows)
        listed = written(table_targets(written(numbered)))
        bits = max(0, (n_rows // BUCKET_ROWS).bit_length())
        own = listed.select("name", "number", F.col("size").alias("source_size"), "target")
        self.rows = rows.join(own, F.col("source").eqNullSafe(F.col("name"))).select(
            "id", F.col("number").alias("source"), "source_size", "target", "size", "hash",
            (F.shiftright("hash", 64 - bits) if bits else F.lit(0).cast("long")).alias("bucket"),
        )
        self.slots = table_schedule(listed, block)


def mix(documents: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source", block: int = BLOCK) -> Mix:
    """The mix by way of the driver for a short list of sources, by tables for a longer one."""
    rows = written(sized(documents, id=id, text=text, source=source))
    few = rows.select("source").distinct().limit(MAX_SOURCES + 1).count() <= MAX_SOURCES
    return (Mix if few else TableMix)(documents, id=id, text=text, source=source, block=block, rows=rows)


def mixed_documents(documents: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Whole documents as often as the mix takes them: taken words by size, to the nearest whole number.

    Only the document at which a source's target is reached is taken in part. All columns stay.
    """
    # Own names by position, so that no column of the documents can clash; as they were at the end.
    names = [f"c{i}" for i in range(len(documents.columns))]
    place = {c: n for c, n in zip(documents.columns, names)}
    renamed = documents.toDF(*names)
    times = (
        mix(renamed, id=place[id], text=place[text], source=place[source]).taken().filter("size > 0")
        .groupBy("id", "hash")
        .agg(F.floor(F.sum("taken") / F.sum("size") + 0.5).cast("int").alias("times"))
        .filter("times > 0")
    )
    out = renamed.join(times, F.col("id").eqNullSafe(F.col(place[id])) & (F.col("hash") == shuffle_key(place[id], place[text])))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).select(*names).toDF(*documents.columns)
