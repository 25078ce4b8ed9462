"""Near duplicates by SetSketch registers (operator 8).

A document's set of word shingles is reduced to registers: for each of many hash
functions the minimum over the set, as the truncated logarithm of an exponential
variate. Equal registers are as likely as two sets are alike. Bands of registers that
agree name candidates; the likelihood of all registers together discards most false
ones, and links are confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry_spark.llm.components import components
from registry_spark.llm.hashing import joined, mixed
from registry_spark.llm.tasks import begin, Numbers, arrow, byte_texts, chunked, loaded, numbered_words, record, segments, ship
from registry_spark.sources.shared import written

# A pair of similarity 0.8 misses every band with probability (1 - 0.8**5)**50 = 2e-9.
BANDS, ROWS = 50, 5
REGISTERS = BANDS * ROWS
# Base, rate and largest value of the registers, as in the SetSketch paper (Ertl, 2021) for 16 bits.
BASE, RATE, TOP = 1.001, 20.0, 2**16 - 1
# Natural log of the odds at which a pair is discarded unseen.
DISCARD = 20.0
# Rows compared with each other in one task.
TILE = 256


class Shingles:
    """Sets of hashed word shingles; the hash of each distinct word is worked out once."""

    def __init__(self, words: int, capacity: int = 250_000):
        self.words, self.capacity = words, capacity
        self.clear()

    def clear(self) -> None:
        self.numbers = Numbers()
        self.hash = np.zeros(0, np.uint64)

    def sets(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct shingle hashes of every text in one array, and where each begins.

        Letters A-Z count as a-z. A text with fewer words than a shingle has its whole
        sequence as the only one; one without words has none.
        """
        if len(self.numbers) > self.capacity:
            self.clear()
        flat, bounds = numbered_words([t.lower() for t in texts], self.numbers)
        if new := self.numbers.new():
            self.hash = np.concatenate((self.hash, np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))))
        n_words = np.diff(bounds)
        n = np.where(n_words >= self.words, n_words - self.words + 1, np.minimum(n_words, 1))
        starts = segments(n)
        out = np.empty(int(starts[-1]), np.uint64)
        hashes = self.hash[flat]
        shingle = mixed(hashes)
        for i in range(1, self.words):
            shingle = joined(shingle[: len(hashes) - i], hashes[i:]) if len(hashes) > i else shingle[:0]
        for a, b, first, k, size in zip(starts[:-1].tolist(), starts[1:].tolist(), bounds[:-1].tolist(), n_words.tolist(), n.tolist()):
            if k >= self.words:
                out[a:b] = shingle[first : first + size]
                out[a:b].sort()
            elif k:
                value = mixed(hashes[first : first + 1])
                for i in range(1, k):
                    value = joined(value, hashes[first + i : first + i + 1])
                out[a:b] = mixed(value + np.uint64(k))
        owner = np.repeat(np.arange(len(texts)), n)
        keep = np.ones(len(out), bool)
        keep[1:] = (out[1:] != out[:-1]) | (owner[1:] != owner[:-1])
        return out[keep], segments(np.bincount(owner[keep], minlength=len(texts)))


def sketch(flat: np.ndarray, bounds: np.ndarray, tile: int = 1 << 15) -> np.ndarray:
    """Registers of every set, one row a set; sets must not be empty.

    Register i is floor(1 - log_BASE x), within 0 and TOP, of the smallest exponential
    variate x = -ln(1 - u) / RATE over the set, with u the i-th hash of an element.
    Registers of a union are the larger of both.
    """
    random = np.random.default_rng(8)
    odd = (random.integers(0, 2**31, (REGISTERS, 2)) * 2 + 1).astype(np.uint32)
    low, high = flat.astype(np.uint32), (flat >> np.uint64(32)).astype(np.uint32)
    least = np.full((len(bounds) - 1, REGISTERS), 2**32 - 1, np.uint32)
    first = 0
    while first < len(bounds) - 1:
        # Tiles of whole sets that fit the processor's cache, or one large set.
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + tile, "right")) - 1)
        a, b = int(bounds[first]), int(bounds[last])
        starts = bounds[first:last] - a
        x, y = low[a:b], high[a:b]
        for i in range(REGISTERS):
            value = x * odd[i, 0]
            value += y * odd[i, 1]
            least[first:last, i] = np.minimum.reduceat(value, starts)
        first = last
    u = (least.astype(np.float64) + 0.5) / 2**32
    x = -np.log1p(-u) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP).astype(np.uint16)


def bands(registers: np.ndarray) -> np.ndarray:
    """64-bit hash of every band of registers, the band's number included."""
    parts = registers.reshape(len(registers), BANDS, ROWS).astype(np.uint64)
    out = mixed(np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]))
    for i in range(ROWS):
        out = joined(out, parts[:, :, i])
    return out


def may_be_alike(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether a similarity of at least ``similarity`` is not ruled out, by the joint likelihood of two sets' registers.

    With sizes known, a register of one set exceeds the other's with probability
    p(u - v J), where u and v are the shares of the sizes and p(x) = -log_BASE(1 - x (BASE - 1) / BASE).
    ``similarity`` is whole percents; whether the sizes allow it is decided in whole numbers, as 4/5 is less than 0.8 in floats.
    """
    possible = 100 * np.minimum(n_a, n_b) >= round(100 * similarity) * np.maximum(n_a, n_b)
    above, below = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    same = REGISTERS - above - below
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    most = np.maximum(np.minimum(u / v, v / u), similarity)
    p = lambda x: np.maximum(-np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE), 1e-12)

    def likelihood(low, high):
        j = low + (high - low) * np.linspace(0, 1, 65)[None, :]
        more, less = p(u - v * j), p(v - u * j)
        return (above * np.log(more) + below * np.log(less) + same * np.log(np.maximum(1 - more - less, 1e-12))).max(axis=1)

    floor = np.full_like(most, similarity)
    return possible & (likelihood(np.zeros_like(most), floor) - likelihood(floor, most) <= DISCARD)


def least_equal(similarity: float) -> int:
    """Equal registers that two sets of this similarity have but for odds of exp(-DISCARD), by Chernoff's bound."""
    share = np.arange(1, REGISTERS) / REGISTERS
    tail = REGISTERS * (share * np.log(share / similarity) + (1 - share) * np.log((1 - share) / (1 - similarity)))
    return int(np.count_nonzero((share < similarity) & (tail >= DISCARD)))


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share at least ``percent`` of their union."""
    both = np.concatenate((a, b))
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def text_key(id: int | None, text: bytes) -> bytes:
    """Key of an id and a text; ``key_of`` is the same as a column."""
    return hashlib.md5((b"" if id is None else b"%d" % id) + b"|" + text).digest()


def key_of(id: Column, text: Column) -> Column:
    parts = F.concat(F.coalesce(id.cast("long").cast("string"), F.lit("")), F.lit("|"), F.coalesce(text, F.lit("")))
    return F.unhex(F.md5(parts.cast("binary")))


def sketched(documents: DataFrame, id: str, text: str, words: int) -> DataFrame:
    """Per row: row (its number), id, key of id and text, n_shingles, digest of its set, bands (once per set and task)."""
    name = uuid.uuid4().hex
    ship(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        row = TaskContext.get().partitionId() << 36
        known: set[bytes] = set()
        for batch in batches:
            for part in chunked(batch):
                shingles = loaded("shingles", f"{name} {words}", lambda: Shingles(words))
                texts = byte_texts(part)
                flat, bounds = shingles.sets(texts)
                digests, new = [], []
                ids = part.column(0).to_pylist()
                for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    digest = hashlib.blake2b(flat[a:b], digest_size=16).digest() if b > a else None
                    digests.append(digest)
                    if digest and digest not in known:
                        known.add(digest)
                        new.append(k)
                keys: list[bytes | None] = [None] * len(texts)
                if new:
                    sizes = np.diff(bounds)[new]
                    own = np.concatenate([flat[bounds[k] : bounds[k + 1]] for k in new])
                    for k, value in zip(new, bands(sketch(own, segments(sizes)))):
                        keys[k] = value.tobytes()
                yield record(
                    row=np.arange(row, row + len(texts)), id=part.column(0), key=[text_key(i, t) for i, t in zip(ids, texts)],
                    n=np.diff(bounds), digest=pa.array(digests, pa.binary()), bands=pa.array(keys, pa.binary()),
                )
                row += len(texts)

    rows = documents.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "row long, id long, key binary, n long, digest binary, bands binary")


def band_rows(rows: DataFrame) -> DataFrame:
    """One row per set and band: band, row."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first in range(0, batch.num_rows, 1_000):
            part = batch.slice(first, 1_000)
            values = np.frombuffer(b"".join(part.column(1).to_pylist()), np.int64)
            yield record(band=values, row=np.repeat(np.array(part.column(0)), BANDS))

    return arrow(rows.filter("bands IS NOT NULL").select("row", "bands"), run, "band long, row long")


def candidate_sets(documents: DataFrame, wanted: DataFrame, id: str, text: str, words: int) -> DataFrame:
    """Full sets and registers of the wanted rows (row, key, least, centre), from their whole texts, beside row, least and centre.

    A key is wanted once, but a row repeated k times meets it k times: a task takes the first and leaves the others.
    """
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        seen: set[int] = set()
        for batch in batches:
            first = []
            for k, row in enumerate(batch.column(0).to_pylist()):
                if row not in seen:
                    seen.add(row)
                    first.append(k)
            if not first:
                continue
            for part in chunked(batch if len(first) == batch.num_rows else batch.take(pa.array(first))):
                shingles = loaded("shingles", f"{name} {words}", lambda: Shingles(words))
                flat, bounds = shingles.sets(byte_texts(part))
                registers = sketch(flat, bounds)
                yield record(
                    row=part.column(0), least=part.column(1), centre=part.column(2), n=np.diff(bounds),
                    set=pa.array([flat[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
                    registers=pa.array([r.tobytes() for r in registers], pa.binary()),
                )

    texts = documents.select(key_of(F.col(f"`{id}`"), F.col(f"`{text}`")).alias("key"), F.col(f"`{text}`").alias("text"))
    found = texts.join(wanted, "key")
    return found.select("row", "least", "centre", "text").mapInArrow(run, "row long, least long, centre boolean, n long, set binary, registers binary")


def confirmed(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of rows with the row they name as ``least``, where the full sets are alike."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            column = lambda i: part.column(i).to_pylist()
            n_a, n_b = np.array(part.column(2), float), np.array(part.column(3), float)
            likely = np.flatnonzero(may_be_alike(registers_of(column(4)), registers_of(column(5)), n_a, n_b, percent / 100))
            left, right = column(6), column(7)
            good = [k for k in likely.tolist() if alike(np.frombuffer(left[k], np.uint64), np.frombuffer(right[k], np.uint64), percent)]
            yield record(a=np.array(part.column(0))[good], b=np.array(part.column(1))[good])

    wide = ("n", "registers", "set")
    members = sets.filter("row <> least").select(F.col("row").alias("a"), F.col("least").alias("b"), *[F.col(c).alias(f"{c}_a") for c in wide])
    centres = sets.filter("centre").select(F.col("row").alias("b"), *[F.col(c).alias(f"{c}_b") for c in wide])
    both = members.join(centres, "b")
    return arrow(both.select("a", "b", *[f"{c}_{s}" for c in wide for s in ("a", "b")]), run, "a long, b long")


def registers_of(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint16).reshape(-1, REGISTERS)


def tile_links(left: pa.Table, right: pa.Table, percent: int) -> tuple[list[int], list[int]]:
    """Links between rows of different components of two lists, enough to tell which components meet.

    Pairs with the most equal registers come first; what they join need not be compared again.
    """
    rows = [np.array(t.column("row")) for t in (left, right)]
    part = [np.array(t.column("component")) for t in (left, right)]
    n = [np.array(t.column("n"), float) for t in (left, right)]
    registers = [registers_of(t.column("registers").to_pylist()) for t in (left, right)]
    sets = [[np.frombuffer(x, np.uint64) for x in t.column("set").to_pylist()] for t in (left, right)]
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while top.get(x, x) != x:
            x = top[x]
        return x

    least = least_equal(percent / 100)
    pairs = []
    for i in range(len(rows[0])):
        other = np.flatnonzero((part[1] != part[0][i]) & (100 * np.minimum(n[1], n[0][i]) >= percent * np.maximum(n[1], n[0][i])))
        if len(other):
            equal = (registers[1][other] == registers[0][i]).sum(axis=1)
            near = equal >= least
            pairs.append(np.stack((equal[near], np.full(near.sum(), i), other[near])))
    both = np.concatenate(pairs, axis=1) if pairs else np.zeros((3, 0), np.int64)
    found = []
    for first in range(0, both.shape[1], 4_096):
        equal, i, j = both[:, first : first + 4_096]
        likely = may_be_alike(registers[0][i], registers[1][j], n[0][i], n[1][j], percent / 100)
        found += zip(equal[likely].tolist(), i[likely].tolist(), j[likely].tolist())
    a, b = [], []
    for _, i, j in sorted(found, reverse=True):
        x, y = find(int(part[0][i])), find(int(part[1][j]))
        if x != y and alike(sets[0][i], sets[1][j], percent):
            top[max(x, y)] = min(x, y)
            a.append(int(rows[0][i]))
            b.append(int(rows[1][j]))
    return a, b


def cross_links(members: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between rows that share a band but no component yet.

    Rows that hang together by bands of several components are a family. All of a family but its largest component is
    compared with all of it, in tiles of TILE by TILE rows, each in one task; pairs of rows are not made.
    """
    own = written(members.join(found, F.col("row") == F.col("node"), "left").select("band", "row", F.coalesce("component", "row").alias("component")))
    several = own.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.min("row").alias("head")).filter("x <> y")
    some = written(own.join(several.select("band", "head"), "band").select("row", "component", "head").distinct())
    family = components(some.select(F.col("row").alias("a"), F.col("head").alias("b")))
    rows = some.select("row", "component").distinct().join(family.withColumnRenamed("component", "family"), F.col("row") == F.col("node"), "left")
    rows = rows.select("row", "component", F.coalesce("family", "row").alias("family"))
    sizes = rows.groupBy("family", "component").agg(F.count(F.lit(1)).alias("n")).groupBy("family").agg(
        F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("largest")
    )
    parts = lambda n: F.ceil(n / F.lit(TILE)).cast("long")
    sizes = sizes.select(
        "family", F.col("largest.component").alias("largest"), parts(F.col("all")).alias("columns"),
        parts(F.col("all") - F.col("largest.n")).alias("lines"),
    )
    wide = written(rows.join(sizes, "family").join(sets.select("row", "n", "registers", "set"), "row"))
    place = lambda parts: F.pmod(F.xxhash64("row"), F.col(parts))
    every = lambda parts: F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1))
    columns = ["row", "component", "n", "registers", "set", "family"]
    left = wide.filter("component <> largest").select(*columns, place("lines").alias("line"), every("columns").alias("column"))
    right = wide.select(*columns, every("lines").alias("line"), place("columns").alias("column"))

    def tile(a, b):
        begin(__name__)
        x, y = tile_links(a, b, percent)
        return pa.table({"a": pa.array(x, pa.int64()), "b": pa.array(y, pa.int64())})

    cell = ["family", "line", "column"]
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(tile, "a long, b long")


def classes(documents: DataFrame, *, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """Per row: row, id, key, n, component (smallest row number linked with it), component_id.

    Candidates are rows that agree in a band. Each is first compared with the smallest row of its bands; then
    rows that share a band and are in different components by now are compared in tiles, so no link that a band shows is lost.
    """
    rows = written(sketched(documents, id, text, words))
    groups = rows.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("row").alias("first"))
    equal = rows.join(groups, "digest").filter("row <> first").select(F.col("row").alias("a"), F.col("first").alias("b"))
    # Equal sets stand for each other: only the first row of each takes part in what follows.
    all_bands = band_rows(rows.filter("bands IS NOT NULL").join(groups.select(F.col("first").alias("row")), "row", "left_semi"))
    shared = all_bands.groupBy("band").agg(F.min("row").alias("least"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    members = written(all_bands.join(shared.drop("rows"), "band"))
    stars = members.groupBy("row").agg(F.min("least").alias("least"))
    centres = stars.select(F.col("least").alias("row")).distinct().withColumn("centre", F.lit(True))
    wanted = rows.select("row", "key").join(stars, "row").join(centres, "row", "left").withColumn("centre", F.coalesce("centre", F.lit(False)))
    sets = written(candidate_sets(documents, wanted, id, text, words))
    found = components(written(confirmed(sets, percent)).unionByName(equal))
    more = written(cross_links(members.select("band", "row"), found, sets, percent))
    if not more.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))
    own = rows.select("row", "id", "key", "n").join(found, F.col("row") == F.col("node"), "left").select(
        "row", "id", "key", "n", F.coalesce("component", "row").alias("component")
    )
    return own.join(own.groupBy("component").agg(F.min("id").alias("component_id")), "component")


def near_duplicates(documents: DataFrame, *, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """Per row: ``id``, n_shingles, component_id, kept.

    Rows are linked when they share at least ``percent`` percent of the union of their sets of ``words``-word shingles;
    component_id is the smallest id reachable, and ``kept`` marks rows that have it as their own id. NULL and empty texts
    are linked with nothing. A NULL id is larger than any other, and stays NULL only where no other is reached. Repeated
    rows form a component of which all are ``kept``; ``one_of_each`` leaves one. Other columns are not read.
    """
    found = classes(documents, id=id, text=text, words=words, percent=percent)
    return found.select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def one_of_each(documents: DataFrame, *, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """Documents, all columns, with one row left of each component: one with the smallest id."""
    found = classes(documents, id=id, text=text, words=words, percent=percent).filter(F.col("id").eqNullSafe(F.col("component_id")))
    best = found.groupBy("component").agg(F.min(F.struct("row", "key")).alias("best")).select(F.col("best.key").alias("key"))
    copies = found.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    best = written(best.join(copies, "key"))
    # Own names by position, so that no column of the documents can clash; as they were at the end.
    names = [f"c{i}" for i in range(len(documents.columns))]
    place = {c: n for c, n in zip(documents.columns, names)}
    keyed = documents.toDF(*names).withColumn("key", key_of(F.col(place[id]), F.col(place[text])))
    alone = keyed.join(best.filter("copies = 1"), "key", "left_semi")
    # Rows equal in id and text are reduced to one on the map side already.
    repeated = keyed.join(best.filter("copies > 1"), "key", "left_semi").dropDuplicates(["key"])
    return alone.unionByName(repeated).select(*names).toDF(*documents.columns)
