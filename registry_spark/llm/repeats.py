"""Passages that occur more than once, by difference-cover sampling (operator 10).

Any two places of the corpus have a common distance of less than a period at which both are
sampled, so two equal strings of ``length`` bytes hold equal sampled substrings of
``length - period + 1`` bytes at the same distance. The sampled substrings are named and the names sorted;
only places with a sample at less than the period whose name is met elsewhere stay. This is done with a long period,
that samples few places, then for what is left with a short one. Last, the remaining suffixes are
sorted by the names of their first ``length`` bytes and neighbours compared. Names are hashes of the bytes, not ranks:
only equality of bounded prefixes is asked for, so names need no recursion to a total order.

The text stays where it is, in block files in the shared folder; names travel to be
sorted by ranges, packed by block, and one bit for each comes back.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry_spark.llm.hashing import joined, mixed
from registry_spark.llm.tasks import begin, arrow, byte_texts, record, segments, ship
from registry_spark.llm.token_files import file_system
from registry_spark.sources.shared import shared_folder, written

# Period and a perfect difference set of it: every number modulo the period is a difference of two members.
LEVELS = ((133, (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)), (31, (1, 5, 11, 24, 25, 27)))
BLOCK_BYTES = 4 << 20
# Names sorted by one task; raise with the executors' memory.
PART_NAMES = 1 << 20
TILE = 1 << 15


@lru_cache
def byte_codes() -> np.ndarray:
    return np.random.default_rng(10).integers(0, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of an odd base and of its inverse modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    out = []
    for factor in (base, pow(base, -1, 2**64)):
        factors = np.full(n, factor, np.uint64)
        factors[0] = 1
        out.append(np.multiply.accumulate(factors))
    return out[0], out[1]


class Block:
    """Distinct texts of one file: their bytes one after the other, and which stand for several rows."""

    def __init__(self, data: np.ndarray, lengths: np.ndarray, copied: np.ndarray):
        self.data, self.bounds, self.copied = data, segments(lengths), copied
        self.ends = np.repeat(self.bounds[1:], lengths)

    def sample_names(self, period: int, cover: tuple, size: int, starts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Sampled places followed by ``size`` bytes of their text, less than ``period`` after one of ``starts``, and the hash of those bytes."""
        n = len(self.data)
        places = (np.arange(0, n, period)[:, None] + np.array(cover)).ravel()
        places = places[places < n]
        places = places[places + size <= self.ends[places]]
        if starts is not None:
            last = np.searchsorted(starts, places, "right") - 1
            places = places[(last >= 0) & (places - starts[last] < period)] if len(starts) else places[:0]
        names = np.empty(len(places), np.uint64)
        codes, (power, inverse) = byte_codes(), powers(TILE + size)
        for start in range(0, n, TILE):
            a, b = np.searchsorted(places, (start, start + TILE))
            if a < b:
                tile = codes[self.data[start : start + TILE + size]]
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tile * power[: len(tile)], dtype=np.uint64)))
                at = places[a:b] - start
                names[a:b] = mixed((sums[at + size] - sums[at]) * inverse[at])
        return places, names

    def prefix_names(self, places: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ``size`` bytes from each place, by joining hashes of halves."""
        names = np.empty(len(places), np.uint64)
        codes = byte_codes()
        for start in range(0, len(self.data), TILE):
            a, b = np.searchsorted(places, (start, start + TILE))
            if a < b:
                level = codes[self.data[start : start + TILE + size]]
                at, width, done = places[a:b] - start, 1, 0
                value = np.full(b - a, size, np.uint64)
                while True:
                    if size & width:
                        value = joined(value, level[at + done])
                        done += width
                    if 2 * width > size:
                        break
                    level = joined(level[:-width], level[width:])
                    width *= 2
                names[a:b] = value
        return names

    def candidates(self, length: int, period: int, met: np.ndarray, starts: np.ndarray | None) -> np.ndarray:
        """Those ``starts`` (None: all with ``length`` bytes of their text) less than ``period`` before a place of ``met``."""
        n = len(self.data)
        if n < length:
            return np.zeros(0, np.int64)
        alike = np.zeros(n + period + 1, np.int32)
        alike[met + 1] = 1
        before = np.cumsum(alike, dtype=np.int32)
        if starts is None:
            starts = np.flatnonzero(np.arange(length, n + 1) <= self.ends[: n - length + 1])
        return starts[before[starts + period] > before[starts]]

    def many(self, places: np.ndarray) -> np.ndarray:
        """Whether each place lies in a text that stands for several rows."""
        return self.copied[np.searchsorted(self.bounds, places, "right") - 1]


def ranked(names: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct names, whether each is met more than once here, and each name's rank."""
    order = np.argsort(names)
    ordered = names[order]
    new = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(names) else np.zeros(0, bool)
    rank = np.empty(len(names), np.int64)
    rank[order] = np.cumsum(new) - 1
    distinct = ordered[new]
    often = np.bincount(rank, minlength=len(distinct)) > 1
    often[rank[many]] = True
    return distinct, often, rank


def read_block(path: str) -> Block:
    fs, inner = file_system(path)
    with fs.open_input_stream(inner, compression=None) as file:
        data = zstandard.ZstdDecompressor().decompressobj().decompress(file.read())
    n = int.from_bytes(data[:8], "little")
    lengths = np.frombuffer(data, "<i8", n, 8).astype(np.int64)
    copied = np.frombuffer(data, np.uint8, n, 8 + 8 * n).astype(bool)
    return Block(np.frombuffer(data, np.uint8, offset=8 + 9 * n), lengths, copied)


def stored(rows: DataFrame, text: str, folder: str, size: int) -> DataFrame:
    """Write the texts to block files; per row: its other columns, block, place in it, n_bytes, sha256 of its text.

    Equal texts of a block are stored once. Files carry a name of their own, and only those
    of tasks that counted are in the result.
    """
    ship(rows.sparkSession)
    names = [c for c in rows.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        known: dict[bytes, int] = {}
        copies: list[int] = []
        texts: list[bytes] = []
        held = 0
        path = f"{folder}/{uuid.uuid4().hex}.zst"

        def flush() -> None:
            data = b"".join([
                len(texts).to_bytes(8, "little"), np.array([len(t) for t in texts], "<i8").tobytes(),
                np.array([c > 1 for c in copies], np.uint8).tobytes(), *texts,
            ])
            fs, inner = file_system(path)
            fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
            with fs.open_output_stream(inner, compression=None) as file:
                file.write(zstandard.ZstdCompressor(level=1).compress(data))

        for batch in batches:
            pending = []
            for k, value in enumerate(byte_texts(batch, text)):
                if held >= size:
                    flush()
                    known, copies, texts, held = {}, [], [], 0
                    path = f"{folder}/{uuid.uuid4().hex}.zst"
                key = hashlib.sha256(value).digest()
                if key not in known:
                    known[key] = len(texts)
                    texts.append(value)
                    copies.append(0)
                    held += len(value) + 64
                copies[known[key]] += 1
                pending.append((path, known[key], len(value), key.hex()))
            columns = {n: batch.column(batch.schema.get_field_index(n)) for n in names}
            for name, values in zip(("__block", "__place", "__bytes", "__sha256"), zip(*pending)):
                columns[name] = pa.array(values)
            yield pa.RecordBatch.from_pydict(columns)
        if texts:
            flush()

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields if f.name != text)
    return rows.mapInArrow(run, f"{fields}__block string, __place long, __bytes long, __sha256 string")


def packed_rows(block: str, distinct: np.ndarray, often: np.ndarray, bits: int, wide: bool) -> Iterator[pa.RecordBatch]:
    """Sorted names cut by their first ``bits`` bits: part, block, names (without those bits if not ``wide``), often."""
    parts = (distinct >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(distinct), np.int64)
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(parts)) + 1, [len(parts)]))
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            names = distinct[a:b] if wide else ((distinct[a:b] << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)
            yield record(
                part=pa.array([int(parts[a])], pa.int32()), block=[block], names=pa.array([names.tobytes()], pa.binary()),
                often=pa.array([np.packbits(often[a:b]).tobytes()], pa.binary()),
            )


def met_elsewhere(packed: DataFrame, wide: bool) -> DataFrame:
    """Per block: flags, one bit for each of its names in order of parts: whether it is met more than once anywhere."""
    kind = np.uint64 if wide else np.uint32

    def sort_part(table):
        begin(__name__)
        names = [np.frombuffer(x, kind) for x in table.column("names").to_pylist()]
        sizes = np.array([len(x) for x in names])
        often = np.concatenate([
            np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool) for x, n in zip(table.column("often").to_pylist(), sizes)
        ])
        every = np.concatenate(names)
        order = np.argsort(every)
        same = every[order][1:] == every[order][:-1]
        often[order[1:][same]] = True
        often[order[:-1][same]] = True
        bounds = segments(sizes)
        return pa.table({
            "block": table.column("block"), "part": table.column("part"), "n": pa.array(sizes),
            "flags": pa.array([np.packbits(often[a:b]).tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
        })

    flagged = packed.groupBy("part").applyInArrow(sort_part, "block string, part int, n long, flags binary")
    return flagged.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "n", "flags"))).alias("flags"))


def unpacked(flags: list[dict] | None, n: int) -> np.ndarray:
    parts = [np.unpackbits(np.frombuffer(f["flags"], np.uint8), count=f["n"]) for f in flags or []]
    out = np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)
    if len(out) != n:
        raise ValueError(f"{len(out)} flags for {n} names")
    return out


def remaining(block: Block, flags: list, length: int, bits: int) -> tuple[np.ndarray, np.ndarray | None, tuple]:
    """What the steps so far, of which ``flags`` tell the outcome, leave of a block.

    Places to be named next and their ranked names; after the last step the places, and which of them are met elsewhere.
    """
    starts = None
    for step in range(len(LEVELS) + 1):
        if step < len(LEVELS):
            period, cover = LEVELS[step]
            places, names = block.sample_names(period, cover, length - period + 1, starts)
            names = names >> np.uint64(32 - bits)
        else:
            places, names = starts, block.prefix_names(starts, length)
        ranks = ranked(names, block.many(places))
        if step == len(flags):
            return places, None, ranks
        met = unpacked(flags[step], len(ranks[0]))[ranks[2]]
        if step < len(LEVELS):
            starts = block.candidates(length, period, places[met], starts)
    return places, met, ranks


def removed_spans(block: Block, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte (exclusive) of the maximal runs covered by ``length`` bytes from each start; starts ascend.

    Runs of different texts are apart, also where they touch.
    """
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.searchsorted(block.bounds, starts, "right")
    apart = np.concatenate(([True], (starts[1:] > starts[:-1] + length) | (text[1:] != text[:-1])))
    last = np.concatenate((np.flatnonzero(apart)[1:] - 1, [len(starts) - 1]))
    return starts[apart], starts[last] + length


class Repeats:
    """Repeated strings of ``length`` bytes in a table of texts.

    Every whole text counts as UTF-8 bytes, a NULL as none; matches stay within a text. Every byte covered by a string
    of ``length`` bytes that also starts anywhere else is to go, in all its places. Equal rows are separate texts. Texts
    shorter than ``length`` keep all bytes; an empty table gives no rows.
    """

    def __init__(self, documents: DataFrame, *, text: str = "text", length: int = 200, keep: list[str] = ("doc_id",), block_bytes: int = BLOCK_BYTES):
        self.spark, self.length = documents.sparkSession, length
        if length < LEVELS[0][0]:
            raise ValueError(f"at least {LEVELS[0][0]} bytes")
        self.keep = [*keep]
        alias = [F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(self.keep)]
        rows = documents.select(*alias, F.col(f"`{text}`").alias("__text"))
        folder = shared_folder(self.spark)
        self.rows = written(stored(rows, "__text", f"{folder}/blocks", block_bytes))
        found = self.rows.agg(F.sum("__bytes").alias("b")).first()["b"] or 0
        # About a tenth of all places is sampled first; later steps have mostly as many names.
        self.bits = max(0, (int(found) // 10 // PART_NAMES).bit_length())
        self.blocks = written(self.rows.select(F.col("__block").alias("block")).distinct())
        self.flags: list[DataFrame] = []
        for step in range(len(LEVELS) + 1):
            self.flags.append(written(met_elsewhere(self.names(), wide=step == len(LEVELS))))

    def with_flags(self) -> DataFrame:
        """Blocks with the flags of all steps so far, few rows that each stand for much work, dealt out evenly."""
        out = self.blocks
        for step, flags in enumerate(self.flags):
            out = out.join(flags.withColumnRenamed("flags", f"flags{step}"), "block", "left")
        return out.repartition(4 * self.spark.sparkContext.defaultParallelism)

    def names(self) -> DataFrame:
        """Names of the next step, packed."""
        length, bits, wide = self.length, self.bits, len(self.flags) == len(LEVELS)

        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for path, *flags in zip(*(column.to_pylist() for column in batch.columns)):
                _, _, (distinct, often, _) = remaining(read_block(path), flags, length, bits)
                yield from packed_rows(path, distinct if wide else distinct << np.uint64(32 - bits), often, bits, wide)

        return arrow(self.with_flags(), run, "part int, block string, names binary, often binary")

    def kept(self, with_text: bool = False) -> DataFrame:
        """Per text of a block: place, n_removed, n_spans, kept_sha256 and, on request, the text that is left.

        Without ``with_text``, only texts that lose something. Left text drops the rest of characters cut in two.
        """
        length, bits = self.length, self.bits

        def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for path, *flags in zip(*(column.to_pylist() for column in batch.columns)):
                block = read_block(path)
                starts, again, _ = remaining(block, flags, length, bits)
                begin, end = removed_spans(block, starts[again], length)
                owner = np.searchsorted(block.bounds, begin, "right") - 1
                n_spans = np.bincount(owner, minlength=len(block.copied))
                lost = np.bincount(owner, end - begin, len(block.copied)).astype(np.int64)
                gone = np.zeros(len(block.data) + 1, np.int8)
                gone[begin] += 1
                gone[end] -= 1
                stay = np.cumsum(gone[:-1], dtype=np.int8) == 0
                chosen = np.arange(len(block.copied)) if with_text else np.flatnonzero(lost)
                for at in range(0, len(chosen), 500):
                    some = chosen[at : at + 500]
                    left = [block.data[a:b][stay[a:b]].tobytes() for a, b in zip(block.bounds[some], block.bounds[some + 1])]
                    columns = {
                        "block": [path] * len(some), "place": some, "n_removed": lost[some], "n_spans": n_spans[some],
                        "kept_sha256": [hashlib.sha256(x).hexdigest() for x in left],
                    }
                    if with_text:
                        columns["left"] = pa.array([x.decode("utf-8", "ignore") for x in left], pa.string())
                    yield record(**columns)

        schema = "block string, place long, n_removed long, n_spans long, kept_sha256 string" + ", left string" * with_text
        return arrow(self.with_flags(), run, schema)

    def result(self, with_text: bool = False) -> DataFrame:
        """Per row: its ``keep`` columns, n_bytes, n_removed, n_spans, kept_sha256 and, on request, left (text)."""
        same = (F.col("__block") == F.col("block")) & (F.col("__place") == F.col("place"))
        both = self.rows.join(self.kept(with_text), same, "left")
        return both.select(
            *[F.col(f"__k{i}").alias(c) for i, c in enumerate(self.keep)],
            F.col("__bytes").alias("n_bytes"),
            F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
            F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
            F.coalesce("kept_sha256", "__sha256").alias("kept_sha256"),
            *[F.col("left")] * with_text,
        )
