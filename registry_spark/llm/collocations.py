"""Phrases whose words hold together, found by Misra-Gries summaries and counted exactly (operator 13).

1. Texts are written once more, in lower case, cut into chunks of bounded size; a chunk is what one task holds.
2. Every chunk sums its n-grams by hash. Hashes are dealt to hash partitions; a partition gets one packed,
   sorted list a chunk. A partition merges its lists into a Misra-Gries summary whose capacity exceeds the
   partition's mass divided by the threshold, so an n-gram that reaches the threshold always survives.
   What survives goes back to the chunks that hold it.
3. Every chunk counts the n-grams of its surviving hashes by their words, and hash partitions add up the counts.
   A hash may stand for several n-grams or survive too often: that costs work and changes no result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registry_spark.llm.hashing import joined
from registry_spark.llm.tasks import begin, Numbers, loaded, record, ship
from registry_spark.sources.shared import written

# Characters that end a piece; in the written texts BREAK stands for all of them.
ENDS, BREAK = b".,;:!?\n\x0b\x0c\r", b"."
UPPER = bytes(range(65, 91))
PLAIN = bytes.maketrans(UPPER + ENDS, UPPER.lower() + BREAK * len(ENDS))

# Bytes of text a chunk holds at least before the next begins, and at which a long text is cut.
CHUNK, LONG_TEXT = 12 << 20, 4 << 20
# Occurrences a hash partition holds on average; its summary needs this over the threshold.
PARTITION_MASS = 1 << 26
# Bits of a hash beyond those that number all occurrences: one in 2^10 hashes is shared by chance.
SPARE_BITS = 10
WORDS = 400_000
SALTS, TOP_SALTS = 16, 64


def cut_text(text: bytes, size: int = LONG_TEXT) -> Iterator[bytes]:
    """Parts of a plain text of about ``size`` bytes that end where a piece ends; a longer piece stays whole."""
    at = 0
    while len(text) - at > size:
        end = text.find(BREAK, at + size)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:]


def parts(documents: DataFrame, text: str, lang: str, chunk: int = CHUNK) -> DataFrame:
    """Plain texts in chunks: chunk, lang, text, words. Texts without a word are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        number, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            rows = []
            for name, whole in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                for part in cut_text(whole.translate(PLAIN)):
                    n = len(part.replace(BREAK, b" ").split())
                    if n:
                        rows.append((number, name, part, n))
                        size += len(part)
                        if size >= chunk:
                            number, size = number + 1, 0
            if rows:
                numbers, names, texts, words = zip(*rows)
                yield record(chunk=pa.array(numbers, pa.int64()), lang=names, text=pa.array(texts, pa.binary()), words=pa.array(words, pa.int64()))

    ship(documents.sparkSession)
    some = documents.filter(F.col(text).isNotNull()).select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    return some.mapInArrow(run, "chunk long, lang string, text binary, words long")


class Words:
    """Words by number with their hashes; 0 is the end of a piece. One a worker, begun anew beyond ``WORDS``."""

    def __init__(self):
        self.numbers = Numbers()
        self.hashes = np.zeros(0, np.uint64)
        self.words: list[bytes] = []
        self.numbers.of([BREAK])

    def numbered(self, texts: list[bytes]) -> np.ndarray:
        """Word numbers of all texts, each text and each piece followed by 0."""
        tokens = (b" . ".join(texts) + b".").replace(BREAK, b" . ").split()
        found = self.numbers.of(tokens)
        new = self.numbers.new()
        if new:
            more = np.fromiter(map(xxhash.xxh3_64_intdigest, new), np.uint64, len(new))
            self.hashes = np.concatenate((self.hashes, more))
            self.words += new
        return found


def words_of_worker() -> Words:
    known = loaded("collocations words", "", Words)
    if len(known.numbers) > WORDS:
        known.__init__()
    return known


def grams(known: Words, x: np.ndarray, lang: str, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For every length: the length, where an n-gram begins, and the hashes of those n-grams."""
    own = known.hashes[x]
    ok = x != 0
    with np.errstate(over="ignore"):
        value = joined(np.uint64(xxhash.xxh3_64_intdigest(lang.encode())), own)
        inside = ok
        for n in range(1, longest + 1):
            if n > 1:
                value = joined(value[:-1], own[n - 1 :])
                inside = inside[:-1] & ok[n - 1 :]
            at = np.flatnonzero(inside)
            yield n, at, value[at]


def by_lang(batch: pa.RecordBatch | pa.Table) -> dict[str, list[bytes]]:
    out: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
        out.setdefault(lang, []).append(text)
    return out


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers by planes of bytes, compressed."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view("<u8")


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


class MisraGries:
    """Summary of counts by key: of a total mass m no key with more than m / (capacity + 1) is ever lost."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add another summary; if too many keys are left, all lose as much as makes the surplus vanish."""
        self.keys, self.counts = summed(np.concatenate((self.keys, keys)), np.concatenate((self.counts, counts)))
        if len(self.keys) > self.capacity:
            at = len(self.keys) - self.capacity - 1
            left = self.counts - np.partition(self.counts, at)[at]
            self.keys, self.counts = self.keys[left > 0], left[left > 0]


def positions(some: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every value its place in the sorted keys, and whether it is there."""
    at = np.searchsorted(some, values)
    at[at == len(some)] = 0
    return at, (some[at] == values) if len(some) else np.zeros(len(values), bool)


def chunk_lists(chunks: DataFrame, longest: int, key_bits: int, partition_bits: int) -> DataFrame:
    """Packed sums of every chunk's n-gram hashes: partition, chunk, mass, keys, counts."""
    shift = np.uint64(64 - key_bits)
    edges = np.arange(1, 1 << partition_bits, dtype=np.uint64) << np.uint64(key_bits - partition_bits)

    def lists(chunk: int, texts: dict[str, list[bytes]]) -> Iterator[pa.RecordBatch]:
        known = words_of_worker()
        found = [value >> shift for lang, some in texts.items() for _, _, value in grams(known, known.numbered(some), lang, longest)]
        keys = np.sort(np.concatenate(found))
        del found
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        counts = np.diff(np.append(first, len(keys)))
        keys = keys[first]
        cuts = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
        rows = [(p, a, b) for p, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        for i in range(0, len(rows), 64):
            some = rows[i : i + 64]
            yield record(
                partition=pa.array([p for p, _, _ in some], pa.int64()), chunk=pa.array([chunk] * len(some), pa.int64()),
                mass=pa.array([int(counts[a:b].sum()) for _, a, b in some], pa.int64()),
                keys=pa.array([pack_sorted(keys[a:b]) for _, a, b in some], pa.binary()),
                counts=pa.array([pack(counts[a:b]) for _, a, b in some], pa.binary()),
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        chunk, held = None, {}
        for batch in batches:
            numbers = batch.column("chunk").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    if chunk != numbers[a] and held:
                        yield from lists(chunk, held)
                        held = {}
                    chunk = int(numbers[a])
                    for lang, texts in by_lang(batch.slice(a, b - a)).items():
                        held.setdefault(lang, []).extend(texts)
        if held:
            yield from lists(chunk, held)

    columns = chunks.select("chunk", "lang", "text")
    return columns.mapInArrow(run, "partition long, chunk long, mass long, keys binary, counts binary")


def surviving(lists: DataFrame, least: int) -> DataFrame:
    """Hashes that may reach ``least``, packed for each chunk that holds them: chunk, keys.

    The summary of a partition has a capacity above its mass over ``least``. Of its survivors those
    go back whose sum over the packed lists, read once more, reaches ``least``.
    """

    def run(table: pa.Table) -> pa.Table:
        begin(__name__)
        rows = list(zip(table.column("chunk").to_pylist(), table.column("keys").to_pylist(), table.column("counts").to_pylist()))
        summary = MisraGries(sum(table.column("mass").to_pylist()) // least + 1)
        held, size = [], 0
        for i, (_, keys, counts) in enumerate(rows):
            held.append((unpack_sorted(keys), unpack(counts).astype(np.int64)))
            size += len(held[-1][0])
            if size > summary.capacity or i + 1 == len(rows):
                summary.merge(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
                held, size = [], 0
        total = np.zeros(len(summary.keys), np.int64)
        for _, keys, counts in rows:
            at, there = positions(summary.keys, unpack_sorted(keys))
            total[at[there]] += unpack(counts).astype(np.int64)[there]
        frequent = summary.keys[total >= least]
        out = []
        for chunk, keys, _ in rows:
            keys = unpack_sorted(keys)
            keys = keys[positions(frequent, keys)[1]]
            if len(keys):
                out.append((chunk, pack_sorted(keys)))
        return pa.table({"chunk": pa.array([c for c, _ in out], pa.int64()), "keys": pa.array([k for _, k in out], pa.binary())})

    return lists.groupBy("partition").applyInArrow(run, "chunk long, keys binary")


def chunk_counts(chunks: DataFrame, keys: DataFrame, longest: int, key_bits: int, partition_bits: int) -> DataFrame:
    """Counts of every chunk's n-grams with a surviving hash, told apart by their words: partition, lang, phrases, counts.

    One row a chunk, language and hash partition; phrases are a compressed list with a line for each.
    """
    shift, partition = np.uint64(64 - key_bits), np.uint64(64 - partition_bits)

    def run(texts: pa.Table, lists: pa.Table) -> pa.Table:
        begin(__name__)
        out: dict[str, list] = {"partition": [], "lang": [], "phrases": [], "counts": []}
        wanted = np.sort(np.concatenate([np.zeros(0, np.uint64), *map(unpack_sorted, lists.column("keys").to_pylist())]))
        known = words_of_worker()
        compress = zstandard.ZstdCompressor(level=1).compress
        for lang, some in by_lang(texts).items() if len(wanted) else ():
            x = known.numbered(some)
            word = known.words.__getitem__
            phrases, counts, places = [], [], []
            for n, at, value in grams(known, x, lang, longest):
                there = positions(wanted, value >> shift)[1]
                at, value = at[there], value[there]
                rows = [x[at + j] for j in range(n)]
                order = np.lexsort(rows[::-1])
                rows = [r[order] for r in rows]
                new = np.ones(len(at), bool)
                new[1:] = np.logical_or.reduce([r[1:] != r[:-1] for r in rows])
                first = np.flatnonzero(new)
                counts.append(np.diff(np.append(first, len(at))))
                places.append((value[order][first] >> partition).astype(np.int64))
                phrases += map(b" ".join, zip(*(map(word, r[first].tolist()) for r in rows)))
            place, count = np.concatenate(places), np.concatenate(counts)
            order = np.argsort(place, kind="stable")
            place, count, by = place[order], count[order], order.tolist()
            cuts = [*np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1]))).tolist(), len(place)] if len(place) else [0]
            for a, b in zip(cuts, cuts[1:]):
                out["partition"].append(int(place[a]))
                out["lang"].append(lang)
                out["phrases"].append(compress(b"\n".join([phrases[i] for i in by[a:b]])))
                out["counts"].append(pack(count[a:b]))
        kinds = (pa.int64(), pa.string(), pa.binary(), pa.binary())
        return pa.table({name: pa.array(column, kind) for (name, column), kind in zip(out.items(), kinds)})

    found = chunks.select("chunk", "lang", "text").groupBy("chunk").cogroup(keys.groupBy("chunk"))
    return found.applyInArrow(run, "partition long, lang string, phrases binary, counts binary")


def exact_counts(lists: DataFrame, least: int) -> DataFrame:
    """lang, phrase, words, f of the phrases that reach ``least``, a hash partition at a time.

    What a partition holds at once is bounded by its survivors, not by how often they are met.
    """

    def run(table: pa.Table) -> pa.Table:
        begin(__name__)
        total: dict[str, Counter] = {}
        open_list = zstandard.ZstdDecompressor().decompress
        for lang, phrases, counts in zip(*(table.column(n).to_pylist() for n in ("lang", "phrases", "counts"))):
            own = total.setdefault(lang, Counter())
            for phrase, n in zip(open_list(phrases).split(b"\n"), unpack(counts).tolist()):
                own[phrase] += n
        rows = [(lang, phrase, phrase.count(b" ") + 1, n) for lang, own in total.items() for phrase, n in own.items() if n >= least]
        langs, phrases, words, counts = zip(*rows) if rows else ((),) * 4
        return pa.table({
            "lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.binary()).cast(pa.string()),
            "words": pa.array(words, pa.int32()), "f": pa.array(counts, pa.int64()),
        })

    return lists.groupBy("partition").applyInArrow(run, "lang string, phrase string, words int, f long")


def wide(x: Column) -> Column:
    return x.cast("decimal(20,0)")


class Collocations:
    """Phrases of up to ``longest`` words met ``least`` times or more in a language, and how firmly they hold.

    Words are runs without blank and tab, phrases lie between the marks ``.,;:!?`` and line breaks, A-Z
    counts as a-z. A NULL text is empty, a NULL language is ``und``; repeated rows count as often as they
    are there; an empty table, or one without a frequent phrase, gives no rows. A piece of any length is
    counted whole. Columns other than ``text`` and ``lang`` are not looked at.
    """

    def __init__(self, documents: DataFrame, *, text: str = "text", lang: str = "lang", longest: int = 4, least: int = 30, chunk: int = CHUNK):
        self.longest, self.least = longest, least
        spark = documents.sparkSession
        chunks = written(parts(documents, text, lang, chunk))
        self.sizes = chunks.groupBy("lang").agg(F.sum("words").alias("n"))
        mass = longest * (self.sizes.agg(F.sum("n")).first()[0] or 1)
        partition_bits = (max(mass // PARTITION_MASS, int(spark.conf.get("spark.sql.shuffle.partitions")), 2) - 1).bit_length()
        key_bits = min(64, max(mass.bit_length() + SPARE_BITS, partition_bits + 1))
        keys = surviving(chunk_lists(chunks, longest, key_bits, partition_bits), least)
        #: lang, phrase, words, f of every word and phrase that reaches ``least``.
        self.counts = written(exact_counts(chunk_counts(chunks, keys, longest, key_bits, partition_bits), least))

    def candidates(self) -> DataFrame:
        """Phrases of two words or more: lang, phrase, words, a, l, r, score of their weakest cut."""
        some = self.counts.filter("words > 1").withColumnRenamed("f", "a").withColumn("tokens", F.split("phrase", " "))
        joined_part = lambda start, n: F.array_join(F.slice("tokens", start, n), " ")
        cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1))
        cuts = some.withColumn("k", cut).select(
            "lang", "phrase", "words", "a", "k",
            F.explode(F.array(
                F.struct(F.lit("l").alias("side"), F.col("k").alias("size"), joined_part(F.lit(1), F.col("k")).alias("part")),
                F.struct(F.lit("r").alias("side"), (F.col("words") - F.col("k")).alias("size"), joined_part(F.col("k") + 1, F.col("words") - F.col("k")).alias("part")),
            )).alias("x"),
        ).select("lang", "phrase", "words", "a", "k", "x.*")
        # A frequent word may be part of a third of all phrases; words are few, so their counts are repeated.
        salt = F.when(F.col("size") == 1, F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")).otherwise(0)
        salts = F.explode(F.sequence(F.lit(0), F.when(F.col("words") == 1, SALTS - 1).otherwise(0)))
        counts = self.counts.filter(F.col("words") < self.longest).select("lang", F.col("phrase").alias("part"), "f", salts.alias("salt"))
        both = cuts.withColumn("salt", salt).join(counts, ["lang", "part", "salt"])
        sides = [
            F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("f"))).alias(f"{side}{k}")
            for k in range(1, self.longest) for side in "lr"
        ]
        pivoted = both.groupBy("lang", "phrase", "words", "a").agg(*sides)
        scores = [
            F.when(F.col(f"l{k}").isNotNull(), F.struct(
                F.expr(f"(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div (cast(l{k} as decimal(20,0)) + cast(r{k} as decimal(20,0)))").alias("score"),
                F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"),
            ))
            for k in range(1, self.longest)
        ]
        weakest = F.least(*scores) if len(scores) > 1 else scores[0]
        return pivoted.withColumn("weakest", weakest).select("lang", "phrase", "words", "a", "weakest.l", "weakest.r", "weakest.score")

    def kept(self, share: int = 80) -> DataFrame:
        """Candidates without those that a longer one holds which is met in ``share`` percent of their places."""
        longer = self.counts.filter("words > 2").withColumn("tokens", F.split("phrase", " "))
        inner = longer.withColumn("n", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
        inner = inner.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("n") + 1)))
        inner = inner.select("lang", F.array_join(F.slice("tokens", F.col("i"), F.col("n")), " ").alias("phrase"), "f")
        most = inner.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
        held = F.col("most").isNotNull() & (100 * wide(F.col("most")) >= share * wide(F.col("a")))
        return self.candidates().join(most, ["lang", "phrase"], "left").filter(~held).drop("most")

    def top(self, count: int = 2000, share: int = 80) -> DataFrame:
        """The ``count`` phrases of each language that hold best: lang, rank, phrase, a, l, r, n, score."""
        order = [F.desc("score"), F.desc("a"), "phrase"]
        salt = F.pmod(F.xxhash64("phrase"), F.lit(TOP_SALTS))
        first = self.kept(share).withColumn("salt", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
        last = first.filter(F.col("rank") <= count).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
        return last.filter(F.col("rank") <= count).join(self.sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
