"""Documents packed into sequences of bounded length by linear grouping (operator 12).

Lengths are whole numbers up to the capacity, so how many pieces have each length says all that a
packing needs: a table of at most ``capacity`` counts, whatever the corpus. The driver plans on those
counts alone; pieces are numbered inside their length and placed by the plan's runs.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import chain
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registry_spark.llm.tasks import begin, Numbers, byte_texts, chunked, loaded, numbered_words, ragged, record, segments, ship
from registry_spark.llm.vocabulary import MARKS, digest
from registry_spark.sources.shared import written

# Lengths above a capacity's share are large; groups of equal cardinality they are rounded up in. The
# planner tries each pair and keeps the packing of fewest sequences; (1, 0) is best-fit alone.
SCHEMES = ((8, 48), (4, 64), (8, 24), (1, 0))
ROUNDS = 600
WORDS = 700_000
# Words that the library gets as one text; the mark of a word's last token in its vocabulary.
GROUP, WORD_END = 50, "</w>"


class WordEncoder:
    """Ids of whole texts by the tokenizers library; every distinct word between ASCII white space once.

    For tokenizers whose tokens never span white space and which drop it. Closing marks after an ASCII letter or
    digit are words of their own, as they start a token there.
    """

    def __init__(self, library: Callable[[], tokenizers.Tokenizer]):
        self.tokenizer = library()
        normalizer = self.tokenizer.normalizer
        self.lower = normalizer is not None and normalizer.normalize_str("A") == "a"
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.clear()

    def clear(self) -> None:
        self.numbers = Numbers()
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.int32)
        self.end = 0

    def each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum())), sizes

    def together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters only, many as one text: a word's last token is one that closes a word."""
        flat, _ = self.each([" ".join(words[i : i + GROUP]) for i in range(0, len(words), GROUP)])
        sizes = np.diff(np.flatnonzero(self.closes[flat]), prepend=-1)
        return (flat, sizes) if len(sizes) == len(words) and sizes.sum() == len(flat) else self.each(words)

    def keep(self, numbers: np.ndarray, flat: np.ndarray, sizes: np.ndarray) -> None:
        if self.end + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids[: self.end], np.zeros(self.end + 2 * len(flat), np.int32)))
        self.ids[self.end : self.end + len(flat)] = flat
        self.starts[numbers] = self.end + segments(sizes)[:-1]
        self.sizes[numbers] = sizes
        self.end += len(flat)

    def learn(self) -> None:
        """Ids of the words met since the last call."""
        numbers, base = self.numbers, len(self.starts)
        letters, others, made, at = ([], []), ([], []), ([], []), base
        while new := numbers.new():
            for word in new:
                core = word.rstrip(MARKS)
                if len(core) < len(word) and core[-1:].isalnum():
                    made[0].append(at)
                    made[1].append((numbers[core], numbers[word[len(core) :]]))
                else:
                    text = word.decode()
                    plain = text.isalpha() and (text.isascii() or normalize("NFC", text).lower().isalpha())
                    some = letters if plain else others
                    some[0].append(at)
                    some[1].append(text)
                at += 1
        self.starts = np.concatenate((self.starts, np.zeros(at - base, np.int64)))
        self.sizes = np.concatenate((self.sizes, np.zeros(at - base, np.int64)))
        if letters[0]:
            self.keep(np.array(letters[0]), *self.together(letters[1]))
        if others[0]:
            self.keep(np.array(others[0]), *self.each(others[1]))
        if made[0]:
            parts = np.array(made[1])
            sizes = self.sizes[parts]
            self.keep(np.array(made[0]), self.ids[ragged(self.starts[parts].ravel(), sizes.ravel())], sizes.sum(1))

    def plain(self, text: bytes) -> bytes:
        """Lower case, where the tokenizer does that too and no special string is at stake."""
        low = text.lower() if self.lower else text
        return text if any(s in low for s in self.special) else low

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and where each text begins and the last ends."""
        if len(self.numbers) > WORDS:
            self.clear()
        numbers, bounds = numbered_words(list(map(self.plain, texts)), self.numbers)
        self.learn()
        sizes = self.sizes[numbers]
        return self.ids[ragged(self.starts[numbers], sizes)], segments(sizes)[bounds]


def pieces(documents: DataFrame, path: str, *, end_id: int, capacity: int, id: str, text: str, with_ids: bool) -> DataFrame:
    """Every document's ids and ``end_id``, cut at ``capacity``; ``number`` counts a length's pieces in a ``part``.

    The numbers are those of the task that writes them: store the frame before using it twice.
    """
    ship(documents.sparkSession)
    with open(path, encoding="utf-8") as file:
        content = file.read()
    key, shared = digest(content), documents.sparkSession.sparkContext.broadcast(content)

    def library() -> tokenizers.Tokenizer:
        tokenizer = tokenizers.Tokenizer.from_str(shared.value)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return tokenizer

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        seen = np.zeros(capacity + 1, np.int64)
        part = TaskContext.get().partitionId()
        for batch in batches:
            for rows in chunked(batch, "text"):
                ids, bounds = loaded("packing encoder", key, lambda: WordEncoder(library)).encode(byte_texts(rows))
                sizes = np.diff(bounds) + 1
                flat = np.full(len(ids) + len(sizes), end_id, "<u4")
                flat[np.arange(len(ids)) + np.repeat(np.arange(len(sizes)), np.diff(bounds))] = ids
                n = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), n)
                piece = np.arange(len(row)) - np.repeat(segments(n)[:-1], n)
                start = piece * capacity
                length = np.minimum(capacity, sizes[row] - start)
                at = segments(sizes)[row] + start
                order = np.argsort(length, kind="stable")
                ordered = length[order]
                first = np.searchsorted(ordered, ordered)
                number = np.empty(len(row), np.int64)
                number[order] = seen[ordered] + np.arange(len(row)) - first
                seen += np.bincount(length, minlength=capacity + 1)
                view = memoryview(flat).cast("B")
                out = {
                    "id": rows.column(0).take(pa.array(row)), "piece": piece.astype(np.int32), "start": start, "length": length,
                    "ids_crc32": pa.array([zlib.crc32(view[4 * a : 4 * (a + b)]) for a, b in zip(at.tolist(), length.tolist())], pa.int64()),
                    "part": np.full(len(row), part, np.int64), "number": number,
                }
                if with_ids:
                    out["ids"] = pa.LargeListArray.from_arrays(segments(length), pa.array(flat.astype(np.int32))).cast(pa.list_(pa.int32()))
                yield record(**out)

    some = documents.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = f"id {some.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, part long, number long"
    return some.mapInArrow(run, schema + ", ids array<int>" * with_ids)


def best_pattern(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes within the capacity of largest value, by the number of its members."""
    best = np.zeros(capacity + 1)
    picks = []
    for _ in range(capacity // int(sizes.min())):
        more, pick = best.copy(), np.full(capacity + 1, -1)
        for i in np.flatnonzero(values > 1e-12).tolist():
            u = int(sizes[i])
            value = best[: capacity + 1 - u] + values[i]
            better = value > more[u:] + 1e-12
            more[u:][better] = value[better]
            pick[u:][better] = i
        if (pick < 0).all():
            break
        best = more
        picks.append(pick)
    counts, room = np.zeros(len(sizes), np.int64), capacity
    for pick in reversed(picks):
        if pick[room] >= 0:
            counts[pick[room]] += 1
            room -= int(sizes[pick[room]])
    return float(best[capacity]), counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Patterns of few sizes and how many bins use each: the cutting-stock program by column generation, rounded down."""
    m = len(sizes)
    columns = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1.0 / np.diag(columns))
    amount = inverse @ demand
    for step in range(ROUNDS):
        value, pattern = best_pattern(sizes, inverse.sum(0), capacity)
        if value <= 1 + 1e-9:
            break
        direction = inverse @ pattern
        ratio = np.where(direction > 1e-9, amount / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(np.argmin(ratio))
        columns[:, out] = pattern
        inverse[out] /= direction[out]
        others = np.arange(m) != out
        inverse[others] -= np.outer(direction[others], inverse[out])
        if step % 50 == 49:
            inverse = np.linalg.inv(columns)
        amount = np.maximum(inverse @ demand, 0)
    return [(columns[:, j].astype(np.int64), int(amount[j] + 1e-6)) for j in range(m)]


class Plan:
    """Runs of equal pieces: of a length, ``n`` pieces from number ``first`` go ``q`` a bin from ``bin`` on, at ``offset``."""

    def __init__(self, counts: np.ndarray):
        self.counts, self.capacity = counts, len(counts) - 1
        self.left = counts.copy()
        self.bins = 0
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.open: list[list[tuple[int, int]]] = [[] for _ in counts]  # by room left: first bin, number of bins

    def put(self, length: int, bin: int, n: int, q: int, offset: int) -> None:
        if n:
            self.runs.append((length, int(self.counts[length] - self.left[length]), n, q, bin, offset))
            self.left[length] -= n

    def fill(self, length: int, bin: int, n: int, room: int) -> None:
        """Put pieces into ``n`` equal bins, each as many as fit, until there are none left."""
        q = room // length
        full = min(n, int(self.left[length]) // q)
        self.put(length, bin, full * q, q, self.capacity - room)
        if full:
            self.open[room - q * length].append((bin, full))
        rest = int(self.left[length]) if full < n else 0
        if rest:
            self.put(length, bin + full, rest, rest, self.capacity - room)
            self.open[room - rest * length].append((bin + full, 1))
            full += 1
        if full < n:
            self.open[room].append((bin + full, n - full))

    def best_fit(self) -> None:
        """All pieces left, longest first, each into the fullest bin that takes it."""
        for length in range(self.capacity, 0, -1):
            for room in range(length, self.capacity + 1) if self.left[length] else ():
                bins, self.open[room] = self.open[room], []
                for i, (bin, n) in enumerate(bins):
                    if not self.left[length]:
                        self.open[room] += bins[i:]
                        break
                    self.fill(length, bin, n, room)
                if not self.left[length]:
                    break
            if self.left[length]:
                new = -(-int(self.left[length]) // (self.capacity // length))
                self.bins += new
                self.fill(length, self.bins - new, new, self.capacity)

    def group(self, least: int, groups: int) -> None:
        """Lengths of ``least`` or more: rounded up in groups, configured, real lengths put in their places."""
        lengths = [n for n in range(self.capacity - 1, least - 1, -1) if self.left[n]]
        total = int(sum(self.left[n] for n in lengths))
        if not total:
            return
        each = -(-total // groups)
        queues: list[list[list[int]]] = []  # a group's lengths, longest first, with their counts
        room = 0
        for length in lengths:
            rest = int(self.left[length])
            while rest:
                if not room:
                    if not (queues and queues[-1][0][0] == length):
                        queues.append([])
                    room = each
                n = min(rest, room)
                queues[-1].append([length, n])
                rest, room = rest - n, room - n
        sizes = np.array([q[0][0] for q in queues])
        demand = np.array([sum(n for _, n in q) for q in queues], float)
        for pattern, n in configurations(sizes, demand, self.capacity):
            self.substitute([queues[i] for i in np.repeat(np.arange(len(sizes)), pattern)], n)

    def substitute(self, slots: list[list[list[int]]], n: int) -> None:
        """Pieces of the slots' groups into ``n`` bins, one a slot, in stretches of equal lengths."""
        first, self.bins = self.bins, self.bins + n
        # Slots of one group take from its queue in turn: each gets its own stretch of it.
        stretches = [[] for _ in slots]
        for stretch, queue in zip(stretches, slots):
            need = n
            while need and queue:
                length, k = queue[0]
                take = min(need, k)
                stretch.append([length, take])
                need -= take
                if take == k:
                    queue.pop(0)
                else:
                    queue[0][1] -= take
            if need:
                stretch.append([0, need])
        at = first
        while at < first + n:
            step = min(s[0][1] for s in stretches)
            room = self.capacity
            for stretch in stretches:
                length = stretch[0][0]
                if length:
                    self.put(length, at, step, 1, self.capacity - room)
                    room -= length
                stretch[0][1] -= step
                if not stretch[0][1]:
                    stretch.pop(0)
            self.open[room].append((at, step))
            at += step


def plan(counts: np.ndarray) -> Plan:
    """The packing of fewest bins among the schemes; ``counts[n]`` pieces have length n, up to the capacity."""
    capacity = len(counts) - 1
    least = -(-int(counts @ np.arange(capacity + 1)) // capacity)
    best = None
    for share, groups in SCHEMES:
        some = Plan(counts)
        if groups:
            some.group(capacity // share, groups)
        some.best_fit()
        if best is None or some.bins < best.bins:
            best = some
        if best.bins == least:
            break
    return best


class Packing:
    """Documents in sequences of at most ``capacity`` ids, as few as the plan finds.

    ``rows``: one row a piece with id, piece, start, length, ids_crc32, sequence_id, offset and, on request, ids.
    A document is its ids by the tokenizers library and ``end_id``; a NULL or empty text is ``end_id`` alone. Only
    longer documents are cut. Repeated rows are documents of their own, NULL ids stay, an empty table gives no
    rows. Columns other than ``id`` and ``text`` are not looked at. Pieces lie in a sequence without gaps.
    """

    def __init__(
        self, documents: DataFrame, path: str, *, end_id: int, capacity: int = 2048, id: str = "doc_id", text: str = "text", with_ids: bool = False
    ):
        spark = documents.sparkSession
        cut = written(pieces(documents, path, end_id=end_id, capacity=capacity, id=id, text=text, with_ids=with_ids))
        counts = written(cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")))
        totals = np.zeros(capacity + 1, np.int64)
        for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row a length
            totals[row["length"]] = row["n"]
        self.plan = plan(totals)
        before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
        numbered = cut.join(offsets, ["length", "part"]).withColumn("number", F.col("number") + F.col("before"))
        self.rows = placed(spark, numbered.drop("before", "part"), self.plan)

    def sequences(self) -> DataFrame:
        """sequence_id and its ids, in order; needs ``with_ids``. A group is one sequence, of at most ``capacity`` ids."""
        some = self.rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("some"))
        return some.select("sequence_id", F.flatten(F.col("some.ids")).alias("ids"))


def placed(spark: SparkSession, numbered: DataFrame, packing: Plan) -> DataFrame:
    """Sequence and offset of numbered pieces; the runs, bounded by the number of lengths, go to all tasks."""
    runs = np.array(sorted(packing.runs), np.int64).reshape(-1, 6)
    shared = spark.sparkContext.broadcast((runs[:, 0] << 48 | runs[:, 1], runs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, table = shared.value
        for batch in batches:
            length, number = (batch.column(batch.schema.get_field_index(n)).to_numpy() for n in ("length", "number"))
            _, first, _, q, bin, offset = table[np.searchsorted(keys, length << 48 | number, "right") - 1].T
            within = number - first
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if n != "number"}
            yield record(**columns, sequence_id=bin + within // q, offset=offset + within % q * length)

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema if f.name != "number"]
    return numbered.mapInArrow(run, ", ".join([*fields, "sequence_id long", "offset long"]))
