"""Log-bilinear language model over word classes, trained by noise-contrastive estimation (operator 1).

Frequent words are classes of their own, all others share classes by their last two
bytes. The model scores the class that follows two others, s(a, b, c) = (A[a] + B[b]) . Q[c]
+ bias[c], and is trained in numpy to tell observed classes from noise. Since the table
of all (a, b) is small, matrix products normalise every context once. Within its class a
word has its share of the smoothed training counts. Together the probabilities of all
training words, and of one unseen word for each class, sum to 1 after every context.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry_spark.llm.tasks import Numbers, arrow, byte_texts, chunked, loaded, numbered_words, record, segment_sums, segments, ship
from registry_spark.sources.shared import written

CLASSES, ENDINGS = 256, 64
DIMS, ROUNDS, SHARDS = 32, 5, 4
BATCH, NOISE, RATE = 2_048, 48, 0.3
# Words whose counts every task holds; all other words are joined.
LISTED_WORDS, LISTED_BYTES = 100_000, 64
SMOOTHING = 0.1
# The end of a document, counted as a token; no word holds a blank.
END = b" "


def ending_class(word: bytes) -> int:
    """Class of a word that has none of its own."""
    return CLASSES - ENDINGS + zlib.crc32(word[-2:]) % ENDINGS


def word_counts(documents: DataFrame) -> DataFrame:
    """Occurrences of every token in the documents (column text): word (binary), n. Letters A-Z count as a-z."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in chunked(batch, size=16 << 20):
            found: Counter = Counter()
            for text in byte_texts(part):
                found.update(text.lower().split())
            found[END] += part.num_rows
            yield record(word=pa.array([*found], pa.binary()), n=pa.array(found.values(), pa.int64()))

    return arrow(documents.select("text"), run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, entries: int = LISTED_WORDS) -> list[tuple[bytes, int]]:
    """The most frequent words, at most ``entries``, from a floor that a histogram over classes of counts gives."""
    short = counts.filter(F.octet_length("word") <= LISTED_BYTES).withColumn("step", F.floor(8 * F.log2("n")))
    kept, floor = 0, None
    for row in sorted(short.groupBy("step").agg(F.count(F.lit(1)).alias("words")).collect(), key=lambda r: -r["step"]):
        kept += row["words"]
        if kept > entries:
            break
        floor = row["step"]
    if floor is None:
        return []
    rows = short.filter(F.col("step") >= floor).select("word", "n").collect()
    return sorted(((bytes(r["word"]), r["n"]) for r in rows), key=lambda r: (-r[1], r[0]))


@dataclass
class Vocabulary:
    """Classes of the listed words, and what the counts sum to."""

    listed: dict[bytes, int]  # word: place
    counts: np.ndarray  # by place
    classes: np.ndarray  # by place
    tokens: int
    distinct: int
    mass: np.ndarray  # by class: sum over its training words of count + SMOOTHING, and SMOOTHING for an unseen one


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Classes and class sums over all counted words."""
    rows = frequent_words(counts)
    listed = {word: i for i, (word, _) in enumerate(rows)}
    own = [w for w, _ in rows if w != END][: CLASSES - ENDINGS - 1]
    alone = {END: 0} | {w: i + 1 for i, w in enumerate(own)}
    classes = np.array([alone[w] if w in alone else ending_class(w) for w, _ in rows], np.int64)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        words, n = batch.column(0).to_pylist(), np.array(batch.column(1), np.int64)
        kind = np.array([alone[w] if w in alone else ending_class(w) for w in words], np.int64)
        some = np.unique(kind)
        yield record(
            kind=some, words=np.bincount(kind, minlength=CLASSES)[some], n=np.bincount(kind, n, CLASSES).astype(np.int64)[some]
        )

    sums = arrow(counts.select("word", "n"), run, "kind long, words long, n long").groupBy("kind").agg(F.sum("words").alias("words"), F.sum("n").alias("n"))
    mass, tokens, distinct = np.full(CLASSES, SMOOTHING), 0, 0
    for r in sums.collect():
        mass[r["kind"]] += r["n"] + SMOOTHING * r["words"]
        tokens, distinct = tokens + r["n"], distinct + r["words"]
    return Vocabulary(listed, np.array([n for _, n in rows], np.int64), classes, tokens, distinct, mass)


class Reader:
    """Numbers the words of texts; knows each distinct word's class and place in the list (-1: not listed)."""

    def __init__(self, vocabulary: Vocabulary, capacity: int = 500_000):
        self.vocabulary, self.capacity = vocabulary, capacity
        self.clear()

    def clear(self) -> None:
        self.numbers = Numbers()
        self.words: list[bytes] = []
        self.place, self.kind = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts, each text followed by the end, and where each text begins."""
        if len(self.numbers) > self.capacity:
            self.clear()
        v = self.vocabulary
        found = [np.append(self.numbers.of(t.lower().split()), self.numbers[END]) for t in texts]
        bounds = segments(np.fromiter(map(len, found), np.int64, len(found)))
        if new := self.numbers.new():
            place = np.fromiter((v.listed.get(w, -1) for w in new), np.int64, len(new))
            kind = np.array([v.classes[p] if p >= 0 else ending_class(w) if w != END else 0 for p, w in zip(place.tolist(), new)], np.int64)
            self.words += new
            self.place, self.kind = np.concatenate((self.place, place)), np.concatenate((self.kind, kind))
        return np.concatenate(found) if found else np.zeros(0, np.int64), bounds

    def contexts(self, flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For every token a * CLASSES**2 + b * CLASSES + c: the classes of the two tokens before it and its own.

        Ends stand before a text's first token.
        """
        kind = self.kind[flat]
        first = np.zeros(len(flat) + 1, bool)
        first[bounds[:-1]] = True
        b = np.concatenate(([0], kind[:-1]))
        a = np.concatenate(([0, 0], kind[:-2]))[: len(kind)]
        b[first[:-1]] = 0
        second = np.concatenate(([False], first[:-2])) if len(flat) else first[:0]
        a[first[:-1] | second] = 0
        return (a * CLASSES + b) * CLASSES + kind


def context_counts(documents: DataFrame, shared, key: str) -> DataFrame:
    """How often each class follows each two classes in the documents: context, n."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in chunked(batch, size=16 << 20):
            reader = loaded("class reader", key, lambda: Reader(shared.value))
            context, n = np.unique(reader.contexts(*reader.read(byte_texts(part))), return_counts=True)
            yield record(context=context.astype(np.int32), n=n)

    return arrow(documents.select("text"), run, "context int, n long").groupBy("context").agg(F.sum("n").alias("n"))


@dataclass
class Weights:
    """Parameters of the model: context vectors by distance, class vectors, biases."""

    far: np.ndarray
    near: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    @staticmethod
    def start(frequency: np.ndarray) -> "Weights":
        random = np.random.default_rng(1)
        draw = lambda: random.normal(0, 0.1, (CLASSES, DIMS)).astype(np.float32)
        return Weights(draw(), draw(), draw(), np.log(frequency).astype(np.float32))

    def packed(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in (self.far, self.near, self.out, self.bias)])

    @staticmethod
    def unpacked(x: np.ndarray) -> "Weights":
        far, near, out = x[: 3 * CLASSES * DIMS].reshape(3, CLASSES, DIMS)
        return Weights(far.copy(), near.copy(), out.copy(), x[3 * CLASSES * DIMS :].copy())

    def log_probabilities(self) -> np.ndarray:
        """log10 P(c | a, b) for all contexts, by one matrix product per a, normalised over c."""
        table = np.empty((CLASSES, CLASSES, CLASSES), np.float32)
        for a in range(CLASSES):
            score = (self.far[a] + self.near) @ self.out.T + self.bias
            top = score.max(axis=1, keepdims=True)
            table[a] = score - top - np.log(np.exp(score - top).sum(axis=1, keepdims=True))
        return table.reshape(-1) / np.float32(np.log(10))


def class_sums(classes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the rows of each class."""
    order = np.argsort(classes, kind="stable")
    ordered = classes[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    out = np.zeros((CLASSES, rows.shape[1]), np.float32)
    out[ordered[starts]] = np.add.reduceat(rows[order], starts)
    return out


def noise_contrastive_pass(w: Weights, context: np.ndarray, n: np.ndarray, noise: np.ndarray, rate: float, seed: int) -> Weights:
    """One pass of AdaGrad over counted contexts; every batch shares its noise classes.

    An observation counts as many times as it was seen; NCE tells it, at odds 1 to NOISE,
    from draws of the noise distribution: sigmoid(s - log(NOISE * noise)).
    """
    random = np.random.default_rng(seed)
    params = [w.far, w.near, w.out, w.bias]
    squares = [np.full_like(p, 1e-4) for p in params]
    log_noise = np.log(NOISE * noise).astype(np.float32)
    order = random.permutation(len(context))
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    for first in range(0, len(order), BATCH):
        rows = order[first : first + BATCH]
        a, b, c = context[rows] // CLASSES**2, context[rows] // CLASSES % CLASSES, context[rows] % CLASSES
        weight = (n[rows] / n[rows].sum()).astype(np.float32)
        drawn = random.choice(CLASSES, NOISE, p=noise)
        hidden = w.far[a] + w.near[b]
        seen = sigmoid((hidden * w.out[c]).sum(axis=1) + w.bias[c] - log_noise[c])
        other = sigmoid(hidden @ w.out[drawn].T + w.bias[drawn] - log_noise[drawn])
        up, down = weight * (1 - seen), -weight[:, None] * other
        to_hidden = up[:, None] * w.out[c] + down @ w.out[drawn]
        to_out, to_bias = class_sums(c, up[:, None] * hidden), np.bincount(c, up, CLASSES).astype(np.float32)
        np.add.at(to_out, drawn, down.T @ hidden)
        np.add.at(to_bias, drawn, down.sum(axis=0))
        steps = class_sums(a, to_hidden), class_sums(b, to_hidden), to_out, to_bias
        for p, square, step in zip(params, squares, steps):
            square += step * step
            p += np.float32(rate) * step / np.sqrt(square)
    return w


def shard_pass(shared, noise: np.ndarray, turn: int):
    """The work of one shard in one round: its parameters after a pass, and its weight."""

    def run(table):
        context, n = np.array(table.column("context"), np.int64), np.array(table.column("n"), np.int64)
        order = np.argsort(context)
        shard = table.column("shard")[0].as_py()
        start = Weights.unpacked(np.array(shared.value))
        w = noise_contrastive_pass(start, context[order], n[order], noise, RATE / (1 + turn), 1_000 * turn + shard)
        return pa.table({
            "shard": pa.array([shard], pa.int32()), "n": [int(n.sum())], "weights": pa.array([w.packed().tobytes()], pa.binary()),
        })

    return run


def train(documents: DataFrame, contexts: DataFrame) -> Weights:
    """Rounds of passes over SHARDS shards of the counted contexts, averaged by weight after each round.

    There are at most CLASSES**3 contexts whatever the corpus, so shards and parameters
    that meet in the driver are bounded. Shards are sorted, so a task that runs again gives
    the same parameters.
    """
    spark = documents.sparkSession
    frequency = np.full(CLASSES, 1.0)
    for r in contexts.groupBy(F.expr(f"context % {CLASSES}").alias("c")).agg(F.sum("n").alias("n")).collect():
        frequency[r["c"]] += r["n"]
    frequency /= frequency.sum()
    noise = frequency**0.75 / (frequency**0.75).sum()
    weights = Weights.start(frequency)
    shards = written(contexts.withColumn("shard", F.pmod(F.xxhash64("context"), F.lit(SHARDS)).cast("int")).repartition(SHARDS, "shard"))
    for turn in range(ROUNDS):
        run = shard_pass(spark.sparkContext.broadcast(weights.packed()), noise, turn)
        parts = sorted(shards.groupBy("shard").applyInArrow(run, "shard int, n long, weights binary").collect(), key=lambda r: r["shard"])
        if not parts:
            break
        total = sum(r["n"] for r in parts)
        mean = sum(np.frombuffer(r["weights"], np.float32).astype(float) * (r["n"] / total) for r in parts)
        weights = Weights.unpacked(mean.astype(np.float32))
    return weights


def scored(documents: DataFrame, training: DataFrame, *, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and the scores of every whole text, by a model of the ``training`` rows (column ``text``).

    Adds n_tokens, n_known, train_tokens, base_score (smoothed unigrams), score (the
    model); both are log10 probabilities of the text with its end. NULL and empty texts are the end
    alone. Every row is scored, repeated ones alike. Without training rows all tokens are unseen: base_score
    is 0 and score that of an untrained model. Columns not in ``keep`` are not carried.

    Counts of LISTED_WORDS words go to all tasks; every other word of a document is joined
    with its count and the parts summed per document.
    """
    spark = ship(documents.sparkSession)
    learned = training.select(F.col(f"`{text}`").alias("text"))
    counts = written(word_counts(learned))
    v = vocabulary(counts)
    shared_vocabulary, key = spark.sparkContext.broadcast(v), uuid.uuid4().hex
    weights = train(documents, written(context_counts(learned, shared_vocabulary, key)))
    shared = spark.sparkContext.broadcast(weights)
    log_mass = np.log10(v.mass)
    base_one = np.log10(v.tokens + SMOOTHING * (v.distinct + 1))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        reader = loaded("class reader", key, lambda: Reader(shared_vocabulary.value))
        table = loaded("class probabilities", key, lambda: shared.value.log_probabilities())
        log_counts = np.log10(reader.vocabulary.counts + SMOOTHING)
        for part in chunked(batch, "__text"):
            flat, bounds = reader.read(byte_texts(part, "__text"))
            place = reader.place[flat]
            listed = place >= 0
            own = np.zeros(len(flat))
            own[listed] = log_counts[place[listed]]
            n = np.diff(bounds)
            alike = segment_sums(table[reader.contexts(flat, bounds)] - log_mass[reader.kind[flat]], bounds)
            sums = segment_sums(own, bounds)
            words, times, sizes = [], [], []
            for a, b in zip(bounds[:-1], bounds[1:]):
                rest, count = np.unique(flat[a:b][~listed[a:b]], return_counts=True)
                words += map(reader.words.__getitem__, rest.tolist())
                times.append(count)
                sizes.append(len(rest))
            ends = pa.array(segments(np.array(sizes)).astype(np.int32))
            columns = dict(zip(part.schema.names[:-1], part.columns[:-1]))
            yield record(
                **columns, __n=n, __known=segment_sums(listed, bounds).astype(np.int64), __listed=sums, __model=alike,
                __words=pa.ListArray.from_arrays(ends, pa.array(words, pa.binary())),
                __times=pa.ListArray.from_arrays(ends, pa.array(np.concatenate(times) if times else [], pa.int64())),
            )

    kept = [f"__k{i}" for i in range(len(keep))]
    fields = "".join(f"{k} {documents.schema[c].dataType.simpleString()}, " for k, c in zip(kept, keep))
    rows = documents.select(*[F.col(f"`{c}`").alias(k) for k, c in zip(kept, keep)], F.col(f"`{text}`").alias("__text"))
    parts = arrow(rows, run, f"{fields}__n long, __known long, __listed double, __model double, __words array<binary>, __times array<long>")
    parts = written(parts.withColumn("__row", F.monotonically_increasing_id()))
    rest = parts.select("__row", F.explode(F.arrays_zip("__words", "__times")).alias("w")).select(
        "__row", F.col("w.__words").alias("word"), F.col("w.__times").alias("times")
    )
    joined = rest.join(counts, "word", "left").groupBy("__row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTHING))).alias("__rest"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("__also"),
    )
    whole = parts.drop("__words", "__times").join(joined, "__row", "left")
    own = F.col("__listed") + F.coalesce("__rest", F.lit(0.0))
    return whole.select(
        *[F.col(k).alias(c) for k, c in zip(kept, keep)],
        F.col("__n").alias("n_tokens"),
        (F.col("__known") + F.coalesce("__also", F.lit(0))).cast("long").alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (own - F.col("__n") * F.lit(float(base_one))).alias("base_score"),
        (own + F.col("__model")).alias("score"),
    )
