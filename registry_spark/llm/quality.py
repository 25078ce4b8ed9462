"""Quality rules: base counts, and a hashed n-gram log-likelihood ratio (operator 6).

Two multinomials over hashed n-grams, one of trusted documents and one of the whole
corpus, give every document the mean log ratio of its n-grams; documents below a
threshold go. The n-grams are single words and pairs of words, as written and as shapes
(classes of characters, runs shortened), so that unseen words still tell by their make.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registry_spark.llm.hashing import joined, mixed
from registry_spark.llm.tasks import begin, Numbers, arrow, byte_texts, chunked, loaded, numbered_words, record, segment_sums, ship
from registry_spark.sources.shared import written

BUCKETS = 1 << 16
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
SYMBOLS = b"#*$%&|<>"
# Rejecting a good document weighs as much as keeping this many bad ones.
GOOD_WEIGHT = 20.0
# Scores are counted in steps of 1 / STEPS before any two are compared: some thousands of steps, as scores are log ratios.
STEPS = 1024

SHAPES = bytes(
    ord("a") if chr(b).islower() and b < 128 else ord("A") if chr(b).isupper() and b < 128 else ord("0") if 48 <= b < 58 else ord("a") if b >= 128 else b
    for b in range(256)
)
RUN = regex.compile(rb"(.)\1+", regex.DOTALL)


class Words:
    """Numbers the distinct words met by a worker; per number: hashes, code points, symbols."""

    def __init__(self, capacity: int = 500_000):
        self.capacity = capacity
        self.clear()

    def clear(self) -> None:
        self.numbers = Numbers()
        self.hash, self.shape = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.chars, self.symbols = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts in one array, and where each text begins."""
        if len(self.numbers) > self.capacity:
            self.clear()
        flat, bounds = numbered_words(texts, self.numbers)
        new = self.numbers.new()
        if new:
            kinds = [RUN.sub(rb"\1", w.translate(SHAPES)) for w in new]
            add = lambda old, values, kind: np.concatenate((old, np.fromiter(values, kind, len(new))))
            self.hash = add(self.hash, map(xxhash.xxh3_64_intdigest, new), np.uint64)
            self.shape = add(self.shape, (xxhash.xxh3_64_intdigest(k, 1) for k in kinds), np.uint64)
            self.chars = add(self.chars, (len(w.decode()) for w in new), np.int64)
            self.symbols = add(self.symbols, (len(w) - len(w.translate(None, SYMBOLS)) for w in new), np.int64)
        return flat, bounds

    def grams(self, flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket of every n-gram, and the text it is of."""
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        inside = text[1:] == text[:-1]
        parts, owners = [], []
        for hashes in (self.hash[flat], self.shape[flat]):
            parts += [mixed(hashes), joined(hashes[:-1], hashes[1:])[inside]]
            owners += [text, text[:-1][inside]]
        return (np.concatenate(parts) & np.uint64(BUCKETS - 1)).astype(np.int64), np.concatenate(owners)


def repeated_windows(flat: np.ndarray, bounds: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Per text: words that lie in a window of WINDOW words found twice or more in the text.

    Windows are sorted by a 64-bit hash; equal hashes count only when all words are equal.
    """
    n = len(flat)
    out = np.zeros(len(bounds) - 1, np.int64)
    if n < WINDOW:
        return out
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    key = hashes[flat]
    for step in (1, 2, 4):
        key = joined(key[:-step], key[step:])
    starts = np.flatnonzero(text[: len(key)] == text[WINDOW - 1 :])
    key = joined(key[starts], text[starts].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    at, sorted_keys = starts[order], key[order]
    same = np.flatnonzero(sorted_keys[1:] == sorted_keys[:-1])
    a, b = at[same], at[same + 1]
    equal = text[a] == text[b]
    for i in range(WINDOW):
        equal &= flat[a + i] == flat[b + i]
    hit = np.zeros(n + 1, np.int64)
    np.add.at(hit, np.unique(np.concatenate((a[equal], b[equal]))), 1)
    ends = np.zeros(n + 1, np.int64)
    ends[WINDOW:] = hit[: n + 1 - WINDOW]
    covered = np.cumsum(hit - ends)[:n] > 0
    return np.bincount(text[covered], minlength=len(out)).astype(np.int64)


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


@dataclass
class QualityModel:
    """Log ratio of trusted to raw relative frequency per bucket; documents with a smaller mean than ``threshold`` go."""

    ratio: np.ndarray
    threshold: float


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Smoothed log ratio; the target is smoothed by the raw distribution, one pseudo-count a bucket on average."""
    share = (raw + 1.0) / (raw.sum() + len(raw))
    return np.log((target + len(raw) * share) / (target.sum() + len(raw))) - np.log(share)


def labelled(labels: DataFrame, *, id: str = "doc_id", quality: str = "quality") -> DataFrame:
    """Every labelled id once: __id, __good, and __half, whether it trains the trusted model (else it sets the threshold).

    An id labelled more than once is good when all its labels are; NULL ids and labels are left out.
    """
    known = labels.select(F.col(id).cast("long").alias("__id"), F.col(quality).cast("int").alias("q")).dropna()
    one = known.groupBy("__id").agg((F.min("q") > 0).alias("__good"))
    return one.withColumn("__half", F.pmod(F.xxhash64("__id"), F.lit(2)) == 0)


def gram_counts(documents: DataFrame, trusted: DataFrame, *, id: str, text: str) -> tuple[np.ndarray, np.ndarray]:
    """n-grams per bucket of the documents of ``trusted`` (__id, each once) and of all documents.

    Ids and texts meet by a hash join: ids never go through the driver, and texts are not sorted.
    """
    ship(documents.sparkSession)
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(__name__)
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for part in chunked(batch):
                words = loaded("quality words", key, Words)
                flat, bounds = words.read(byte_texts(part))
                buckets, owners = words.grams(flat, bounds)
                good = part.column(2).to_numpy(zero_copy_only=False).astype(bool)
                counts[1] += np.bincount(buckets, minlength=BUCKETS)
                if good.any():
                    counts[0] += np.bincount(buckets[good[owners]], minlength=BUCKETS)
        some = np.flatnonzero(counts[1])
        yield record(bucket=some, target=counts[0, some], raw=counts[1, some])

    marked = trusted.select("__id", F.lit(True).alias("__trusted")).hint("shuffle_hash")
    rows = documents.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).join(
        marked, F.col("id") == F.col("__id"), "left"
    ).select("id", "text", F.coalesce("__trusted", F.lit(False)).alias("trusted"))
    per_task = rows.mapInArrow(run, "bucket long, target long, raw long")
    out = np.zeros((2, BUCKETS), np.int64)
    for r in per_task.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw")).collect():
        out[:, r["bucket"]] = r["target"], r["raw"]
    return out[0], out[1]


def measured(documents: DataFrame, ratio: np.ndarray, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: base counts, ``base_failed``, and ``score``, the mean log ratio of its n-grams (0 without words)."""
    spark = ship(documents.sparkSession)
    shared = spark.sparkContext.broadcast(ratio)
    key = uuid.uuid4().hex

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in chunked(batch):
            words = loaded("quality words", key, Words)
            texts = byte_texts(part)
            flat, bounds = words.read(texts)
            buckets, owners = words.grams(flat, bounds)
            n_words = np.diff(bounds)
            n_grams = np.bincount(owners, minlength=len(texts))
            repeat = repeated_windows(flat, bounds, words.hash)
            yield record(
                id=part.column(0),
                n_words=n_words,
                word_chars=segment_sums(words.chars[flat], bounds).astype(np.int64),
                n_symbols=segment_sums(words.symbols[flat], bounds).astype(np.int64),
                n_dup_lines=np.array([duplicate_lines(t) for t in texts], np.int64),
                n_repeat_words=repeat,
                base_failed=(n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n_words),
                score=np.bincount(owners, shared.value[buckets], minlength=len(texts)) / np.maximum(n_grams, 1),
            )

    kind = documents.schema[id].dataType.simpleString()
    schema = (
        f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, score double"
    )
    return arrow(documents.select(F.col(id).alias("id"), F.col(text).alias("text")), run, schema).withColumnRenamed("id", id)


def best_threshold(good: np.ndarray, bad: np.ndarray, weight: float = GOOD_WEIGHT) -> float:
    """The score below which documents go: most bad ones below, each good one below counting ``weight`` of them.

    Shares of each class are compared, so the ratio of labels does not matter. Halfway
    between neighbouring scores; keeps everything when a class is empty or no cut pays.
    """
    if not len(good) or not len(bad):
        return -np.inf
    scores = np.unique(np.concatenate((good, bad)))
    cuts = np.concatenate(([-np.inf], (scores[1:] + scores[:-1]) / 2))
    gain = np.searchsorted(np.sort(bad), cuts) / len(bad) - weight * np.searchsorted(np.sort(good), cuts) / len(good)
    return float(cuts[int(np.argmax(gain))])


def threshold_of(scored: DataFrame, weight: float = GOOD_WEIGHT) -> float:
    """``best_threshold`` of any number of rows (__good, score): each distinct score is a cut, none is left out.

    Scores are counted once, their counts summed up by steps, and steps and the scores inside each are totalled in order.
    """
    good, bad = F.count_if("__good"), F.count_if(~F.col("__good"))
    counts = written(
        scored.groupBy("score").agg(good.alias("good"), bad.alias("bad")).withColumn("step", F.floor(F.col("score") * STEPS))
    )
    n_good, n_bad = counts.agg(F.sum("good"), F.sum("bad")).first()
    if not n_good or not n_bad:
        return -np.inf
    steps = counts.groupBy("step").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.max("score").alias("last"))
    before = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    starts = steps.select(
        "step", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("good", "bad")],
        F.max("last").over(before).alias("last_before"),
    )
    order = Window.partitionBy("step").orderBy("score")
    inside = order.rowsBetween(Window.unboundedPreceding, -1)
    below = counts.select(
        "step", "score", F.lag("score").over(order).alias("last"),
        *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(c) for c in ("good", "bad")],
    ).join(starts, "step")
    last = F.coalesce("last", "last_before")
    middle = (F.col("score") + last) / 2
    gain = (F.col("bad") + F.col("bad_before")) / F.lit(n_bad) - F.lit(weight) * (F.col("good") + F.col("good_before")) / F.lit(n_good)
    cuts = below.filter(last.isNotNull()).select(gain.alias("gain"), F.when(middle > last, middle).otherwise(F.col("score")).alias("cut"))
    best = cuts.agg(F.max(F.struct("gain", (-F.col("cut")).alias("low")))).first()[0]
    return -best["low"] if best and best["gain"] > 0 else -np.inf


def judged(
    documents: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, QualityModel]:
    """Every document's counts, score and ``kept``, with the model used.

    NULL and empty texts have no words and fail the base rules; every row, also a repeated one, is judged by its whole
    text. n-grams of all documents are counted; the trusted ones are all good documents of the training half of the
    labels (``labelled``), and the threshold comes from all base-rule survivors of the other half. Without labels only
    the base rules decide. Other columns are not read.
    """
    known = written(labelled(labels))
    target, raw = gram_counts(documents, known.filter("__good AND __half"), id=id, text=text)
    ratio = log_ratio(target, raw) if target.sum() else np.zeros(BUCKETS)
    rows = written(measured(documents, ratio, id=id, text=text))
    held = known.filter("NOT __half")
    seen = rows.join(held, F.col(id).cast("long") == F.col("__id")).filter("NOT base_failed").select("__good", "score")
    model = QualityModel(ratio, threshold_of(seen) if target.sum() else -np.inf)
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(model.threshold))), model
