"""Language identification by words, with character n-grams for unseen words (operator 9)."""

from __future__ import annotations

import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registry_spark.llm.tasks import Numbers, arrow, byte_texts, chunked, loaded, numbered_words, record, segment_sums, segments, ship
from registry_spark.sources.shared import written

UNDETERMINED = "und"
NOT_LETTER = regex.compile(r"[^\p{L}\p{M}]+")
LETTER = regex.compile(r"\p{L}")

# Words, and n-grams of each length, that every task gets; all others are joined.
WORD_ENTRIES, GRAM_ENTRIES = 200_000, 50_000
GRAM_LENGTHS = (5, 4, 3, 2, 1)
SMOOTHING = 0.5
# Each shorter n-gram tells less about a word.
BACKOFF = 0.4


def normal(token: bytes) -> str:
    """Letters of a token, in lower case and composed form; marks stay with their letters."""
    return NOT_LETTER.sub("", unicodedata.normalize("NFC", token.decode().lower()))


def grams(word: str, n: int) -> list[str]:
    """Character n-grams of a word with a mark at either end."""
    text = f"\x02{word}\x03"
    return [text[i : i + n] for i in range(len(text) - n + 1)] if n > 1 else list(word)


def by_key(counts: DataFrame, key: str) -> DataFrame:
    """Counts (lang, key, n) as one row a key: key, n over all languages, entries (lang, n)."""
    sums = counts.groupBy("lang", key).agg(F.sum("n").alias("n"))
    return sums.groupBy(key).agg(F.sum("n").alias("n"), F.collect_list(F.struct("lang", "n")).alias("entries"))


def counted_words(labelled: DataFrame) -> DataFrame:
    """Occurrences of every normalised word: word, n, and each language's as entries (lang, n)."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in chunked(batch):
            tokens: dict[str, Counter] = {}
            for lang, text in zip(part.column(0).to_pylist(), byte_texts(part)):
                tokens.setdefault(lang, Counter()).update(text.split())
            langs, words, counts = [], [], []
            for lang, found in tokens.items():
                merged: Counter = Counter()
                for token, n in found.items():
                    if word := normal(token):
                        merged[word] += n
                langs += [lang] * len(merged)
                words += merged.keys()
                counts += merged.values()
            yield record(lang=pa.array(langs, pa.string()), word=pa.array(words, pa.string()), n=pa.array(counts, pa.int64()))

    return by_key(arrow(labelled.select("lang", "text"), run, "lang string, word string, n long"), "word")


def counted_grams(words: DataFrame) -> DataFrame:
    """Occurrences of every n-gram: gram, n, entries (lang, n); from counted words, none left out."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for lang, word, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
            counter = found.setdefault(lang, Counter())
            for length in GRAM_LENGTHS:
                for gram in grams(word, length):
                    counter[gram] += n
        for lang, counter in found.items():
            yield record(
                lang=pa.array([lang] * len(counter), pa.string()), gram=pa.array([*counter], pa.string()),
                n=pa.array(counter.values(), pa.int64()),
            )

    rows = words.select("word", F.explode("entries").alias("e")).select("e.lang", "word", "e.n")
    return by_key(arrow(rows, run, "lang string, gram string, n long"), "gram")


def most_frequent(counts: DataFrame, groups: list[str], entries: int) -> DataFrame:
    """The frequent rows of each group, at most ``entries`` of each.

    Rows are kept above a count that a histogram over classes of counts (an eighth of a
    power of two wide, so a few hundred rows a group) shows to leave few enough.
    """
    step = F.floor(8 * F.log2("n"))
    histogram = counts.groupBy(*groups, step.alias("step")).agg(F.count(F.lit(1)).alias("rows"))
    floors: dict[tuple, int] = {}
    kept: dict[tuple, int] = {}
    for row in sorted(histogram.collect(), key=lambda r: -r["step"]):
        group = tuple(row[g] for g in groups)
        kept[group] = kept.get(group, 0) + row["rows"]
        if kept[group] <= entries:
            floors[group] = row["step"]
        else:
            kept[group] = entries + 1
    if not floors:
        return counts.limit(0)
    keep = F.lit(False)
    for group, floor in floors.items():
        same = F.lit(True)
        for name, value in zip(groups, group):
            same = same & F.col(name).eqNullSafe(F.lit(value))
        keep = keep | (same & (step >= floor))
    return counts.filter(keep)


@dataclass
class Model:
    """What the languages' documents taught: the counts of all words and n-grams as tables, the frequent ones as matrices.

    ``words`` and ``grams`` give an entry's number, and a matrix row per number of centred log
    frequencies per language; entries beyond them are joined with ``word_counts`` and ``gram_counts``.
    """

    languages: list[str]
    totals: dict[str, int]
    words: tuple[dict, np.ndarray]
    grams: tuple[dict, np.ndarray]
    word_counts: DataFrame
    gram_counts: DataFrame


def log_shares(entries: list[list[dict]], languages: list[str], totals: dict[str, int]) -> np.ndarray:
    """Per list of entries (lang, n) the log of each language's smoothed relative frequency, less their mean."""
    place = {lang: i for i, lang in enumerate(languages)}
    counts = np.full((len(entries), len(languages)), SMOOTHING)
    for k, found in enumerate(entries):
        for e in found:
            counts[k, place[e["lang"]]] += e["n"]
    share = np.log(counts / (np.array([totals[lang] for lang in languages], float) + SMOOTHING))
    return (share - share.mean(axis=1, keepdims=True) if languages else share).astype(np.float32)


def listed(counts: DataFrame, key: str, languages: list[str], totals: dict[str, int]) -> tuple[dict, np.ndarray]:
    """Number of every entry of a small table of counts, by way of Arrow, and their matrix."""
    table = counts.select(key, "entries").toArrow()
    numbers = {k: i for i, k in enumerate(table.column(0).to_pylist())}
    rows = [np.zeros((0, len(languages)), np.float32)]
    for batch in table.to_batches(max_chunksize=10_000):
        rows.append(log_shares(batch.column(1).to_pylist(), languages, totals))
    return numbers, np.concatenate(rows)


def train(labelled: DataFrame) -> Model:
    """Model of all labelled documents (columns lang, text); rows without a language or text are left out.

    Every document is counted, and all counts are kept as tables. Every task also gets the most
    frequent entries with the counts of all languages: at most WORD_ENTRIES words and GRAM_ENTRIES
    n-grams of each length, however large the corpus. No rows give a model without languages.
    """
    words = written(counted_words(labelled.filter("lang IS NOT NULL AND text IS NOT NULL")))
    by_language = words.select(F.explode("entries").alias("e")).groupBy("e.lang").agg(F.sum("e.n").alias("n"))
    totals = {r["lang"]: r["n"] for r in by_language.collect()}
    languages = sorted(totals)
    grams = written(counted_grams(words))
    frequent = most_frequent(words, [], WORD_ENTRIES)
    few = most_frequent(grams.withColumn("length", F.length("gram")), ["length"], GRAM_ENTRIES)
    return Model(languages, totals, listed(frequent, "word", languages, totals), listed(few, "gram", languages, totals), words, grams)


class Scorer:
    """Sums the listed words of texts and names the others; each distinct token is looked up once, up to ``capacity`` tokens."""

    def __init__(self, words: tuple[dict, np.ndarray], capacity: int = 500_000):
        self.listed, self.table = words
        self.capacity = capacity
        self.clear()

    def clear(self) -> None:
        self.numbers = Numbers()
        # Row of the table; -1 for a word beyond it, -2 for a token without a letter.
        self.row = np.zeros(0, np.int64)
        self.others: dict[int, str] = {}

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[dict[str, int]]]:
        """Per text: sum of its listed words' scores by language, their number, and how often it has each other word."""
        if len(self.numbers) > self.capacity:
            self.clear()
        flat, bounds = numbered_words(texts, self.numbers)
        if new := self.numbers.new():
            first, rows = len(self.row), []
            for k, word in enumerate(map(normal, new)):
                rows.append(self.listed.get(word, -1) if word else -2)
                if rows[-1] == -1:
                    self.others[first + k] = word
            self.row = np.concatenate((self.row, np.array(rows, np.int64)))
        row = self.row[flat]
        here = row >= 0
        sums = np.zeros((len(texts), self.table.shape[1]))
        for j in range(sums.shape[1]):
            scores = np.zeros(len(flat))
            scores[here] = self.table[row[here], j]
            sums[:, j] = segment_sums(scores, bounds)
        rest = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            rest.append(Counter(self.others[t] for t in flat[a:b][row[a:b] == -1].tolist()))
        return sums, segment_sums(here, bounds).astype(np.int64), rest


def longest_grams(word: str, known: dict[str, int]) -> Iterator[tuple[int, int, str, int | None]]:
    """Place, step of GRAM_LENGTHS, n-gram and its number, from the longest at each place down to the first that is listed."""
    text = f"\x02{word}\x03"
    for i in range(len(word) + 1):
        gram = None
        for step, n in enumerate(GRAM_LENGTHS):
            # Near the end the longest strings are the same; a mark alone is no n-gram.
            last, gram = gram, text[i : i + n]
            if gram not in (last, "\x02"):
                yield i, step, gram, (number := known.get(gram))
                if number is not None:
                    break


def unseen_scores(words: DataFrame, model: Model) -> DataFrame:
    """Scores of distinct words (word) that no language has, by their n-grams: word, scores; words without a known one are left out.

    Each place of a word takes the longest known n-gram that starts there, and the word their mean.
    N-grams beyond the listed ones are joined with all counts.
    """
    shared = ship(words.sparkSession).sparkContext.broadcast((model.languages, model.totals, model.grams))

    def look(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known = shared.value[2][0]
        for first in range(0, batch.num_rows, 10_000):
            rows = [
                (word, place, step, gram) for word in batch.column(0).slice(first, 10_000).to_pylist()
                for place, step, gram, number in longest_grams(word, known) if number is None
            ]
            word, place, step, gram = zip(*rows) if rows else ((), (), (), ())
            yield record(
                word=pa.array(word, pa.string()), place=pa.array(place, pa.int32()), step=pa.array(step, pa.int32()), gram=pa.array(gram, pa.string())
            )

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        languages, totals, (known, table) = shared.value
        names, rows = [], []
        for word, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            best: dict[int, tuple[int, np.ndarray]] = {}
            for place, step, _, number in longest_grams(word, known):
                if number is not None:
                    best[place] = (step, table[number])
            joined = sorted(found or [], key=lambda e: -e["step"])
            for e, row in zip(joined, log_shares([e["entries"] for e in joined], languages, totals)):
                best[e["place"]] = (e["step"], row)
            if best:
                names.append(word)
                rows.append(np.mean([BACKOFF**step * row.astype(float) for step, row in best.values()], axis=0))
        ends = pa.array((np.arange(len(rows) + 1) * len(languages)).astype(np.int32))
        yield record(word=pa.array(names, pa.string()), scores=pa.ListArray.from_arrays(ends, np.concatenate(rows) if rows else np.zeros(0)))

    wanted = arrow(words, look, "word string, place int, step int, gram string")
    found = wanted.join(model.gram_counts.select("gram", "entries"), "gram").groupBy("word").agg(
        F.collect_list(F.struct("place", "step", "entries")).alias("found")
    )
    return arrow(words.join(found, "word", "left").select("word", "found"), score, "word string, scores array<double>")


# Number of words that some language has, and of those read by n-grams, beside the languages' sums.
SEEN, READ = -1, -2


def other_words(rest: DataFrame, model: Model) -> DataFrame:
    """Sums over words beyond the table, from __row, word, times: __row, __more.

    __more has, by a language's place, the sum of log(n + SMOOTHING) - log(SMOOTHING) of the words it
    has and of the scores of words no language has, and the numbers SEEN and READ of words.
    """
    value = lambda lang, x: F.struct(lang.cast("int").alias("lang"), x.cast("double").alias("value"))
    one = lambda kind: F.array(value(F.lit(kind), F.lit(1.0)))
    names = F.array(*[F.lit(x) for x in model.languages])
    words = written(rest.select("word").distinct().join(model.word_counts.select("word", "entries"), "word", "left"))
    seen = words.filter("entries IS NOT NULL").select("word", F.concat(
        F.transform("entries", lambda e: value(F.array_position(names, e["lang"]) - 1, F.log(e["n"] + F.lit(SMOOTHING)) - F.log(F.lit(SMOOTHING)))),
        one(SEEN),
    ).alias("values"))
    unseen = unseen_scores(words.filter("entries IS NULL").select("word"), model).select(
        "word", F.concat(F.transform("scores", lambda x, i: value(i, x)), one(READ)).alias("values")
    )
    each = rest.join(seen.unionByName(unseen), "word").select("__row", "times", F.explode("values").alias("v"))
    sums = each.groupBy("__row", "v.lang").agg(F.sum(F.col("times") * F.col("v.value")).alias("value"))
    return sums.groupBy("__row").agg(F.map_from_entries(F.collect_list(F.struct("lang", "value"))).alias("__more"))


def told(documents: DataFrame, model: Model, keep: list[str], text: str, settle: bool = False) -> DataFrame:
    """``keep`` columns as __k0, __k1, ..., and of every text: __letter (whether it has one), __known (number of words known), __mean (by language).

    ``settle`` is for whether any word is known: other words are then looked up only for texts without a listed one.
    """
    spark = ship(documents.sparkSession)
    shared = spark.sparkContext.broadcast(model.words)
    key = uuid.uuid4().hex
    place = f"__k{keep.index(text)}" if text in keep else "__text"

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        scorer = loaded("language scorer", key, lambda: Scorer(shared.value))
        for part in chunked(batch, place):
            texts = byte_texts(part, place)
            sums, known, rest = scorer.read(texts)
            if settle:
                rest = [Counter() if n else x for n, x in zip(known.tolist(), rest)]
            some = [LETTER.search(t.decode()) is not None for t in texts]
            ends = lambda sizes: pa.array(segments(np.array(sizes)).astype(np.int32))
            to = ends([len(x) for x in rest])
            yield record(
                **dict(zip(part.schema.names[: len(keep)], part.columns)), __letter=pa.array(some, pa.bool_()), __listed=known,
                __sums=pa.ListArray.from_arrays(ends([sums.shape[1]] * len(sums)), sums.ravel()),
                __words=pa.ListArray.from_arrays(to, pa.array([w for x in rest for w in x], pa.string())),
                __times=pa.ListArray.from_arrays(to, pa.array([n for x in rest for n in x.values()], pa.int64())),
            )

    fields = "".join(f"`__k{i}` {documents.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    rows = documents.select(*[F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keep)], *[F.col(f"`{text}`").alias("__text")] * (text not in keep))
    parts = arrow(rows, run, f"{fields}__letter boolean, __listed long, __sums array<double>, __words array<string>, __times array<long>")
    parts = written(parts.withColumn("__row", F.monotonically_increasing_id()))
    rest = parts.select("__row", F.explode(F.arrays_zip("__words", "__times")).alias("w")).select(
        "__row", F.col("w.__words").alias("word"), F.col("w.__times").alias("times")
    )
    narrow = parts.drop("__words", "__times")
    whole = narrow.filter(F.size("__words") > 0).join(other_words(rest, model), "__row", "left").unionByName(
        narrow.filter(F.size("__words") == 0).withColumn("__more", F.lit(None).cast("map<int,double>"))
    )
    more = lambda k: F.coalesce(F.try_element_at("__more", k), F.lit(0.0))
    base = F.array(*[F.lit(float(np.log(SMOOTHING / (model.totals[x] + SMOOTHING)))) for x in model.languages])
    known = F.col("__listed") + more(F.lit(SEEN)) + more(F.lit(READ))
    mean = F.transform(base, lambda b, i: (F.get("__sums", i) + more(i) + more(F.lit(SEEN)) * b) / F.greatest(F.col("__known"), F.lit(1.0)))
    return whole.withColumn("__known", known).withColumn("__mean", mean).select(*[f"__k{i}" for i in range(len(keep))], "__letter", "__known", "__mean")


def identify(documents: DataFrame, model: Model, *, id: str = "doc_id", text: str = "text", keep: list[str] = ()) -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` of every document, from its whole text alone.

    The language with the largest mean score of the words known, ties to the first by name; the score is
    the softmax share of that mean over the languages. A word that some language has scores by the counts of all
    languages, any other by its n-grams. A NULL or empty text, or one without a
    letter, is ``und`` with score 0, as is every text when no language was learned.
    A text of which no word or n-gram is known scores all languages alike.
    """
    kept = [*keep] or [id]
    if not model.languages:
        same = [F.col(f"`{c}`").alias(c) for c in kept]
        return documents.select(*same, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    best = F.array_max("__mean")
    names = F.array(*[F.lit(x) for x in model.languages])
    share = 1 / F.aggregate("__mean", F.lit(0.0), lambda total, x: total + F.exp(x - best))
    return told(documents, model, kept, text).select(
        *[F.col(f"__k{i}").alias(c) for i, c in enumerate(kept)],
        F.when(F.col("__letter"), F.element_at(names, F.array_position("__mean", best).cast("int"))).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(F.col("__letter"), share).otherwise(0.0).alias("score"),
    )


def recognised(documents: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The documents, all columns, whose language is recognised: with a letter, and a word or n-gram that the model knows."""
    if not model.languages:
        return documents.limit(0)
    names = [f"__c{i}" for i in range(len(documents.columns))]
    found = told(documents.toDF(*names), model, names, names[documents.columns.index(text)], settle=True)
    return found.filter("__letter AND __known > 0").drop("__letter", "__known", "__mean").toDF(*documents.columns)
