"""Language model, quality rules and language identification."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from registry_spark.llm.language import identify, recognised, train
from registry_spark.llm.neural import CLASSES, END, SMOOTHING, Weights, ending_class, noise_contrastive_pass, scored, vocabulary, word_counts
from registry_spark.llm.quality import best_threshold, gram_counts, judged, labelled, threshold_of

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def slow_scores(rows, training):
    tokens = lambda t: [*(t or "").encode().lower().split(), END]
    c = Counter(w for t in training for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return sorted(
        ((i, len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n,
          round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)), 4)) for i, t in rows), key=str,
    )


@pytest.mark.parametrize("listed", [100_000, 30])
def test_base_scores(documents, odd_rows, listed, monkeypatch):
    monkeypatch.setattr("registry_spark.llm.neural.frequent_words.__defaults__", (listed,))
    rows = [r if r[0] != 4 else (4, r[1][:20_000], *r[2:]) for r in odd_rows]
    df = documents(rows).withColumn("held", F.col("doc_id") % 3 == 0)
    out = scored(df, df.filter("NOT held"), keep=["doc_id"]).collect()
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in out), key=str)
    assert got == slow_scores([r[:2] for r in rows], [t for i, t, *_ in rows if i is not None and i % 3])
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)


def test_probabilities_sum_to_one(spark, documents, odd_rows):
    df = documents(odd_rows)
    counts = word_counts(df)
    v = vocabulary(counts)
    assert v.tokens == sum(len((t or "").encode().split()) + 1 for _, t, _, _ in odd_rows)
    own = np.zeros(CLASSES)
    alone = {w: v.classes[p] for w, p in v.listed.items()}
    for r in counts.collect():
        word = bytes(r["word"])
        own[alone.get(word, ending_class(word))] += r["n"] + SMOOTHING
    assert np.allclose(own + SMOOTHING, v.mass)
    rng = np.random.default_rng(0)
    weights = Weights(*(rng.normal(size=(CLASSES, 32)).astype(np.float32) for _ in range(3)), rng.normal(size=CLASSES).astype(np.float32))
    table = 10 ** weights.log_probabilities().astype(float).reshape(CLASSES, CLASSES, CLASSES)
    assert np.allclose(table.sum(axis=2), 1, atol=1e-4)


def test_training_learns_what_follows():
    a, n = np.arange(200), np.full(200, 50)
    context = (a * CLASSES + (a * 7) % CLASSES) * CLASSES + (a * 3) % 20
    frequency = np.full(CLASSES, 1.0)
    np.add.at(frequency, context % CLASSES, n)
    frequency /= frequency.sum()
    w = Weights.start(frequency)
    before = w.log_probabilities()[context].mean()
    for turn in range(60):
        w = noise_contrastive_pass(w, context, n, frequency**0.75 / (frequency**0.75).sum(), 0.3, turn)
    assert w.log_probabilities()[context].mean() > before + 0.5


def test_model_beats_unigrams_on_held_out_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0)
    rows = scored(df, df.filter("NOT held_out"), keep=["held_out"]).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
    assert sum(r["score"] > r["base_score"] for r in rows) > 0.9 * len(rows)


def test_scoring_without_training_rows(documents):
    df = documents([(1, "a b", None, None), (2, None, None, None)])
    out = scored(df, df.limit(0), keep=["doc_id"]).orderBy("doc_id").collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in out] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert scored(documents([]), documents([]), keep=["doc_id"]).collect() == []


def slow_base(text):
    text = text or ""
    words = text.encode().split()
    lines = [x for x in text.encode().split(b"\n") if x.split()]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            inside.update(range(i, i + 8))
    n = len(words)
    return (
        n, sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside),
        n < 20 or 100 * len(inside) > 30 * n,
    )


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_quality_counts(spark, documents, odd_rows):
    rows = [*odd_rows, (200, "a b c d e f g h " * 3 + "#x* <b>", None, None), (201, "one two\nthree\none two\n\n \n", None, None)]
    out, model = judged(documents(rows), spark.createDataFrame([], LABELS))
    got = sorted(((r["doc_id"], *(r[c] for c in BASE)) for r in out.collect()), key=str)
    assert got == sorted(((i, *slow_base(t)) for i, t, *_ in rows), key=str)
    assert all(r["kept"] == (not r["base_failed"]) for r in out.collect())
    assert judged(documents([]), spark.createDataFrame([(1, 1, 0)], LABELS))[0].collect() == []


def test_quality_separates_labelled_documents(spark):
    df, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out, _ = judged(df, labels.unionByName(spark.createDataFrame([(None, 1, 0), (3, None, 0)], LABELS)))
    rows = out.join(labels, "doc_id").filter("NOT base_failed").collect()
    good, bad = ([r["kept"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.2 * len(bad)
    again, _ = judged(df.repartition(5), labels)
    assert again.select("doc_id", "kept").exceptAll(out.select("doc_id", "kept")).isEmpty()


def test_threshold():
    assert best_threshold(np.array([1.0, 2.0]), np.array([-3.0, -1.0])) == 0.0
    assert best_threshold(np.array([]), np.array([1.0])) == -math.inf
    assert best_threshold(np.array([0.0, 1.0]), np.array([5.0])) == -math.inf


def test_every_label_counts(spark):
    """More labels than 20,000: each good document of the training half is counted (a word and its shape)."""
    labels = spark.range(24_000).selectExpr("id AS doc_id", "1 AS quality")
    known = labelled(labels)
    half = known.filter("__good AND __half").count()
    texts = spark.range(24_000).selectExpr("id AS doc_id", "'w' || id AS text")
    target, raw = gram_counts(texts, known.filter("__good AND __half"), id="doc_id", text="text")
    assert known.count() == 24_000 and target.sum() == 2 * half and raw.sum() == 48_000 and half > 11_000


def test_threshold_of_a_table_is_that_of_the_arrays(spark):
    draw = np.random.default_rng(5)
    for good, bad in [
        (draw.normal(1, 1, 700), draw.normal(-1, 1, 500)),
        (draw.integers(0, 6, 300) / 4, draw.integers(-4, 3, 300) / 4),
        (np.array([1.0, 2.0]), np.array([-3.0, -1.0])), (np.array([]), np.array([1.0])), (np.array([0.0, 1.0]), np.array([5.0])),
    ]:
        rows = [(True, float(x)) for x in good] + [(False, float(x)) for x in bad]
        table = spark.createDataFrame(rows, "__good boolean, score double")
        for weight in (1.0, 20.0):
            assert threshold_of(table, weight) == best_threshold(good, bad, weight)


def test_languages(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    model = train(df.filter("NOT held_out"))
    rows = identify(df, model, keep=["doc_id", "held_out"]).join(df.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_documents(documents, odd_rows):
    df = documents(odd_rows)
    model = train(df)
    got = {r["doc_id"]: r for r in identify(df, model).collect()}
    assert {i for i, r in got.items() if r["lang_pred"] == "und"} == {1, 2, 3, 10, 12}
    assert {r["lang_pred"] for r in got.values()} == {"und", "en", "de"} and got[10]["score"] == 0
    left = recognised(df, model)
    assert left.columns == df.columns and left.count() == len(odd_rows) - 5


def test_language_without_training(documents):
    df = documents([(1, "some words", None, None), (2, None, "en", None)])
    assert {r["lang_pred"] for r in identify(df, train(df)).collect()} == {"und"}
    assert identify(documents([]), train(documents([]))).collect() == []


def test_unseen_words_use_shorter_strings(documents):
    german = "schöne straße über grün weiß möchte können für" * 3
    french = "élève où français être déjà garçon très château" * 3
    df = documents([(1, german, "de", None), (2, french, "fr", None)])
    got = identify(documents([(3, "schönstes weißgrün", None, None), (4, "élèves françaises", None, None)]), train(df)).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got] == ["de", "fr"]


def test_words_beyond_the_table_keep_their_counts(documents, odd_rows, monkeypatch):
    english = " ".join(f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100))
    rows = [r if r[0] != 4 else (4, r[1][:20_000], *r[2:]) for r in odd_rows]
    rows += [(100, f"{english} {english}", "en", "a"), (101, "wak wal " + english[:11], "es", "a"), (102, "zzz wak", None, "a"), (103, "wjt wit wat", None, "a")]
    df = documents(rows)
    whole = {r["doc_id"]: r for r in identify(df, train(df)).collect()}
    monkeypatch.setattr("registry_spark.llm.language.WORD_ENTRIES", 7)
    monkeypatch.setattr("registry_spark.llm.language.GRAM_ENTRIES", 5)
    few = train(df)
    assert len(few.words[0]) <= 7 and len(few.grams[0]) <= 25
    got = {r["doc_id"]: r for r in identify(df, few).collect()}
    assert {i: r["lang_pred"] for i, r in got.items()} == {i: r["lang_pred"] for i, r in whole.items()}
    assert [got[i]["score"] for i in whole] == pytest.approx([whole[i]["score"] for i in whole], rel=1e-4)


def test_word_of_two_languages_scores_by_both_counts(documents, monkeypatch):
    rare = " ".join(f"x{'abcdefgh'[i % 8]}{'klmnopqr'[i // 8]}" for i in range(58))
    df = documents([(1, "the " * 60 + "casa " * 30, "en", "a"), (2, "casa " * 3 + rare, "es", "a"), (3, "casa", None, "a")])
    monkeypatch.setattr("registry_spark.llm.language.WORD_ENTRIES", 2)
    got = {r["doc_id"]: r for r in identify(df, train(df)).collect()}
    en, es = 30.5 / 90.5, 3.5 / 61.5
    assert got[3]["lang_pred"] == "en" and got[3]["score"] == pytest.approx(en / (en + es), rel=1e-4)


def test_texts_of_which_nothing_is_known_are_not_recognised(documents, monkeypatch):
    rows = [
        (1, "the house of the sea the", "en", "a"), (2, "das haus am meer", "de", "a"), (3, "άλφα βήτα γάμμα", None, "a"), (4, "日本 語", None, "a"),
        (5, "άλφα the", None, "a"), (6, "άλφα meer", None, "a"), (7, "άλφα hausmeer", None, "a"), (8, "12 !", None, "a"), (9, None, "en", "a"),
    ]
    df = documents(rows)
    model = train(df)
    assert {r["doc_id"] for r in recognised(df, model).collect()} == {1, 2, 5, 6, 7}
    monkeypatch.setattr("registry_spark.llm.language.WORD_ENTRIES", 1)
    monkeypatch.setattr("registry_spark.llm.language.GRAM_ENTRIES", 0)
    left = recognised(df, train(df))
    assert left.columns == df.columns and {r["doc_id"] for r in left.collect()} == {1, 2, 5, 6, 7}
    assert recognised(df, train(df.limit(0))).collect() == []
    assert {r["doc_id"]: r["score"] for r in identify(df, model).collect()}[3] == 0.5


def test_crc_matches_python(documents):
    from registry_spark.llm.tasks import id_remainder

    rows = documents([(i, "a", None, None) for i in (0, 7, 123456, None)]).select("doc_id", id_remainder(F.col("doc_id"), 10).alias("m")).collect()
    assert all(r["m"] == zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 10 for r in rows)


def test_files_present():
    assert pq.read_schema(f"{SF}/documents.parquet").names == ["doc_id", "text", "lang", "source", "n_chars"]
