"""Packing: every id once and in order, within the capacity, in few sequences."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from registry_spark.llm.packing import Packing, Plan, WordEncoder, best_pattern, configurations, plan

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def test_words_are_encoded_as_in_whole_texts(library):
    texts = [
        "", " ", "a\x0bb\x0cc\rd", "a b", "a ́b é ́", "<|endoftext|>x <|startoftext|> y<|endoftext|>", "ΑΣ ΑΣ. İ", "a\u0085b\x1cc d",
        "don't 'S it'll 12a", "日本 語　x", "x‍́ y", "A" * 3_000, "\U0001f642 ﬁ ǅ", "the the  the\tThe",
        "Word word. WORD... İx. <|ENDOFTEXT|> K Å. x'. it's; <|endoftext|>abc. ;! 5. ½. ʼn ǰ Größe, ΑΣ.", "ก็ ह्न 𐐀 ꙮ",
    ]
    encoder = WordEncoder(lambda: library)
    for _ in range(2):
        ids, bounds = encoder.encode([t.encode() for t in texts])
        got = [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def packed(frame, capacity, **options):
    return Packing(frame, PATH, end_id=0, capacity=capacity, with_ids=True, **options)


def check(rows, want, capacity):
    """``want``: ids of every document, by its id; repeated ids hold the same text."""
    bins, whole = {}, {}
    for r in rows:
        ids = want[r["id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids"] == ids and len(ids) == r["length"] and r["start"] == capacity * r["piece"]
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        whole[r["id"]] = whole.get(r["id"], 0) + r["length"]
    for some in bins.values():
        some.sort()
        assert [o for o, _ in some] == np.cumsum([0, *(n for _, n in some)])[:-1].tolist()
        assert sum(n for _, n in some) <= capacity
    return bins, whole


@pytest.mark.parametrize("capacity", [16, 2048])
def test_odd_rows(spark, documents, odd_rows, library, capacity):
    frame = documents(odd_rows)
    some = packed(frame.repartition(3), capacity)
    want = {r[0]: library.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in odd_rows}
    rows = some.rows.collect()
    bins, whole = check(rows, want, capacity)
    times = {k: sum(r[0] == k for r in odd_rows) for k in want}
    assert whole == {k: times[k] * len(ids) for k, ids in want.items()}
    total = sum(whole.values())
    assert len(bins) <= 1.15 * total / capacity + 1
    sequences = {r["sequence_id"]: r["ids"] for r in some.sequences().collect()}
    for r in rows:
        assert sequences[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]


def test_nothing(spark, documents):
    assert packed(documents([]), 2048).rows.count() == 0


def test_one_text_a_third_of_all_rows(spark, library):
    rows = [(i, "one two three") for i in range(500)] + [(i, "word " * (i % 40)) for i in range(500, 1500)]
    some = packed(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), 32)
    want = {i: library.encode(t, add_special_tokens=False).ids + [0] for i, t in rows}
    bins, whole = check(some.rows.collect(), want, 32)
    assert whole == {i: len(ids) for i, ids in want.items()}
    assert len(bins) <= -(-sum(whole.values()) // 32) + 2


def test_string_ids(spark):
    rows = packed(spark.createDataFrame([("a", "x"), (None, "y")], "key string, body string"), 8, id="key", text="body").rows.collect()
    assert sorted(str(r["id"]) for r in rows) == ["None", "a"]


def bins_of(some):
    """Lengths in every bin, from the runs; numbers of each length are used once."""
    bins, numbers = {}, {}
    for length, first, n, q, bin, offset in some.runs:
        numbers.setdefault(length, []).extend(range(first, first + n))
        for i in range(n):
            bins.setdefault(bin + i // q, []).append((offset + i % q * length, length))
    assert all(sorted(v) == list(range(int(some.counts[k]))) for k, v in numbers.items())
    return bins


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 60), max_size=150))
def test_plans_place_all_pieces(lengths):
    counts = np.bincount(np.array(lengths, np.int64), minlength=61)
    some = plan(counts)
    bins = bins_of(some)
    assert sum(len(b) for b in bins.values()) == len(lengths) and len(bins) == some.bins
    for b in bins.values():
        b.sort()
        ends = np.cumsum([n for _, n in b])
        assert ends[-1] <= 60 and [o for o, _ in b[1:]] == ends[:-1].tolist()
    fitted = Plan(counts)
    fitted.best_fit()
    assert -(-sum(lengths) // 60) <= some.bins <= fitted.bins


def test_grouping_beats_best_fit():
    lengths = np.random.default_rng(1).integers(600, 1000, 3000)
    counts = np.bincount(lengths, minlength=2049)
    fitted = Plan(counts)
    fitted.best_fit()
    some = plan(counts)
    assert some.bins < 0.98 * fitted.bins
    # What the plan holds does not grow with the corpus.
    assert len(plan(counts * 10**6).runs) < 4 * len(some.runs)


def test_patterns():
    sizes = np.array([50, 30, 20])
    value, pattern = best_pattern(sizes, np.array([5.0, 3.1, 2.0]), 100)
    assert pattern.tolist() in ([0, 3, 0], [1, 1, 1]) or value >= 10.2
    assert int(pattern @ sizes) <= 100 and abs(value - float(pattern @ [5.0, 3.1, 2.0])) < 1e-9
    used = configurations(sizes, np.array([200.0, 200, 200]), 100)
    assert sum(n for _, n in used) == 200 and all(int(p @ sizes) <= 100 for p, _ in used)
