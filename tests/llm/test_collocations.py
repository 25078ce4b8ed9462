"""Phrases against brute force; what a summary guarantees; packing of lists."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from registry_spark.llm import collocations
from registry_spark.llm.collocations import Collocations, MisraGries, cut_text, pack, pack_sorted, summed, unpack, unpack_sorted


def brute(rows, longest, least, share=80, count=2000):
    """(lang, rank, phrase, a, l, r, n, score) from (text, lang) rows."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in f.items():
        some = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inner = {
            p[i : i + k] for p, a in some.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
            if 100 * a >= share * c[p[i : i + k]]
        }
        rows = []
        for p, a in some.items():
            if p not in inner:
                score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                rows.append((lang, " ".join(p), a, c[p[:k]], c[p[k:]], n[lang], score))
        rows.sort(key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(r[0], i + 1, *r[1:]) for i, r in enumerate(rows[:count])]
    return sorted(out)


def found(frame, longest, least, count=2000, **options):
    return sorted(map(tuple, Collocations(frame, longest=longest, least=least, **options).top(count).collect()))


def invented(seed, rows=120):
    random.seed(seed)
    words = [w + x for w in ("der", "La", "ö", "x1", "Tag", "a-b") for x in ("", "n", "É", "q")]
    text = lambda: "".join(random.choice(words) + random.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "!? "]) for _ in range(random.randint(0, 60)))
    return [(text(), random.choice(["de", "fr", None, "und", ""])) for _ in range(rows)]


@pytest.mark.parametrize("options", [{}, {"chunk": 300}])
def test_equals_brute_force(spark, options, monkeypatch):
    monkeypatch.setattr(collocations, "SPARE_BITS", -6 if options else 10)  # hashes shared by many n-grams
    rows = invented(3)
    frame = spark.createDataFrame([(i, *r, 7, "x") for i, r in enumerate(rows)], "doc_id int, text string, lang string, words int, phrase string")
    for longest, least in ((4, 3), (2, 5), (3, 30)):
        assert found(frame.repartition(5), longest, least, **options) == brute(rows, longest, least)


def test_odd_rows(spark, documents, odd_rows):
    got = found(documents(odd_rows), 4, 4)
    assert got == brute([(r[1], r[2]) for r in odd_rows], 4, 4) and got


def test_hot_phrase_and_repeated_rows(spark):
    rows = [("New York is far. new york", "en")] * 400 + [("York is far, is far", "en")] * 200 + invented(5, 30)
    assert found(spark.createDataFrame(rows, "text string, lang string").repartition(6), 4, 30) == brute(rows, 4, 30)


def test_top_and_ties(spark):
    rows = [(f"a{i} b{i}. Z{i} z{i}", "en") for i in range(12)] * 30
    assert found(spark.createDataFrame(rows, "text string, lang string"), 4, 30, 5) == brute(rows, 4, 30, count=5)


def test_nothing(spark):
    for rows in ([], [(None, None), ("", "en"), (" .,\n", "en"), ("one two", "en")]):
        assert found(spark.createDataFrame(rows, "text string, lang string"), 4, 30) == []


def test_long_texts_are_cut_at_marks():
    text = b"aa bb. cc dd ee.ff gg hh ii jj"
    parts = list(cut_text(text, 4))
    assert b"".join(parts) == text and all(p.startswith(b".") for p in parts[1:]) and len(parts) == 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=60), min_size=1, max_size=12), st.integers(1, 30))
def test_frequent_keys_survive_any_merge(lists, least):
    total = Counter(x for some in lists for x in some)
    summary = MisraGries(sum(total.values()) // least + 1)
    for some in lists:
        keys, counts = summed(np.array(some, np.uint64), np.ones(len(some), np.int64))
        summary.merge(keys, counts)
    kept = dict(zip(summary.keys.tolist(), summary.counts.tolist()))
    assert len(kept) <= summary.capacity
    assert all(k in kept for k, n in total.items() if n >= least)
    assert all(n <= total[k] for k, n in kept.items())


@given(st.lists(st.integers(0, 2**64 - 1), unique=True))
def test_packed_lists(values):
    values = np.array(sorted(values), np.uint64)
    assert unpack_sorted(pack_sorted(values)).tolist() == values.tolist() == unpack(pack(values)).tolist()
