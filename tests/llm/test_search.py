"""Top-k search, near duplicates and repeated strings against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from registry_spark.llm.components import components
from registry_spark.llm.near_duplicates import BANDS, alike, bands, may_be_alike, near_duplicates, one_of_each, sketch
from registry_spark.llm.repeats import LEVELS, Repeats
from registry_spark.llm.tasks import segments
from registry_spark.llm.top_k import top_k


def slow_top(rows, k):
    good = {(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, a in good:
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b))[:k]
            out += [(q, r + 1, i, max(-s, -(2**63) + 1)) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def searched(spark, rows, k=20):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, score string, id int")
    return sorted(map(tuple, top_k(df, F.col("vec_id") % 20 == 0, k, transform=lambda x: F.floor(64 * x)).collect()))


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr("registry_spark.llm.top_k.SHARD_ROWS", 40)
    monkeypatch.setattr("registry_spark.llm.top_k.QUERY_ROWS", 3)
    monkeypatch.setattr("registry_spark.llm.top_k.FAN_IN", 2)
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(300)] + [(300 + i, [0.5] * 5) for i in range(120)]
    assert searched(spark, rows) == slow_top(rows, 20)


def test_top_k_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]), (5, [1.0]),
        (6, []), (20, []), (40, [3.0]), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (60, [1e8, -1e8]), (8, [2e7, 1e8]), (80, None), (100, [0.0, -0.01]),
    ]
    assert searched(spark, rows) == slow_top(rows, 20)
    assert searched(spark, []) == []


def shingles(text, words):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()


def slow_classes(rows, words, percent):
    sets = [shingles(t, words) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for x, (i, _) in zip(label, rows):
        least[x] = i if least.get(x) is None else min(least[x], i) if i is not None else least[x]
    return sorted(((i, len(s), least[x], i == least[x]) for (i, _), s, x in zip(rows, sets, label)), key=str)


def near(df, words=2):
    return sorted(map(tuple, near_duplicates(df, words=words).collect()), key=str)


def test_odd_documents(documents, odd_rows):
    assert near(documents(odd_rows)) == slow_classes([r[:2] for r in odd_rows], 2, 80)


def test_groups_of_copies(documents):
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(500)]
    rows = []
    for size in (60, 9, 3, 2, 2, 1, 1):
        base = random.choices(vocabulary, k=random.choice([6, 12, 40, 90]))
        for _ in range(size):
            copy = list(base)
            for _ in range(random.choice([0, 0, 1, 2])):
                copy[random.randrange(len(copy))] = random.choice(vocabulary)
            rows.append((random.randrange(10**6), " ".join(copy)))
    df = documents([(*r, None, None) for r in rows])
    for words in (2, 5):
        assert near(df, words) == slow_classes(rows, words, 80)


def test_chain_of_small_changes(documents):
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(25):
        rows.append((100 - i, " ".join(words)))
        words[(7 * i) % 60] = f"new{i}"
    assert near(documents([(*r, None, None) for r in rows])) == slow_classes(rows, 2, 80)


def test_one_of_each(documents, odd_rows):
    df = documents(odd_rows)
    left = one_of_each(df, words=2)
    assert left.columns == df.columns
    groups = {r[2] for r in slow_classes([r[:2] for r in odd_rows], 2, 80)}
    ids = [r["doc_id"] for r in left.collect()]
    assert len(ids) == len(set(ids)) == len({i for i, t, *_ in odd_rows}) - 2 and set(ids) == groups
    assert one_of_each(documents([])).collect() == []


def test_registers_tell_similarity():
    rng = np.random.default_rng(5)
    for share in (0.5, 0.8, 0.95):
        pool = rng.integers(0, 2**63, 4_000).astype(np.uint64)
        same = int(4_000 * share)
        a, b = np.sort(pool[:same]), np.sort(pool[: same + (4_000 - same) // 2])
        c = np.sort(np.concatenate((pool[:same], pool[same + (4_000 - same) // 2 :])))
        flat = np.concatenate((a, b, c))
        registers = sketch(flat, segments(np.array([len(a), len(b), len(c)])))
        assert (registers[0] <= registers[1]).all()
        equal = (registers[1] == registers[2]).mean()
        assert abs(equal - same / 4_000) < 0.12
        n = np.array([len(b)], float), np.array([len(c)], float)
        assert may_be_alike(registers[1:2], registers[2:3], *n, 0.8)[0] or share < 0.8
        assert alike(b, c, 80) == (100 * same >= 80 * 4_000)
    assert bands(registers).shape == (3, BANDS)


def test_contained_sets_of_sizes_four_to_five():
    rng = np.random.default_rng(9)
    for k in (1, 2, 7, 10, 100, 333):
        large = np.sort(rng.integers(0, 2**63, 5 * k).astype(np.uint64))
        small = np.sort(rng.permutation(large)[: 4 * k])
        registers = sketch(np.concatenate((small, large)), segments(np.array([4 * k, 5 * k])))
        n_small, n_large = np.array([4.0 * k]), np.array([5.0 * k])
        assert alike(small, large, 80)
        assert may_be_alike(registers[:1], registers[1:], n_small, n_large, 0.8)[0]
        assert may_be_alike(registers[1:], registers[:1], n_large, n_small, 0.8)[0]
        assert not may_be_alike(registers[:1], registers[1:], n_small - 0.5, n_large, 0.8)[0]


def test_document_extended_by_a_quarter(documents):
    words = [f"w{i}" for i in range(51)]
    rows = [(1, " ".join(words[:41])), (2, " ".join(words)), (3, " ".join(f"v{i}" for i in range(51))), (4, " ".join(f"v{i}" for i in range(40)))]
    df = documents([(*r, None, None) for r in rows])
    assert near(df) == slow_classes(rows, 2, 80)
    assert sorted(r["doc_id"] for r in one_of_each(df, words=2).collect()) == [1, 3, 4]


def test_components(spark):
    random.seed(6)
    links = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(1_000 + i, 1_001 + i) for i in range(70)] + [(5, 5), (0, 2_000)]
    label = {}
    for a, b in links:
        label.setdefault(a, a), label.setdefault(b, b)
    for a, b in links:
        old, new = max(label[a], label[b]), min(label[a], label[b])
        label = {k: new if v == old else v for k, v in label.items()}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: v for k, v in label.items() if k != v}


def slow_repeats(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for (i, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(1 for k in range(len(t)) if gone[k] and (k == 0 or not gone[k - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_difference_cover():
    for period, cover in LEVELS:
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


@pytest.mark.parametrize("block_bytes", [2_000, 1 << 20])
def test_repeats(documents, block_bytes):
    random.seed(7)
    text = lambda n: "".join(random.choices("abcdefgh é\n", k=n))
    passages = [text(n) for n in (150, 199, 200, 201, 260, 333, 500, 900)]
    rows = []
    for i in range(60):
        parts = [text(random.randrange(300))]
        for _ in range(random.randrange(4)):
            parts += [random.choice(passages)[random.choice([0, 0, 3]) :], text(random.randrange(120))]
        rows.append((i, "".join(parts)))
    rows += [(100, "a" * 199), (101, "a" * 200), (102, "b" * 201), (103, "xy" * 400), (104, passages[7]), (105, passages[7]), (105, passages[7]), (106, passages[7][:200] + passages[6])]
    got = Repeats(documents([(*r, None, None) for r in rows]), block_bytes=block_bytes).result().collect()
    assert sorted(map(tuple, got), key=str) == slow_repeats(rows, 200)


def test_repeats_odd_documents(documents, odd_rows):
    rows = [r if r[0] != 4 else (4, r[1][:30_000], *r[2:]) for r in odd_rows]
    found = Repeats(documents(rows))
    assert sorted(map(tuple, found.result().collect()), key=str) == slow_repeats([r[:2] for r in rows], 200)
    left = {r["doc_id"]: r["left"] for r in found.result(with_text=True).collect()}
    assert left[9] == "" and left[8] == "word" and left[1] == ""
    assert Repeats(documents([])).result().collect() == []


def test_a_row_repeated_often_is_one_set(documents, monkeypatch):
    """Copies of a row, and equal texts of other ids, neither multiply the full sets nor the comparisons."""
    from registry_spark.llm import near_duplicates as module

    random.seed(4)
    words = [f"w{i}" for i in range(300)]
    base = random.choices(words, k=60)
    near = [*base[:-2], "other", "end"]
    rows = [(7, " ".join(base), "en", "a")] * 600 + [(1000 + i, " ".join(base), "en", "b") for i in range(300)] + [(2000, " ".join(near), "en", "b")]
    rows += [(3000 + i, " ".join(random.choices(words, k=40)), "de", "c") for i in range(40)]
    sizes = []
    confirm = module.confirmed
    monkeypatch.setattr(module, "confirmed", lambda sets, percent: sizes.append(sets.count()) or confirm(sets, percent))
    frame = documents(rows).repartition(8)
    got = {(r["doc_id"], r["component_id"]) for r in near_duplicates(frame, words=2, percent=80).collect()}
    assert got == {(r[0], 7 if r[0] <= 2000 else r[0]) for r in rows}
    assert sizes == [2]
    left = one_of_each(frame, words=2, percent=80)
    assert left.columns == frame.columns and sorted(r["doc_id"] for r in left.select("doc_id").collect()) == sorted([7, *range(3000, 3040)])
    assert {r["__key"] for r in left.select("__key").collect()} == {6}
