"""Source mixing: targets, the schedule, and what is taken of every document."""

import random

import numpy as np
import pytest

from registry_spark.llm import mixing
from registry_spark.llm.mixing import Mix, Source, count_below, mixed_documents, reverse_bits, schedule, source_targets


def slow_targets(sizes):
    wish = [(5.0, 2.0, 1.0)[i % 3] for i in range(len(sizes))]
    low, high = 0.0, 4.0 * sum(sizes) + 1
    for _ in range(200):
        unit = (low + high) / 2
        if sum(min(2 * s, unit * w) for s, w in zip(sizes, wish)) < 1.5 * sum(sizes):
            low = unit
        else:
            high = unit
    return [min(2 * s, high * w) for s, w in zip(sizes, wish)]


@pytest.mark.parametrize("seed", range(20))
def test_targets(seed):
    random.seed(seed)
    sizes = [random.choice([0, 1, 7, random.randint(0, 100_000)]) for _ in range(random.randint(1, 30))]
    assert source_targets(sizes) == pytest.approx(slow_targets(sizes), rel=1e-6, abs=1e-6)


def test_no_sources():
    assert source_targets([]) == []


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_points_below(bits):
    points = reverse_bits(np.arange(1 << bits), bits)
    limits = np.arange((1 << bits) + 1)
    for n in range((1 << bits) + 1):
        assert count_below(n, limits, bits).tolist() == [(points[:n] < x).sum() for x in limits]


def test_schedule_takes_each_quota_once_and_evenly(spark):
    sizes = [100_000, 30_000, 0, 999, 4_096, 1]
    sources = [Source(str(i), s, t) for i, (s, t) in enumerate(zip(sizes, source_targets(sizes)))]
    rows = schedule(spark, sources, 512).collect()
    assert len({r["slot"] for r in rows}) == len(rows)
    for i, s in enumerate(sources):
        own = sorted((r for r in rows if r["source"] == i), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(s.slots(512)))
        assert sum(r["n"] for r in own) == s.quota
    order = [r["source"] for r in sorted(rows, key=lambda r: r["slot"])]
    half = order[: len(order) // 2]
    assert abs(half.count(0) - order.count(0) / 2) < 12


def check(rows, taken):
    assert len(taken) == len(rows)
    by_source = {}
    for r in taken:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by_source.setdefault((r["source_size"], r["target"]), []).append(r)
    for (_, target), own in by_source.items():
        assert sum(r["taken"] for r in own) == round(target)


def test_odd_rows(documents, odd_rows):
    df = documents(odd_rows)
    taken = Mix(df, block=64).taken().collect()
    sizes = sorted(len((t or "").encode().split()) for _, t, _, _ in odd_rows)
    assert sorted(r["size"] for r in taken) == sizes
    check(odd_rows, taken)
    again = Mix(df.repartition(7), block=64).taken().collect()
    assert sorted(map(str, taken)) == sorted(map(str, again))


def test_bucket_width_does_not_matter(documents, monkeypatch):
    rows = [(i, "w " * (i % 17), None, "s" + str(i % 3)) for i in range(500)]
    wide = Mix(documents(rows), block=32).taken().collect()
    monkeypatch.setattr("registry_spark.llm.mixing.BUCKET_ROWS", 7)
    assert sorted(map(str, Mix(documents(rows), block=32).taken().collect())) == sorted(map(str, wide))


def test_mixed_documents(documents, odd_rows):
    df = documents(odd_rows)
    out = mixed_documents(df)
    assert out.columns == df.columns
    times = {}
    for r in out.collect():
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert 1 not in times and 2 not in times and max(v for k, v in times.items() if k != 5) <= 2


def test_empty_table(documents):
    empty = documents([])
    assert Mix(empty).taken().collect() == [] and mixed_documents(empty).collect() == []


def test_too_many_sources(documents, monkeypatch):
    monkeypatch.setattr("registry_spark.llm.mixing.MAX_SOURCES", 2)
    with pytest.raises(ValueError):
        Mix(documents([(i, "a", None, str(i)) for i in range(3)]))


def test_more_sources_than_the_driver_lists(documents, odd_rows, monkeypatch):
    random.seed(5)
    rows = odd_rows + [(1_000 + i, "w " * random.choice([0, 1, 9, 40, 900]), None, f"s{random.randrange(70)}") for i in range(300)]
    df = documents(rows)
    want = Mix(df, block=16)
    slots = lambda m: sorted(map(tuple, m.slots.select("slot", "source", "rank", "block", "n").collect()))
    taken = lambda m: sorted(m.taken().collect(), key=lambda r: (str(r["id"]), r["hash"], r["taken"]))
    copies = sorted(str(r["doc_id"]) for r in mixed_documents(df).collect())
    monkeypatch.setattr(mixing, "MAX_SOURCES", 2)
    monkeypatch.setattr(mixing, "PIECE_POINTS", 8)
    got = mixing.mix(df, block=16)
    assert slots(got) == slots(want)
    plain = lambda rows: [tuple(r[c] for c in ("id", "size", "source_size", "hash", "taken")) for r in rows]
    assert plain(taken(got)) == plain(taken(want))
    assert [r["target"] for r in taken(got)] == pytest.approx([r["target"] for r in taken(want)], abs=1e-6)
    assert sorted(str(r["doc_id"]) for r in mixed_documents(df).collect()) == copies
