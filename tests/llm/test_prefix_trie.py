"""Prefix tries against brute force, in one shard and in many, in one segment and in many."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from registry_spark.llm.prefix_trie import Crowded, PrefixTrie, dense, pack, packed
from registry_spark.llm.tasks import segments

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, (r or "").encode(), (x or "").encode()))
    own = {c: [v[2:] for v in sorted(some)] for c, some in own.items()}
    whole = {}
    for c, some in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = tuple(own.get(base, [])[:h]) + tuple(some[h:])
    nodes = {}
    for c, p in whole.items():
        for d in range(len(p) + 1):
            nodes.setdefault(p[:d], []).append(c)
    children, leaves, saved = ({p: 0 for p in nodes} for _ in range(3))
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    for p, members in nodes.items():
        words = len(re.findall(rb"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members) - 1) * words
    sha = lambda p: hashlib.sha256(",".join(map(str, sorted(c for c in nodes[p] if len(whole[c]) == len(p)))).encode()).hexdigest()
    return sorted(
        ((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(p)) for p, m in nodes.items()),
        key=lambda r: r[:2],
    )


def found(frame, **options):
    conv = F.col("conv_id")
    trie = PrefixTrie(frame, shared=(conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4), **options)
    return sorted(map(tuple, trie.with_digests().select(*COLUMNS).collect()), key=lambda r: r[:2])


def invented(seed):
    """NULLs in every column, ties, repeated rows, empty and long conversations, common beginnings."""
    random.seed(seed)
    rows = [(None, 1, "user", "x")]
    for c in range(-30, 60):
        for k in range(random.choice([0, 1, 1, 2, 3, 5, 9])):
            rows += [(c, random.choice([k, k, k, None]), random.choice(["u", "a", None]), random.choice(["x y", "x", "", None, "zé\n\tw"]))] * random.choice([1, 1, 1, 2])
    return rows + [(100 + c, k, "u", ["a b", "c d e"][k % 3 // 2]) for c in range(6) for k in range(17 if c != 3 else 10)]


@pytest.mark.parametrize("options", [{}, {"shard": 5}, {"segment": 4, "shard": 9}])
def test_equals_brute_force(spark, options):
    rows = invented(2)
    frame = spark.createDataFrame([(*r, 1, "n", "b") for r in rows], "conv_id long, turn long, role string, text string, n int, path string, `block` string")
    assert found(frame.repartition(5), **options) == brute(rows)


def test_one_conversation_holds_most_turns(spark):
    """Its turns lie in many parts and its segments, shared with a copy, in many shards."""
    rows = [(c, t, "user", f"turn {t % 7}") for c in (5, 6) for t in range(150)] + [(c, 0, "user", "hi") for c in range(30, 60)]
    assert found(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6), segment=8, shard=40) == brute(rows)


def test_many_equal_conversations(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(1000, 1400) for t in range(3)] + [(c, 0, "user", f"turn {c % 3}") for c in range(2000, 2100)]
    assert found(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4), shard=16) == brute(rows)


def test_plain_conversations_and_nothing(spark):
    schema = "c long, t int, who string, what string"
    names = {"conversation": "c", "turn": "t", "role": "who", "text": "what"}
    rows = [(1, 0, "u", "a"), (1, 1, "v", "b"), (2, 0, "u", "a"), (3, None, None, None)]
    trie = PrefixTrie(spark.createDataFrame(rows, schema), **names)
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves) for r in trie.nodes.collect()}
    assert got == {(1, 0): (None, 3, 2, 2), (1, 1): (1, 2, 1, 1), (1, 2): (1, 1, 0, 1), (3, 1): (1, 1, 0, 1)}
    assert PrefixTrie(spark.createDataFrame([], schema), **names).with_digests().count() == 0


def test_role_and_text_are_told_apart(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "", "abc"), (4, 0, "abc", None)]
    trie = PrefixTrie(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    assert trie.nodes.filter("depth = 1").count() == 4


@pytest.mark.parametrize("seed", range(4))
def test_double_array(seed):
    random.seed(seed)
    alphabet = random.choice([2, 5, 400])
    some = sorted({tuple(random.randrange(alphabet) for _ in range(random.randint(0, 6))) for _ in range(300)})
    bounds = segments(np.array(list(map(len, some))))
    codes = np.array([c for s in some for c in s], np.int64)
    trie = pack(codes, bounds)
    prefixes = {s[:d] for s in some for d in range(len(s) + 1)}
    assert (trie.check >= 0).sum() == len(prefixes) - 1
    for probe in [tuple(random.randrange(alphabet) for _ in range(random.randint(1, 5))) for _ in range(200)] + some:
        slot = 0
        for c in probe:
            slot = int(trie.step(np.array([slot]), np.array([c]))[0])
            if slot < 0:
                break
        assert (slot >= 0) == (probe in prefixes)


def test_dense_numbers_follow_first_sight():
    pairs = np.array([[5, 1], [2, 2], [5, 1], [2, 3]])
    assert dense(pairs, np.array([3, 0, 1, 2])).tolist() == [1, 0, 1, 2]


def test_many_first_turns_leave_few_slots_free():
    """Children of a node that fills many windows: what follows goes right behind them."""
    n = 30_000
    firsts = np.repeat(np.arange(n), 2)
    codes = np.stack([firsts, n + np.arange(2 * n)], 1).ravel()
    trie = pack(codes, np.arange(0, 4 * n + 1, 2))
    assert (trie.check >= 0).sum() == 3 * n
    assert len(trie.check) < 4 * n
    assert (trie.step(trie.step(np.zeros(2 * n, np.int64), firsts), n + np.arange(2 * n)) > 0).all()


def scattered(seed, parents=40, children=25, pool=2000):
    """Children of each node from a common pool: their numbers lie far apart."""
    random.seed(seed)
    return sorted((a, b) for a in range(parents) for b in random.sample(range(parents, parents + pool), children))


def test_crowded_stretch_is_cut():
    some = scattered(1)
    codes, bounds = np.array(some, np.int64).ravel(), np.arange(0, 2 * len(some) + 1, 2)
    most = 2 * 25 * 40
    with pytest.raises(Crowded):
        pack(codes, bounds, most)
    turn = pa.StructArray.from_arrays([pa.array(codes), pa.array(codes + 7), pa.array(np.ones_like(codes))], ["hi", "lo", "words"])
    none, one = np.zeros(len(some), np.int64), np.ones(len(some), np.int64)
    rows = pa.table({
        "block": none, "prev_hi": none, "prev_lo": none, "path": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), turn), "n": one, "ended": one,
        "conv_id": np.arange(len(some)), "below_leaves": none, "below_saved": none,
    })
    batches = list(packed(rows, most, itertools.count(5)))
    assert [b.column("shard")[0].as_py() for b in batches] == list(range(5, 5 + len(batches))) and len(batches) > 1
    members = {}
    for r in pa.Table.from_batches(batches).to_pylist():
        members[r["hi"], r["lo"]] = members.get((r["hi"], r["lo"]), 0) + r["n"]
    expected = {}
    for a, b in some:
        for hi, lo in ((0, 0), (a, a + 7), (a ^ b, (a + 7) ^ (b + 7))):
            expected[hi, lo] = expected.get((hi, lo), 0) + 1
    assert members == expected


def test_scattered_turns_in_cut_stretches(spark):
    rows = [(20 * k + c, t, "u", f"{t} {x}") for k, (a, b) in enumerate(scattered(3, 30, 12, 300)) for c in (0, 3) for t, x in enumerate((a, b, c))]
    assert found(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4), shard=150) == brute(rows)
