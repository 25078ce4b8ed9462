import random

import pytest
from pyspark.sql import functions as F

from registry_spark.operators.lookups import first_per_key, lookup_join

METHODS = ["broadcast", "shuffle", "auto"]


def skewed(frame):
    """A third of the rows on one key, a third without a key, keys the lookup lacks."""
    rng = random.Random(3)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{rng.randrange(40)}"
        rows.append((i, key, rng.choice(["x", "y", None])))
    facts = frame(rows, "i int, a string, b string")
    lookup = frame(
        [("hot", "x", "HX"), ("hot", None, "HN"), (None, "x", "NX"), (None, None, "NN")]
        + [(f"k{j}", "x", f"V{j}") for j in range(0, 60, 2)],
        "la string, lb string, value string")
    return rows, facts, lookup


@pytest.mark.parametrize("method", METHODS)
@pytest.mark.parametrize("null_safe", [True, False])
def test_left_join_by_any_method(frame, method, null_safe):
    rows, facts, lookup = skewed(frame)
    table = {(r.la, r.lb): r.value for r in lookup.collect()}
    out = lookup_join(facts, lookup, [("a", "la"), ("b", "lb")], null_safe=null_safe, method=method)
    assert out.columns == ["i", "a", "b", "value"]
    got = sorted((r.i, r.value) for r in out.collect())
    want = [(i, table.get((a, b)) if null_safe or (a and b) else None) for i, a, b in rows]
    assert got == want


def test_same_key_name_on_both_sides(frame):
    facts = frame([("a", 1), ("b", 2)], "code string, n int")
    lookup = frame([("a", "A")], "code string, value string")
    for method in METHODS:
        out = lookup_join(facts, lookup, [("code", "code")], method=method)
        assert sorted(tuple(r) for r in out.collect()) == [("a", 1, "A"), ("b", 2, None)]


def test_payload_must_not_hide_fact_columns(frame):
    facts = frame([("a", 1)], "code string, Value int")
    lookup = frame([("a", 1)], "k string, value int")
    with pytest.raises(ValueError, match="value"):
        lookup_join(facts, lookup, [("code", "k")])


def test_unknown_method(frame):
    df = frame([("a",)], "k string")
    with pytest.raises(ValueError, match="magic"):
        lookup_join(df, df, [("k", "k")], method="magic")


def test_methods_in_the_plan(spark, frame):
    """The shuffle method reads the facts once, in a merge join that adaptive execution can split."""
    _, facts, lookup = skewed(frame)
    for method, join in (("shuffle", "SortMergeJoin"), ("broadcast", "BroadcastHashJoin")):
        out = lookup_join(facts, lookup, [("a", "la"), ("b", "lb")], method=method)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count(join) == 1 and plan.count("Join") == 1


def test_first_per_key(frame):
    df = frame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", None, "n"), (None, 5, "q")],
               "k string, o int, v string")
    out = sorted(map(tuple, first_per_key(df, ["k"], ["o"]).collect()), key=str)
    assert out == [("a", 1, "y"), ("b", None, "n"), (None, 5, "q")]
    assert first_per_key(df.withColumn("o", F.col("o")), ["k"], ["o"]).columns == df.columns
