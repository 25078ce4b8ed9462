from collections import Counter

import pytest
from pyspark.sql import functions as F

from registry_spark.operators import hot_keys
from registry_spark.sources.shared import written


def facts(spark, n=20_000):
    """One key with 90 % of the rows, one with 4 %, the rest spread; every hundredth NULL."""
    k = F.expr("CASE WHEN id % 100 = 99 THEN NULL WHEN id % 100 < 90 THEN 7 WHEN id % 100 < 94 THEN 8 ELSE id END")
    return spark.range(n).select(k.alias("k"), F.lit("same").alias("v"))


def test_heavy_keys_and_their_parts(spark):
    heavy = {r.heavy_key: r.parts for r in hot_keys.heavy_keys(facts(spark), "k", share=1 / 32).collect()}
    assert heavy == {"7": 30, "8": 2}  # 18,000 and 800 of 19,800 rows with a key, 618.75 a part
    assert hot_keys.heavy_keys(facts(spark).filter("k > 10"), "k", share=1 / 32).count() == 0


def test_parts_are_even_and_cold_rows_are_not_copied(spark):
    table = written(facts(spark))
    heavy = hot_keys.heavy_keys(table, "k", share=1 / 32)
    parts = Counter((r.k, r.__getitem__("__part")) for r in hot_keys.dealt(table, "k", heavy).collect())
    of_seven = [n for (k, _), n in parts.items() if k == 7]
    assert len(of_seven) == 30 and max(of_seven) < 2 * 618 and sum(parts.values()) == 20_000
    other = spark.range(0, 1000).withColumnRenamed("id", "k")
    assert hot_keys.copied(other, "k", heavy).count() == 1000 + 29 + 1


@pytest.mark.parametrize("share", [None, 1 / 32, 1e-9])
def test_join_is_the_plain_join(spark, share):
    left = facts(spark, 5_000)
    right = spark.range(0, 3000).select((F.col("id") % 1500).alias("k"), F.col("id").alias("w"))
    want = Counter(map(tuple, left.join(right, "k").select("k", "v", "w").collect()))
    got = hot_keys.join_heavy(left, right, "k", share=share)
    assert got.columns == ["k", "v", "w"]
    assert Counter(map(tuple, got.collect())) == want


def test_text_keys_and_empty_tables(frame):
    left = frame([("a", 1)] * 50 + [("b", 2), (None, 3), ("", 4)], "k string, v int")
    right = frame([("a", 10), ("", 20), (None, 30), ("c", 40)], "k string, w int")
    got = Counter(map(tuple, hot_keys.join_heavy(left, right, "k", share=0.1).collect()))
    assert got == Counter({("a", 1, 10): 50, ("", 4, 20): 1})
    assert hot_keys.join_heavy(left.filter("false"), right, "k").count() == 0
    assert hot_keys.join_heavy(left, right.filter("false"), "k").count() == 0


def test_keys_whose_texts_may_differ_are_refused(frame):
    numbers, texts = frame([(1.0, 1)], "k double, v int"), frame([("1", 1)], "k string, w int")
    for left, right in ((numbers, texts), (numbers, numbers.withColumnRenamed("v", "w"))):
        with pytest.raises(ValueError):
            hot_keys.join_heavy(left, right, "k")
