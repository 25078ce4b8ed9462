import random
import re

import pytest
from pyspark.sql import functions as F

from registry_spark.operators import rule_index

PATTERNS = [
    ("malaria|mrdt", ["malaria", "mrdt"]), (r"\banc\b", ["anc"]), ("^error|^others$", ["error", "others"]), (r"colou?r test", ["r test"]),
    (r"x-?ray", ["ray"]), (r"(hiv|aids) care", [" care"]), (r"ab+c", ["ab"]), (r"[a-z]+ward", ["ward"]), (r"\d{2,3}", [""]), (r"a.b", ["b"]),
    (r"(a(b|c))+z", ["z"]), ("(?i)ABC", [""]), ("Surgery", ["surgery"]), ("", [""]), (r"ab{0}cd", ["cd"]), (r"\x41bc", [""]), (r"a\.bc", ["bc"]),
    (r"[\]]abc", [""]), (r"ab|", ["ab", ""]), (r"(?=abc)x", ["x"]), (r"ten (?:beds)?", ["ten "]), (r"a*?bcd", ["bcd"]), (r"[]x]ray", ["ray"]),
]


def test_fragments(frame):
    out = frame([(i, p) for i, (p, _) in enumerate(PATTERNS)], "i int, p string").select("i", rule_index.fragments(F.col("p")).alias("f"))
    assert [(PATTERNS[r.i][0], r.f) for r in out.orderBy("i").collect()] == PATTERNS


def test_random_rules_against_trying_all(frame):
    rng = random.Random(5)
    letters = "abcde "
    word = lambda n: "".join(rng.choice(letters) for _ in range(rng.randint(1, n)))
    piece = lambda: rng.choice([
        word(3), word(4), word(3) + rng.choice("?*+"), "[ab]" + rng.choice(["", "+", "?"]), f"({word(2)}|{word(3)})" + rng.choice(["", "?"]), ".", r"\b",
        "^" + word(2), word(2) + "$", word(2) + "{0,2}"])
    rules = [(i, "|".join("".join(piece() for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 2)))) for i in range(400)]
    rng.shuffle(rules)
    rules = [(i, p) for i, p in rules if i % 7 or len(p) > 9]
    names = sorted({word(12) for _ in range(500)}) + ["", None, "ABC de", "É a"]
    out = rule_index.first_rules(frame([(n,) for n in names], "name string"), frame(rules, "rule_id int, pattern string"))
    want = {}
    for name in {n.lower() for n in names if n is not None}:
        hits = [i for i, p in rules if re.search(p, name)]
        if hits:
            want[name] = min(hits)
    assert {r.name: r.rule_id for r in out.collect()} == want and len(want) > 300


def test_many_rules_and_defaults(frame):
    names = frame([(i, f"Service {i % 40_000} unit", "k" if i % 2 else "other") for i in range(50_000)], "i int, name string, kind string")
    rules = names.sparkSession.range(20_000).select(
        (F.lit(20_000) - F.col("id")).alias("rule_id"), F.format_string(r"service %d\b", F.col("id") * 2).alias("pattern"),
        F.concat(F.lit("d"), F.col("id") * 2).alias("domain"))
    defaults = frame([("k", "by kind")], "kind string, domain string")
    out = rule_index.with_rule_table(names, "name", rules, defaults=defaults, on="kind")
    assert out.columns == ["i", "name", "kind", "domain"]
    bad = out.filter("NOT (domain <=> CASE WHEN i % 40000 % 2 = 0 THEN 'd' || (i % 40000) WHEN kind = 'k' THEN 'by kind' END)")
    assert out.count() == 50_000 and bad.count() == 0
    with pytest.raises(ValueError):
        rule_index.with_rule_table(names.withColumn("domain", F.lit(1)), "name", rules)


def test_empty_tables(frame):
    names, rules = frame([("a",)], "name string"), frame([(1, "a"), (2, None)], "rule_id int, pattern string")
    assert rule_index.first_rules(names.limit(0), rules).count() == 0
    assert rule_index.first_rules(names, rules.limit(0)).count() == 0
    assert rule_index.first_rules(names, rules).collect() == [("a", 1)]
