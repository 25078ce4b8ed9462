"""Ordered pattern rules kept as a table of any length.

A rule can only match a name that holds one of its literal fragments: for every alternative the longest run of plain
characters that each match must contain. A fragment is known by its rarest gram of up to three characters in the
vocabulary, so names and rules meet by an equality join; the whole fragment, and then the pattern, are tried
on what is left, and the rule of the smallest id wins. Nothing passes through the driver.

Patterns are Java regular expressions, found anywhere in the lower-case name. What the reading of a pattern does not
understand (inline flags, quoting, escapes by code) only loses the fragment: such rules, and those without any plain
character, are tried on every name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry_spark.sources.shared import written

GRAM = 3
CUT = "\u0001"
# Innermost groups are taken out so many times; deeper ones leave the rule without a fragment.
DEPTH = 6
REPEATED = r"(?:[*+?]|\{[^}]*\})*"


def fragments(pattern: Column) -> Column:
    """One entry for every alternative: a lower-case text that each of its matches contains, '' if none is known."""
    opaque = pattern.rlike(r"\(\?[^:=!<]|\(\?<[^=!]|\\[QEuxcNpPkGXR0]") | pattern.contains(CUT) | pattern.rlike(r"\[[^\]]*[\[\\]")
    plain = F.regexp_replace(pattern, r"\\.", CUT)
    # The character before a quantifier that allows none is no part of every match; an escape or class goes with it.
    plain = F.regexp_replace(plain, r"\[\^?\]?[^\]]*\]" + REPEATED, CUT)
    for _ in range(DEPTH):
        plain = F.regexp_replace(plain, r"\([^()]*\)" + REPEATED, CUT)
    opaque = opaque | plain.rlike(r"[()\[\]]")
    plain = F.regexp_replace(plain, r"(?s).(?:[*?]|\{[^}]*\})[*+?]*", CUT)
    plain = F.regexp_replace(plain, r"[+.^$]", CUT)

    def longest(alternative: Column) -> Column:
        runs = F.transform(F.split(alternative, CUT), lambda run: F.struct(F.length(run).alias("n"), run.alias("run")))
        return F.array_max(runs)["run"]

    return F.when(opaque, F.array(F.lit(""))).otherwise(F.transform(F.split(F.lower(plain), r"\|", -1), longest))


def grams(text: Column, size: int) -> Column:
    """All runs of ``size`` characters, each once."""
    last = F.length(text) - size + 1
    found = F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, F.lit(size)))
    return F.when(last >= 1, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def name_grams(text: Column) -> Column:
    """Runs of one to GRAM characters, and the empty one that every text holds."""
    return F.concat(F.array(F.lit("")), *[grams(text, size) for size in range(1, GRAM + 1)])


def keyed_rules(rules: DataFrame, used: DataFrame) -> DataFrame:
    """A row for each distinct fragment of a rule with the gram it is looked up by: the rarest of ``used`` (gram, n).

    A gram that no name holds makes the fragment impossible, and its row is left out.
    """
    parts = rules.select("rule_id", "pattern", F.explode(F.array_distinct(fragments(F.col("pattern")))).alias("fragment"))
    size = F.least(F.length("fragment"), F.lit(GRAM))
    some = F.when(size == 0, F.array(F.lit("")))
    for n in range(1, GRAM + 1):
        some = some.when(size == n, grams(F.col("fragment"), n))
    # Grams are looked up in the list of those in use; a fragment with an unused one has no name.
    counted = parts.withColumn("n_grams", F.size(some)).withColumn("gram", F.explode(some)).join(used, "gram")
    rarest = counted.groupBy("rule_id", "pattern", "fragment", "n_grams").agg(
        F.count(F.lit(1)).alias("known"), F.min(F.struct("n", "gram"))["gram"].alias("gram"))
    return rarest.filter("known = n_grams").select("rule_id", "pattern", "fragment", "gram")


def first_rules(names: DataFrame, rules: DataFrame, *, name: str = "name") -> DataFrame:
    """Distinct lower-case ``name`` values with the smallest rule_id of ``rules`` (rule_id, pattern) that matches.

    Columns: ``name``, rule_id. Names without a match, and NULL names, are not listed. A NULL pattern matches nothing,
    an empty one everything. The vocabulary is written once, since its grams are read twice.
    """
    vocabulary = written(names.select(F.lower(F.col(f"`{name}`")).alias("__name")).filter("__name IS NOT NULL").distinct())
    held = vocabulary.select("__name", F.explode(name_grams(F.col("__name"))).alias("gram"))
    used = held.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    known = rules.select("rule_id", "pattern").filter("pattern IS NOT NULL")
    met = held.join(written(keyed_rules(known, used)), "gram").filter(F.col("__name").contains(F.col("fragment")))
    # Word boundaries follow Unicode letters, as in the rules given as code.
    matched = met.filter((F.col("pattern") == F.col("fragment")) | F.expr("__name RLIKE concat('(?U)', pattern)"))
    return matched.groupBy(F.col("__name").alias(name)).agg(F.min("rule_id").alias("rule_id"))


def with_rule_table(
    df: DataFrame, name: str, rules: DataFrame, *, key: str = "rule_id", defaults: DataFrame | None = None, on: str | None = None
) -> DataFrame:
    """Add the attributes of the first rule that matches a name, else those of its category's default.

    ``rules`` has rule_id (one row each; order is by it), pattern and the attributes; ``defaults`` has one row per
    value of the column ``on`` and the same attributes. Rows without either get NULL.
    """
    attributes = [c for c in rules.columns if c not in (key, "pattern")]
    clash = {c.lower() for c in df.columns} & {c.lower() for c in (*attributes, "lowered")}
    if clash:
        raise ValueError(f"attributes already in the table: {sorted(clash)}")
    lowered = df.withColumn("lowered", F.lower(F.col(f"`{name}`")))
    found = first_rules(lowered, rules.withColumnRenamed(key, "rule_id"), name="lowered")
    chosen = found.join(rules.withColumnRenamed(key, "rule_id").drop("pattern"), "rule_id").select(
        F.col("lowered").alias("__lowered"), F.struct(*[F.col(f"`{c}`") for c in attributes]).alias("__rule"))
    out = lowered.join(chosen, F.col("lowered") == F.col("__lowered"), "left").drop("__lowered")
    pick = F.col("__rule")
    if defaults is not None:
        fallback = defaults.select(F.col(on).alias("__on"), F.struct(*[F.col(f"`{c}`") for c in attributes]).alias("__default"))
        out = out.join(fallback, F.col(f"`{on}`") == F.col("__on"), "left").drop("__on")
        pick = F.coalesce("__rule", "__default")
    return out.withColumn("__rule", pick).select(*[F.col(f"`{c}`") for c in df.columns], "__rule.*")
