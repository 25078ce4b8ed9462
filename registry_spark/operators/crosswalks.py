"""Source vocabularies to the standard service hierarchy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry_spark.functions.rules import first_match, matches
from registry_spark.functions.text import trim_ws
from registry_spark.operators.lookups import first_per_key, lookup_join
from registry_spark.vocabularies import (
    CATEGORY_DEFAULTS,
    CATEGORY_RULES,
    MALARIA,
    MALARIA_DETAIL,
    MALARIA_GROUP,
    MALARIA_NAME,
    NAME_RULES,
    REVIEW_NAME,
    SUPPORT,
    CategoryRule,
    NameRule,
)

HIERARCHY = ("service_domain", "service_group", "service_name")
FLAGS = ("is_clinical", "is_malaria_related", "include_in_analysis", "needs_review")


def vocabulary(df: DataFrame, columns: list[str], *, drop_nulls: bool = False) -> DataFrame:
    """Distinct combinations in use; combined on the map side before any shuffle."""
    pairs = df.select(*columns)
    return (pairs.dropna() if drop_nulls else pairs).distinct()


def with_name_rules(
    df: DataFrame,
    category: str,
    name: str,
    rules: tuple[NameRule, ...] = NAME_RULES,
    defaults: tuple[CategoryRule, ...] = CATEGORY_DEFAULTS,
) -> DataFrame:
    """Add domain, group, clinical and include of the first name rule, else of the category.

    A rule into the support domain turns both flags off, any other rule on. Also
    adds ``lowered``, the lower-case name the rules were tried on.
    """

    def attributes(domain: str, group: str, clinical: bool, include: bool) -> Column:
        return F.struct(
            F.lit(domain).alias("service_domain"),
            F.lit(group).alias("service_group"),
            F.lit(clinical).alias("is_clinical"),
            F.lit(include).alias("include_in_analysis"),
        )

    by_category = F.create_map(*[
        part
        for d in defaults
        for part in (F.lit(d.category), attributes(d.domain, d.group, d.is_clinical, d.include_in_analysis))
    ])
    cases = [(r.pattern, attributes(r.domain, r.group, r.domain != SUPPORT, r.domain != SUPPORT)) for r in rules]
    lowered = df.withColumn("lowered", F.lower(F.col(name)))
    matched = lowered.withColumn(
        "__a", first_match(F.col("lowered"), cases, F.element_at(by_category, F.col(category)))
    )
    return matched.select("*", "__a.*").drop("__a")


def name_rules(table: DataFrame, limit: int = 5_000) -> tuple[NameRule, ...]:
    """Rules kept as a table (rule_id, pattern, service_domain, service_group), in order of rule_id.

    Rules become one expression, so a table of more than ``limit`` is refused.
    """
    rows = table.select("rule_id", "pattern", "service_domain", "service_group").orderBy("rule_id").limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rules")
    return tuple(NameRule(r["pattern"], r["service_domain"], r["service_group"]) for r in rows)


def crosswalk_from_names(
    pairs: DataFrame, category: str = "service_category", name: str = "service_name", **tables
) -> DataFrame:
    """Crosswalk of distinct (category, name) pairs by ordered name rules."""
    return with_name_rules(pairs.select(category, name), category, name, **tables).select(
        F.col(category).alias("source_category"),
        F.col(name).alias("source_service_name"),
        "service_domain",
        "service_group",
        F.col(name).alias("service_name"),
        "is_clinical",
        matches(F.col("lowered"), MALARIA_NAME).alias("is_malaria_related"),
        "include_in_analysis",
        matches(F.col("lowered"), REVIEW_NAME).alias("needs_review"),
    )


def crosswalk_from_categories(
    pairs: DataFrame,
    category: str = "service_category",
    detail: str = "service_detail",
    rules: tuple[CategoryRule, ...] = CATEGORY_RULES,
) -> DataFrame:
    """Crosswalk of distinct (category, detail) pairs by exact category.

    A category without a rule needs review, also when its detail names malaria,
    which always leads to the malaria domain.
    """
    table = F.create_map(*[
        part
        for r in rules
        for part in (F.lit(r.category), F.struct(
            F.lit(r.domain).alias("domain"),
            F.lit(r.group).alias("grp"),
            F.lit(r.is_clinical).alias("clinical"),
            F.lit(r.is_malaria_related).alias("malaria"),
            F.lit(r.include_in_analysis).alias("include"),
        ))
    ])
    c, d = F.col(category), F.col(detail)
    malaria = F.lower(d).rlike(MALARIA_DETAIL)
    return pairs.withColumn("__a", F.element_at(table, c)).select(
        c.alias("source_category"),
        d.alias("source_service_name"),
        F.when(malaria, MALARIA).otherwise(F.col("__a.domain")).alias("service_domain"),
        F.when(malaria, MALARIA_GROUP).otherwise(F.col("__a.grp")).alias("service_group"),
        d.alias("service_name"),
        F.col("__a.clinical").alias("is_clinical"),
        (F.col("__a.malaria") | malaria).alias("is_malaria_related"),
        F.col("__a.include").alias("include_in_analysis"),
        F.col("__a.domain").isNull().alias("needs_review"),
    )


def trim_text(df: DataFrame, columns=None) -> DataFrame:
    """Trim the named text columns, by default all of them."""
    text = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    chosen = text if columns is None else [c for c in columns if c in text]
    return df.withColumns({c: trim_ws(F.col(f"`{c}`")) for c in chosen})


def translate(
    facts: DataFrame,
    crosswalk: DataFrame,
    keys: tuple[tuple[str, str], ...],
    *,
    fallback_to_source: str | None = None,
    method: str = "auto",
) -> DataFrame:
    """Add hierarchy and flags from the crosswalk to every fact row.

    Keys are trimmed on both sides, and a NULL key matches a NULL key. A key listed
    twice counts once, so fact rows never multiply. Group and name of the source
    are replaced. ``fallback_to_source`` names the raw column that stands in where
    the crosswalk has no name.
    """
    columns = [c for c in (*HIERARCHY, *FLAGS) if c in crosswalk.columns]
    standard = crosswalk.select(
        *[trim_ws(F.col(f"`{k}`").cast("string")).alias(f"cw_{k}") for _, k in keys],
        *[(trim_ws(F.col(c)) if c in HIERARCHY else F.col(c)).alias(f"std_{c}") for c in columns],
    )
    standard = first_per_key(standard, [f"cw_{k}" for _, k in keys], [])
    trimmed = trim_text(facts, [f for f, _ in keys])
    joined = lookup_join(
        trimmed, standard, [(f, f"cw_{k}") for f, k in keys], null_safe=True, method=method
    )
    values = {c: F.col(f"std_{c}") for c in columns}
    if fallback_to_source:
        values["service_name"] = F.coalesce(values["service_name"], F.col(fallback_to_source))
    kept = [c for c in facts.columns if c not in columns]
    return joined.select(*[F.col(f"`{c}`") for c in kept], *[v.alias(c) for c, v in values.items()])


def missing_names(facts: DataFrame, crosswalk: DataFrame, keys: tuple[tuple[str, str], ...]) -> DataFrame:
    """Distinct source keys the crosswalk does not know yet."""
    names = [f for f, _ in keys]
    used = trim_text(facts.select(*names)).distinct()
    known = trim_text(crosswalk.select(*[F.col(k).alias(f"cw_{k}") for _, k in keys]).distinct())
    same = reduce(lambda x, y: x & y, [F.col(f).eqNullSafe(F.col(f"cw_{k}")) for f, k in keys])
    return used.join(known, same, "left_anti")


def union_crosswalks(crosswalks: dict[str, DataFrame]) -> DataFrame:
    """Master vocabulary: all crosswalks with their country code."""
    labelled = [df.withColumn("country_iso", F.lit(iso)) for iso, df in crosswalks.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)
