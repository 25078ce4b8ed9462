import random
import re

import pytest
from pyspark.sql import functions as F

from registry_spark.operators import identifiers, partials, profiles
from registry_spark.plans.facilities import write_counters
from registry_spark.plans.reports import facility_reports, stored_reports
from registry_spark.sources import lake
from registry_spark.sources.shared import shared_folder, written

SCHEMA = "uid string, facility_name string, latitude double, data_quality_flag string, country string"


@pytest.fixture
def facilities(frame):
    rng = random.Random(2)
    pick = lambda *values: rng.choice(values)
    return frame([
        (pick(None, f"u{i}"), pick(None, f"name {i % 300}"), pick(None, 1.5), pick(None, "complete", "no_coordinates"), pick("Kenya", "Mali", "Chad"))
        for i in range(3_000)
    ], SCHEMA)


def plain(df):
    return sorted(map(str, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


def test_merged_counters_equal_one_pass(facilities):
    kept = written(partials.partial_counters(facilities.withColumn("month", F.length("uid")), ["country", "data_quality_flag", "month"], distinct=["facility_name"]))
    small = facilities.drop("country", "data_quality_flag")
    assert plain(partials.completeness_from(kept)) == plain(profiles.completeness(small))
    by_country = profiles.completeness(facilities.drop("data_quality_flag"), by="country")
    assert plain(partials.completeness_from(kept, by="country")) == plain(by_country)
    assert plain(partials.quality_from(kept)) == plain(profiles.quality_by_country(facilities))
    assert plain(partials.rows_by(kept, "country")) == plain(profiles.counts_by(facilities, "country"))
    exact = {r.country: r.n for r in facilities.groupBy("country").agg(F.count_distinct("facility_name").alias("n")).collect()}
    guessed = {r.country: r.n_distinct for r in partials.distinct_from(kept, "country").collect()}
    assert set(guessed) == set(exact) and all(abs(guessed[c] - exact[c]) <= 0.03 * exact[c] for c in exact)


def test_sketches_of_many_values(spark):
    rows = spark.range(400_000).select((F.col("id") % 100_000).alias("code"), (F.col("id") % 12).alias("month"))
    kept = written(partials.partial_counters(rows, ["month"], distinct=["code"]))
    total = partials.distinct_from(kept).collect()
    assert [r.column_name for r in total] == ["code"] and abs(total[0].n_distinct - 100_000) < 3_000
    quarter = partials.distinct_from(kept.filter("month < 3")).collect()[0].n_distinct
    exact = rows.filter("month < 3").select("code").distinct().count()
    assert abs(quarter - exact) < 0.03 * exact


def test_one_changed_country(spark, facilities):
    root = shared_folder(spark)
    lake.write_country_tables(facilities, f"{root}/t")
    table = lambda: spark.read.schema(facilities.schema).parquet(f"{root}/t")
    for country in ("Kenya", "Mali", "Chad"):
        write_counters(table(), f"{root}/c", country)
    files = lambda: {f for f in spark.read.parquet(f"{root}/c").inputFiles() if "Kenya" not in f}
    others = files()
    lake.write_country_tables(facilities.filter("country = 'Kenya' AND uid IS NULL"), f"{root}/t")
    write_counters(table(), f"{root}/c", "Kenya")
    assert files() == others
    want, got = facility_reports(table()), stored_reports(spark, f"{root}/c")
    for name in ("countries", "quality"):
        assert plain(got[name]) == plain(want[name])
    names = "column_name NOT IN ('data_quality_flag')"
    assert plain(got["completeness"]) == plain(want["completeness"].filter(names))
    lake.empty_country(table(), f"{root}/t", "Kenya")
    write_counters(table(), f"{root}/c", "Kenya")
    assert {r.country for r in stored_reports(spark, f"{root}/c")["countries"].collect()} == {"Mali", "Chad"}


def test_empty_table(facilities):
    none = partials.partial_counters(facilities.limit(0), ["country", "data_quality_flag"], distinct=["uid"])
    assert none.count() == 0 and partials.completeness_from(none).count() == 0 and partials.distinct_from(none).count() == 0


def test_bucketed_registry_is_not_shuffled(spark, frame):
    rows = [("KEN", f"c{i}", f"KEN-{i:06d}", None) for i in range(500)] + [("KEN", "c3", "KEN-900000", None)]
    registry = frame(rows, "country string, facility_code string, uid string, created_date date")
    base = lake.bucketed_table(registry, "bucketed_for_test", ["country", "facility_code"], 4, f"{shared_folder(spark)}/b")
    late = frame([("KEN", "new", "KEN-000777", None), ("KEN", "c5", "KEN-000778", None)], registry.schema)
    facts = frame([(i, "KEN" if i % 50 else None, f"c{i}" if i % 7 else "new") for i in range(600)], "i int, iso string, facility_code string")
    out = identifiers.assign_uids_layered(facts, base, late)
    want = identifiers.assign_uids(facts, registry.unionByName(late))
    assert plain(out) == plain(want)
    plan = identifiers.assign_uids(facts, base, method="shuffle")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1  # the facts' side alone
    assert "Bucketed: true" in plan
