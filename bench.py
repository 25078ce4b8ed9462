"""Headline queries on the given tables; prints one JSON line.

Every query runs twice into a sink that discards rows; the second, warm run counts,
including the time to build the plan.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from registry_spark.session import local_session  # noqa: E402

HEADLINE = (
    "lake_summary", "standardize_columns", "ownership_class", "coord_clean", "date_clean", "enforce_schema",
    "quality_flag", "within_filter", "within_flag", "geocode_cache", "coord_lookup", "union_merge", "completeness",
    "contract_facilities", "uid_new", "uid_reuse_mint", "service_uid", "facility_uid_join",
    "facility_uid_join_skewed", "crosswalk_two_key", "crosswalk_unmatched", "rule_exact", "rule_first_match",
    "rule_names", "vocab_inventory", "service_report", "domain_distribution", "malaria_counts", "source_profile", "csv_registry", "lake_tables", "uid_registry",
    "contract_services", "facility_service_join", "facility_service_hot", "crosswalk_two_key_skewed", "split_explode", "split_lists", "payload_services",
    "facilities_plan", "services_plan", "services_plan_large", "within_flag_large",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    os.environ.setdefault("SHUFFLE_PARTITIONS", cores)
    names = sys.argv[1:] or HEADLINE
    spark = local_session("bench", cores)
    seconds = {}
    for name in names:
        for _ in range(2):
            started = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.time() - started, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
