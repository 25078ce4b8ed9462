"""Versions of state tables, published tables, feeds that fail, landed answers."""

import datetime as dt
from pathlib import Path

import pytest

from checks import queries
from registry_spark.countries import Feed
from registry_spark.operators import lookups, numbering
from registry_spark.operators.identifiers import new_registry_rows
from registry_spark.plans.facilities import LakePaths, land_answers, register_new
from registry_spark.plans.services import FINER, run_services
from registry_spark.schema import UID_REGISTRY
from registry_spark.session import more_partitions
from registry_spark.sources import lake, readers
from registry_spark.sources import versions as module
from registry_spark.sources.runlog import RunLog, counters_path
from registry_spark.sources.versions import Conflict, VersionedTable

DAY = dt.date(2026, 1, 31)


def facilities(spark, codes):
    return spark.createDataFrame([("TZA", c) for c in codes], "iso string, facility_code string")


def test_versions_and_plain_files(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert readers.read_uid_registry(spark, path).count() == 0
    lake.append_rows(spark.createDataFrame([("TZA", "a", "TZA-000007", DAY)], UID_REGISTRY), path)
    for codes in (["a", "b"], ["b", "c", "d"], ["c"]):
        register_new(spark, facilities(spark, codes), path, DAY)
    table = VersionedTable(spark, path, UID_REGISTRY)
    assert table.version() == 2  # nothing new, no version
    assert [table.read(v).count() for v in (0, 1, 2)] == [1, 2, 4]
    assert sorted(r.uid for r in table.read().collect()) == [f"TZA-00000{n}" for n in (7, 8, 9)] + ["TZA-000010"]
    table.compact()
    assert table.version() == 3 and table.read().count() == 4 and table.read(1).count() == 2


def test_interleaved_runs_give_no_number_twice(spark, tmp_path):
    path = str(tmp_path / "registry")
    table, calls = VersionedTable(spark, path, UID_REGISTRY), []

    def slow(registry):
        """Another run registers codes while this one works on what it read."""
        calls.append(registry.count())
        if len(calls) == 1:
            register_new(spark, facilities(spark, ["b", "c"]), path, DAY)
        return new_registry_rows(facilities(spark, ["a", "b"]), registry, DAY)

    assert table.update(slow) == 1 and calls == [0, 2]
    rows = table.read().collect()
    assert sorted(r.facility_code for r in rows) == ["a", "b", "c"]
    assert sorted(r.uid for r in rows) == ["TZA-000001", "TZA-000002", "TZA-000003"]
    with pytest.raises(Conflict):
        table.commit(1, "other")


def test_small_changes_are_brought_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(module, "COMPACT_AFTER", 3)
    path = str(tmp_path / "registry")
    for code in "abcd":
        register_new(spark, facilities(spark, [code]), path, DAY)
    commits = VersionedTable(spark, path, UID_REGISTRY).commits()
    assert [c["whole"] for c in commits] == [False, False, False, True, False]
    assert readers.read_uid_registry(spark, path).count() == 4


def test_publication_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "published")
    first = spark.createDataFrame([(1, "TZA"), (2, "KEN")], "n int, country_iso string")
    lake.publish(first, "pub_table", root, partition_by="country_iso")
    broken = first.selectExpr("assert_true(n < 2) AS bad", "n", "country_iso")
    with pytest.raises(Exception, match="n < 2|assert"):
        lake.publish(broken, "pub_table", root)

    def refuse(files):
        raise ValueError("not good")

    with pytest.raises(ValueError, match="not good"):
        lake.publish(first.limit(1), "pub_table", root, check=refuse)
    assert spark.table("pub_table").count() == 2
    lake.publish(first.withColumn("more", first.n + 1), "pub_table", root)
    assert sorted(spark.table("pub_table").columns) == ["country_iso", "more", "n"]
    spark.sql("DROP VIEW pub_table")
    assert lake.restore(spark, root) == ["pub_table"] and spark.table("pub_table").count() == 2


def test_a_failing_feed_leaves_the_table_and_the_others(spark, tmp_path):
    feed = Feed("Tanzania", (("service_detail", "source_name"),), source_service_name="service_detail")
    paths, good, bad = LakePaths(str(tmp_path / "lake")), tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text('facility_code,service_detail\n1,x\n2,"long\nname"\n')
    bad.write_text('facility_code,service_detail\n1,x\n2,y,z,"w"\n')
    (tmp_path / "cw.csv").write_text(
        "source_name,service_domain,service_group,service_name,is_clinical,is_malaria_related,include_in_analysis,needs_review\n"
        "x,Clinical,Group,X,TRUE,FALSE,TRUE,FALSE\n"
    )
    cross = str(tmp_path / "cw.csv")
    feeds, options = {"TZA": feed, "KEN": feed}, {"order_by": ["facility_code"]}
    run_services(spark, {"TZA": (str(good), cross)}, paths, feeds=feeds, table="fs_test", read_options={"multi_line": True}, **options)
    assert spark.table("fs_test").count() == 2
    # Without the option the quoted line break stops one feed and not the other.
    ken = tmp_path / "ken.csv"
    ken.write_text("facility_code,service_detail\n7,x\n")
    out = run_services(spark, {"TZA": (str(good), cross), "KEN": (str(ken), cross)}, paths, feeds=feeds, table="fs_test", **options)
    assert [(r.country_iso, r.facility_code) for r in out.collect()] == [("KEN", "7")]
    log = {(r.step, r.status) for r in spark.read.parquet(paths.log).collect()}
    assert {("services TZA", "FAILED"), ("services KEN", "SUCCESS"), ("services TZA", "SUCCESS")} <= log
    # All feeds fail: the last table stands.
    with pytest.raises(ValueError):
        run_services(spark, {"KEN": (str(bad), cross)}, paths, feeds=feeds, table="fs_test", **options)
    assert spark.table("fs_test").count() == 1


def test_answers_are_merged_once(spark, tmp_path):
    path, schema = str(tmp_path / "cache"), "query string, result_lat double, result_lon double, result_type string, at int"
    rows = [("a", 1.0, 2.0, "x", 1), ("a", 3.0, 4.0, "y", 2), ("b", None, None, None, 1), (None, 1.0, 1.0, "x", 1)]
    answers = spark.createDataFrame(rows, schema)
    assert land_answers(spark, answers, path, order="at") == 2
    assert land_answers(spark, answers, path, order="at") == 0
    more = spark.createDataFrame([("b", 5.0, 6.0, "z", 3), ("c", 7.0, 8.0, "z", 3)], schema)
    assert land_answers(spark, more, path, order="at") == 3
    got = sorted(map(tuple, readers.read_geocode_cache(spark, path).collect()))
    assert got == [("a", 3.0, 4.0, "y"), ("b", 5.0, 6.0, "z"), ("c", 7.0, 8.0, "z")]
    assert readers.read_geocode_cache(spark, path, 1).count() == 2


CROSSWALK = ("source_name,service_domain,service_group,service_name,is_clinical,is_malaria_related,include_in_analysis,needs_review\n"
             "x,Clinical,Group,X,TRUE,FALSE,TRUE,FALSE\n")


def two_feeds(tmp_path):
    feed = Feed("Tanzania", (("service_detail", "source_name"),), source_service_name="service_detail")
    (tmp_path / "cw.csv").write_text(CROSSWALK)
    inputs = {}
    for iso, codes in (("TZA", "123"), ("KEN", "78")):
        (tmp_path / f"{iso}.csv").write_text("facility_code,service_detail\n" + "".join(f"{c},x\n" for c in codes))
        inputs[iso] = (str(tmp_path / f"{iso}.csv"), str(tmp_path / "cw.csv"))
    return inputs, {"TZA": feed, "KEN": feed}


def test_a_feed_is_written_once(spark, tmp_path):
    inputs, feeds = two_feeds(tmp_path)
    paths, shared = LakePaths(str(tmp_path / "lake")), Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    out = run_services(spark, inputs, paths, feeds=feeds, table="fs_once", order_by=["facility_code"])
    assert set(shared.iterdir()) == before
    assert len(list(Path(paths.published, "fs_once").iterdir())) == 1
    assert sorted((r.country_iso, r.facility_code) for r in out.collect()) == [("KEN", "7"), ("KEN", "8"), ("TZA", "1"), ("TZA", "2"), ("TZA", "3")]
    slim = spark.read.parquet(paths.slim_services)
    assert sorted((r.country_iso, r.service_name) for r in slim.collect()) == [("KEN", "X")] * 2 + [("TZA", "X")] * 3


def test_a_feed_that_fails_after_its_write_is_left_out(spark, tmp_path, monkeypatch):
    inputs, feeds = two_feeds(tmp_path)
    paths, count = LakePaths(str(tmp_path / "lake")), RunLog.count

    def refuse(log, country, step, **counters):
        if country == "TZA":
            raise ValueError("no counters")
        count(log, country, step, **counters)

    monkeypatch.setattr(RunLog, "count", refuse)
    out = run_services(spark, inputs, paths, feeds=feeds, table="fs_late", order_by=["facility_code"])
    assert sorted((r.country_iso, r.facility_code) for r in out.collect()) == [("KEN", "7"), ("KEN", "8")]
    log = {(r.step, r.status) for r in spark.read.parquet(paths.log).collect()}
    assert log == {("services TZA", "FAILED"), ("services KEN", "SUCCESS"), ("services", "SUCCESS")}


def test_more_partitions_only_meanwhile(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    for n, wanted in ((None, before), (1, before), (int(before) + 9, str(int(before) + 9))):
        with pytest.raises(KeyError), more_partitions(spark, n):
            assert spark.conf.get(key) == wanted
            raise KeyError
        assert spark.conf.get(key) == before


def test_more_partitions_are_kept_and_read_in_as_many_tasks(spark, tmp_path):
    """A join is not brought back to a few partitions that a task must spill; small files stay whole."""
    keys = ("spark.sql.files.minPartitionNum", "spark.sql.adaptive.coalescePartitions.enabled")
    before, scanned = [spark.conf.get(k, None) for k in keys], str(tmp_path / "rows")
    spark.range(1_500_000).selectExpr("id", "uuid() AS text").coalesce(1).write.option("parquet.block.size", 4 << 20).parquet(scanned)
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) + 9
    with more_partitions(spark, n):
        joined = spark.range(1000).join(spark.range(0, 2000, 2).hint("merge"), "id")
        joined.write.parquet(str(tmp_path / "joined"))
        assert spark.read.parquet(scanned).rdd.getNumPartitions() >= n
        assert spark.read.parquet(str(tmp_path / "joined")).count() == 500
    assert len(list((tmp_path / "joined").glob("part-*"))) == n
    assert [spark.conf.get(k, None) for k in keys] == before


def test_finer_partitions_only_of_large_lists(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "list")
    spark.range(3000).selectExpr("uuid() AS text").coalesce(1).write.parquet(path)
    session, stored = int(spark.conf.get("spark.sql.shuffle.partitions")), next(Path(path).glob("part-*")).stat().st_size
    rows = spark.read.parquet(path)
    for wanted, given in ((session, None), (session + 3, 4 * (session + 3)), (1000, 3000)):
        monkeypatch.setattr(lookups, "PART_BYTES", -(-stored // wanted))
        found = lookups.partitions_of(rows, 3000, 4)
        assert found == given


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).is_dir(), reason="test tables not present")
def test_a_run_deals_its_rows_by_the_size_of_the_list(spark, monkeypatch):
    """Every merge join and the numbering of a run take more partitions for a larger list than the session has."""
    monkeypatch.setattr(lookups, "PART_BYTES", 8_000)
    limit, asked, number = "spark.sql.autoBroadcastJoinThreshold", [], numbering.partitions_of

    def dealt(*args):
        asked.append(number(*args))
        return asked[-1]

    monkeypatch.setattr(numbering, "partitions_of", dealt)
    session, before = int(spark.conf.get("spark.sql.shuffle.partitions")), spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        paths = queries.run_feeds(spark, SF)
    finally:
        spark.conf.set(limit, before)
    files = len(list(Path(paths.root).parent.joinpath("list.parquet").glob("part-*")))
    assert files > session
    assert asked[0] > session and asked[0] % FINER == 0
    rows = {r.counter: r.n for r in spark.read.parquet(counters_path(paths.log)).collect()}
    assert rows["rows"] == spark.read.parquet(f"{SF}/lineitem.parquet").count() == rows["matched"] + rows["unmatched"]
