import datetime as dt
import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from registry_spark.operators import identifiers, lookups
from registry_spark.operators import numbering
from registry_spark.operators.numbering import number_rows

TODAY = dt.date(2026, 1, 31)


@pytest.mark.parametrize("collapse", [True, False])
@pytest.mark.parametrize("digits", [1, 3])
def test_numbers_are_dense_per_group(spark, collapse, digits):
    df = spark.range(5000).select(
        F.col("id").cast("string").alias("k"),
        F.expr("CASE WHEN id % 10 < 7 THEN 'big' WHEN id % 10 = 7 THEN 'mid' WHEN id = 9 THEN 'one' ELSE 'low' END").alias("g"))
    out = number_rows(df, ["k"], within=["g"], digits=digits, collapse=collapse)
    assert out.columns == ["k", "g", "n"]
    per_group = {}
    for r in out.collect():
        per_group.setdefault(r.g, []).append(r.n)
    for numbers in per_group.values():
        assert sorted(numbers) == list(range(1, len(numbers) + 1))
    assert sum(map(len, per_group.values())) == 5000


def test_numbers_do_not_depend_on_the_layout(spark):
    df = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    one = number_rows(df.repartition(1), ["k"]).collect()
    many = number_rows(df.repartition(13).sortWithinPartitions(F.desc("k")), ["k"]).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))


def test_copies_get_their_own_numbers(spark, monkeypatch):
    monkeypatch.setattr(numbering, "CHUNK", 7)
    df = spark.range(300).select(F.expr("CASE WHEN id % 3 = 0 THEN 'copy' ELSE CAST(id AS STRING) END").alias("k"),
                                 F.lit("g").alias("g"))
    out = number_rows(df, ["k"], within=["g"]).collect()
    assert sorted(r.n for r in out) == list(range(1, 301))
    assert Counter(r.k for r in out)["copy"] == 100


def test_copies_are_spread_over_buckets(spark, monkeypatch):
    """Chunks of one repeated row fall into different buckets."""
    monkeypatch.setattr(numbering, "CHUNK", 10)
    df = spark.range(1000).select(F.lit("same").alias("k"))
    numbers = [r.n for r in number_rows(df, ["k"]).collect()]
    assert sorted(numbers) == list(range(1, 1001))


def test_empty_input(spark):
    df = spark.createDataFrame([], "k string, g string")
    assert number_rows(df, ["k"], within=["g"]).count() == 0


@pytest.fixture
def registry(frame):
    return frame(
        [("KEN", "a", "KEN-000007", TODAY), ("KEN", "old", "KEN-1000002", TODAY), ("MWI", "a", "MWI-000001", TODAY),
         ("KEN", "b", "KEN-000009", TODAY), ("KEN", "b", "KEN-000003", TODAY)],
        "country string, facility_code string, uid string, created_date date")


def test_minting(frame, registry):
    fac = frame([("KEN", "a"), ("KEN", "new"), ("KEN", "new"), ("KEN", "b"), ("KEN", None), ("KEN", ""),
                 ("TZA", "t"), (None, "x")], "iso string, facility_code string")
    minted = identifiers.new_registry_rows(fac, registry, TODAY)
    rows = {(r.country, r.facility_code): r.uid for r in minted.collect()}
    assert rows == {("KEN", "new"): "KEN-1000003", ("TZA", "t"): "TZA-000001"}

    both = registry.unionByName(minted)
    assert identifiers.new_registry_rows(fac, both, TODAY).count() == 0
    for method in ("broadcast", "shuffle"):
        out = Counter((r.iso, r.facility_code, r.uid) for r in identifiers.assign_uids(fac, both, method=method).collect())
        assert out == Counter({
            ("KEN", "a", "KEN-000007"): 1, ("KEN", "new", "KEN-1000003"): 2, ("KEN", "b", "KEN-000003"): 1,
            ("KEN", None, None): 1, ("KEN", "", None): 1, ("TZA", "t", "TZA-000001"): 1, (None, "x", None): 1})


def test_highest_number_per_country(registry):
    out = {r.country: r.highest for r in identifiers.highest_numbers(registry).collect()}
    assert out == {"KEN": 1000002, "MWI": 1}


def test_service_uids(frame):
    df = frame([("f1", "x"), ("f1", "x"), ("f2", None)], "facility_code string, name string")
    out = identifiers.service_uids(df, "KEN")
    assert sorted(r.uid for r in out.collect()) == ["KEN-SVC-000001", "KEN-SVC-000002", "KEN-SVC-000003"]


def test_uid_text_is_null_without_a_number(frame):
    df = frame([("A", 5), ("A", None), (None, 5), ("A", 1234567)], "p string, n bigint")
    out = [r[0] for r in df.select(identifiers.uid_text(F.col("p"), F.col("n"))).collect()]
    assert out == ["A-000005", None, None, "A-1234567"]


def test_whole_rows_are_shuffled_once_in_parts_of_the_input(spark, tmp_path, monkeypatch, capsys):
    """Rows of a large list are not held in one hash table a task, and the session's number of partitions is no limit."""
    monkeypatch.setattr(lookups, "PART_BYTES", 2_000)
    path = str(tmp_path / "a list")
    spark.range(6000).selectExpr("CAST(id * 7919 AS STRING) AS k", "id % 3 AS other").write.parquet(path)
    out = number_rows(spark.read.parquet(path), ["k", "other"], digits=2)
    out.explain()
    plan = capsys.readouterr().out
    parts = {int(n) for n in re.findall(r"__bucket#\d+, (\d+)\), REPARTITION_BY_NUM", plan)}
    assert parts and min(parts) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(r.n for r in out.collect()) == list(range(1, 6001))


def test_rare_and_frequent_copies_together(spark, monkeypatch):
    """Rows of full cells are counted, the others are not; the numbers are those of all chunks and rows in one order."""
    monkeypatch.setattr(numbering, "CHUNK", 5)
    values = [f"v{i % 40}" for i in range(400)] + [f"w{i}" for i in range(300)] + [f"x{i % 150}" for i in range(300)]
    copies = Counter(values)
    entries = []
    for value, n in copies.items():
        for chunk in range((n - 1) // 5 + 1):
            entries.append((hashlib.md5(f"{value}|{chunk}".encode()).hexdigest(), value, min(5, n - 5 * chunk)))
    expected = [value for _, value, size in sorted(entries) for _ in range(size)]
    for digits in (1, 3):
        out = number_rows(spark.createDataFrame([(v,) for v in values], "k string"), ["k"], digits=digits)
        assert [r.k for r in out.orderBy("n").collect()] == expected


def test_rows_are_counted_in_16_cells_a_bucket_and_finer_only_where_crowded(spark, monkeypatch, capsys):
    """The numbers are those of one order, whether cells are crowded, full or neither."""
    df = spark.range(2000).selectExpr("CASE WHEN id % 4 = 0 THEN 'copy' ELSE CAST(id AS STRING) END AS k")
    plain = number_rows(df, ["k"], digits=1)
    plain.explain()
    plan = capsys.readouterr().out
    assert re.search(r"hashpartitioning\(__cell#\d+, \d+\)", plan) and re.search(r"hashpartitioning\(__cell#\d+, __part#\d+, \d+\)", plan)
    monkeypatch.setattr(numbering, "CHUNK", 6)
    entries = [(hashlib.md5(f"copy|{c}".encode()).hexdigest(), "copy", min(6, 500 - 6 * c)) for c in range(84)]
    entries += [(hashlib.md5(f"{i}|0".encode()).hexdigest(), str(i), 1) for i in range(2000) if i % 4]
    expected = [value for _, value, size in sorted(entries) for _ in range(size)]
    assert [r.k for r in number_rows(df, ["k"], digits=1).orderBy("n").collect()] == expected


def test_uid_text_is_padded_as_by_a_format(frame):
    numbers = [0, 5, 99999, 100000, 1234567, 2**62, -5, -1234567]
    df = frame([(n,) for n in numbers], "n bigint")
    assert [r[0] for r in df.select(identifiers.uid_text(F.lit("A"), F.col("n"))).collect()] == ["A-%06d" % n for n in numbers]
