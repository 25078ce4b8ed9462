"""CSV with line breaks in quoted fields, in many blocks, against the reader that takes a file whole."""

import csv
import random

import pytest

from registry_spark.sources.readers import read_text_csv
from registry_spark.sources.records import read_records

PIECES = ["a", "bc", ",", '"', "\n", "\n\n", " ", '""', "é", "NA", "x\ny", '",\n"', "1"]


def invented(seed, rows=400):
    random.seed(seed)
    field = lambda: "".join(random.choices(PIECES, k=random.randint(0, 5)))
    return [[str(i), field(), field(), field()] for i in range(rows)]


def write(path, rows, end="\n", encoding="utf-8"):
    with open(path, "w", newline="", encoding=encoding) as file:
        out = csv.writer(file, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
        out.writerow(["id", "one, two", "b", "c"])
        out.writerows(rows)


@pytest.fixture
def small_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for key, value in zip(before, ("700", "1")):
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def whole(spark, path, encoding="UTF-8"):
    return spark.read.options(header=True, multiLine=True, escape='"', nullValue="NA", encoding=encoding).csv(str(path))


@pytest.mark.parametrize("seed", range(3))
def test_blocks_equal_whole_files(spark, tmp_path, small_blocks, seed):
    rows = invented(seed)
    write(tmp_path / "a.csv", rows[:300])
    write(tmp_path / "b.csv", rows[300:])
    got = read_records(spark, str(tmp_path))
    assert got.columns == ["id", "one, two", "b", "c"]
    found = sorted(map(tuple, got.collect()), key=str)
    assert found == sorted(map(tuple, whole(spark, tmp_path).collect()), key=str)
    assert {r[0]: [v or "" for v in r[1:]] for r in found} == {r[0]: ["" if v == "NA" else v for v in r[1:]] for r in rows}
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8


def test_line_ends_and_encoding(spark, tmp_path, small_blocks):
    rows = [[str(i), "é\r\nß" if i % 3 else "ü", 'say "no"', "x,y"] for i in range(120)]
    write(tmp_path / "a.csv", rows, end="\r\n", encoding="latin-1")
    got = sorted(map(tuple, read_text_csv(spark, str(tmp_path), encoding="ISO-8859-1", multi_line=True).collect()))
    assert got == sorted((r[0], r[1].replace("\r\n", "\n"), r[2], r[3]) for r in rows)


def test_quotes_inside_plain_fields(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_text('id,v\n1,5" pipe\n2,"a\nb"\n3,6" and 7"\n4,"x ""y""\nz"\n' * 40)
    got = sorted(map(tuple, read_records(spark, str(tmp_path)).filter("id <> 'id'").distinct().collect()))
    assert got == [("1", '5" pipe'), ("2", "a\nb"), ("3", '6" and 7"'), ("4", 'x "y"\nz')]


def test_filters_on_parsed_columns(spark, tmp_path):
    """A filter that the optimizer moves below the parser meets no half records."""
    (tmp_path / "a.csv").write_text('id,v,w\n1,"a\nb",3\n\n2,x,4\n3,y,\n')
    df = read_text_csv(spark, str(tmp_path / "a.csv"), multi_line=True)
    assert sorted(map(tuple, df.filter("cast(w AS int) > 2 AND v <> 'q'").collect())) == [("1", "a\nb", "3"), ("2", "x", "4")]


def test_damage(spark, tmp_path):
    (tmp_path / "open.csv").write_text('id,v\n1,"a\n2,b\n')
    with pytest.raises(ValueError, match="no end"):
        read_records(spark, str(tmp_path / "open.csv"))
    (tmp_path / "short.csv").write_text('id,v\n1,"a\nb"\n2\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_records(spark, str(tmp_path / "short.csv")).collect()
    assert read_records(spark, str(tmp_path / "short.csv"), mode="PERMISSIVE").count() == 2
    (tmp_path / "none.csv").write_text("id,v\n")
    assert read_records(spark, str(tmp_path / "none.csv")).count() == 0
