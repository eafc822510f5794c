"""CSV by byte ranges against the library's one-task reader, for cuts at every place."""

import csv
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.sources.csv_ranges import read_csv_ranges
from lotwise.sources.listings import scan_listings_csv

HEAD = ["id", "web scraper.order", "a,b", "n"]


def _write(path, rows, **options):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, **options).writerows([HEAD, *rows])


def _rows(n, seed=1):
    rng = random.Random(seed)
    texts = ["", "x", "a\nb", "a\r\nb", '"', '""', 'say "a, b"\n\n', "\n", "é\n漢", "line\n" * 9, ",", " x ", "a\n" + '"' * 5]
    return [[str(i), rng.choice(texts), rng.choice(texts), str(rng.randrange(9))] for i in range(n)]


def _whole(spark, path, schema=None):
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    return (reader.schema(schema) if schema else reader).csv(path)


@pytest.fixture
def cuts(spark):
    """Byte ranges of a given size."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def of(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)

    yield of
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("options", [{"quoting": csv.QUOTE_ALL}, {}, {"lineterminator": "\n"}])
def test_same_rows_for_every_cut(spark, tmp_path, cuts, options):
    path = str(tmp_path / "x.csv")
    rows = _rows(60)
    _write(path, rows, **options)
    # in a file whose records end with \r\n the one-task reader turns that into \n in texts as well
    flat = lambda row: tuple(x if x is None else x.replace("\r\n", "\n") for x in row)
    want = sorted(map(flat, _whole(spark, path).collect()), key=str)
    for size in (3, 17, 64, 200, 1 << 20):
        cuts(size)
        got = read_csv_ranges(spark, path)
        assert got.columns == HEAD
        found = got.collect()
        assert sorted(map(flat, found), key=str) == want and len(want) == 60
        assert sorted(tuple(x or "" for x in r) for r in found) == sorted(map(tuple, rows))


def test_one_file_is_read_by_many_tasks(spark, tmp_path, cuts):
    path = str(tmp_path / "x.csv")
    _write(path, _rows(3000))
    cuts(4000)
    rows = read_csv_ranges(spark, path).withColumn("task", F.spark_partition_id()).collect()
    assert len(rows) == 3000 and len({r["task"] for r in rows}) > 5
    assert sorted(int(r["id"]) for r in rows) == list(range(3000))


def test_many_files_and_a_row_like_the_header(spark, tmp_path, cuts):
    for k in range(4):
        _write(tmp_path / f"{k}.csv", [*_rows(20, k), HEAD])
    _write(tmp_path / "none.csv", [])
    cuts(50)
    got = read_csv_ranges(spark, str(tmp_path))
    want = _whole(spark, str(tmp_path))
    flat = lambda row: tuple(x if x is None else x.replace("\r\n", "\n") for x in row)
    key = lambda df: sorted(map(flat, df.collect()), key=str)
    assert key(got) == key(want) and got.filter("id = 'id'").count() == 4


def test_schema_types_and_options(spark, tmp_path):
    path = str(tmp_path / "x.csv")
    _write(path, [["1", "NA", "", "7"], ["2", "b", "c", "junk"], ["3", "b"]])
    schema = T.StructType([T.StructField(n, T.IntegerType() if n in ("id", "n") else T.StringType()) for n in HEAD])
    got = read_csv_ranges(spark, path, schema, nullValue="NA").orderBy("id").collect()
    want = spark.read.option("header", True).option("escape", '"').option("nullValue", "NA").schema(schema).csv(path)
    assert got == want.orderBy("id").collect()
    with pytest.raises(ValueError, match="header"):
        read_csv_ranges(spark, path, T.StructType(list(reversed(schema.fields))))


def test_files_that_cannot_be_read_are_errors(spark, tmp_path):
    (tmp_path / "open.csv").write_text('a,b\n1,"no end\n2,3\n')
    with pytest.raises(ValueError, match="quoted"):
        read_csv_ranges(spark, str(tmp_path / "open.csv"))
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "d" / "2.csv").write_text("b,a\n1,2\n")
    with pytest.raises(ValueError, match="header"):
        read_csv_ranges(spark, str(tmp_path / "d"))
    (tmp_path / "head.csv").write_text('a,"b\nc"\n1,2\n')
    with pytest.raises(ValueError, match="line break"):
        read_csv_ranges(spark, str(tmp_path / "head.csv"))


def test_no_rows_odd_headers_and_blank_lines(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    assert read_csv_ranges(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "x.csv").write_text("﻿a,,A,b`\r\n\r\n1,2,3,4\r\n\n5,6,7,8", encoding="utf-8")
    got = read_csv_ranges(spark, str(tmp_path / "x.csv"))
    assert got.columns == ["a0", "_c1", "A2", "b`"] and got.count() == 2
    assert scan_listings_csv(spark, str(tmp_path / "x.csv")).count() == 2
