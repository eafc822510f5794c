import csv
from datetime import datetime
from pathlib import Path

import pytest

from lotwise.sources import sinks
from lotwise.sources.listings import RAW_COLUMNS, RAW_SCHEMA, clean_listings, kept_listings, literal_rows, scan_listings_csv
from lotwise.workspace import new_path, shared_root

HEADER = list(RAW_COLUMNS)
ROWS = [
    ["1712255147-11664", "http://x/1", "BMW", "7-Series", "730 Li", "2019", "120,000", "73,700 Km", "6", "Automatic", "", "3", "04/04/2024", ""],
    ["1712255147-2", "http://x/2", "Kia", "Rio, \"S\"", "Std", "2016", "call", "0 Km", "V4", "Manual", "p", "0", "5 hours ago", ""],
    ["1712255147-3", "http://x/3", "Kia", "Rio", "Std", "2012", "20,000", "", "4", "Manual", "", "", "yesterday", ""],
]


@pytest.fixture
def raw_csv(tmp_path):
    path = tmp_path / "raw.csv"
    with open(path, "w", newline="") as f:
        csv.writer(f, quoting=csv.QUOTE_ALL, doublequote=True).writerows([HEADER, *ROWS])
    return str(path)


def test_scan_and_clean(spark, raw_csv):
    rows = {r["id"]: r for r in clean_listings(scan_listings_csv(spark, raw_csv)).collect()}
    one, two, three = (rows[r[0]] for r in ROWS)
    assert (one["price"], one["mileage"], one["cylinder"], one["mileage_range"]) == (120000.0, 73700.0, 6, 80000.0)
    assert one["date_sold"] == "04-Apr-2024" and one["likes"] == 3
    assert two["model"] == 'Rio, "S"' and two["price"] is None and two["cylinder"] is None
    assert two["posted_time"] == 5.0 and two["mileage_range"] == 0.0
    assert three["mileage"] is None and three["likes"] is None and three["date_sold"] == ""
    kept = kept_listings(clean_listings(scan_listings_csv(spark, raw_csv))).collect()
    assert [r["trim_key"] for r in kept] == ["BMW-BMW-7-Series-730 Li-6-Automatic"]


def test_scan_by_header_order(spark, tmp_path):
    """Columns in another order and two unknown ones; a missing and an empty text."""
    head = ["extra", *reversed(HEADER), "more"]
    rows = [["e", *reversed(r), "m"] for r in ROWS]
    rows[2][head.index("make")], rows[2][head.index("trim")] = "NA", ""
    path = tmp_path / "raw.csv"
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([head, *rows])
    raw = scan_listings_csv(spark, str(path))
    assert {"extra", "more", "price_raw", "id"} <= set(raw.columns)
    got = {r["id"]: r for r in clean_listings(raw).collect()}
    assert got[ROWS[0][0]]["price"] == 120000.0 and got[ROWS[0][0]]["year"] == 2019
    assert got[ROWS[2][0]]["make"] is None and got[ROWS[2][0]]["trim"] == ""


def test_scan_with_schema_checks_the_header(spark, raw_csv, tmp_path):
    assert scan_listings_csv(spark, raw_csv, RAW_SCHEMA).count() == 3
    path = tmp_path / "bad.csv"
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([list(reversed(HEADER)), *[list(reversed(r)) for r in ROWS]])
    with pytest.raises(Exception):
        scan_listings_csv(spark, str(path), RAW_SCHEMA).collect()


def test_empty_lookup_is_counted(spark):
    """A table that turns out empty while it is written still reports its rows."""
    from lotwise.workspace import stored_counted

    df = spark.range(10)
    empty = df.join(df.filter("id > 99").groupBy("id").count(), "id").distinct()
    table, n = stored_counted(empty, "empty")
    assert n == 0 and table.count() == 0
    assert stored_counted(df.filter("false"), "empty")[1] == 0


def test_sink_quotes_and_never_overwrites(spark, tmp_path):
    df = spark.createDataFrame([("a, b", 1.5), ('q"x', 2.0), ("none", None)], "name string, n double")
    path = str(tmp_path / "out")
    sinks.sink_csv(df, path)
    text = "".join(p.read_text() for p in Path(path).glob("part-*"))
    assert '"name","n"' in text and '"a, b","1.5"' in text and '"q""x"' in text
    assert '"none","NA"' in text
    assert sorted(map(tuple, sinks.read_back_csv(spark, path, df.schema).collect()), key=str) == sorted(
        map(tuple, df.collect()), key=str
    )
    with pytest.raises(Exception):
        sinks.sink_csv(df, path)


def test_run_folders(spark, tmp_path):
    run = sinks.run_id(datetime(2024, 4, 18, 11, 54, 3))
    assert run == "2024Apr18_11-54-03"
    df = spark.createDataFrame([("t", 1)], "x string, n int")
    paths = sinks.export_run(str(tmp_path), run, df, df, df, missing=df.select("x"), suffix="_rf")
    assert set(paths) == {"_Export_full_rf", "_Export_Formated_rf", "_Export_Formated_Filtered_rf", "_Export_missing"}
    assert all(Path(p, "_SUCCESS").exists() for p in paths.values())


def test_literal_rows(spark):
    df = literal_rows(spark, [("Audi", "A8", "4.0", "", 2019, "Automatic", 8, 100000.0)])
    assert df.count() == 1 and df.first()["mileage"] == 100000.0


def test_shared_folder_is_the_named_one(spark):
    root = shared_root(spark)
    assert new_path(spark, "t").startswith(root) and shared_root(spark) == root


def test_texts_survive_sink_and_read_back(spark, tmp_path):
    texts = [" GXR ", "a\nb", "a\r\nb", "NA", "\\NA", "\\\\NA", None, "", 'q"x,y', '"', '\\"', "\t"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    sinks.sink_csv(df, str(tmp_path / "x"))
    back = sinks.read_back_csv(spark, str(tmp_path / "x"), df.schema)
    assert [r["t"] for r in back.orderBy("i").collect()] == texts
