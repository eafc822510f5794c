"""Cleaning functions on literal text, keys and null semantics."""

import pytest
from pyspark.sql import functions as F

from lotwise.functions import clean, display, keys, pricing
from lotwise.functions.nulls import strict_avg, strict_sum
from lotwise.operators import filters, groups
from lotwise.params import Params

P = Params()


def value(spark, column, **inputs):
    types = {str: "string", float: "double", int: "int", type(None): "string"}
    row = spark.range(1).select(
        *[F.lit(v).cast(types[type(v)]).alias(k) for k, v in inputs.items()]
    )
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, km",
    [("73,700 Km", 73700.0), ("0 Km", 0.0), ("1,234,567 Km", 1234567.0), ("12", 12.0), ("n/a", None), ("", None), (None, None)],
)
def test_mileage(spark, text, km):
    assert value(spark, clean.clean_mileage(F.col("t")), t=text) == km


@pytest.mark.parametrize("text, price", [("120,000", 120000.0), ("call", None), ("", None), (None, None)])
def test_price(spark, text, price):
    assert value(spark, clean.clean_price(F.col("t")), t=text) == price


@pytest.mark.parametrize("text, n", [("6", 6), ("6.0", 6), ("V8", None), (None, None), ("99999999999", None)])
def test_cylinder(spark, text, n):
    assert value(spark, clean.cast_cylinder(F.col("t")), t=text) == n


@pytest.mark.parametrize(
    "text, sold, hours",
    [
        ("04/04/2024", "04-Apr-2024", None),
        ("4/4/2024", "04-Apr-2024", None),
        ("31/02/2024", None, None),
        ("a/b", None, None),
        ("5 hours ago", "", 5.0),
        ("30 minutes ago", "", 0.5),
        ("1 hour ago", "", None),
        ("yesterday", "", None),
        (None, "", None),
    ],
)
def test_time(spark, text, sold, hours):
    assert value(spark, clean.parse_date_sold(F.col("t")), t=text) == sold
    assert value(spark, clean.parse_posted_hours(F.col("t")), t=text) == hours


def test_singular_hour(spark):
    assert value(spark, clean.parse_posted_hours(F.col("t"), singular=True), t="1 hour ago") == 1.0


@pytest.mark.parametrize("km, tier", [(0.0, 0.0), (1.0, 10000.0), (10000.0, 10000.0), (10001.0, 20000.0), (-5.0, None)])
def test_tier(spark, km, tier):
    assert value(spark, clean.mileage_tier(F.col("m")), m=km) == tier


def test_keys(spark):
    df = spark.createDataFrame(
        [("BMW", "7-Series", "730 Li", 6, "Automatic"), ("BMW", None, None, None, "Manual")],
        "make string, model string, trim string, cylinder int, gear_type string",
    )
    rows = keys.with_keys(df).collect()
    assert rows[0]["model_key"] == "BMW-7-Series"
    assert rows[0]["trim_key"] == "BMW-BMW-7-Series-730 Li-6-Automatic"
    assert rows[1]["trim_key"] == "BMW-BMW-NA-NA-NA-Manual"
    key = "BMW-BMW-7-Series-730 Li-6-Automatic-2019"
    assert value(spark, keys.year_of_key(F.col("k")), k=key) == 2019
    assert value(spark, keys.trim_of_key(F.col("k")), k=key) == rows[0]["trim_key"]
    assert value(spark, keys.mileage_key(F.lit("T"), F.col("m")), m=100000.0) == "T-100000"
    assert value(spark, keys.mileage_key(F.lit("T"), F.col("m").cast("double")), m=None) == "T-NA"


def test_display(spark):
    assert value(spark, display.round_format(F.col("x")), x=12345.5) == "12,346"
    assert value(spark, display.round_format(F.col("x")), x=2.5) == "2"
    assert value(spark, display.reparse_number(F.col("t")), t=" 73,700") == 73700.0


def test_price_expressions_keep_nulls(spark):
    null, c = F.lit(None).cast("double"), F.lit
    for column in (
        pricing.clamp_at_zero(null),
        pricing.price_floor(null, c(100.0), P),
        pricing.price_floor(c(100.0), null, P),
        pricing.year_fallback(null, c(1.0), c(2020), c(2019.0), P),
        pricing.price_gap(null, c(1.0), P),
        pricing.price_gap(c(1.0), c(0.0), P),
    ):
        assert value(spark, column, x=1) is None


def test_price_expressions(spark):
    c = F.lit
    assert value(spark, pricing.price_floor(c(10.0), c(100.0), P), x=1) == 20.0
    assert value(spark, pricing.price_floor(c(30.0), c(100.0), P), x=1) == 30.0
    assert value(spark, pricing.clamp_at_zero(c(-1.0)), x=1) == 0.0
    assert value(spark, pricing.year_fallback(c(0.0), c(100.0), c(2021), c(2019.0), P), x=1) == 20.0
    assert value(spark, pricing.year_fallback(c(5.0), c(100.0), c(2021), c(2019.0), P), x=1) == 0.0
    assert value(spark, pricing.price_gap(c(100.005), c(100.0), P), x=1) == 0.0
    assert value(spark, pricing.price_gap(c(150.0), c(100.0), P), x=1) == 50.0


@pytest.fixture
def holes(spark):
    """Ten listings, with a null in every column somewhere."""
    rows = [
        ("a", "A", "x", 6, "auto", 10000.0, 100.0, 2019, "now"),
        ("b", "A", "x", 6, "auto", None, 200.0, 2019, "now"),
        ("c", None, "x", 6, "auto", 20000.0, 300.0, 2018, None),
        ("d", None, "x", 6, "auto", 20000.0, 500.0, 2018, "now"),
        ("e", "A", None, 6, "auto", 5000.0, 300.0, 2018, "now"),
        ("f", "A", "x", None, "auto", 5000.0, 300.0, 2018, "now"),
        ("g", "A", "x", 6, None, 5000.0, 300.0, 2018, "now"),
        ("h", "A", "x", 6, "auto", 5000.0, None, 2018, "now"),
        ("i", "B", "x", 6, "auto", 5000.0, 100.0, None, "now"),
        ("j", "B", "x", 6, "auto", 5000.0, 300.0, 2018, "now"),
    ]
    return spark.createDataFrame(
        rows,
        "id string, make string, trim string, cylinder int, gear_type string, mileage double,"
        " price double, year int, time string",
    )


def test_strict_aggregates(holes):
    got = {
        r["make"]: (r["s"], r["m"])
        for r in holes.groupBy("make").agg(strict_sum("price").alias("s"), strict_avg("mileage").alias("m")).collect()
    }
    assert got["A"] == (None, None)
    assert got[None] == (800.0, 20000.0)
    assert got["B"] == (400.0, 5000.0)


def test_lookup_matches_null_with_null(holes):
    means = groups.with_group_stats(holes, ["make"], {"mean": strict_avg("price")})
    got = {r["id"]: r["mean"] for r in means.collect()}
    assert len(got) == 10
    assert got["c"] == got["d"] == 400.0 and got["j"] == 200.0 and got["a"] is None


def test_filters_drop_unknown(holes):
    p = Params(price_cap=400.0, min_year=2017)
    kept = {r["id"] for r in filters.keep_listings(holes, p).collect()}
    assert kept == {"a", "b", "c", "e", "f", "g", "j"}


def test_semi_join_matches_null_with_null(holes):
    out = filters.semi_join_keys(holes, holes.filter("id IN ('c', 'j')"), ["make"])
    assert {r["id"] for r in out.collect()} == {"c", "d", "i", "j"}


def test_only_plain_numbers_are_numbers(spark):
    texts = ["12f", "12d", "NaN", "Infinity", "-Infinity", "0x1F", "1e3", " 7 ", "+.5", "5.", ".", "", "1,2,3", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r["p"] for r in df.orderBy("i").select(clean.clean_price(F.col("t")).alias("p")).collect()]
    assert got == [None] * 6 + [1000.0, 7.0, 0.5, 5.0, None, None, 123.0, None]
