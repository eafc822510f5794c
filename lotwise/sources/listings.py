"""Raw listings: CSV scan, literal rows, cleaning into the canonical columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.functions import clean
from lotwise.functions.keys import with_keys
from lotwise.params import Params
from lotwise.sources.csv_ranges import read_csv_ranges

_S, _I, _L = T.StringType(), T.IntegerType(), T.LongType()

# fixed values: header of the scraped file -> our column name
RAW_COLUMNS = {
    "web.scraper.order": "id",
    "car.href": "link",
    "make": "make",
    "model": "model",
    "trim": "trim",
    "year": "year",
    "price": "price_raw",
    "mileage": "mileage_raw",
    "cylinder": "cylinder",
    "gear_type": "gear_type",
    "personal": "personal",
    "likes": "likes",
    "time": "time",
    "car": "car",
}

# the file's own types: numbers that may hold junk are text here and cast on cleaning
RAW_SCHEMA = T.StructType(
    [T.StructField(n, {"year": _I, "likes": _L}.get(n, _S)) for n in RAW_COLUMNS]
)

# a car to price by hand: no id, no price
CAR_SCHEMA = T.StructType(
    [
        T.StructField("make", _S),
        T.StructField("model", _S),
        T.StructField("trim", _S),
        T.StructField("personal", _S),
        T.StructField("year", _I),
        T.StructField("gear_type", _S),
        T.StructField("cylinder", _I),
        T.StructField("mileage", T.DoubleType()),
    ]
)


def scan_listings_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, line_breaks: bool = True
) -> DataFrame:
    """Header CSV without type inference.

    With a schema, the file must have exactly its columns in its order, which is checked
    against the header. Without one, columns go by the names in the header, whatever
    their order; unknown ones pass through as text. ``NA`` is a missing value and an
    empty text stays an empty text.

    A quoted text may hold line breaks: a file is read by byte ranges whose starts are
    settled first (:mod:`lotwise.sources.csv_ranges`). Files known to have none need one scan
    less with ``line_breaks=False``.
    """
    if line_breaks:
        rows = read_csv_ranges(spark, path, schema)
        return canonical(rows if schema is not None else typed(rows))
    reader = spark.read.option("header", True).option("escape", '"')
    if schema is not None:
        return canonical(reader.schema(schema).option("enforceSchema", False).csv(path))
    return canonical(typed(reader.csv(path)))


def typed(df: DataFrame) -> DataFrame:
    """Text columns cast to the raw file's own types, by name; junk becomes missing."""
    types = {f.name: f.dataType for f in RAW_SCHEMA if f.dataType != _S and f.name in df.columns}
    return df.withColumns({n: F.col(f"`{n}`").try_cast(t) for n, t in types.items()})


def canonical(df: DataFrame) -> DataFrame:
    """Our column names; ``NA`` becomes missing, missing text becomes empty text."""
    df = df.withColumnsRenamed({k: v for k, v in RAW_COLUMNS.items() if k in df.columns})
    texts = [f.name for f in df.schema if f.dataType == _S and f.name in RAW_COLUMNS.values()]
    return df.withColumns({n: F.nullif(F.coalesce(n, F.lit("")), F.lit("NA")) for n in texts})


def literal_rows(spark: SparkSession, rows: Iterable[tuple | Row]) -> DataFrame:
    """Cars typed in by hand, ready for keys and scoring."""
    return spark.createDataFrame(list(rows), CAR_SCHEMA)


def drop_column(df: DataFrame, name: str = "car") -> DataFrame:
    return df.drop(name)


def clean_listings(raw: DataFrame, p: Params = Params()) -> DataFrame:
    """Typed columns from raw text, plus the mileage tier. Narrow: no shuffle."""
    c = F.col
    typed = raw.withColumns(
        {
            "mileage": clean.clean_mileage(c("mileage_raw")),
            "price": clean.clean_price(c("price_raw")),
            "cylinder": clean.cast_cylinder(c("cylinder")),
            "date_sold": clean.parse_date_sold(c("time")),
            "posted_time": clean.parse_posted_hours(c("time")),
        }
    )
    return typed.withColumn("mileage_range", clean.mileage_tier(c("mileage"), p.tier_width))


def kept_listings(cleaned: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows the model works on, with their keys."""
    from lotwise.operators import filters

    return with_keys(filters.keep_listings(cleaned, p))
