"""Header CSV read by byte ranges although quoted texts may hold line breaks.

The text source deals a file out in byte ranges and gives each the lines that start in it.
Whether a line begins inside a quoted text depends on the number of quotes before it in the
file, odd or even. So one scan counts the quotes of each range, a running sum over the few
rows of a file tells every range how it starts, and a second scan joins lines to records: a
range keeps the records that start and end in it, and what crosses its ends, at most one
record a side, is put together from the pieces of all ranges it touches.

No file is read by one task, no line is shuffled, only the pieces are. The ranges of all
files must fit the broadcast bound (some 1.4 million); raise ``spark.sql.files.maxPartitionBytes``
where there are more.
"""

from __future__ import annotations

import csv
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.workspace import BROADCAST_BYTES, row_bytes, stored

_RECORDS = "file bigint, start bigint, kind string, record string"
_SCHEMA = pa.schema([("file", pa.int64()), ("start", pa.int64()), ("kind", pa.string()), ("record", pa.string())])


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, start, value) of every line, in the order of its range within a task."""
    lines = spark.read.option("lineSep", "\n").text(path)
    name = F.input_file_name()
    return lines.select(
        name.alias("name"), F.xxhash64(name).alias("file"), F.input_file_block_start().alias("start"), "value"
    )


def _ranges(lines: DataFrame) -> DataFrame:
    """Each range that has lines: does it start, does it end inside a quoted text?"""
    c = F.col
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    # the first line of a file is the first of range 0; rows of a range come in order
    found = lines.groupBy("name", "file", "start").agg(
        F.sum(quotes).alias("quotes"), F.first(F.when(c("start") == 0, c("value"))).alias("line")
    )
    before = Window.partitionBy("name").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    odd = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    last = F.lead("start").over(Window.partitionBy("name").orderBy("start")).isNull()
    found = found.select("*", odd.alias("opens_inside"), last.alias("last"))
    ends = c("opens_inside") != (c("quotes") % 2 == 1)
    found = stored(found.select("name", "file", "start", "line", "opens_inside", ends.alias("ends_inside"), "last"), "ranges")
    narrow = found.select("file", "start", "opens_inside", "ends_inside")
    checks = found.agg(
        F.count_distinct("name").alias("names"),
        F.count_distinct("file").alias("files"),
        F.max(F.when(c("last") & c("ends_inside"), c("name"))).alias("open"),
        F.coalesce(F.sum(row_bytes(narrow)), F.lit(0)).alias("bytes"),
    ).first()
    if checks["open"] is not None:
        raise ValueError(f"{checks['open']} ends inside a quoted text")
    if checks["names"] != checks["files"] or checks["bytes"] > BROADCAST_BYTES:
        raise ValueError("too many ranges: raise spark.sql.files.maxPartitionBytes")
    return found


def _joined(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the ranges, one after the other; ``kind`` tells what is only a piece.

    whole: a record; head: the start of one that goes on in the next range; tail: the rest
    of one from before; through: a range that lies inside one record.
    """
    place, inside, begun, held, rows = None, False, False, [], []

    def kind(closed: bool) -> str:
        return ("whole" if closed else "head") if begun else ("tail" if closed else "through")

    def close(closed: bool) -> None:
        rows.append((*place, kind(closed), "\n".join(held)))
        held.clear()

    def packed() -> pa.RecordBatch:
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, _SCHEMA)], schema=_SCHEMA)

    for batch in stream:
        columns = [batch.column(x).to_pylist() for x in ("file", "start", "opens_inside", "value")]
        for file, start, opens_inside, value in zip(*columns):
            if (file, start) != place:
                if held:
                    close(False)
                place, inside, begun = (file, start), opens_inside, not opens_inside
                if start == 0:  # the header
                    continue
            held.append(value)
            inside ^= value.count('"') % 2 == 1
            if not inside:
                close(True)
                begun = True
        if rows:
            yield packed()
            rows.clear()
    if held:
        close(False)
        yield packed()


def _records(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    c = F.col
    narrow = F.broadcast(ranges.select("file", "start", "opens_inside", "ends_inside"))  # checked above
    met = lines.select("file", "start", "value").join(narrow, ["file", "start"])
    whole = met.mapInArrow(_joined, _RECORDS).filter("kind = 'whole'").select("record")
    cut = met.filter("opens_inside OR ends_inside").mapInArrow(_joined, _RECORDS).filter("kind <> 'whole'")
    in_order = Window.partitionBy("file").orderBy("start", c("kind") == "head")
    number = F.sum((c("kind") == "head").cast("int")).over(in_order)
    pieces = F.array_sort(F.collect_list(F.struct("start", "record")))
    cut = cut.withColumn("number", number).groupBy("file", "number")
    cut = cut.agg(F.array_join(F.transform(pieces, lambda x: x["record"]), "\n").alias("record"))
    return whole.unionByName(cut.select("record"))


def _header(ranges: DataFrame) -> str:
    """The first line, the same in all files."""
    heads = ranges.filter("start = 0").select(F.rtrim(F.col("line"), F.lit("\r")).alias("line")).distinct()
    found = [r["line"] for r in heads.limit(2).collect()]
    if len(found) != 1:
        raise ValueError("the files have no header line" if not found else f"files differ in their header: {found}")
    if found[0].count('"') % 2:
        raise ValueError("a column name may not hold a line break")
    return found[0]


def read_csv_ranges(
    spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, **options: str
) -> DataFrame:
    """As ``spark.read.csv`` with ``header``, ``multiLine`` and doubled quotes, by byte ranges.

    Records end with a line feed, with or without a carriage return in front; one inside
    quotes stays, also where the one-task reader would drop it. Quotes must
    enclose whole fields and be doubled inside: a lone quote in a field without quotes is not
    told from a start. Empty lines are skipped. All files need the same header; with a
    ``schema`` it must hold its names in its order, without one all columns are text. A file
    that ends inside a quoted text is an error, files without any line have no rows.
    """
    options = {"escape": '"', "multiLine": "true", **options}
    lines = _lines(spark, path)
    ranges = _ranges(lines)
    if ranges.isEmpty():
        return spark.createDataFrame([], schema or T.StructType([]))
    head = _header(ranges)
    names = _names(head)
    if schema is None:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    elif names != schema.names:
        raise ValueError(f"the header {names} is not that of the schema {schema.names}")
    record = F.regexp_replace("record", r"\r\z", "")
    rows = _records(lines, ranges).select(record.alias("record")).filter(F.col("record") != "")
    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    return rows.select(F.from_csv("record", fields, options).alias("row")).select("row.*")


def _names(head: str) -> list[str]:
    """Column names of a header; one without a name or with that of another gets its place."""
    found = next(csv.reader([head.lstrip("\ufeff")]))
    met = Counter(n.lower() for n in found)
    return [f"_c{i}" if not n else f"{n}{i}" if met[n.lower()] > 1 else n for i, n in enumerate(found)]
