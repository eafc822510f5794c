"""Intermediate tables kept in the shared folder the session names.

A fitted table is written once and read back, for two reasons: its lineage is cut on
storage that outlives any executor, and its size is known before it is joined. A lookup
table is broadcast only if its measured bytes are within ``BROADCAST_BYTES``; beyond that
the planner joins by shuffle, where adaptive execution splits skewed keys.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# most bytes of a table that is sent to every executor
BROADCAST_BYTES = 64 << 20

_CONF = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Where it is unset, a session in one process (``local[...]``, as in tests) gets a
    temporary folder; on a cluster no folder of one machine would do, so that is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get(_CONF, None) or context.getConf().get(_CONF)
    if not root:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError(f"set {_CONF} to a folder that the driver and all executors share")
        root = _LOCAL.setdefault(context.applicationId, tempfile.mkdtemp(prefix="lotwise-"))
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/lotwise/{uuid.uuid4().hex}/{name}"


_SCOPES: list[list[str]] = []


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`stored` writes inside the block are deleted at its end."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            drop_path(spark, path)


def drop_path(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if it is not there."""
    if not exists(spark, path):
        return []
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    return [f.getPath().getName() for f in found if f.isDirectory()]


def rename(spark: SparkSession, path: str, to: str) -> None:
    """One rename that never replaces a folder, nor goes into it, if it is there already."""
    fs = spark._jvm.org.apache.hadoop.fs
    here, there, conf = fs.Path(path), fs.Path(to), spark._jsc.hadoopConfiguration()
    context = fs.FileContext.getFileContext(here.getFileSystem(conf).getUri(), conf)
    no_options = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    context.rename(here, there, no_options)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh shared path and return the table read back from it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row in memory: what varies is measured."""
    fixed, parts = 0, []
    for field in df.schema.fields:
        kind = field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)))
            fixed += 16
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))), F.lit(0)))
            fixed += 32
        else:
            fixed += 16
    return sum((p.cast("bigint") for p in parts), F.lit(fixed).cast("bigint"))


def bounded_broadcast(table: DataFrame, size: int) -> DataFrame:
    """``table`` marked for broadcast if its measured ``size`` in bytes is small enough."""
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def measured(table: DataFrame) -> DataFrame:
    """A table that is there already, marked for broadcast if its bytes are few enough."""
    size = table.agg(F.coalesce(F.sum(row_bytes(table)), F.lit(0)).alias("b")).first()["b"]
    return bounded_broadcast(table, size)


def stored_lookup(df: DataFrame, name: str) -> DataFrame:
    """As :func:`stored`, for a table that rows will be joined with."""
    return stored_counted(df, name)[0]


def stored_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """The stored lookup table and its number of rows, measured while it is written."""
    return stored_sized(df, name)[:2]


def stored_sized(df: DataFrame, name: str) -> tuple[DataFrame, int, int]:
    """The stored lookup table, its number of rows and its bytes, measured while it is written."""
    seen = Observation()
    watched = df.observe(
        seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")
    )
    table = stored(watched, name)
    found = seen.get
    return bounded_broadcast(table, found["b"]), found["n"], found["b"]
