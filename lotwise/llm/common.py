"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# words of the contracts: runs without ASCII whitespace
SPACE_WORDS = r"[^\x20\x09-\x0D]+"

# everything that is no ASCII letter or digit and no byte of a longer code point becomes a
# blank, A-Z become a-z: `bytes.translate` and `split` then give the normalised words
_NORMAL = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 32
    for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(column: pa.Array) -> Iterator[bytes | None]:
    """The values of a text column as bytes, without decoding them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for value in column.cast(kind):
        yield value.as_py()


def normal_words(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z only) runs of ASCII letters, digits and all non-ASCII characters."""
    return text.translate(_NORMAL).split() if text else []


def fold(name: str, of: int) -> Column:
    """The remainder of crc32 of an id's decimal text; null for a null id."""
    return F.pmod(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(of))


def share(column: Column, seed: int = 42) -> Column:
    """A number in [0, 1) that only depends on the value: a seeded hash."""
    return F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def _comparable(kind: T.DataType) -> bool:
    """Can values be hashed and compared? Maps cannot, nor what holds one."""
    if isinstance(kind, T.ArrayType):
        return _comparable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_comparable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def plain(docs: DataFrame) -> list[Column]:
    """All columns; those that hold maps as JSON texts of them."""
    columns = [(F.col(f"`{f.name}`"), _comparable(f.dataType)) for f in docs.schema.fields]
    return [c if fine else F.to_json(F.struct(c.alias("m"))) for c, fine in columns]


def distinct_rows(docs: DataFrame) -> DataFrame:
    """One of each set of wholly equal rows, whatever the types of their columns."""
    if all(_comparable(f.dataType) for f in docs.schema.fields):
        return docs.distinct()
    names = docs.columns
    side = [spare(docs, f"_plain_{i}") for i in range(len(names))]
    wide = docs.select("*", *[c.alias(n) for c, n in zip(plain(docs), side)])
    return wide.dropDuplicates(side).drop(*side)


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded length."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema
    )
