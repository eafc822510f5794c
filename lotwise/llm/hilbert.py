"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is cut into 2^bits classes of about equal numbers of rows, the classes of
a row give its place on the curve, and the curve is cut into runs of about equal bytes.
Neighbours on the curve are alike in every dimension at once, so a filter on any of them
needs few shards.

Rows with the same text are one group: they take the place of the group's smallest row
and stay in one shard, unless a group is so large (a quarter of a shard) that this would
make shards uneven; its rows are then spread along the run it covers by a hash.

Places are running sums over groups. They come from a range-partitioned table: sums of
its partitions first (one row each), then sums within each partition, which no task
needs more than its own partition for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import plain, share, spare
from lotwise.workspace import stored, stored_lookup

RUN_ROWS = 50_000  # rows aimed at in one piece of a shard


def hilbert_index(axes: np.ndarray, bits: int) -> np.ndarray:
    """Place on the curve of points (rows) with ``bits`` bits in each dimension (columns).

    Works from the highest bit down: the current orientation of the curve is undone by
    exchanging or inverting the lower bits, then the bits are Gray-coded and interleaved.
    """
    x = axes.astype(np.uint64).T.copy()
    dims = len(x)
    one = np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        q, below = one << np.uint64(bit), (one << np.uint64(bit)) - one
        for i in range(dims):
            inverted = (x[i] & q) != 0
            exchange = np.where(inverted, np.uint64(0), (x[0] ^ x[i]) & below)
            x[0] ^= np.where(inverted, below, exchange)
            x[i] ^= exchange
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    twist = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        q = one << np.uint64(bit)
        twist ^= np.where((x[dims - 1] & q) != 0, q - one, np.uint64(0))
    out = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << one) | (((x[i] ^ twist) >> np.uint64(bit)) & one)
    return out.astype(np.int64)


def curve(classes: Column, dims: int, bits: int) -> Column:
    """``hilbert_index`` of a column of class arrays."""

    @F.arrow_udf("bigint")
    def place(column: pa.Array) -> pa.Array:
        flat = column.flatten().to_numpy(zero_copy_only=False)
        return pa.array(hilbert_index(flat.reshape(-1, dims), bits))

    return place(classes)


def number(df: DataFrame, column: str) -> Column:
    """A dimension as a number: numbers as they are, anything else by its hash; null first."""
    kind = dict(df.dtypes)[column]
    value = F.col(f"`{column}`")
    numeric = kind.startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal"))
    hashed = F.xxhash64(value.cast("string")).cast("double")
    return F.when(value.isNull(), F.lit(float("-inf"))).otherwise(value.cast("double") if numeric else hashed)


def quantised(df: DataFrame, dims: dict[str, Column], bits: int) -> Column:
    """The class of each dimension: how many of its 2^bits - 1 cuts lie below the value.

    Cuts are approximate quantiles of all rows, from one aggregate. A value held by very
    many rows takes several cuts and is still one class.
    """
    n = 1 << bits
    shares = [k / n for k in range(1, n)]
    cuts = df.agg(*[F.percentile_approx(v, shares, 10_000).alias(f"c{i}") for i, v in enumerate(dims.values())]).first()
    classes = []
    for i, value in enumerate(dims.values()):
        above = [float(x) for x in sorted(set(cuts[f"c{i}"] or []))]
        classes.append(sum(((value > F.lit(x)).cast("int") for x in above), F.lit(0)))
    return F.array(*classes)


_PART = "g bigint, bytes bigint, rows bigint, part int, before bigint"


def running_bytes(groups: DataFrame, keys: list[str]) -> DataFrame:
    """(g, bytes, rows, start): bytes of all groups before each, in the order of ``keys``."""
    ordered = groups.repartitionByRange(*keys).sortWithinPartitions(*keys).select("g", "bytes", "rows")

    def add_up(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, total = TaskContext.get().partitionId(), 0
        for batch in stream:
            size = batch.column("bytes").to_numpy(zero_copy_only=False)
            after = total + np.cumsum(size)
            columns = [batch.column("g"), pa.array(size, pa.int64()), batch.column("rows"), pa.array([part] * len(size), pa.int32())]
            names = ["g", "bytes", "rows", "part", "before"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(after - size, pa.int64())], names=names)
            total = int(after[-1]) if len(after) else total

    # written once: the ranges of the partitions are settled with it
    table = stored(ordered.mapInArrow(add_up, _PART), "ordered")
    sums = table.groupBy("part").agg(F.sum("bytes").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))  # one row a partition
    start = (F.col("offset") + F.col("before")).alias("start")
    return table.join(F.broadcast(offsets), "part").select("g", "bytes", "rows", start)


def _bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8


def _group(text: Column) -> Column:
    return F.xxhash64(text, _bytes(text))


def _where(whole, count: int, start: Column, size: Column, rows: Column, chance: Column) -> dict[str, Column]:
    """Shard, piece of it, part of the piece and place on the curve, for rows with their
    group's start, bytes and rows. The rows of a group of many short texts stand at one
    place: they are dealt out to parts of the piece, behind its other rows."""
    target = max(1.0, whole["b"] / count)
    pieces = max(1, whole["n"] // (count * RUN_ROWS))
    position = start + size * F.when(size > target / 4, chance).otherwise(0.5)
    shard = F.least(F.floor(position / target), F.lit(count - 1)).cast("int")
    piece = F.least(F.floor((position / target - shard) * pieces), F.lit(pieces - 1)).cast("int")
    parts = F.floor(rows / RUN_ROWS)
    part = F.when(parts > 0, 1 + F.floor(chance * parts)).otherwise(0).cast("int")
    return {"shard": shard, "piece": piece, "part": part, "position": position}


def _settled(docs: DataFrame, dims, text: str, id_column: str, bits: int, keep: dict[str, Column]):
    """The rows without their texts, the groups' starts, and the sums of all rows."""
    c = F.col
    body = c(f"`{text}`")
    values = {d: number(docs, d) for d in dims} | {"size": _bytes(body).cast("double")}
    narrow = docs.select(
        _group(body).alias("g"),
        _bytes(body).alias("size"),
        c(f"`{id_column}`").alias("id"),
        _chance(docs).alias("chance"),
        *[v.alias(k) for k, v in keep.items()],
        curve(quantised(docs, values, bits), len(values), bits).alias("curve"),
    )
    narrow = stored(narrow, "rows")
    # a group stands where its smallest row does
    first = F.min(F.struct(c("id").isNull().alias("none"), c("id"), c("chance"), c("curve")))
    groups = narrow.groupBy("g").agg(
        F.sum("size").alias("bytes"), first["curve"].alias("at"), F.count(F.lit(1)).alias("rows")
    )
    groups = stored(groups, "groups")
    whole = groups.agg(
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("b"), F.coalesce(F.sum("rows"), F.lit(0)).alias("n")
    ).first()
    return narrow, running_bytes(groups, ["at", "g"]), whole


def _chance(docs: DataFrame) -> Column:
    return share(F.xxhash64(*plain(docs)), 5)


DIMS = ("lang", "source")


def placed(
    docs: DataFrame,
    count: int = 24,
    dims: tuple[str, ...] = DIMS,
    text: str = "text",
    id_column: str = "doc_id",
    bits: int = 4,
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """(id, size, kept columns, shard, slot): where each row of ``docs`` goes.

    Dimensions are those named in ``dims`` and the size of the text. A null text has no
    bytes and groups with other null texts. ``slot`` counts the rows of a shard from 0,
    along the curve; wholly repeated rows take a slot each. An empty table gives no rows.
    """
    keep = keep or {}
    c = F.col
    narrow, starts, whole = _settled(docs, dims, text, id_column, bits, keep)
    at = _where(whole, count, c("start"), c("bytes"), c("rows"), c("chance"))
    rows = narrow.join(starts, "g").withColumns(at)
    rows = stored(rows.select("g", "id", "size", "chance", *keep, *at), "placed")
    run = ["shard", "piece", "part"]
    sums = rows.groupBy(*run).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("piece", "part").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")
    offsets = stored_lookup(sums.select(*run, offset), "offsets")
    here = Window.partitionBy(*run).orderBy("position", "g", "id", "chance")
    ranked = rows.withColumn("at", F.row_number().over(here) - 1).join(offsets, run)
    return ranked.select("id", "size", *keep, "shard", (c("offset") + c("at")).cast("bigint").alias("slot"))


def sharded(
    docs: DataFrame,
    count: int = 24,
    dims: tuple[str, ...] = DIMS,
    text: str = "text",
    id_column: str = "doc_id",
    bits: int = 4,
    name: str = "shard",
) -> DataFrame:
    """``docs`` and the shard of each row, dealt out and sorted along the curve, so that
    files written from it hold runs of it. ``name`` is lengthened if it is taken."""
    c = F.col
    name, side = spare(docs, name), spare(docs, "_side")
    _, starts, whole = _settled(docs, dims, text, id_column, bits, {})
    starts = starts.select(F.struct("g", "start", "bytes", "rows").alias(side))
    met = docs.join(starts, _group(docs[f"`{text}`"]) == starts[side]["g"])
    at = _where(whole, count, c(side)["start"], c(side)["bytes"], c(side)["rows"], _chance(docs))
    placed_at = F.struct(*[v.alias(k) for k, v in at.items()])
    met = met.withColumn(side, placed_at).withColumn(name, c(side)["shard"])
    place = [c(side)[x] for x in ("piece", "part", "position")]
    met = met.repartition(c(name), *place[:2]).sortWithinPartitions(c(name), *place)
    return met.drop(side)
