"""Connected components of a link table by alternating large-star and small-star rounds.

Each round is two aggregates and joins on the link table alone; labels shrink towards the
smallest node of a component. A hub's links are never gathered: its smallest neighbour
comes from an aggregate with map-side combine, and the join that hands it back is one
adaptive execution may split. Every round is written to the shared folder, so a lost
executor costs one round at most, and rounds end when the links no longer change.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lotwise.workspace import stored


def _observed(links: DataFrame, name: str) -> tuple[DataFrame, tuple[int, int]]:
    seen = Observation()
    state = F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))
    out = stored(links.observe(seen, F.count(F.lit(1)).alias("n"), state.alias("x")), name)
    return out, (seen.get["n"], seen.get["x"])


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Large star: a node's larger neighbours move to its smallest one. Small star: its
    smaller neighbours and the node itself do. ``links`` is (u > v), each link once."""
    if large:
        both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links.select("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = both.join(least, "u")
    if large:
        out = met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u != v").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): every node that has a link, with the smallest node it reaches.

    ``links`` has two columns of one comparable type. Links to itself and repeated links
    are ignored, null ends dropped; no links give an empty table.
    """
    a, b = (F.col(f"`{c}`") for c in links.columns)
    start = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), (a.isNull() | b.isNull()).alias("bad"))
    now, state = _observed(start.filter("NOT bad AND u != v").select("u", "v").distinct(), "links")
    while state[0]:
        before = state
        now, _ = _observed(_star(now, large=True), "large_star")
        now, state = _observed(_star(now, large=False), "small_star")
        if state == before:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
