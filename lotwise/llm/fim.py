"""Fill-in-middle: a text is cut at two units and its parts are written in another order.

Units are runs of ASCII letters and every other code point by itself. A text is read in
blocks of ``block`` UTF-8 bytes; a Fenwick tree over the blocks holds the units and the code
points that start in each. Binary-lifting descent finds the block a cut falls into and what
stands before it; only that block is looked at again to place the cut. The work on a text
is one pass over its bytes in slabs, so beside the text itself memory stays bounded.

Which cuts and which form a text gets depends on a hash of its id alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import spare, utf8

# fixed values: the marks in front of prefix, suffix and middle
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


@dataclass(frozen=True)
class Settings:
    seed: int = 1
    plain: int = 10  # per cent of texts that stay as they are
    suffix_first: int = 20  # per cent of the others that start with the suffix
    block: int = 1024  # bytes of a block


class BlockTree:
    """Units and code points of a UTF-8 text by fixed blocks, in a Fenwick tree."""

    SLAB = 1 << 20  # bytes looked at in one go, in whole blocks

    def __init__(self, text: bytes, block: int = 1024):
        self.bytes, self.block = np.frombuffer(text, np.uint8), block
        slab = max(1, self.SLAB // block) * block
        units, chars = [], []
        for at in range(0, len(text), slab):
            starts, points = self._starts(at, min(at + slab, len(text)))
            edges = np.arange(0, len(starts), block)
            units.append(np.add.reduceat(starts, edges, dtype=np.int64))
            chars.append(np.add.reduceat(points, edges, dtype=np.int64))
        none = np.zeros(0, np.int64)
        self.units = self._tree(np.concatenate(units) if units else none)
        self.chars = self._tree(np.concatenate(chars) if chars else none)
        self.n = self.before(self.units, len(self.units) - 1)

    def _starts(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Where in bytes low..high a unit starts, and where a code point does."""
        part = self.bytes[max(low - 1, 0) : high]
        letter = ((part | 32) - 97).astype(np.uint8) < 26
        points = (part & 0xC0) != 0x80
        starts = points.copy()
        starts[1:] &= ~(letter[1:] & letter[:-1])
        cut = int(low > 0)
        return starts[cut:], points[cut:]

    @staticmethod
    def _tree(counts: np.ndarray) -> np.ndarray:
        """Fenwick tree: place i holds the counts of the ``i & -i`` blocks up to block i."""
        tree = np.concatenate([np.zeros(1, np.int64), counts])
        step = 1
        while step < len(tree):
            inner = np.arange(2 * step, len(tree), 2 * step)  # parents of the places i - step
            tree[inner] += tree[inner - step]
            step *= 2
        return tree

    @staticmethod
    def before(tree: np.ndarray, blocks: int) -> int:
        total = 0
        while blocks > 0:
            total += int(tree[blocks])
            blocks &= blocks - 1
        return total

    def cut(self, k: int) -> tuple[int, int]:
        """The bytes and the code points of the first ``k`` units."""
        if k >= self.n:
            return len(self.bytes), self.before(self.chars, len(self.chars) - 1)
        place, left, chars = 0, k, 0
        step = 1 << (len(self.units).bit_length() - 1)
        while step:
            further = place + step
            if further < len(self.units) and self.units[further] <= left:
                place, left = further, left - int(self.units[further])
                chars += int(self.chars[further])
            step //= 2
        low = place * self.block
        starts, points = self._starts(low, min(low + self.block, len(self.bytes)))
        inside = int(np.flatnonzero(starts)[left])
        return low + inside, chars + int(points[:inside].sum())


def transform(text: bytes, draws: tuple[int, int, int, int], s: Settings) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text by four numbers."""
    tree = BlockTree(text, s.block)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not text or draws[2] % 100 >= 100 - s.plain or any(m in text for m in marks):
        return tree.n, "plain", None, None, text
    low, high = sorted(d % (tree.n + 1) for d in draws[:2])
    (a, a_chars), (b, b_chars) = tree.cut(low), tree.cut(high)
    p, sfx, m = marks
    if draws[3] % 100 < s.suffix_first:
        form, parts = "spm", [sfx, text[b:], p, text[:a], m, text[a:b]]
    else:
        form, parts = "psm", [p, text[:a], sfx, text[b:], m, text[a:b]]
    return tree.n, form, a_chars, b_chars - a_chars, b"".join(parts)


_MADE = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"


def draw(id_value: Column, place: int, seed: int) -> Column:
    """Number ``place`` of an id: eight hex digits of the digest of ``seed:id``; a null id is ''."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(id_value.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(key, 256), 8 * place + 1, 8), 16, 10).cast("bigint")


def with_middle(
    docs: DataFrame,
    s: Settings = Settings(),
    id_column: str = "doc_id",
    text: str = "text",
    name: str = "fim",
) -> DataFrame:
    """``docs`` and a column ``name``: struct(n, form, prefix_chars, middle_chars, output).

    Null counts as an empty text. Empty texts and texts that hold a mark stay ``plain``, with
    null lengths. Rows with the same id and text get the same output. No row is left out.
    """

    @F.arrow_udf(_MADE)
    def made(texts: pa.Array, d1: pa.Array, d2: pa.Array, d3: pa.Array, d4: pa.Array) -> pa.Array:
        draws = zip(*(d.to_pylist() for d in (d1, d2, d3, d4)))
        rows = [transform(t or b"", d, s) for t, d in zip(utf8(texts), draws)]
        n, form, prefix, middle, output = zip(*rows) if rows else ([],) * 5
        return pa.StructArray.from_arrays(
            [
                pa.array(n, pa.int64()),
                pa.array(form, pa.string()),
                pa.array(prefix, pa.int64()),
                pa.array(middle, pa.int64()),
                pa.array(output, pa.binary()).cast(pa.string()),  # joined whole UTF-8 units
            ],
            ["n", "form", "prefix_chars", "middle_chars", "output"],
        )

    draws = [draw(F.col(f"`{id_column}`"), i, s.seed) for i in range(4)]
    return docs.withColumn(spare(docs, name), made(F.col(f"`{text}`"), *draws))


def restored(output: Column, form: Column) -> Column:
    """The text that was transformed: no part holds a mark, so the first marks are ours."""

    def parts(first: str, second: str, order: list[int]) -> Column:
        body = F.substring(output, len(first) + 1, 2147483647)
        head = F.split(body, second, 2)
        tail = F.split(head[1], MIDDLE, 2)
        return F.concat(*[[head[0], tail[0], tail[1]][i] for i in order])

    return (
        F.when(form == "psm", parts(PREFIX, SUFFIX, [0, 2, 1]))
        .when(form == "spm", parts(SUFFIX, PREFIX, [1, 2, 0]))
        .otherwise(output)
    )
