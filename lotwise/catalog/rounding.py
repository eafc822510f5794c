"""One rounding for a query and its SQL: half up, after noise is taken off.

Sums of doubles differ between two engines in their last bits, and means of whole prices
often end on a half digit, where those bits would decide. So a value is first brought to
``SNAP`` more digits than wanted, half up, which makes such halves exact, and then to the
wanted ones, half up. The result is the rounded value; nothing is added to it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

SNAP = 4


def r(c: Column | str, digits: int = 2, snap: int = SNAP) -> Column:
    """``snap``: fewer digits for values whose noise is larger, as intercepts far from the data."""
    c = F.col(c) if isinstance(c, str) else c
    snapped = F.floor(c.cast("double") * float(10 ** (digits + snap)) + 0.5).cast("double")
    whole = F.floor((snapped + 0.5 * 10**snap) / float(10**snap)).cast("double")
    return whole / float(10**digits)


def expanded(sql: str) -> str:
    """``rounded(expression, digits[, snap])`` written out as plain SQL."""
    head, call, rest = sql.partition("rounded(")
    if not call:
        return sql
    depth, quoted, end = 1, False, 0
    while depth:
        ch = rest[end]
        quoted ^= ch == "'"
        depth += 0 if quoted else (ch == "(") - (ch == ")")
        end += 1
    value, digits, snap = re.fullmatch(r"(.*?),\s*(\d)(?:,\s*(\d))?", rest[: end - 1], re.DOTALL).groups()
    d, s = int(digits), int(snap or SNAP)
    snapped = f"floor(CAST({expanded(value)} AS DOUBLE) * 1e{d + s} + 0.5)"
    return f"{head}(floor(({snapped} + 5e{s - 1}) / 1e{s}) / 1e{d}){expanded(rest[end:])}"
