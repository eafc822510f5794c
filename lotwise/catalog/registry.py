"""Names of the catalog's queries, each with its Spark form and its SQL form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from lotwise.catalog.rounding import expanded
from lotwise.catalog.study import Study

REGISTRY: dict[str, tuple[Callable[[Study], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Study], DataFrame]):
        REGISTRY[name] = (build, None if sql is None else expanded(sql))
        return build

    return register
