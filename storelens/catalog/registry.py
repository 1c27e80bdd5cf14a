"""Queries by name, each with the SQL it must agree with."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.catalog.views import VIEWS, RetailTables, sql_of
from storelens.session import tune

Build = Callable[[RetailTables], DataFrame]


@dataclass(frozen=True)
class Query:
    """How Spark computes a result, the SQL for it, and the digits sums of
    floating-point numbers are compared to (their order of addition is open)."""

    build: Build
    sql: str | None = None
    digits: Mapping[str, int] = field(default_factory=dict)

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(RetailTables(tune(spark), folder))
        return df.withColumns({c: F.round(c, d) + F.lit(0.0) for c, d in self.digits.items()})


class Catalog:
    """A set of queries and the named sub-selects their SQL shares."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.parts: dict[str, str] = {}

    def part(self, name: str, sql: str) -> None:
        self.parts[name] = sql

    def add(self, name: str, build: Build, sql: str | None = None, **digits: int) -> None:
        if name in self.queries:
            raise ValueError(f"query {name} exists already")
        self.queries[name] = Query(build, sql, digits)

    def _uses(self, sql: str) -> list[str]:
        words = dict.fromkeys(re.findall(r"[a-z_0-9]+", sql))
        return [w for w in words if w in self.parts or w in VIEWS]

    def _text(self, name: str) -> str:
        return self.parts[name] if name in self.parts else sql_of(name)

    def _closure(self, sql: str, own: frozenset[str] = frozenset()) -> dict[str, None]:
        ordered: dict[str, None] = {}
        for name in self._uses(sql):
            if name in own:
                continue
            text = self._text(name)
            ordered.update(self._closure(text, own | {name}))
            ordered[name] = None
        return ordered

    def oracle(self, name: str) -> str | None:
        """One self-contained statement: the shared parts, then the query's SQL."""
        query = self.queries[name]
        if query.sql is None:
            return None
        parts = [f"{p} as ({self._text(p)})" for p in self._closure(query.sql)]
        head = f"with {', '.join(parts)} " if parts else ""
        if not query.digits:
            return head + query.sql
        rounded = ", ".join(f"round({c}, {d}) + 0.0 as {c}" for c, d in query.digits.items())
        return f"{head}select * replace ({rounded}) from ({query.sql}) q"
