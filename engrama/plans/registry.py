"""Where each query is registered together with the SQL it must agree with."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from engrama.plans.views import VIEW_SQL, Tables
from engrama.session import ship_package


@dataclass(frozen=True)
class Registered:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return self.build(Tables(spark, sf_dir))


REGISTRY: dict[str, Registered] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable:
    """Register the decorated builder under its own name."""

    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or build.__name__
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")
        REGISTRY[key] = Registered(key, build, oracle(sql) if sql else None)
        return build

    return add


def oracle(sql: str) -> str:
    """Complete SQL: the test views it mentions are put in front as common table expressions."""
    ctes = []
    for view, text in VIEW_SQL.items():
        if re.search(rf"\b{view}\b", sql):
            ctes.append(f"{view} AS ({text['duckdb']})")
    body = sql.strip()
    recursive = ""
    found = re.match(r"WITH\s+(RECURSIVE\s+)?", body, flags=re.IGNORECASE)
    if found:
        recursive = "RECURSIVE " if found.group(1) else ""
        body = body[found.end():]
        return f"WITH {recursive}" + ",\n".join([*ctes, body])
    return (f"WITH {', '.join(ctes)}\n" if ctes else "") + body
