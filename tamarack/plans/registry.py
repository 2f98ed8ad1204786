"""Names of the runnable queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tamarack.session import spread

TEXTS = {"documents": "doc_id", "pages": "page_id"}  # costly to process per byte read


class Tables:
    """The input tables below one folder: ``tables("orders")``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def __call__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return spread(table, TEXTS[name]) if name in TEXTS else table


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(tables)`` under ``name`` with its check, if SQL can state one."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(lambda spark, root: build(Tables(spark, root)), sql)
        return build

    return add
