"""Query registry: name -> (plan builder, equivalent SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from lorewright.session import let_workers_import

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(f: Query) -> Query:
            @wraps(f)
            def run(spark: SparkSession, root: str) -> DataFrame:
                let_workers_import(spark)
                return f(spark, root)

            self.queries[name] = run
            if sql is not None:
                self.sql[name] = sql
            return f

        return register


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")
