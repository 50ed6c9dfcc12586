"""Shared pieces of the registered queries: table access and the registry itself."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from jobtide.session import tune

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    queries: dict[str, Query] = field(default_factory=dict)
    oracles: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        """Register a query under a name, with the SQL that has to give the same rows."""

        def register(query: Query) -> Query:
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return query(tune(spark), sf_dir)

            self.queries[name] = run
            if sql is not None:
                self.oracles[name] = sql
            return query

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
