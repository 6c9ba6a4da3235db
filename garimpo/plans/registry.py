"""Registered queries: a Spark plan, the inventory rows it covers and its SQL check."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    name: str
    ids: str
    plan: Callable[["Tables"], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


class Tables:
    """Parquet tables of one folder, opened on first access."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


def query(ids: str, sql: str | None = None):
    """Register the decorated plan under its function name."""

    def add(plan: Callable[[Tables], DataFrame]):
        if plan.__name__ in REGISTRY:
            raise ValueError(f"query {plan.__name__} registered twice")
        REGISTRY[plan.__name__] = Query(plan.__name__, ids, plan, sql)
        return plan

    return add
