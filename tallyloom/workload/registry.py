"""The registered queries: each runs an operator on the driver tables, beside the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tallyloom.scale import estimated_bytes
from tallyloom.session import follow_input, prepare

Run = Callable[[SparkSession, str], DataFrame]


class Query(NamedTuple):
    run: Run
    sql: str | None


class Tables:
    """The driver tables of one scale factor, by attribute."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = prepare(spark), root.rstrip("/")
        self.sizes: dict[str, int] = {}

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        self.sizes[name] = estimated_bytes(table)
        follow_input(self.spark, sum(self.sizes.values()))
        return table


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function of `Tables`; its name is the query's key."""

    def add(fn: Callable[[Tables], DataFrame]):
        key = name or fn.__name__
        if key in REGISTRY:
            raise KeyError(f"query {key} is registered twice")
        REGISTRY[key] = Query(lambda spark, root: fn(Tables(spark, root)), sql)
        return fn

    return add
