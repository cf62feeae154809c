"""The list of runnable queries and the decorator that fills it."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from keelson.session import spread


@dataclass(frozen=True)
class Query:
    """A query over the tables of one folder.

    ``covers`` names the inventory rows it shows; ``sql`` gives the same result
    on the same tables, where plain SQL can.
    """

    name: str
    run: Callable[[SparkSession, str], DataFrame]
    covers: tuple[str, ...]
    sql: str | None = None


QUERIES: dict[str, Query] = {}
MODULES = ("cleaning", "splitting", "profiling", "scoring", "served", "drifting", "encoding",
           "rates", "storage", "learning", "counted", "live")


def query(covers: str, sql: str | None = None):
    def add(fn):
        name = fn.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, fn, tuple(covers.split()), sql)
        return fn
    return add


def load_all() -> dict[str, Query]:
    for module in MODULES:
        importlib.import_module(f"keelson.plans.{module}")
    return QUERIES


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rows_of(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table dealt out to all cores, for work that does not depend on file order."""
    return spread(table(spark, folder, name))
