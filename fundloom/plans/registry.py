"""Registered queries: a name, a Spark builder over the driver tables and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..session import tune

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver tables of one scale, read on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None, views: str = ""):
    """Registers a builder under its function name. ``views`` names the stand-in views its SQL starts from."""
    def add(fn):
        from .views import VIEW_SQL, needs

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(tune(spark), folder))

        QUERIES[fn.__name__] = run
        if sql is not None:
            ctes = [f"{v} AS ({VIEW_SQL[v]})" for v in needs(views.split())]
            body = sql.strip()
            if ctes:
                again = "RECURSIVE " if body.upper().startswith("WITH RECURSIVE ") else ""
                body = f"WITH {again}" + ",\n".join(ctes) + ("\n, " + body[5 + len(again):].strip() if body.upper().startswith("WITH ") else "\n" + body)
            ORACLES[fn.__name__] = body
        return fn
    return add
