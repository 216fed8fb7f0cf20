"""Registered queries and their counterparts in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks import views
from careloom.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Inputs:
    """The given tables and the views over them, read on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir

    def __getattr__(self, table: str) -> DataFrame:
        if table not in views.TABLES:
            raise AttributeError(table)
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    def view(self, sql: str) -> DataFrame:
        return self.spark.sql(views.for_spark(sql, self.sf_dir))


class Views(dict):
    """Views of one family by name, made when asked for."""

    def __init__(self, inputs: Inputs, family: dict[str, str]):
        self.inputs, self.family = inputs, family

    def __missing__(self, name: str) -> DataFrame:
        return self.inputs.view(self.family[name])


def query(name: str, sql: str | None = None):
    """Register ``fn(inputs) -> DataFrame`` under a name, with its SQL."""

    def register(fn: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
