"""Tables of a warehouse, through whatever connector the session has."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_query(spark: SparkSession, query: str, fmt: str, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format(fmt).options(**options).option("query", query).load()


def read_table(spark: SparkSession, table: str, fmt: str | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """A table by name: of the session's catalog, or of a connector's database."""
    if fmt is None:
        return spark.table(table)
    return spark.read.format(fmt).options(**(options or {})).option("dbtable", table).load()


def list_tables(
    spark: SparkSession, schema: str, fmt: str | None = None, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Names of the tables a schema holds, as column ``tableName``."""
    if fmt is None:
        return spark.sql(f"SHOW TABLES IN {schema}").select("tableName")
    query = f"SELECT table_name FROM information_schema.tables WHERE table_schema = '{schema}'"
    names = read_query(spark, query, fmt, options or {})
    return names.select(F.col(names.columns[0]).alias("tableName"))
