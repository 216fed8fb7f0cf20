"""Loading typed tables into a warehouse.

The connector is a parameter: a Spark data source name and its options, or none
for the session's own catalog.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careloom.operators import schema as sch
from careloom.operators.merge import PRIMARY_KEYS, missing_tables, upsert_keep_new
from careloom.session import batch_folder
from careloom.sinks.stage import stage_widths, write_measured_stage

# Fixed value: the table never merged.
NEVER_MERGED = ("HARVEST",)


@dataclass(frozen=True)
class Target:
    fmt: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    prefix: str = ""
    partitions: int | None = None

    def name(self, batch: str, table: str) -> str:
        return f"{self.prefix}{batch}_{table}" if batch else f"{self.prefix}{table}"


def save(df: DataFrame, target: Target, name: str, mode: str = "overwrite", **extra: str) -> None:
    writer = df.write.mode(mode)
    if target.fmt is None:
        writer.saveAsTable(name)
    else:
        writer.format(target.fmt).options(**target.options, **extra).option("dbtable", name).save()


def _dealt(df: DataFrame, target: Target) -> DataFrame:
    """As the plan has it, unless the target names a number of writers."""
    return df.repartition(target.partitions) if target.partitions else df


def prepare(df: DataFrame, fields: list[tuple[str, str]], widths: Mapping[str, int] | None = None) -> DataFrame:
    """Typed by the spec, with widths as given or else as observed in the table."""
    return sch.apply_schema(df, sch.table_schema(fields, sch.observed_widths(df) if widths is None else dict(widths)))


def _staged(df: DataFrame, folder: str | None) -> tuple[DataFrame, dict[str, int]]:
    """The table written once, with the widths seen on the way."""
    path = f"{folder or batch_folder(df.sparkSession, 'loads')}/{uuid.uuid4().hex}"
    widths = write_measured_stage(df, path)
    return df.sparkSession.read.parquet(path), widths


def replace_table(df: DataFrame, target: Target, batch: str, table: str, fields: list[tuple[str, str]], folder: str | None = None) -> None:
    """Load a table with the widths of its texts.  Widths come before rows, so the rows are staged in ``folder``: their plan runs once."""
    staged, widths = _staged(df, folder)
    save(_dealt(prepare(staged, fields, widths), target), target, target.name(batch, table))


def load_stage(spark: SparkSession, path: str, target: Target, batch: str, table: str, fields: list[tuple[str, str]]) -> None:
    """Load a measured stage."""
    save(_dealt(prepare(spark.read.parquet(path), fields, stage_widths(spark, path)), target), target, target.name(batch, table))


def merge_table(
    df: DataFrame, existing: DataFrame, target: Target, batch: str, table: str, fields: list[tuple[str, str]], folder: str | None = None
) -> None:
    """Load the batch together with the rows the warehouse has and the batch does not, with the widths of what is left.

    A merge asks for the batch's keys and rows, so the batch is staged before it; the merged rows are made once.
    """
    staged, widths = _staged(df, folder)
    if table not in NEVER_MERGED:
        staged, widths = _staged(upsert_keep_new(existing, staged, PRIMARY_KEYS[table]), folder)
    save(_dealt(prepare(staged, fields, widths), target), target, target.name(f"{batch}_merged", table))


def all_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def write_jdbc_text(df: DataFrame, target: Target, batch: str, table: str) -> None:
    save(all_text(df), target, target.name(batch, table))


def write_jdbc_typed(df: DataFrame, target: Target, batch: str, table: str, schema: T.StructType) -> None:
    """Column types of the created table come from the schema's DDL."""
    save(sch.apply_schema(df, schema), target, target.name(batch, table), createTableColumnTypes=sch.ddl(schema))


WRITERS: dict[str, Callable] = {"warehouse": replace_table, "jdbc_typed": write_jdbc_typed, "jdbc_text": write_jdbc_text}


def upload(kind: str, df: DataFrame, target: Target, batch: str, table: str, *args) -> None:
    WRITERS[kind](df, target, batch, table, *args)


def create_missing_tables(spark: SparkSession, spec: DataFrame, present: DataFrame, target: Target) -> list[str]:
    """Empty typed tables for what the spec names and the catalog lacks."""
    names = [r[0] for r in missing_tables(spec, present).collect()]  # at most the spec's tables
    for table in names:
        empty = spark.createDataFrame([], sch.table_schema(sch.table_fields(spec, table)))
        save(empty, target, target.name("", table), mode="ignore")
    return names
