"""Reference data: the data model's fields and value sets, vocabularies, dictionaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from careloom.operators.codes import checked, unit_name

SPEC_COLUMNS = ("TABLE_NAME", "FIELD_NAME", "RDBMS_DATA_TYPE")
CODE_MAP_SCHEMA = "table STRING, field STRING, source_value STRING, target_value STRING"


def read_spec(spark: SparkSession, path: str) -> DataFrame:
    """The data model's field list."""
    return spark.read.options(header=True, inferSchema=False, quote='"', escape='"').csv(path)


def table_headers(spec: DataFrame, table: str) -> list[str]:
    rows = spec.where(F.col("TABLE_NAME") == table).select("FIELD_NAME").collect()  # tens of rows
    return [r["FIELD_NAME"] for r in rows]


def value_items(valueset: DataFrame, field: str) -> DataFrame:
    """Codes the data model allows in a field."""
    return valueset.where(F.col("FIELD_NAME") == field).select(F.trim("VALUESET_ITEM").alias("VALUESET_ITEM")).distinct()


def tables_with_field(spec: DataFrame, text: str) -> DataFrame:
    """Tables that have a field whose name contains a text."""
    return spec.where(F.col("FIELD_NAME").contains(text)).select("TABLE_NAME").distinct()


def concepts(concept: DataFrame, role: str, where: str, take: Mapping[str, str]) -> DataFrame:
    """Vocabulary rows of one role: ``<role>_concept_id`` and the renamed columns taken."""
    return concept.where(where).select(
        F.col("concept_id").alias(f"{role}_concept_id"), *[F.col(c).alias(n) for n, c in take.items()]
    )


def code_map(spark: SparkSession, dictionaries: Mapping[tuple[str, str], Mapping[str, str | None]]) -> DataFrame:
    """Dictionaries ``{(table, field): {source: target}}`` as one checked table."""
    rows = [(t, f, s, v) for (t, f), entries in dictionaries.items() for s, v in entries.items()]
    if any(s is None for _, _, s, _ in rows):
        raise ValueError("dictionary keys that are missing")
    keys = [(t, f, s if unit_name(t, f) else s.upper()) for t, f, s, _ in rows]
    if len(set(keys)) < len(keys):
        raise ValueError(f"dictionary keys that occur more than once: {sorted({k for k in keys if keys.count(k) > 1})}")
    return spark.createDataFrame(rows, CODE_MAP_SCHEMA)


def read_code_map(spark: SparkSession, path: str) -> DataFrame:
    """Dictionaries kept as a headed file (table, field, source_value, target_value), checked."""
    options = {"header": True, "quote": '"', "escape": '"', "emptyValue": ""}
    return checked(spark.read.schema(CODE_MAP_SCHEMA).options(**options).csv(path))


def table_dictionary(code_map: DataFrame, table: str) -> DataFrame:
    return code_map.where(F.col("table") == table)


def stage_vocabulary(concept: DataFrame, table: str, files: int = 8) -> DataFrame:
    """The vocabulary as a table of the session's catalog partitioned by domain, written once for a batch.

    A lookup takes one domain.  Of files Spark knows the whole size only and shuffles the other side for every
    lookup; of a table's pruned partitions it knows the domain's, so that small domains (types, units, routes) are
    broadcast by their size.  Large domains are written in up to ``files`` parts.  An empty domain comes back as none.
    """
    dealt = concept.repartition("domain_id", F.pmod(F.xxhash64("concept_id"), F.lit(files)))
    dealt.write.mode("overwrite").format("parquet").partitionBy("domain_id").saveAsTable(table)
    return concept.sparkSession.table(table).select(concept.columns)
