"""How well the dictionaries cover the codes that occur."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careloom.functions.text import dictionary_entry, without_controls
from careloom.operators.codes import is_unit
from careloom.operators.profile import value_profile

# Targets that say nothing.
FLAVOURS_OF_NULL = ("NI", "OT", "UN")


def coverage(df: DataFrame, code_map: DataFrame, table: str, fields: Sequence[str]) -> DataFrame:
    """(field, value, target, count, percent) of every code that occurs.

    The mapped columns are counted in one pass; only the counts meet the
    dictionary.  Units are compared with their case, all else without.
    """
    counts = value_profile(df, fields)
    unit = is_unit(F.lit(table), F.col("field"))
    entries = code_map.where(F.col("table") == table).select(
        F.col("field").alias("__field"),
        F.when(unit, F.col("source_value")).otherwise(F.upper("source_value")).alias("__key"),
        F.col("target_value").alias("target"),
    )
    key = F.when(unit, F.col("value")).otherwise(F.upper("value"))
    joined = counts.join(entries, (F.col("field") == F.col("__field")) & (key == F.col("__key")), "left")
    return joined.select("field", "value", "target", "count", "percent")


def missing_mapping(covered: DataFrame, valueset: DataFrame) -> DataFrame:
    """Codes without a target that are not codes of the data model themselves."""
    known = valueset.select(F.col("FIELD_NAME").alias("field"), F.trim("VALUESET_ITEM").alias("value"))
    open_codes = covered.where(F.col("target").isNull() & F.col("value").isNotNull())
    return open_codes.join(known, ["field", "value"], "left_anti").select(*covered.columns)


def flavours_of_null(code_map: DataFrame) -> DataFrame:
    """Dictionary entries that map to no information."""
    target = F.col("target_value")
    return code_map.where(target.isin(*FLAVOURS_OF_NULL) | target.isNull() | (target == ""))


def suggest_codes(code_map: DataFrame, missing: DataFrame, table: str) -> DataFrame:
    """The dictionary of a table with the missing codes appended, and each as a line to paste."""
    present = code_map.where(F.col("table") == table).select("field", "source_value", "target_value")
    wanted = missing.select("field", F.col("value").alias("source_value"), F.lit("").alias("target_value"))
    both = present.unionByName(wanted)
    line = dictionary_entry(F.col("source_value"), F.col("target_value"), is_unit(F.lit(table), F.col("field")))
    return both.withColumn("entry", line)


def mapping_report(covered: dict[str, DataFrame]) -> DataFrame:
    """Coverage of all tables as one long table, with text safe for a report."""
    parts = [
        df.select(F.lit(table).alias("table"), "field", without_controls(F.col("value")).alias("value"), "target", "count", "percent")
        for table, df in covered.items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
