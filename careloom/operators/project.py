"""Projections by spec."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careloom.functions.dates import load_stamp


def project(
    df: DataFrame, spec: Mapping[str, Column], passthrough: bool = False, used: Sequence[str] = ()
) -> DataFrame:
    """Select ``{name: expression}``; with ``passthrough`` the other source columns follow.

    The extra columns ride along in the same select: no second read, no join back.
    """
    taken = {n.upper() for n in spec} | {c.upper() for c in used}
    extra = [F.col(c) for c in df.columns if c.upper() not in taken] if passthrough else []
    return df.select(*[e.alias(n) for n, e in spec.items()], *extra)


def add_audit(df: DataFrame, source: str, updated: str | None = None) -> DataFrame:
    """Append UPDATED and SOURCE; ``updated`` fixes the load time of a whole run."""
    stamp = F.lit(updated) if updated else load_stamp()
    return df.withColumn("UPDATED", stamp).withColumn("SOURCE", F.lit(source.upper()))


def common_columns(df: DataFrame, other: DataFrame) -> DataFrame:
    """Columns that the other table has as well, in their order here."""
    return df.select(*[c for c in df.columns if c in other.columns])


def without_columns(df: DataFrame, other: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Columns that the other table lacks, and those to keep."""
    return df.drop(*[c for c in df.columns if c in other.columns and c not in keep])


def in_order_of(df: DataFrame, other: DataFrame) -> DataFrame:
    return df.select(*other.columns)


def void_to_string(df: DataFrame) -> DataFrame:
    """Columns of no type become text, so that any sink can hold them."""
    return df.select(
        *[F.col(f.name).cast("string").alias(f.name) if f.dataType.typeName() == "void" else F.col(f.name) for f in df.schema]
    )
