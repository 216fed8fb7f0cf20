"""Rows whose parent is missing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careloom.operators.keys import SPREAD, distinct_keys_of, keys_of, spread, with_spread
from careloom.operators.result import DROPPED, RENEWED, TOUCHED, Result, from_judged


def _joined(df: DataFrame, parents: DataFrame, key: str, parent_key: str | None) -> DataFrame:
    """The rows with ``__found`` where their parent exists."""
    found = distinct_keys_of(parents, parent_key or key, df, key).withColumn("__found", F.lit(True))
    return with_spread(df, key).join(found, [key, SPREAD], "left")


def drop_orphans(df: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> Result:
    """Keep rows whose parent exists; report the distinct missing keys.

    Until it is settled the report is a plan of its own, which reads the keys only.
    """
    missing = F.col("__found").isNull()
    judged = _joined(df, parents, key, parent_key).select(*df.columns, missing.alias(TOUCHED), missing.alias(DROPPED))
    found = keys_of(parents, parent_key or key, df, key)
    keys = df.select(key).distinct().withColumn(SPREAD, spread(F.col(key), F.col(key)))
    lean = keys.join(found, [key, SPREAD], "left_anti").select(key)
    return replace(from_judged(judged, df.columns, report=lambda touched: touched.select(key).distinct()), report=lean)


def nullify_orphans(df: DataFrame, parents: DataFrame, key: str, parent_key: str | None = None) -> Result:
    """Keep every row; make the key NULL where the parent is missing; count rows per missing key."""
    missing = F.col("__found").isNull() & F.col(key).isNotNull()
    renewed = F.when(F.col("__found"), F.col(key)).alias(RENEWED + key)
    judged = _joined(df, parents, key, parent_key).select(*df.columns, missing.alias(TOUCHED), renewed)
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    lean = counts.join(keys_of(parents, parent_key or key, df, key).drop(SPREAD), key, "left_anti")
    counted = from_judged(judged, df.columns, report=lambda touched: touched.groupBy(key).agg(F.count(F.lit(1)).alias("count")))
    return replace(counted, report=lean)


def replicate(
    df: DataFrame,
    parents: DataFrame,
    key: str,
    columns: Sequence[str],
    *,
    how: str = "left",
    parents_unique: bool = False,
) -> Result:
    """Overwrite ``columns`` with the parent's values; show the rows that disagreed.

    With ``how="left"`` a row without a parent gets NULLs; ``inner`` drops it.
    ``parents_unique`` saves the grouping when the parent is already one row per key.
    """
    typed = parents.withColumn(key, F.col(key).try_cast(df.schema[key].dataType))
    side = typed.where(F.col(key).isNotNull()).select(key, *columns)
    if not parents_unique:
        first = F.min(F.struct(*columns)).alias("__first")
        side = side.groupBy(key).agg(first).select(key, "__first.*")
    side = side.select(F.col(key), spread(F.col(key)).alias(SPREAD), *[F.col(c).alias(RENEWED + c) for c in columns])
    joined = with_spread(df, key).join(side, [key, SPREAD], how)
    differs = F.lit(False)
    for c in columns:
        differs = differs | F.coalesce(F.col(c) != F.col(RENEWED + c), F.lit(False))
    judged = joined.select(*df.columns, differs.alias(TOUCHED), *[RENEWED + c for c in columns])
    return from_judged(judged, df.columns, {RENEWED + c: f"SOURCE_{c}" for c in columns})
