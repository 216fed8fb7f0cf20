"""One row per key from the first filled value of every column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def collapse_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], blank: str | None = "") -> DataFrame:
    """For every other column the first value, by ``order_by``, that is neither NULL nor blank."""
    ranked = df.withColumn("__order", F.struct(*order_by))

    def first_filled(c: str):
        value = F.col(c)
        text = df.schema[c].dataType.typeName() == "string"
        filled = value.isNotNull() & (value != blank) if text and blank is not None else value.isNotNull()
        return F.min_by(value, F.when(filled, F.col("__order"))).alias(c)

    return ranked.groupBy(*keys).agg(*[first_filled(c) for c in df.columns if c not in keys])
