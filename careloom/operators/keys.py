"""Key handling shared by the joins.

``spread`` adds a second join column that is a function of the key, except for
rows with a NULL key, which it scatters.  It costs one hash per row and buys two
things on a large join:

* NULL keys, often the most common value, no longer meet in one partition;
* the join gets an exchange of its own on both sides even when one side was just
  grouped by the same key, which is the shape in which adaptive execution splits
  the partition of a hot key.

Both sides must have the key in the same type, or their hashes would not agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD = "__spread"
WIDTH = 4096


def spread(key: Column, *row: Column) -> Column:
    by_key = F.pmod(F.xxhash64(key), F.lit(WIDTH))
    if not row:
        return by_key
    return F.when(key.isNull(), F.pmod(F.xxhash64(*row), F.lit(WIDTH))).otherwise(by_key)


def with_spread(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn(SPREAD, spread(F.col(key), *[F.col(c) for c in df.columns]))


def left_join_grouped(df: DataFrame, side: DataFrame, key: Column, side_key: str) -> DataFrame:
    """Left join of a side that was grouped by its key, without the key; adaptive execution can split hot keys."""
    own = df.withColumn("__own", key)
    own = own.withColumn(SPREAD, spread(F.col("__own"), *[F.col(c) for c in df.columns]))
    typed = side.withColumn(side_key, F.col(side_key).try_cast(own.schema["__own"].dataType))
    typed = typed.withColumn("__side", spread(F.col(side_key)))
    test = (own["__own"] == typed[side_key]) & (own[SPREAD] == typed["__side"])
    return own.join(typed, test, "left").drop("__own", SPREAD, side_key, "__side")


def keys_of(parents: DataFrame, parent_key: str, child: DataFrame, key: str) -> DataFrame:
    """Non-NULL parent keys under the child's name and type, ready to be joined on (key, SPREAD)."""
    typed = F.col(parent_key).try_cast(child.schema[key].dataType).alias(key)
    return parents.select(typed).where(F.col(key).isNotNull()).withColumn(SPREAD, spread(F.col(key)))


def distinct_keys_of(parents: DataFrame, parent_key: str, child: DataFrame, key: str) -> DataFrame:
    keys = keys_of(parents, parent_key, child, key).drop(SPREAD).distinct()
    return keys.withColumn(SPREAD, spread(F.col(key)))
