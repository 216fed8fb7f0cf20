"""Keep-first de-duplication and last-row lookups."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careloom.operators.keys import WIDTH

COPIES_PER_STEP = 100_000


@dataclass(frozen=True)
class Dedup:
    kept: DataFrame
    surplus: DataFrame
    key_report: DataFrame


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ()) -> Dedup:
    """Keep the first row of every key; report the rest.

    "First" is by ``order_by``, then by the remaining columns, so the choice does
    not depend on how the input was split.
    """
    return Dedup(
        kept=keep_first(df, keys, order_by),
        surplus=surplus_rows(df, keys, order_by),
        key_report=duplicate_keys(df, keys),
    )


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key.

    The rank filter is applied before the shuffle too (window group limit), so a
    task sends at most one row per key however often the key occurs.
    """
    named = {c for c in order_by if isinstance(c, str)}
    ties = [F.col(c) for c in df.columns if c not in keys and c not in named and _sortable(df, c)]
    order = [F.col(c) if isinstance(c, str) else c for c in order_by] + ties
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*(order or [F.lit(1)])))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def last_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row of each key that comes last by ``order_by``."""
    return keep_first(df, keys, [F.col(c).desc() for c in order_by])


def surplus_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] = ()) -> DataFrame:
    """Every row that ``keep_first`` leaves out, copies included.

    Only rows of repeated keys can be left out, so the narrow counts of the keys come first.
    Among those rows it is a multiset difference grouped by the whole row: copies collapse
    before the shuffle and a hot key with differing rows spreads over all partitions.
    """
    df, cols = _of_repeated_keys(df, keys), df.columns
    signed = df.withColumn("__n", F.lit(1)).unionAll(keep_first(df, keys, order_by).withColumn("__n", F.lit(-1)))
    left = signed.groupBy(*cols).agg(F.sum("__n").alias("__n")).where("__n > 0")
    return repeat_rows(left, "__n")


def _of_repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The second key, made of the others, gives the join exchanges of its own, so that a hot key is split."""
    named = {k: f"__key{n}" for n, k in enumerate(keys)}
    repeated = duplicate_keys(df, keys).select(*[F.col(k).alias(n) for k, n in named.items()])
    repeated = repeated.withColumn("__mark", F.pmod(F.xxhash64(*named.values()), F.lit(WIDTH)))
    test = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in named.items()])
    own = df.withColumn("__own", F.pmod(F.xxhash64(*keys), F.lit(WIDTH)))
    return own.join(repeated, test & (F.col("__own") == F.col("__mark")), "left_semi").select(*df.columns)


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` over, dealt out in steps so that a very long run of copies is made by many tasks."""
    every = _steps(df, times)
    return every.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).drop("__copy", times)


def _steps(df: DataFrame, times: str) -> DataFrame:
    last = F.floor((F.col(times) - 1) / COPIES_PER_STEP)
    size = F.least(F.lit(COPIES_PER_STEP), F.col(times) - F.col("__step") * COPIES_PER_STEP)
    return (
        df.withColumn("__step", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        .withColumn(times, size)
        .repartition("__step", *[c for c in df.columns if c != times])
        .drop("__step")
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where("count > 1")


def _sortable(df: DataFrame, column: str) -> bool:
    return not df.schema[column].dataType.typeName().startswith(("map", "variant"))
