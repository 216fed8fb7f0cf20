"""Row repairs that need no parent table.  Each judges a row once; its results are read off that."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careloom.functions.dates import days_before
from careloom.operators.keys import left_join_grouped
from careloom.operators.patterns import text_hits
from careloom.operators.result import DROPPED, RENEWED, TOUCHED, Result, from_judged


def copy_when_null(df: DataFrame, field: str, other: str) -> Result:
    judged = df.withColumns({TOUCHED: F.col(field).isNull(), RENEWED + field: F.coalesce(field, other)})
    return from_judged(judged, df.columns)


def delete_when_null(df: DataFrame, field: str) -> Result:
    return _dropped(df, F.col(field).isNull(), df.columns)


def _dropped(df: DataFrame, test: Column, columns: list[str]) -> Result:
    """Rows that pass the test go."""
    hit = F.coalesce(test, F.lit(False))
    return from_judged(df.select(*columns, hit.alias(TOUCHED), hit.alias(DROPPED)), columns)


def invalid_to_null(df: DataFrame, field: str, valueset: DataFrame, item: str = "VALUESET_ITEM") -> Result:
    """Make codes outside the value set NULL."""
    valid = valueset.select(F.trim(item).alias("__item")).distinct().withColumn("__valid", F.lit(True))
    joined = left_join_grouped(df, valid, F.col(field), "__item")
    outside = F.col("__valid").isNull() & F.col(field).isNotNull()
    judged = joined.select(*df.columns, outside.alias(TOUCHED), F.when(F.col("__valid"), F.col(field)).alias(RENEWED + field))
    return from_judged(judged, df.columns)


def clamp_early_date(df: DataFrame, field: str, anchor: str = "ADMIT_DATE", days: int = 5) -> Result:
    """A date more than ``days`` before the anchor becomes the anchor."""
    early = F.coalesce(days_before(F.col(anchor).cast("string"), F.col(field).cast("string")) > days, F.lit(False))
    judged = df.withColumns({TOUCHED: early, RENEWED + field: F.when(early, F.col(anchor)).otherwise(F.col(field))})
    return from_judged(judged, df.columns)


def remove_listed(df: DataFrame, column: str, codes: DataFrame) -> Result:
    """Drop rows whose code is in a one-column list; rows without a code stay."""
    listed = codes.select(F.col(codes.columns[0]).alias("__code")).distinct().withColumn("__listed", F.lit(True))
    joined = left_join_grouped(df, listed, F.col(column), "__code")
    return _dropped(joined, F.col("__listed"), df.columns)


def remove_patterns(df: DataFrame, column: str, patterns: DataFrame) -> Result:
    """Drop rows whose text contains a listed text, whatever its case; rows without text stay.  See ``text_hits``."""
    joined, hit = text_hits(df, column, patterns)
    return _dropped(joined, hit, df.columns)
