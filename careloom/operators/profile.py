"""Profiles: frequencies, monthly counts, widths.

Each report is one pass over the table: the columns are unpivoted and grouped
once, with partial counts before the single exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careloom.functions.dates import month_bucket, parse_datetime, unreadable
from careloom.functions.numbers import round_percent

# rows of a field in a report, and the parts in which a field's values are ranked first
REPORT_ROWS = 1_000_000
PARTS = 64


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Value, count and percent of rows of one column, most frequent first."""
    profile = value_profile(df, [column]).drop("field").withColumnRenamed("value", column)
    return profile.orderBy(F.desc("count"), column)


def top_values(df: DataFrame, column: str, rows: int) -> DataFrame:
    """The most frequent values: the report's row cap after its order."""
    return frequency(df, column).limit(rows)


def profiled_columns(df: DataFrame) -> list[str]:
    """Columns worth profiling: identifiers are not."""
    return [c for c in df.columns if not c.upper().endswith("ID")]


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = texts.unpivot([], list(columns), "field", "value")
    return long.groupBy("field", "value").agg(F.count(F.lit(1)).alias("count"))


def value_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(field, value, count, percent) for every distinct value of every column.

    The totals come from the grouped counts, one row per column, so the side that
    is broadcast has exactly as many rows as the report has columns.
    """
    counts = value_counts(df, columns or profiled_columns(df))
    return _with_percent(counts, counts)


def _with_percent(rows: DataFrame, counts: DataFrame) -> DataFrame:
    totals = counts.groupBy("field").agg(F.sum("count").alias("__total"))
    joined = rows.join(F.broadcast(totals), "field")
    return joined.select("field", "value", "count", round_percent(F.col("count"), F.col("__total")).alias("percent"))


def top_profile(df: DataFrame, columns: Sequence[str] | None = None, rows: int = REPORT_ROWS) -> DataFrame:
    """``value_profile`` with the report's cap for each field: its most frequent values, ties by value, NULL first.

    Percents are of all rows.  A value is ranked among those of its field with the same remainder of a hash before it
    is among the field's, so no task gets a field's values whole: at most ``rows`` of each remainder reach the last
    rank, and of those a task sends on no more than ``rows``.
    """
    counts = value_counts(df, columns or profiled_columns(df))
    order = [F.desc("count"), F.asc_nulls_first("value")]
    best = counts.withColumn("__part", F.pmod(F.xxhash64("value"), F.lit(PARTS)))
    for keys in (["field", "__part"], ["field"]):
        best = best.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__rank") <= rows)
    return _with_percent(best.select("field", "value", "count"), counts)


def date_columns(df: DataFrame, spec: DataFrame | None = None, table: str | None = None) -> list[str]:
    """Date columns by the spec's type; by name when there is no spec."""
    if spec is None:
        return [c for c in df.columns if "DATE" in c.upper()]
    dates = spec.where((F.col("TABLE_NAME") == table) & F.col("RDBMS_DATA_TYPE").contains("Date"))
    names = {r["FIELD_NAME"] for r in dates.select("FIELD_NAME").collect()}  # spec rows: at most a few hundred
    return [c for c in df.columns if c in names]


def monthly_counts(df: DataFrame, columns: Sequence[str] | None = None, ordered: bool = True) -> DataFrame:
    """(field, year_month, count) for every date column, newest month first."""
    columns = list(columns or date_columns(df))
    months = df.select(*[F.trunc(_as_date(df, c), "month").alias(c) for c in columns])
    long = months.unpivot([], columns, "field", "month")
    counted = long.groupBy("field", "month").agg(F.count(F.lit(1)).alias("count"))
    # months are text only once they are few
    counts = counted.select("field", month_bucket(F.col("month"), typed=True).alias("year_month"), "count")
    return counts.orderBy("field", F.desc("year_month")) if ordered else counts


def _as_date(df: DataFrame, column: str) -> Column:
    typed = df.schema[column].dataType.typeName() in ("date", "timestamp", "timestamp_ntz")
    return F.col(column).cast("date") if typed else parse_datetime(F.col(column)).cast("date")


def width_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(field, width): longest text of every column, at least 1."""
    columns = list(columns or df.columns)
    widest = [F.greatest(F.coalesce(F.max(F.length(F.col(c).cast("string"))), F.lit(1)), F.lit(1)).alias(c) for c in columns]
    return df.agg(*widest).unpivot([], columns, "field", "width")


def unreadable_dates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, unreadable): how many texts of every date column are neither blank nor a date, in one pass."""
    lost = [F.count_if(unreadable(F.col(c))).alias(c) for c in columns]
    return df.agg(*lost).unpivot([], list(columns), "field", "unreadable")
