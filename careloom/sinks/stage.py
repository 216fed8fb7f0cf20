"""Stage tables between the steps of a batch, and the text export at the end."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from careloom.operators.merge import union_all
from careloom.operators.project import void_to_string
from careloom.operators.result import Result

WIDTHS = ".widths"


def write_stage(df: DataFrame, path: str, by: str | None = None) -> None:
    """``by``: a column with a few values, which have folders of their own; read such a stage with its schema."""
    writer = void_to_string(df).write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)


def write_measured_stage(df: DataFrame, path: str) -> dict[str, int]:
    """Write a stage and, beside it, the longest text of every column, observed while its rows go by."""
    df, seen = void_to_string(df), Observation()
    widest = [F.max(F.length(F.col(f"`{c}`").cast("string"))).alias(f"w{k}") for k, c in enumerate(df.columns)]
    df.observe(seen, *widest).write.mode("overwrite").parquet(path)
    widths = {c: max(1, seen.get[f"w{k}"] or 1) for k, c in enumerate(df.columns)}
    rows = df.sparkSession.createDataFrame(list(widths.items()), "field STRING, width INT")
    rows.coalesce(1).write.mode("overwrite").parquet(path.rstrip("/") + WIDTHS)
    return widths


def stage_widths(spark: SparkSession, path: str) -> dict[str, int]:
    """What ``write_measured_stage`` left beside a stage."""
    return {r["field"]: r["width"] for r in spark.read.parquet(path.rstrip("/") + WIDTHS).collect()}  # one row per column


def export_text(df: DataFrame, path: str, files: int | None = None) -> None:
    """Tab-separated text with a header.  ``files=1`` is for small reports."""
    out = void_to_string(df)
    out = out.coalesce(files) if files else out
    out.write.mode("overwrite").options(header=True, sep="\t", nullValue=None, quote="").csv(path)


def write_union(parts: Iterable[DataFrame], path: str) -> None:
    """Parts of one table under one header."""
    write_stage(union_all(parts), path)


def write_rejects(results: Mapping[str, Result], path: str) -> None:
    """Beside the repaired table, what every repair touched: its report, or else its rows."""
    for name, result in results.items():
        touched = result.rejects if result.report is None else result.report
        if touched is not None:
            write_stage(touched, f"{path}/{name}")
