"""Classifying claim lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careloom.functions.clinical import clean_code, code_number, encounter_type


def add_encounter_type(
    df: DataFrame,
    form: str,
    bill: str,
    revenue: str,
    hcpcs: str,
    place: str,
    modifiers: Sequence[str],
    name: str = "ENC_TYPE",
) -> DataFrame:
    """Add the encounter type of a claim line.

    The codes are cleaned in a projection of their own: each rule then compares
    plain columns instead of cleaning the same code again.
    """
    raw = [form, bill, revenue, hcpcs, place, *modifiers]
    names = [f"__code{i}" for i in range(len(raw))]
    cleaned = df.withColumns({n: clean_code(F.col(c)) for n, c in zip(names, raw)})
    numbered = cleaned.withColumn("__number", code_number(F.col(names[3])))
    cols = [F.col(n) for n in names]
    return numbered.withColumn(
        name, encounter_type(*cols[:4], F.col("__number"), *cols[4:])
    ).drop(*names, "__number")
