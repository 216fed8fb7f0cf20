"""Numbers held as text.

One definition of "numeric" serves every cleaner: an optional sign, digits with
an optional decimal point, an optional exponent.  Words such as ``nan``, type
suffixes and digit separators are not numbers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC_TEXT = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def is_numeric(c: Column) -> Column:
    return F.trim(c).rlike(NUMERIC_TEXT)


def to_double(c: Column) -> Column:
    return F.when(is_numeric(c), F.trim(c).try_cast("double"))


def keep_if_numeric(c: Column) -> Column:
    """The text itself when it is numeric."""
    return F.when(is_numeric(c), c)


def to_double_without_commas(c: Column) -> Column:
    return to_double(F.replace(c, F.lit(","), F.lit("")))


def leading_quantity(c: Column) -> Column:
    """Number in the whole text, else in its first word, else 0."""
    return F.coalesce(to_double(c), to_double(F.split_part(c, F.lit(" "), F.lit(1))), F.lit(0.0))


def whole_or_decimal(c: Column) -> Column:
    """Integer text when the value is one, else the decimal's text, else NULL."""
    whole = F.when(F.trim(c).rlike("^[+-]?[0-9]+$"), F.trim(c).try_cast("bigint"))
    return F.coalesce(whole.cast("string"), to_double(c).cast("string"))


def strip_signs(c: Column) -> Column:
    """Numeric text as it is; otherwise without its signs, when that is numeric."""
    bare = F.translate(c, "+-", "")
    return F.when(is_numeric(c), c).when(is_numeric(bare), bare)


def ratio_text(c: Column) -> Column:
    """Text such as ``120/80``."""
    return F.when(F.contains(c, F.lit("/")), c)


def non_ratio_number(c: Column) -> Column:
    return F.when(~F.contains(c, F.lit("/")) & is_numeric(c), c)


def round_percent(part: Column, total: Column) -> Column:
    """Percent to two places, in the steps of ``round(100.0 * part / total, 2)`` in SQL, so that halves fall on the same side."""
    return F.when(total == 0, F.lit(0.0)).otherwise(F.round(F.lit(100.0) * part / total * 100) / 100)
