"""Text cleaners and validators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fifty state codes.
US_STATES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
)


def null_word(c: Column) -> Column:
    """The literal word ``NULL`` is no value."""
    return F.nullif(c, F.lit("NULL"))


def after_pipe(c: Column) -> Column:
    """Second part of ``number|value``; NULL without a pipe."""
    return F.when(F.contains(c, F.lit("|")), F.split_part(c, F.lit("|"), F.lit(2)))


def first_eight(c: Column) -> Column:
    return F.substring(c, 1, 8)


def strip_exponent_marks(c: Column) -> Column:
    return F.trim(F.btrim(c, F.lit("eE")))


def zip5(c: Column) -> Column:
    return F.when(c.rlike("^[0-9]{5}$"), c)


def zip9(c: Column) -> Column:
    bare = F.replace(c, F.lit("-"), F.lit(""))
    return F.when(bare.rlike("^[0-9]{9}$"), bare)


def us_state(c: Column) -> Column:
    return F.when(F.upper(c).isin(*US_STATES), F.upper(c))


def npi_flag(c: Column) -> Column:
    return F.when(c.rlike("^[0-9]{10}$"), "Y").otherwise("N")


def dash_join(left: Column, right: Column) -> Column:
    """``left - right``; NULL when either side is."""
    return F.concat(left, F.lit(" - "), right)


def without_controls(c: Column) -> Column:
    """Text safe for a report cell."""
    return F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def zip_key(c: Column) -> Column:
    return F.lpad(c, 5, "0")


def county_key(c: Column) -> Column:
    return F.upper(F.replace(c, F.lit(" County"), F.lit("")))


def dictionary_entry(key: Column, value: Column, is_unit: Column, width: int = 20) -> Column:
    """A dictionary line: quoted key, commented out while it has no target."""
    quoted = F.concat(F.lit('"'), F.when(is_unit, key).otherwise(F.upper(key)), F.lit('"'))
    marked = F.when(F.coalesce(value, F.lit("")) == "", F.concat(F.lit("# "), quoted)).otherwise(quoted)
    padded = F.when(F.length(marked) < width, F.rpad(marked, width, " ")).otherwise(marked)
    return F.concat(F.lit("       "), padded, F.lit('  :  "'), F.coalesce(value, F.lit("")), F.lit('",'))
