"""Code mapping through a dictionary table ``(table, field, source_value, target_value)``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careloom.operators.keys import left_join_grouped

# a dictionary of so many entries becomes a literal map; one of so many, and so many bytes, is sent to all tasks.  Neither
# changes the result.
LITERAL_ENTRIES = 64
BROADCAST_ENTRIES = 100_000
BROADCAST_BYTES = 16 << 20
# Units that are compared without case all the same.
CASE_BLIND_UNITS = (("DISPENSING", "DISPENSE_DOSE_DISP_UNIT"),)


def dictionary(code_map: DataFrame, table: str, field: str, case_sensitive: bool = False) -> DataFrame:
    """One row per key of one field; a missing key is none, and of several targets the last by order counts."""
    entries = code_map.where((F.col("table") == table) & (F.col("field") == field) & F.col("source_value").isNotNull())
    return entries.groupBy(_key(F.col("source_value"), case_sensitive).alias("__key")).agg(F.max("target_value").alias("__target"))


def is_unit(table: Column, field: Column) -> Column:
    """Units are told apart by case, but for those listed; all other codes are not."""
    listed = F.concat_ws(".", table, field).isin([".".join(k) for k in CASE_BLIND_UNITS])
    return F.contains(field, F.lit("UNIT")) & ~listed


def unit_name(table: str, field: str) -> bool:
    return "UNIT" in field and (table, field) not in CASE_BLIND_UNITS


def colliding_entries(code_map: DataFrame) -> DataFrame:
    """Keys that are missing or occur more than once."""
    key = F.when(is_unit(F.col("table"), F.col("field")), F.col("source_value")).otherwise(F.upper("source_value"))
    return (
        code_map.groupBy("table", "field", key.alias("key"))
        .agg(F.count(F.lit(1)).alias("entries"))
        .where("entries > 1 OR key IS NULL")
    )


def checked(code_map: DataFrame) -> DataFrame:
    """The dictionary itself, once it is known to hold every key once."""
    examples = colliding_entries(code_map).limit(5).collect()
    if examples:
        raise ValueError(f"dictionary keys that are missing or occur more than once: {[tuple(r) for r in examples]}")
    return code_map


def map_codes(
    df: DataFrame,
    code_map: DataFrame,
    table: str,
    fields: Iterable[str],
    mode: str = "fallback",
    case_sensitive: Iterable[str] = (),
) -> DataFrame:
    """Replace source codes by target codes; the dictionary is a checked one.

    ``fallback`` keeps a code without an entry, ``strict`` makes it NULL.  A field
    with few entries is mapped by a literal map inside the projection; one with many
    by a join with its slice of the dictionary, since the lookup in a literal map is a
    scan and its text swells the plan; beyond what is broadcast, the join can split a
    hot code.  The result is the same.  All fields' sizes are read in one job, and all
    small ones' entries in another.
    """
    exact, fields = set(case_sensitive), list(fields)
    sizes = dictionary_sizes(code_map, table, fields) if fields else {}
    large = [f for f in fields if f in sizes and sizes[f][0] > LITERAL_ENTRIES]
    few = small_dictionaries(code_map, table, [f for f in fields if f in sizes and f not in large], exact)
    mapped = {f: _by_literal(f, few.get(f, {}), mode, f in exact) for f in fields if f not in large}
    out = df.withColumns(mapped) if mapped else df
    for field in large:
        entries, size = sizes[field]
        side = dictionary(code_map, table, field, field in exact)
        out = _by_join(out, side, field, mode, field in exact, entries <= BROADCAST_ENTRIES and size <= BROADCAST_BYTES)
    return out


def dictionary_sizes(code_map: DataFrame, table: str, fields: list[str]) -> dict[str, tuple[int, int]]:
    """Entries and bytes of the fields that have any."""
    size = F.octet_length("source_value") + F.coalesce(F.octet_length("target_value"), F.lit(0))
    sizes = _entries_of(code_map, table, fields).groupBy("field").agg(F.count(F.lit(1)).alias("entries"), F.sum(size).alias("bytes"))
    return {r["field"]: (r["entries"], r["bytes"]) for r in sizes.collect()}  # tens of fields


def small_dictionaries(code_map: DataFrame, table: str, fields: list[str], exact: set[str]) -> dict[str, dict[str, str | None]]:
    """Entries by field, of fields that have few."""
    if not fields:
        return {}
    told_apart = F.col("field").isin(sorted(exact)) if exact else F.lit(False)
    key = F.when(told_apart, F.col("source_value")).otherwise(F.upper("source_value"))
    merged = _entries_of(code_map, table, fields).groupBy("field", key.alias("key")).agg(F.max("target_value").alias("target"))
    found: dict[str, dict[str, str | None]] = {f: {} for f in fields}
    for r in merged.collect():  # at most LITERAL_ENTRIES a field
        found[r["field"]][r["key"]] = r["target"]
    return found


def _entries_of(code_map: DataFrame, table: str, fields: list[str]) -> DataFrame:
    return code_map.where((F.col("table") == table) & F.col("field").isin(fields) & F.col("source_value").isNotNull())


def _by_literal(field: str, entries: dict[str, str | None], mode: str, case_sensitive: bool) -> Column:
    if not entries:
        return F.lit(None).cast("string") if mode == "strict" else F.col(field)
    pairs = [F.lit(v) for entry in entries.items() for v in entry]
    found = F.create_map(*pairs)[_key(F.col(field), case_sensitive)]
    return found if mode == "strict" else F.coalesce(found, field)


def _by_join(df: DataFrame, side: DataFrame, field: str, mode: str, case_sensitive: bool, small: bool) -> DataFrame:
    key = _key(F.col(field), case_sensitive)
    if small:
        joined = df.join(F.broadcast(side), key == F.col("__key"), "left").drop("__key")
    else:
        joined = left_join_grouped(df, side, key, "__key")
    mapped = F.col("__target") if mode == "strict" else F.coalesce("__target", field)
    return joined.withColumn(field, mapped).drop("__target")


def _key(c: Column, case_sensitive: bool) -> Column:
    return c if case_sensitive else F.upper(c)
