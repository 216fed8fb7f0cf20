"""Move results between LAB_RESULT_CM, OBS_CLIN and OBS_GEN by their code.

The three tables are brought to one shape and put together once; each row meets
the code list once and is tagged with the table it belongs in.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careloom.operators.keys import SPREAD, spread, with_spread

LAB, CLIN, GEN = "LAB_RESULT_CM", "OBS_CLIN", "OBS_GEN"
DESTINATION = "__destination"
HOME = "__home"

# Columns that carry the same content under another name.  The
# OBS tables follow a rule (see _common_name); the lab table is listed.
LAB_NAMES = {
    "LAB_RESULT_CM_ID": "ID",
    "LAB_LOINC": "CODE",
    "LAB_RESULT_SOURCE": "RESULT_SOURCE",
    "RAW_LAB_NAME": "RAW_NAME",
    "RAW_LAB_CODE": "RAW_CODE",
    "RESULT_DATE": "START_DATE",
    "RESULT_TIME": "START_TIME",
}
OBS_PREFIX = {CLIN: "OBSCLIN", GEN: "OBSGEN"}
# Code class of the list, by table.
CLASS_OF = {LAB: ["1"], CLIN: ["2"], GEN: ["3", "4"]}
# Moves made by class, in order.
MOVES = ((LAB, CLIN), (LAB, GEN), (CLIN, LAB), (GEN, LAB), (CLIN, GEN))


def _common_name(table: str, column: str, one_type: bool) -> str:
    """``one_type``: the tables' code types are one column."""
    if table == LAB:
        return "TYPE" if one_type and column == "LAB_PX_TYPE" else LAB_NAMES.get(column, column)
    prefix = OBS_PREFIX[table]
    if column == f"{prefix}ID":
        return "ID"
    if column == f"{prefix}_SOURCE":
        return "RESULT_SOURCE"
    return column.replace(f"RAW_{prefix}_", "RAW_").removeprefix(f"{prefix}_")


def to_common(df: DataFrame, table: str, one_type: bool = True) -> DataFrame:
    return df.select(*[F.col(c).alias(_common_name(table, c, one_type)) for c in df.columns], F.lit(table).alias(HOME))


def from_common(df: DataFrame, table: str, columns: list[str], one_type: bool = True) -> DataFrame:
    """The rows that belong in a table, under its names; ``one_type`` as when they were put together."""
    wanted = [(c, _common_name(table, c, one_type)) for c in columns]
    return df.where(F.col(DESTINATION) == table).select(
        *[(F.col(n) if n in df.columns else F.lit(None).cast("string")).alias(c) for c, n in wanted]
    )


def _together(tables: Mapping[str, DataFrame], one_type: bool) -> DataFrame:
    parts = [to_common(df, t, one_type) for t, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _with_codes(rows: DataFrame, side: DataFrame) -> DataFrame:
    """Rows beside what the list, one row per text code, says of their code."""
    side = side.withColumn("__side", spread(F.col("__code")))
    test = (F.col("CODE") == F.col("__code")) & (F.col(SPREAD) == F.col("__side"))
    return with_spread(rows, "CODE").join(side, test, "left").drop(SPREAD, "__side")


def route(tables: Mapping[str, DataFrame], locations: DataFrame, copies: bool = False) -> DataFrame:
    """All rows in the common shape with the table each belongs in.

    The code type travels along: LAB_PX_TYPE and the types of the OBS tables are one.
    ``locations``: loinc_num, found_in_lab, found_in_obs_clin, found_in_obs_gen.
    A code in several tables goes to the first of lab, clinical, general; one in no
    table stays.  With ``copies`` a code in lab and clinical goes to both, and a
    listed code without a table disappears.
    """
    flags = locations.groupBy(F.col("loinc_num").alias("__code")).agg(
        *[F.max(F.col(f"found_in_{t}") == "1").alias(f"__{t}") for t in ("lab", "obs_clin", "obs_gen")]
    )
    rows = _with_codes(_together(tables, True), flags)
    lab, clin, gen = F.col("__lab"), F.col("__obs_clin"), F.col("__obs_gen")
    if copies:
        homes = F.array_compact(
            F.array(F.when(lab, LAB), F.when(clin, CLIN), F.when(~clin & gen, GEN), F.when(F.col("__code").isNull(), F.col(HOME)))
        )
        rows = rows.withColumn(DESTINATION, F.explode(homes))
    else:
        rows = rows.withColumn(DESTINATION, F.when(lab, LAB).when(clin, CLIN).when(gen, GEN).otherwise(F.col(HOME)))
    source = F.col("RESULT_SOURCE")
    recoded = F.when((F.col(DESTINATION) == CLIN) & (source == "OD") & F.col("__code").isNotNull(), "DR").otherwise(source)
    return rows.withColumn("RESULT_SOURCE", recoded).drop("__code", "__lab", "__obs_clin", "__obs_gen")


def move_by_class(tables: Mapping[str, DataFrame], classes: DataFrame) -> DataFrame:
    """All rows in the common shape with the table each belongs in by its code's class.

    ``classes``: loinc_num, classtype.  The lab table keeps its LAB_PX_TYPE.  Rows of the OBS tables move only when they
    are typed as such codes.  A row moves at most once, since where it arrives is
    where its class belongs.
    """
    side = classes.groupBy(F.col("loinc_num").alias("__code")).agg(F.min("classtype").alias("__class"))
    rows = _together(tables, False)
    if "TYPE" not in rows.columns:
        rows = rows.withColumn("TYPE", F.lit(None).cast("string"))
    rows = _with_codes(rows, side)
    home, from_lab = F.col(HOME), F.col(HOME) == LAB
    typed = from_lab | (F.col("TYPE") == "LC")
    target: Column = F.lit(None).cast("string")
    for source, destination in MOVES:
        belongs = (home == source) & F.col("__class").isin(CLASS_OF[destination]) & typed
        target = F.coalesce(target, F.when(belongs, destination))
    rows = rows.withColumn(DESTINATION, F.coalesce(target, home))
    left_lab = from_lab & (F.col(DESTINATION) != LAB)
    rows = rows.withColumn("TYPE", F.when(left_lab, "LC").otherwise(F.col("TYPE")))
    rows = rows.withColumn("RESULT_SOURCE", F.when(left_lab, "HC").otherwise(F.col("RESULT_SOURCE")))
    return rows.drop("__code", "__class")


def moved_report(routed: DataFrame) -> DataFrame:
    """(step, source_table, target_table, records_moved) for every move there is, none included."""
    moved = routed.groupBy(HOME, DESTINATION).agg(F.count(F.lit(1)).alias("n"))
    counts = moved.agg(
        *[
            F.coalesce(F.sum(F.when((F.col(HOME) == s) & (F.col(DESTINATION) == d), F.col("n"))), F.lit(0)).alias(f"{s} -> {d}")
            for s, d in MOVES
        ]
    )
    long = counts.unpivot([], counts.columns, "step", "records_moved")
    ends = F.split("step", " -> ")
    return long.select("step", ends[0].alias("source_table"), ends[1].alias("target_table"), "records_moved")
