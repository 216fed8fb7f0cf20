"""A whole batch: format, de-duplicate, map, repair, load; and the two reports.

Each stage of a table is one lazy plan.  What later stages read more than once is
written once as Parquet in the batch's shared folder, which also cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from careloom.operators import coverage as cov
from careloom.operators import route
from careloom.operators.dedup import Dedup, dedup
from careloom.operators.history import merge_history
from careloom.operators.lookup import remap_ids
from careloom.operators.merge import union_all
from careloom.operators.profile import date_columns, monthly_counts, top_profile, value_profile
from careloom.operators.result import TOUCHED
from careloom.plans import chains, mapping, pcornet
from careloom.sinks.stage import write_rejects, write_stage
from careloom.sources.files import read_stage

# Columns that identify a row when duplicates are removed.  Where a
# table is not named, its first column does.
DEDUP_KEYS = {
    "ENROLLMENT": ("PATID", "ENR_START_DATE", "ENR_BASIS"),
    "DEATH_CAUSE": ("PATID", "DEATH_CAUSE", "DEATH_CAUSE_CODE", "DEATH_CAUSE_TYPE", "DEATH_CAUSE_SOURCE"),
    "PAT_RELATIONSHIP": ("PATID_1", "PATID_2"),
    "PCORNET_TRIAL": ("PATID", "TRIALID", "PARTICIPANTID"),
}
# Tables identified by their first n columns, and those left as they are.
DEDUP_WIDTHS = {"FACT_RELATIONSHIP": 5, "PROBLEM_CONTACT": 6, "INTERVENTION_CONTACT": 7}
NOT_DEDUPLICATED = ("TUMOR_DATE",)
NOT_PROFILED = ("FACT_RELATIONSHIP",)
ADDRESSES = "LDS_ADDRESS_HISTORY"


def dedup_keys(table: str, columns: Sequence[str]) -> list[str]:
    return list(DEDUP_KEYS.get(table, columns[: DEDUP_WIDTHS.get(table, 1)]))


def deduplicate(table: str, df: DataFrame) -> Dedup | None:
    return None if table in NOT_DEDUPLICATED else dedup(df, dedup_keys(table, df.columns))


@dataclass(frozen=True)
class Batch:
    """One delivery of a site.  ``folder`` is shared storage; see session.batch_folder.

    Results move by ``code_locations`` or, without those, by ``code_classes``.  Repairs
    against a parent table that the delivery lacks are an error unless it is named in
    ``absent_parents``; then they are left out.
    """

    folder: str
    site: mapping.Site
    code_map: DataFrame
    ruca_zip: DataFrame | None = None
    extra_fixes: Mapping[str, Sequence[chains.Step]] = field(default_factory=dict)
    lists: Mapping[str, DataFrame] = field(default_factory=dict)
    code_locations: DataFrame | None = None
    code_classes: DataFrame | None = None
    absent_parents: tuple[str, ...] = ()
    address_history: DataFrame | None = None

    def path(self, stage: str, table: str) -> str:
        return f"{self.folder}/{stage}/{table.lower()}"


def run_batch(
    spark: SparkSession, batch: Batch, formatted: Mapping[str, DataFrame], on_table: Callable[[str], None] = lambda t: None
) -> dict[str, DataFrame]:
    """Take the formatted tables to the repaired ones.

    Tables are mapped first, since repairs look across tables; the repairs then run
    parents first, each against the repaired parents.
    """
    mapped = {}
    for table, df in formatted.items():
        write_stage(df, batch.path("formatted", table))
        df = read_stage(spark, batch.path("formatted", table))
        unique = deduplicate(table, df)
        if unique:
            write_stage(unique.surplus, batch.path("deduplicated/surplus", table))
            write_stage(unique.key_report, batch.path("deduplicated/keys", table))
            df = unique.kept
        write_stage(mapping.run(table, df, batch.code_map, batch.site, batch.ruca_zip), batch.path("mapped", table))
        mapped[table] = read_stage(spark, batch.path("mapped", table))
        on_table(table)
    fixed: dict[str, DataFrame] = {}
    order = [t for t in chains.ORDER if t in mapped] + [t for t in mapped if t not in chains.ORDER]
    for table in order:
        steps = [*chains.CHAINS.get(table, ()), *batch.extra_fixes.get(table, ())]
        usable = [s for s in steps if _parent_present(s, table, fixed, batch.absent_parents)]

        def settle(df: DataFrame, name: str, table: str = table) -> DataFrame:
            path = f"{batch.path('fixing', table)}/{name}"
            write_stage(df, path, by=TOUCHED if TOUCHED in df.columns else None)
            return read_stage(spark, path, df.schema)

        good, results = chains.run_chain(mapped[table], usable, chains.Context(fixed, batch.lists), settle)
        write_stage(good, batch.path("fixed", table))
        write_rejects(results, batch.path("fixed_rejects", table))
        fixed[table] = read_stage(spark, batch.path("fixed", table))
    return fixed | _repair_across_tables(spark, batch, fixed)


def _repair_across_tables(spark: SparkSession, batch: Batch, fixed: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Repairs of several tables at once come last: results to where their code belongs, addresses to their history."""
    out = {}
    results = {t: fixed[t] for t in (route.LAB, route.CLIN, route.GEN) if t in fixed}
    by_flags = batch.code_locations is not None
    if results and (by_flags or batch.code_classes is not None):
        path = batch.path("relocated", "results")
        routed = route.route(results, batch.code_locations) if by_flags else route.move_by_class(results, batch.code_classes)
        # one write decides for all rows; each table then reads its own part
        routed.write.mode("overwrite").partitionBy(route.DESTINATION).parquet(path)
        placed = read_stage(spark, path)
        arrived = [r[0] for r in placed.select(route.DESTINATION).distinct().collect()]  # three tables at most
        columns = {t: results[t].columns if t in results else _columns_of(t) for t in {*results, *arrived}}
        out = {t: route.from_common(placed, t, names, by_flags) for t, names in columns.items()}
    if batch.address_history is not None and ADDRESSES in fixed:
        write_stage(merge_history(batch.address_history, fixed[ADDRESSES]), batch.path("relocated", ADDRESSES))
        out[ADDRESSES] = read_stage(spark, batch.path("relocated", ADDRESSES))
    return out


def _columns_of(table: str) -> list[str]:
    """The columns of a table that the delivery lacks: the data model's, and the audit's."""
    return [*pcornet.JOBS[table].columns, "UPDATED", "SOURCE"]


def remap_patients(tables: Mapping[str, DataFrame], id_map: DataFrame, old: str, new: str) -> dict[str, DataFrame]:
    """Every table under another set of patient ids; tables without patients stay as they are."""
    return {t: remap_ids(df, id_map, "PATID", old, new) if "PATID" in df.columns else df for t, df in tables.items()}


PARENT_OF_FIX = {
    "patient_orphans": "DEMOGRAPHIC",
    "encounter_orphans": "ENCOUNTER",
    "provider_orphans": "PROVIDER",
    "replicate_encounter": "ENCOUNTER",
}


def _parent_present(s: chains.Step, table: str, tables: Mapping[str, DataFrame], absent: Sequence[str]) -> bool:
    parent = PARENT_OF_FIX.get(s.fix)
    if parent is None or parent in tables:
        return True
    if parent not in absent:
        raise ValueError(f"{table} is repaired against {parent}, which is not in the batch")
    return False


def monthly_report(tables: Mapping[str, DataFrame], spec: DataFrame | None = None) -> DataFrame:
    """Months of all date columns: those of the spec's types, or by name without a spec."""
    dated = {t: date_columns(df, spec, t) for t, df in tables.items()}
    return _report({t: df for t, df in tables.items() if dated[t]}, lambda t, df: monthly_counts(df, dated[t], ordered=False))


def distinct_report(tables: Mapping[str, DataFrame], rows: int | None = None) -> DataFrame:
    """Values of all columns that are not identifiers; ``rows`` keeps that many of each, the most frequent."""
    profiled = {t: df for t, df in tables.items() if t not in NOT_PROFILED}
    return _report(profiled, lambda _, df: top_profile(df, rows=rows) if rows else value_profile(df))


def _report(tables: Mapping[str, DataFrame], one: Callable[[str, DataFrame], DataFrame]) -> DataFrame:
    parts = [one(t, df).selectExpr(f"'{t}' AS table", "*") for t, df in tables.items()]
    return union_all(parts)


def coded_fields(code_map: DataFrame, table: str) -> list[str]:
    """Fields of a table that have a dictionary."""
    rows = code_map.where(f"table = '{table}'").select("field").distinct().collect()  # tens of fields
    return sorted(r["field"] for r in rows)


def mapping_gap(tables: Mapping[str, DataFrame], code_map: DataFrame, valueset: DataFrame) -> dict[str, DataFrame]:
    """Coverage, missing codes and suggested dictionaries of all tables."""
    covered = {
        t: cov.coverage(df, code_map, t, fields)
        for t, df in tables.items()
        if (fields := [f for f in coded_fields(code_map, t) if f in df.columns])
    }
    missing = {t: cov.missing_mapping(c, valueset) for t, c in covered.items()}
    return {
        "all_mapping": cov.mapping_report(covered),
        "missing_mapping": cov.mapping_report(missing),
        "flavours_of_null": cov.flavours_of_null(code_map),
        "suggested": union_all(
            cov.suggest_codes(code_map, m, t).selectExpr(f"'{t}' AS table", "*") for t, m in missing.items()
        ),
    }
