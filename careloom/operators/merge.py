"""Merging with what a warehouse already holds."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Primary key of each target table.
PRIMARY_KEYS = {
    "DEMOGRAPHIC": ["PATID"],
    "ENROLLMENT": ["PATID", "ENR_START_DATE", "ENR_BASIS"],
    "ENCOUNTER": ["ENCOUNTERID"],
    "DIAGNOSIS": ["DIAGNOSISID"],
    "PROCEDURES": ["PROCEDURESID"],
    "VITAL": ["VITALID"],
    "DISPENSING": ["DISPENSINGID"],
    "LAB_RESULT_CM": ["LAB_RESULT_CM_ID"],
    "CONDITION": ["CONDITIONID"],
    "PRO_CM": ["PRO_CM_ID"],
    "PRESCRIBING": ["PRESCRIBINGID"],
    "PCORNET_TRIAL": ["PATID", "TRIALID", "PARTICIPANTID"],
    "DEATH": ["PATID", "DEATH_SOURCE"],
    "DEATH_CAUSE": ["PATID", "DEATH_CAUSE", "DEATH_CAUSE_CODE", "DEATH_CAUSE_TYPE", "DEATH_CAUSE_SOURCE"],
    "MED_ADMIN": ["MEDADMINID"],
    "PROVIDER": ["PROVIDERID"],
    "OBS_CLIN": ["OBSCLINID"],
    "OBS_GEN": ["OBSGENID"],
    "HASH_TOKEN": ["PATID", "TOKEN_ENCRYPTION_KEY"],
    "LDS_ADDRESS_HISTORY": ["ADDRESSID"],
    "IMMUNIZATION": ["IMMUNIZATIONID"],
    "PAT_RELATIONSHIP": ["PATID_1", "PATID_2", "RELATIONSHIP_TYPE"],
    "EXTERNAL_MEDS": ["EXTMEDID"],
}


def upsert_keep_new(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The incoming table plus the existing rows whose key did not come in again."""
    old = existing.select(*[c for c in existing.columns if c in incoming.columns])
    missing = old.join(incoming.select(*keys), list(keys), "left_anti")
    return incoming.unionByName(missing, allowMissingColumns=True)


def union_all(parts: Iterable[DataFrame]) -> DataFrame:
    """Parts of one table put together by column name; a column a part lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def missing_tables(spec: DataFrame, present: DataFrame, spec_name: str = "TABLE_NAME", name: str = "tableName") -> DataFrame:
    """Tables the spec names that the catalog does not hold, whatever the case."""
    held = present.select(F.upper(name).alias("__held"))
    wanted = spec.select(F.col(spec_name)).distinct()
    return wanted.join(held, F.upper(spec_name) == F.col("__held"), "left_anti")
