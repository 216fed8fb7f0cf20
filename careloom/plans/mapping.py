"""Map jobs: pseudonymise identifiers, map codes, add the audit columns.

The formatted table already has the target's columns, so a job only names those
that change; all others, extra ones included, pass through in place.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careloom.functions.ids import pseudonym
from careloom.operators.codes import map_codes
from careloom.operators.lookup import zip_to_ruca
from careloom.operators.project import add_audit


@dataclass(frozen=True)
class MapJob:
    ids: tuple[str, ...] = ()
    codes: tuple[str, ...] = ()
    exact_codes: tuple[str, ...] = ()
    strict_codes: tuple[str, ...] = ()
    salted: str | None = None


@dataclass(frozen=True)
class Site:
    """Who sent the data and how its identifiers are hidden."""

    code: str
    key: str
    mode: str = "keyed"
    updated: str | None = None


def _job(ids: str = "", codes: str = "", exact: str = "", strict: str = "", salted: str | None = None) -> MapJob:
    return MapJob(tuple(ids.split()), tuple(codes.split()), tuple(exact.split()), tuple(strict.split()), salted)


# Identifiers and coded fields of the target tables.
JOBS: dict[str, MapJob] = {
    "CONDITION": _job("CONDITIONID PATID ENCOUNTERID", "CONDITION_STATUS CONDITION_TYPE CONDITION_SOURCE"),
    "DEATH_CAUSE": _job("PATID", "DEATH_CAUSE_CODE DEATH_CAUSE_TYPE DEATH_CAUSE_SOURCE DEATH_CAUSE_CONFIDENCE"),
    "DEATH": _job("PATID", "DEATH_DATE_IMPUTE DEATH_SOURCE DEATH_MATCH_CONFIDENCE"),
    "DEMOGRAPHIC": _job(
        "PATID",
        "SEX SEXUAL_ORIENTATION GENDER_IDENTITY HISPANIC RACE RACE_ETH_MISSING RACE_ETH_AI_AN RACE_ETH_ASIAN "
        "RACE_ETH_BLACK RACE_ETH_HISPANIC RACE_ETH_ME_NA RACE_ETH_NH_PI RACE_ETH_WHITE BIOBANK_FLAG "
        "PAT_PREF_LANGUAGE_SPOKEN",
    ),
    "DIAGNOSIS": _job("DIAGNOSISID PATID ENCOUNTERID PROVIDERID", "ENC_TYPE DX_TYPE DX_SOURCE DX_ORIGIN PDX DX_POA"),
    "DISPENSING": _job(
        "DISPENSINGID PATID PRESCRIBINGID", strict="DISPENSE_SOURCE DISPENSE_DOSE_DISP_UNIT DISPENSE_ROUTE"
    ),
    "ENCOUNTER": _job(
        "ENCOUNTERID PATID PROVIDERID",
        "ENC_TYPE DISCHARGE_DISPOSITION DISCHARGE_STATUS DRG_TYPE ADMITTING_SOURCE PAYER_TYPE_PRIMARY "
        "PAYER_TYPE_SECONDARY FACILITY_TYPE",
    ),
    "ENROLLMENT": _job("PATID", "CHART ENR_BASIS"),
    "EXTERNAL_MEDS": _job("EXTMEDID PATID", "EXT_DOSE_FORM EXT_ROUTE EXT_BASIS EXTMED_SOURCE", "EXT_DOSE_ORDERED_UNIT"),
    "HARVEST": _job(),
    "HASH_TOKEN": _job("PATID"),
    "IMMUNIZATION": _job(
        "IMMUNIZATIONID PATID ENCOUNTERID PROCEDURESID VX_PROVIDERID",
        "VX_CODE_TYPE VX_STATUS VX_STATUS_REASON VX_SOURCE VX_ROUTE VX_BODY_SITE VX_MANUFACTURER",
        "VX_DOSE_UNIT",
    ),
    "LAB_RESULT_CM": _job(
        "LAB_RESULT_CM_ID PATID ENCOUNTERID",
        "SPECIMEN_SOURCE LAB_RESULT_SOURCE LAB_LOINC_SOURCE PRIORITY RESULT_LOC LAB_PX_TYPE RESULT_QUAL RESULT_MODIFIER "
        "NORM_MODIFIER_LOW NORM_MODIFIER_HIGH ABN_IND",
        "RESULT_UNIT",
        salted="LAB_RESULT_CM_ID",
    ),
    "LDS_ADDRESS_HISTORY": _job(
        "ADDRESSID PATID", "ADDRESS_USE ADDRESS_TYPE ADDRESS_PREFERRED ADDRESS_STATE CURRENT_ADDRESS_FLAG"
    ),
    "MED_ADMIN": _job(
        "MEDADMINID PATID ENCOUNTERID PRESCRIBINGID MEDADMIN_PROVIDERID",
        "MEDADMIN_TYPE MEDADMIN_ROUTE MEDADMIN_SOURCE",
        "MEDADMIN_DOSE_ADMIN_UNIT",
    ),
    "OBS_CLIN": _job(
        "OBSCLINID PATID ENCOUNTERID OBSCLIN_PROVIDERID",
        "OBSCLIN_TYPE OBSCLIN_RESULT_QUAL OBSCLIN_RESULT_MODIFIER OBSCLIN_SOURCE OBSCLIN_ABN_IND",
        "OBSCLIN_RESULT_UNIT",
        salted="OBSCLINID",
    ),
    "OBS_GEN": _job(
        "OBSGENID PATID ENCOUNTERID OBSGEN_PROVIDERID",
        "OBSGEN_TYPE OBSGEN_RESULT_QUAL OBSGEN_RESULT_MODIFIER OBSGEN_SOURCE OBSGEN_ABN_IND",
        "OBSGEN_RESULT_UNIT",
        salted="OBSGENID",
    ),
    "PAT_RELATIONSHIP": _job("PATID_1 PATID_2", "RELATIONSHIP_TYPE"),
    "PCORNET_TRIAL": _job("PATID"),
    "PRESCRIBING": _job(
        "PRESCRIBINGID PATID ENCOUNTERID RX_PROVIDERID",
        "RX_DOSE_FORM RX_FREQUENCY RX_PRN_FLAG RX_ROUTE RX_BASIS RX_SOURCE RX_DISPENSE_AS_WRITTEN",
        "RX_DOSE_ORDERED_UNIT",
    ),
    "PRO_CM": _job("PRO_CM_ID PATID ENCOUNTERID", "PRO_TYPE PRO_METHOD PRO_MODE PRO_CAT PRO_SOURCE"),
    "PROCEDURES": _job("PROCEDURESID PATID ENCOUNTERID PROVIDERID", "ENC_TYPE PX_TYPE PX_SOURCE PPX"),
    "PROVIDER": _job("PROVIDERID", "PROVIDER_SEX PROVIDER_SPECIALTY_PRIMARY PROVIDER_NPI_FLAG"),
    "VITAL": _job("VITALID PATID ENCOUNTERID", "VITAL_SOURCE BP_POSITION SMOKING TOBACCO TOBACCO_TYPE"),
}


def run(table: str, df: DataFrame, code_map: DataFrame, site: Site, ruca_zip: DataFrame | None = None) -> DataFrame:
    """The mapped table.  Named columns that a source lacks are skipped."""
    job = JOBS[table]
    has = {c.upper() for c in df.columns}
    exact = [c for c in job.exact_codes if c in has]
    out = map_codes(df, code_map, table, [c for c in job.codes if c in has] + exact, "fallback", exact)
    strict = [c for c in job.strict_codes if c in has]
    out = map_codes(out, code_map, table, strict, "strict")
    if table == "LDS_ADDRESS_HISTORY" and ruca_zip is not None:
        out = zip_to_ruca(out, ruca_zip, "ADDRESS_ZIP5")
    hidden = {
        c: pseudonym(F.col(c), site.code, site.key, site.mode, salt=table if c == job.salted else None)
        for c in job.ids
        if c in has
    }
    return add_audit(out.withColumns(hidden) if hidden else out, site.code, site.updated)
