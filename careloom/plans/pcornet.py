"""Format jobs for extracts that already have the target's shape, in one of two dirty layouts.

The lower-case ``~`` layout and the upper-case ``;`` (tab, ``,``) layout carry the
same names but for the exceptions listed, so one job serves both: Spark resolves
column names whatever their case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from careloom.operators.merge import union_all
from careloom.plans.spec import BLANK, Const, Job, Value, override, run_job, same, use
from careloom.sources.files import Layout, choose_layout, list_files, read_layout


def _date(name: str):
    return use("format_date", name)


def _time(name: str):
    return use("format_time", name)


def _dates(*names: str) -> dict:
    return {n: _date(n) for n in names}


def _times(*names: str) -> dict:
    return {n: _time(n) for n in names}


def _numbers(*names: str) -> dict:
    return {n: use("keep_if_numeric", n) for n in names}


# File pattern of each table and the separators its layouts use.
FILES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "CONDITION": (("*Condition*",), ("~", ";")),
    "DEATH_CAUSE": (("*Death_Cause*",), ("~", ";")),
    "DEATH": (("*Death_2*",), ("~", ";")),
    "DEMOGRAPHIC": (("*Demographics*",), ("~", ";")),
    "DIAGNOSIS": (("*Diagnosis*",), ("~", ";")),
    "ENCOUNTER": (("*Encounter*",), ("~", ";")),
    "ENROLLMENT": (("*Enrollment*",), ("~", ";")),
    "IMMUNIZATION": (("*Immunization*",), ("~", ";")),
    "LAB_RESULT_CM": (("*Lab*",), ("~", "\t")),
    "LDS_ADDRESS_HISTORY": (("*Address*",), ("~", ",")),
    "MED_ADMIN": (("*Medadmin*", "*Med_Admin*"), ("~", ";")),
    "OBS_CLIN": (("*Clinial*", "*Clinical*"), ("~", ";")),
    "OBS_GEN": (("OBS_GEN_*.txt",), ("|",)),
    "PRESCRIBING": (("*Prescribing*",), ("~", ";")),
    "PROCEDURES": (("*Procedure*",), ("~", "\t")),
    "PROVIDER": (("*Provider*",), ("~", ";")),
    "VITAL": (("*Vital*",), ("~", ";")),
}
# Columns that one layout lacks or spells differently: {as the job reads it: as found}.
OTHER_NAMES: dict[str, dict[str, str | None]] = {
    "DIAGNOSIS": {"DX_POA": "RAW_DX_POA"},
    "ENCOUNTER": {
        "PAYER_TYPE_PRIMARY": "payor_type_primary",
        "PAYER_TYPE_SECONDARY": "payor_type_secondary",
        "RAW_PAYER_NAME_SECONDARY": "raw_payor_name_secondary",
        "RAW_PAYER_ID_SECONDARY": "raw_payor_id_secondary",
    },
    "LAB_RESULT_CM": {"LAB_RESULT_CM_ID": "LAB_RESULTS_CM_ID"},
    "OBS_CLIN": {
        "OBSCLIN_START_DATE": "OBSCLIN_DATE",
        "OBSCLIN_START_TIME": "OBSCLIN_TIME",
        "OBSCLIN_STOP_DATE": "OBSCLIN_DATE",
        "OBSCLIN_STOP_TIME": "OBSCLIN_TIME",
        "OBSCLIN_ABN_IND": None,
    },
    "OBS_GEN": {"OBSGEN_TABLE_MODIFIED": None, "OBSGEN_ID_MODIFIED": None},
}
# Values that one layout, told by its separator, takes from elsewhere.
OTHER_VALUES: dict[tuple[str, str], dict[str, Value]] = {
    ("ENCOUNTER", ";"): {"DISCHARGE_DISPOSITION": use("discharge_disposition", "DISCHARGE_DISPOSITION")},
    ("PROCEDURES", "\t"): {"PX": "PX"},
}

JOBS: dict[str, Job] = {
    "CONDITION": Job(
        source="condition",
        columns=same(
            "CONDITIONID PATID ENCOUNTERID CONDITION_STATUS CONDITION_TYPE CONDITION_SOURCE RAW_CONDITION_STATUS "
            "RAW_CONDITION_TYPE RAW_CONDITION_SOURCE RAW_CONDITION",
            CONDITION="RAW_CONDITION",
            **_dates("REPORT_DATE", "RESOLVE_DATE", "ONSET_DATE"),
        ),
    ),
    "DEATH_CAUSE": Job(
        source="death_cause",
        columns=same(
            "PATID DEATH_CAUSE_CODE DEATH_CAUSE_TYPE DEATH_CAUSE_CONFIDENCE",
            DEATH_CAUSE=use("first_eight", "DEATH_CAUSE"),
            DEATH_CAUSE_SOURCE=Const("L"),
        ),
    ),
    "DEATH": Job(
        source="death",
        columns=same("PATID DEATH_DATE_IMPUTE DEATH_SOURCE DEATH_MATCH_CONFIDENCE", **_dates("DEATH_DATE")),
    ),
    "DEMOGRAPHIC": Job(
        source="demographic",
        columns=same(
            "PATID SEX SEXUAL_ORIENTATION GENDER_IDENTITY HISPANIC RACE PAT_PREF_LANGUAGE_SPOKEN RAW_SEX "
            "RAW_SEXUAL_ORIENTATION RAW_GENDER_IDENTITY RAW_HISPANIC RAW_RACE RAW_PAT_PREF_LANGUAGE_SPOKEN",
            BIOBANK_FLAG=Const("N"),
            ZIP_CODE="ZIPCODE",
            **_dates("BIRTH_DATE"),
            **_times("BIRTH_TIME"),
        ),
    ),
    "DIAGNOSIS": Job(
        source="diagnosis",
        columns=same(
            "DIAGNOSISID PATID ENCOUNTERID ENC_TYPE PROVIDERID DX_TYPE RAW_DX_TYPE RAW_DX_SOURCE RAW_PDX",
            DX="RAW_DX",
            DX_SOURCE="RAW_DX_SOURCE",
            DX_ORIGIN=Const("OD"),
            PDX=use("principal_diagnosis", "PDX"),
            DX_POA=use("present_on_admission", "RAW_DX"),
            RAW_DX="DX",
            RAW_DX_POA="DX_POA",
            **_dates("ADMIT_DATE", "DX_DATE"),
        ),
    ),
    "ENCOUNTER": Job(
        source="encounter",
        columns=same(
            "ENCOUNTERID PATID PROVIDERID FACILITY_LOCATION FACILITYID DRG ADMITTING_SOURCE PAYER_TYPE_PRIMARY "
            "PAYER_TYPE_SECONDARY RAW_SITEID RAW_ENC_TYPE RAW_DISCHARGE_DISPOSITION RAW_DISCHARGE_STATUS RAW_DRG_TYPE "
            "RAW_ADMITTING_SOURCE RAW_FACILITY_TYPE RAW_PAYER_TYPE_PRIMARY RAW_PAYER_NAME_PRIMARY RAW_PAYER_ID_PRIMARY "
            "RAW_PAYER_TYPE_SECONDARY RAW_PAYER_NAME_SECONDARY RAW_PAYER_ID_SECONDARY COVID19_POSITIVE_FLAG VENT_FLAG "
            "ICU_FLAG",
            ENC_TYPE="RAW_ENC_TYPE",
            DISCHARGE_DISPOSITION=use("discharge_disposition", "RAW_DISCHARGE_DISPOSITION"),
            DISCHARGE_STATUS="RAW_DISCHARGE_STATUS",
            DRG_TYPE="RAW_DRG_TYPE",
            FACILITY_TYPE=Const("HOSPITAL_COMMUNITY"),
            **_dates("ADMIT_DATE", "DISCHARGE_DATE", "COVID19_POSITIVE_REPORT_DATE"),
            **_times("ADMIT_TIME", "DISCHARGE_TIME"),
        ),
    ),
    "ENROLLMENT": Job(
        source="enrollment",
        columns=same(
            "PATID CHART ENR_BASIS",
            ENR_START_DATE=use("us_date", "ENR_START_DATE"),
            ENR_END_DATE=use("us_date", "ENR_END_DATE"),
        ),
    ),
    "IMMUNIZATION": Job(
        source="immunization",
        columns=same(
            "IMMUNIZATIONID PATID ENCOUNTERID PROCEDURESID VX_PROVIDERID VX_SOURCE VX_LOT_NUM RAW_VX_NAME RAW_VX_CODE "
            "RAW_VX_CODE_TYPE RAW_VX_DOSE RAW_VX_DOSE_UNIT RAW_VX_ROUTE RAW_VX_BODY_SITE RAW_VX_STATUS "
            "RAW_VX_STATUS_REASON RAW_VX_MANUFACTURER",
            VX_CODE_TYPE="RAW_VX_CODE_TYPE",
            VX_CODE="RAW_VX_CODE",
            VX_STATUS="RAW_VX_STATUS",
            VX_STATUS_REASON="RAW_VX_STATUS_REASON",
            VX_DOSE=use("to_double_without_commas", "RAW_VX_DOSE"),
            VX_DOSE_UNIT="RAW_VX_DOSE_UNIT",
            VX_ROUTE="RAW_VX_ROUTE",
            VX_BODY_SITE="RAW_VX_BODY_SITE",
            VX_MANUFACTURER="RAW_VX_MANUFACTURER",
            **_dates("VX_RECORD_DATE", "VX_ADMIN_DATE", "VX_EXP_DATE"),
        ),
    ),
    "LAB_RESULT_CM": Job(
        source="lab_result_cm",
        columns=same(
            "LAB_RESULT_CM_ID PATID ENCOUNTERID LAB_LOINC PRIORITY RESULT_LOC LAB_PX_TYPE RESULT_SNOMED RESULT_MODIFIER "
            "RESULT_UNIT NORM_RANGE_LOW NORM_MODIFIER_LOW NORM_RANGE_HIGH NORM_MODIFIER_HIGH ABN_IND RAW_LAB_NAME "
            "RAW_LAB_CODE RAW_PANEL RAW_RESULT RAW_UNIT RAW_ORDER_DEPT RAW_FACILITY_CODE",
            SPECIMEN_SOURCE="LAB_LOINC",
            LAB_RESULT_SOURCE=Const("OD"),
            LAB_LOINC_SOURCE=Const("LM"),
            LAB_PX=use("after_pipe", "LAB_PX"),
            RESULT_DATE=use("first_date", "RESULT_DATE", "SPECIMEN_DATE", "LAB_ORDER_DATE"),
            RESULT_QUAL=use("result_qualifier", "RESULT_QUAL"),
            RESULT_NUM=use("keep_if_numeric", "RAW_RESULT"),
            **_dates("LAB_ORDER_DATE", "SPECIMEN_DATE"),
            **_times("SPECIMEN_TIME", "RESULT_TIME"),
        ),
    ),
    "LDS_ADDRESS_HISTORY": Job(
        source="lds_address_history",
        columns=same(
            "ADDRESSID PATID ADDRESS_USE ADDRESS_TYPE ADDRESS_PREFERRED ADDRESS_CITY ADDRESS_COUNTY",
            ADDRESS_STATE=use("us_state", "ADDRESS_STATE"),
            ADDRESS_ZIP5=use("zip5", "ADDRESS_ZIP5"),
            ADDRESS_ZIP9=use("zip9", "ADDRESS_ZIP9"),
            **_dates("ADDRESS_PERIOD_START", "ADDRESS_PERIOD_END"),
        ),
    ),
    "MED_ADMIN": Job(
        source="med_admin",
        columns=same(
            "MEDADMINID PATID ENCOUNTERID PRESCRIBINGID MEDADMIN_PROVIDERID MEDADMIN_TYPE MEDADMIN_CODE "
            "MEDADMIN_DOSE_ADMIN MEDADMIN_DOSE_ADMIN_UNIT MEDADMIN_ROUTE RAW_MEDADMIN_MED_NAME RAW_MEDADMIN_CODE "
            "RAW_MEDADMIN_DOSE_ADMIN RAW_MEDADMIN_DOSE_ADMIN_UNIT RAW_MEDADMIN_ROUTE",
            MEDADMIN_SOURCE=Const("OD"),
            **_dates("MEDADMIN_START_DATE", "MEDADMIN_STOP_DATE"),
            **_times("MEDADMIN_START_TIME", "MEDADMIN_STOP_TIME"),
        ),
    ),
    "OBS_CLIN": Job(
        source="obs_clin",
        columns=same(
            "OBSCLINID PATID ENCOUNTERID OBSCLIN_PROVIDERID OBSCLIN_TYPE OBSCLIN_CODE OBSCLIN_RESULT_TEXT "
            "OBSCLIN_RESULT_SNOMED OBSCLIN_RESULT_MODIFIER OBSCLIN_RESULT_UNIT OBSCLIN_SOURCE OBSCLIN_ABN_IND "
            "RAW_OBSCLIN_NAME RAW_OBSCLIN_CODE RAW_OBSCLIN_TYPE RAW_OBSCLIN_RESULT RAW_OBSCLIN_MODIFIER RAW_OBSCLIN_UNIT",
            OBSCLIN_RESULT_QUAL=use("result_qualifier", "OBSCLIN_RESULT_QUAL"),
            OBSCLIN_RESULT_NUM=use("to_double", "OBSCLIN_RESULT_NUM"),
            **_dates("OBSCLIN_START_DATE", "OBSCLIN_STOP_DATE"),
            **_times("OBSCLIN_START_TIME", "OBSCLIN_STOP_TIME"),
        ),
    ),
    "OBS_GEN": Job(
        source="obs_gen",
        columns=same(
            "OBSGENID PATID ENCOUNTERID OBSGEN_PROVIDERID OBSGEN_START_DATE OBSGEN_START_TIME OBSGEN_STOP_DATE "
            "OBSGEN_STOP_TIME OBSGEN_TYPE OBSGEN_CODE OBSGEN_RESULT_QUAL OBSGEN_RESULT_TEXT OBSGEN_RESULT_NUM "
            "OBSGEN_RESULT_MODIFIER OBSGEN_RESULT_UNIT OBSGEN_TABLE_MODIFIED OBSGEN_ID_MODIFIED OBSGEN_SOURCE "
            "OBSGEN_ABN_IND RAW_OBSGEN_NAME RAW_OBSGEN_CODE RAW_OBSGEN_TYPE RAW_OBSGEN_RESULT RAW_OBSGEN_UNIT"
        ),
    ),
    "PRESCRIBING": Job(
        source="prescribing",
        columns=same(
            "PRESCRIBINGID PATID ENCOUNTERID RX_PROVIDERID RX_PRN_FLAG RX_BASIS RX_SOURCE RAW_RX_MED_NAME RAW_RX_FREQUENCY "
            "RAW_RXNORM_CUI RAW_RX_QUANTITY RAW_RX_NDC RAW_RX_DOSE_ORDERED RAW_RX_DOSE_ORDERED_UNIT RAW_RX_ROUTE "
            "RAW_RX_REFILLS",
            RX_DOSE_ORDERED=use("keep_if_numeric", "RAW_RX_DOSE_ORDERED"),
            RX_DOSE_ORDERED_UNIT="RAW_RX_DOSE_ORDERED_UNIT",
            RX_QUANTITY=use("keep_if_numeric", "RAW_RX_QUANTITY"),
            RX_DOSE_FORM="RAW_RXNORM_CUI",
            RX_REFILLS=use("keep_if_numeric", "RAW_RX_REFILLS"),
            RX_DAYS_SUPPLY=use("keep_if_numeric", "RX_DAYS_SUPPLY"),
            RX_FREQUENCY="RAW_RX_FREQUENCY",
            RX_ROUTE="RAW_RX_ROUTE",
            RXNORM_CUI="RAW_RXNORM_CUI",
            RX_DISPENSE_AS_WRITTEN=Const("NI"),
            **_dates("RX_ORDER_DATE", "RX_START_DATE", "RX_END_DATE"),
            **_times("RX_ORDER_TIME"),
        ),
    ),
    "PROCEDURES": Job(
        source="procedures",
        columns=same(
            "PROCEDURESID PATID ENCOUNTERID ENC_TYPE PROVIDERID RAW_PX RAW_PX_TYPE RAW_PPX",
            PX="RAW_PX",
            PX_TYPE="RAW_PX_TYPE",
            PX_SOURCE=Const("OD"),
            PPX=use("principal_procedure", "RAW_PPX"),
            RENDERING_PROVIDERID=BLANK,
            **_dates("ADMIT_DATE", "PX_DATE"),
        ),
    ),
    "PROVIDER": Job(
        source="provider",
        columns=same(
            "PROVIDERID PROVIDER_SEX PROVIDER_NPI PROVIDER_NPI_FLAG RAW_PROVIDER_SPECIALTY_PRIMARY",
            PROVIDER_SPECIALTY_PRIMARY=Const("NI"),
        ),
    ),
    "VITAL": Job(
        source="vital",
        columns=same(
            "VITALID PATID ENCOUNTERID VITAL_SOURCE BP_POSITION SMOKING TOBACCO TOBACCO_TYPE RAW_DIASTOLIC RAW_SYSTOLIC "
            "RAW_BP_POSITION RAW_SMOKING RAW_TOBACCO RAW_TOBACCO_TYPE",
            **_numbers("HT", "WT", "DIASTOLIC", "SYSTOLIC", "ORIGINAL_BMI"),
            **_dates("MEASURE_DATE"),
            **_times("MEASURE_TIME"),
        ),
    ),
}


def layouts(table: str) -> list[Layout]:
    """The layouts of a table's files; its key column, under either name, proves the separator."""
    key = next(iter(JOBS[table].columns))
    names = OTHER_NAMES.get(table, {})
    keys = [k for k in (key, names.get(key)) if k]
    return [Layout(sep, (k,), names) for sep in FILES[table][1] for k in keys]


def read(spark: SparkSession, table: str, folder: str) -> list[tuple[DataFrame, Layout]]:
    """All files of a table in a folder, whichever of its patterns they match, by the layout that fits their header."""
    declared, found = layouts(table), {}
    for path in list_files(spark, [f"{folder}/{pattern}" for pattern in FILES[table][0]]):
        found.setdefault(declared.index(choose_layout(spark, path, declared)), []).append(path)
    return [(read_layout(spark, paths, declared[k]), declared[k]) for k, paths in sorted(found.items())]


def read_and_run(spark: SparkSession, table: str, folder: str) -> DataFrame:
    """The formatted table of all files in a folder."""
    return union_all([run(table, df, layout.sep) for df, layout in read(spark, table, folder)])


def run(table: str, df: DataFrame, sep: str = "~") -> DataFrame:
    job = JOBS[table]
    return run_job(override(job, **OTHER_VALUES.get((table, sep), {})), {job.source: df})
