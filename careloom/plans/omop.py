"""Format jobs for OMOP 5.3 extracts with supplement tables and the CONCEPT vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame

from careloom.operators.collapse import collapse_first
from careloom.plans.spec import BLANK, Const, Job, Lookup, run_job, use

# Condition types that are problem-list entries.
PROBLEM_LIST_TYPES = "('32840', '32865', '38000245')"
PRIMARY_PAYER = "payer_type IN ('Primary', 'primary', 'Primary Payer', 'Primary payer')"
SECONDARY_PAYER = "payer_type IN ('Secondary', 'secondary', 'Secondary Payer', 'Secondary payer')"

# Concepts of vital signs.
HEIGHT = (
    "37020737 3035463 3036277 3036798 3013842 3014149 3008989 3015514 1003232 1003304 1029031 3023540 3019171 "
    "36304231 37020651 1003850"
).split()
WEIGHT = (
    "3003176 3002072 3020933 3020110 3005565 3004464 3002756 3001647 3023704 3037845 3033534 3033528 3021838 3001912 "
    "3000749 3033350 3034205 3034737 3022724 3013673 3011956 3017459 3018298 3035618 3036221 3009664 3012860 3018372 "
    "3008484 3022484 3013747 40761330 3013853 3011043 3026659 3027492 3010914 3028543 3009617 3010147 3015644 3019336 "
    "3022281 3005422 3010220 3011054 21492642 3026600 3013131 3042378 40759177 40759213 40759214 43533987 36305329 "
    "1029318 3025315 40760186 3043735 3046620 3046286 3046309 3046001 3028871 3029459 3028864 46234683 1003088 1003261 "
    "1003206 3014618 3015141 3008900 3007541 3014140 3008128 3015512 3016054 3016341 3008303 3013762 3023166 40771967 "
    "40771968 1003642 1004141 1004122"
).split()
DIASTOLIC = "3034703 3019962 3013940 3012888".split()
SYSTOLIC = "3018586 3035856 3009395 3004249".split()
BODY_MASS = "40762636 3038553 45581059 45600349 45552098 45600350".split()
SMOKING = (
    "3477063 3465894 3466598 3171662 4132133 4218197 4282779 4005823 3434950 3422059 762498 762500 45765920 4218741 "
    "3323369 4224317 3235632 3450269"
).split()


def concept(key: str, where: str, take: dict[str, str], how: str = "left") -> Lookup:
    """A lookup in the vocabulary, restricted to one role."""
    return Lookup("concept", on=(key, "concept_id"), take=take, where=where, how=how)


def domain(name: str) -> str:
    return f"domain_id = '{name}'"


def supplement(table: str, key: str, *names: str) -> Lookup:
    return Lookup(f"{table}_sup", on=(key, key), take={n: n for n in names})


def visit(**take: str) -> Lookup:
    return Lookup("visit_occurrence", on=("visit_occurrence_id", "visit_occurrence_id"), take=take)


def payer(rank: str, rows: str) -> Lookup:
    take = {f"{rank}_type": "payer_type", f"{rank}_class": "plan_class", f"{rank}_name": "plan_name", f"{rank}_id": "visit_payer_id"}
    return Lookup("visit_payer", on=("visit_occurrence_id", "visit_occurrence_id"), take=take, where=rows)


DRUG = concept(
    "drug_concept_id",
    domain("Drug"),
    {"drug_name": "concept_name", "drug_vocabulary": "vocabulary_id", "drug_code": "concept_code"},
)
ROUTE = concept("route_concept_id", domain("Route"), {"route_name": "concept_name"})
UNIT = concept("unit_concept_id", domain("Unit"), {"unit_code": "concept_code"})
VALUE = concept("value_as_concept_id", domain("Meas Value"), {"value_code": "concept_code"})
OPERATOR = concept("operator_concept_id", domain("Meas Value Operator"), {"operator_name": "concept_name"})
GENDER = concept("gender_concept_id", domain("Gender"), {"gender_code": "concept_code"})
DRUG_SUP = supplement(
    "drug_exposure", "drug_exposure_id", "dose", "rx_frequency", "drug_exposure_record_date", "vx_status",
    "vx_status_reason", "vx_manufatcurer", "body_site_source_value", "procedure_occurrence_id",
)
MEASUREMENT_SUP = supplement(
    "measurement", "measurement_id", "measurement_order_date", "measurement_loinc_source", "priority"
)
DEATH_SUP = supplement(
    "death", "person_id", "death_date_impute", "death_match_confidence", "death_cause_source", "death_cause_confidence"
)


def measured(clinical: bool) -> Lookup:
    test = "=" if clinical else "<>"
    return concept(
        "measurement_concept_id",
        f"{domain('Measurement')} AND concept_class_id {test} 'Clinical Observation'",
        {"measure_code": "concept_code", "measure_name": "concept_name", "measure_vocabulary": "vocabulary_id"},
        how="inner",
    )


def exposure_type(rows: str) -> Lookup:
    return concept("drug_type_concept_id", rows, {"exposure_type": "concept_name"}, how="inner")


TOKENS = [*range(1, 10), 12, *range(14, 19), *range(23, 27), 29, 30, *range(101, 112)]

JOBS: dict[str, Job] = {
    "CONDITION": Job(
        source="condition_occurrence",
        where=f"condition_type_concept_id IN {PROBLEM_LIST_TYPES}",
        lookups=(
            visit(visit_id="visit_occurrence_id", visit_start="visit_start_date"),
            concept(
                "condition_concept_id",
                domain("Condition"),
                {"code": "concept_code", "name": "concept_name", "vocabulary": "vocabulary_id"},
            ),
            concept("condition_type_concept_id", domain("Type Concept"), {"type_name": "concept_name"}),
        ),
        columns={
            "CONDITIONID": "condition_occurrence_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_id",
            "REPORT_DATE": use("format_date", "visit_start"),
            "RESOLVE_DATE": use("format_date", "condition_end_date"),
            "ONSET_DATE": use("format_date", "condition_start_date"),
            "CONDITION_STATUS": use("condition_status", "condition_end_date"),
            "CONDITION": "code",
            "CONDITION_TYPE": "vocabulary",
            "CONDITION_SOURCE": Const("HC"),
            "RAW_CONDITION_STATUS": use("condition_status", "condition_end_date"),
            "RAW_CONDITION": "name",
            "RAW_CONDITION_TYPE": "vocabulary",
            "RAW_CONDITION_SOURCE": "type_name",
        },
    ),
    "DEATH_CAUSE": Job(
        source="death",
        lookups=(
            DEATH_SUP,
            concept(
                "cause_concept_id",
                domain("Observation"),
                {"cause_name": "concept_name", "cause_code": "concept_code", "cause_type": "vocabulary_id"},
            ),
        ),
        columns={
            "PATID": "person_id",
            "DEATH_CAUSE": "cause_name",
            "DEATH_CAUSE_CODE": "cause_code",
            "DEATH_CAUSE_TYPE": "cause_type",
            "DEATH_CAUSE_SOURCE": "death_cause_source",
            "DEATH_CAUSE_CONFIDENCE": "death_cause_confidence",
        },
    ),
    "DEATH": Job(
        source="death",
        lookups=(DEATH_SUP, concept("death_type_concept_id", domain("Type Concept"), {"source_name": "concept_name"})),
        columns={
            "PATID": "person_id",
            "DEATH_DATE": "death_date",
            "DEATH_DATE_IMPUTE": "death_date_impute",
            "DEATH_SOURCE": "source_name",
            "DEATH_MATCH_CONFIDENCE": "death_match_confidence",
        },
    ),
    "DEMOGRAPHIC": Job(
        source="person",
        lookups=(
            GENDER,
            concept("ethnicity_concept_id", domain("Ethnicity"), {"ethnicity_code": "concept_code"}),
            concept("race_concept_id", domain("Race"), {"race_code": "concept_code"}),
            supplement(
                "person", "person_id", "sex", "sex_source_value", "sexual_orientation",
                "sexual_orientation_source_value", "spoken_language", "spoken_language_source_value",
            ),
        ),
        columns={
            "PATID": "person_id",
            "BIRTH_DATE": use("format_date", "birth_datetime"),
            "BIRTH_TIME": use("format_time", "birth_datetime"),
            "SEX": "gender_code",
            "SEXUAL_ORIENTATION": "sexual_orientation",
            "GENDER_IDENTITY": "sex",
            "HISPANIC": "ethnicity_code",
            "RACE": "race_code",
            "BIOBANK_FLAG": Const("N"),
            "PAT_PREF_LANGUAGE_SPOKEN": "spoken_language",
            "RAW_SEX": "sex_source_value",
            "RAW_SEXUAL_ORIENTATION": "sexual_orientation_source_value",
            "RAW_GENDER_IDENTITY": "gender_source_value",
            "RAW_HISPANIC": "ethnicity_source_value",
            "RAW_RACE": "race_source_value",
            "RAW_PAT_PREF_LANGUAGE_SPOKEN": "spoken_language_source_value",
            "ZIP_CODE": BLANK,
        },
    ),
    "DIAGNOSIS": Job(
        source="condition_occurrence",
        where=f"condition_type_concept_id NOT IN {PROBLEM_LIST_TYPES}",
        lookups=(
            visit(
                visit_id="visit_occurrence_id", visit_start="visit_start_date", visit_provider="provider_id",
                visit_concept_id="visit_concept_id",
            ),
            concept(
                "condition_concept_id",
                domain("Condition"),
                {"code": "concept_code", "name": "concept_name", "vocabulary": "vocabulary_id"},
            ),
            concept("condition_type_concept_id", domain("Type Concept"), {"origin_name": "concept_name"}),
            concept("visit_concept_id", domain("Visit"), {"visit_name": "concept_name"}),
            supplement("condition_occurrence", "condition_occurrence_id", "poa"),
        ),
        columns={
            "DIAGNOSISID": "condition_occurrence_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_id",
            "ENC_TYPE": "visit_name",
            "ADMIT_DATE": use("format_date", "visit_start"),
            "PROVIDERID": "visit_provider",
            "DX": "code",
            "DX_TYPE": "vocabulary",
            "DX_DATE": use("format_date", "condition_start_date"),
            "DX_SOURCE": "condition_status_source_value",
            "DX_ORIGIN": "origin_name",
            "PDX": BLANK,
            "DX_POA": "poa",
            "RAW_DX": "name",
            "RAW_DX_TYPE": "vocabulary",
            "RAW_DX_SOURCE": "condition_status_source_value",
            "RAW_PDX": BLANK,
            "RAW_DX_POA": "poa",
        },
    ),
    "DISPENSING": Job(
        source="drug_exposure",
        lookups=(exposure_type(f"{domain('Type Concept')} AND lower(concept_name) LIKE '%dispens%'"), DRUG, DRUG_SUP),
        columns={
            "DISPENSINGID": "drug_exposure_id",
            "PATID": "person_id",
            "PRESCRIBINGID": BLANK,
            "DISPENSE_DATE": use("format_date", "drug_exposure_start_date"),
            "NDC": "drug_code",
            "DISPENSE_SOURCE": Const("OD"),
            "DISPENSE_SUP": BLANK,
            "DISPENSE_AMT": "quantity",
            "DISPENSE_DOSE_DISP": "dose",
            "DISPENSE_DOSE_DISP_UNIT": "dose_unit_source_value",
            "DISPENSE_ROUTE": "sig",
            "RAW_NDC": "drug_code",
            "RAW_DISPENSE_DOSE_DISP": "dose",
            "RAW_DISPENSE_DOSE_DISP_UNIT": "dose_unit_source_value",
            "RAW_DISPENSE_ROUTE": "sig",
            "RAW_NDC_CODE": "drug_code",
            "RAW_RXNORM_CODE": "drug_code",
        },
    ),
    "ENCOUNTER": Job(
        source="visit_occurrence",
        lookups=(
            concept("visit_concept_id", domain("Visit"), {"visit_name": "concept_name"}),
            supplement("visit_occurrence", "visit_occurrence_id", "drg", "discharge_status"),
            payer("primary", PRIMARY_PAYER),
            payer("secondary", SECONDARY_PAYER),
            Lookup(
                "care_site",
                on=("care_site_id", "care_site_id"),
                take={"place_of_service": "place_of_service_source_value", "site_location": "location_id"},
            ),
            Lookup("location", on=("site_location", "location_id"), take={"facility_zip": "zip"}),
            concept("admitting_source_concept_id", domain("Place of service"), {"admitting_name": "concept_name"}),
            concept("discharge_to_concept_id", domain("Place of service"), {"discharge_name": "concept_name"}),
        ),
        columns={
            "ENCOUNTERID": "visit_occurrence_id",
            "PATID": "person_id",
            "ADMIT_DATE": use("format_date", "visit_start_date"),
            "ADMIT_TIME": use("format_time", "visit_start_datetime"),
            "DISCHARGE_DATE": use("format_date", "visit_end_date"),
            "DISCHARGE_TIME": use("time_by_position", "visit_end_datetime"),
            "PROVIDERID": "provider_id",
            "FACILITY_LOCATION": "facility_zip",
            "ENC_TYPE": "visit_name",
            "FACILITYID": "care_site_id",
            "DISCHARGE_DISPOSITION": "discharge_status",
            "DISCHARGE_STATUS": "discharge_to_source_value",
            "DRG": "drg",
            "DRG_TYPE": use("drg_version", "visit_start_date"),
            "ADMITTING_SOURCE": "admitting_name",
            "PAYER_TYPE_PRIMARY": "primary_type",
            "PAYER_TYPE_SECONDARY": "secondary_type",
            "FACILITY_TYPE": "place_of_service",
            "RAW_SITEID": "care_site_id",
            "RAW_ENC_TYPE": "visit_name",
            "RAW_DISCHARGE_DISPOSITION": "discharge_status",
            "RAW_DISCHARGE_STATUS": "discharge_name",
            "RAW_DRG_TYPE": use("drg_label", "visit_start_date"),
            "RAW_ADMITTING_SOURCE": "admitting_source_value",
            "RAW_FACILITY_TYPE": "care_site_id",
            "RAW_PAYER_TYPE_PRIMARY": "primary_class",
            "RAW_PAYER_NAME_PRIMARY": "primary_name",
            "RAW_PAYER_ID_PRIMARY": "primary_id",
            "RAW_PAYER_TYPE_SECONDARY": "secondary_class",
            "RAW_PAYER_NAME_SECONDARY": "secondary_name",
            "RAW_PAYER_ID_SECONDARY": "secondary_id",
        },
    ),
    "ENROLLMENT": Job(
        source="observation_period",
        lookups=(supplement("observation_period", "observation_period_id", "chart", "enrollment_basis"),),
        columns={
            "PATID": "person_id",
            "ENR_START_DATE": "observation_period_start_date",
            "ENR_END_DATE": "observation_period_end_date",
            "CHART": "chart",
            "ENR_BASIS": "enrollment_basis",
        },
    ),
    "HASH_TOKEN": Job(
        source="hash_token",
        columns={
            "PATID": "pat_id",
            **{f"TOKEN_{n:02d}": f"token_{n}" for n in TOKENS},
            "TOKEN_ENCRYPTION_KEY": "token_encryption_key",
        },
    ),
    "IMMUNIZATION": Job(
        source="drug_exposure",
        lookups=(
            concept(
                "drug_concept_id",
                "vocabulary_id = 'CVX'",
                {"vaccine_name": "concept_name", "vaccine_vocabulary": "vocabulary_id", "vaccine_code": "concept_code"},
                how="inner",
            ),
            DRUG_SUP,
            ROUTE,
        ),
        columns={
            "IMMUNIZATIONID": "drug_exposure_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_occurrence_id",
            "PROCEDURESID": "procedure_occurrence_id",
            "VX_PROVIDERID": "provider_id",
            "VX_RECORD_DATE": use("format_date", "drug_exposure_record_date"),
            "VX_ADMIN_DATE": use("format_date", "drug_exposure_start_date"),
            "VX_CODE_TYPE": "vaccine_vocabulary",
            "VX_CODE": "vaccine_code",
            "VX_STATUS": "vx_status",
            "VX_STATUS_REASON": "vx_status_reason",
            "VX_SOURCE": Const("DR"),
            "VX_DOSE": "days_supply",
            "VX_DOSE_UNIT": "dose_unit_source_value",
            "VX_ROUTE": "route_concept_id",
            "VX_BODY_SITE": "body_site_source_value",
            "VX_MANUFACTURER": "vx_manufatcurer",
            "VX_LOT_NUM": "lot_number",
            "VX_EXP_DATE": use("format_date", "drug_exposure_end_date"),
            "RAW_VX_NAME": "vaccine_name",
            "RAW_VX_CODE": "vaccine_code",
            "RAW_VX_CODE_TYPE": "vaccine_vocabulary",
            "RAW_VX_DOSE": "days_supply",
            "RAW_VX_DOSE_UNIT": "dose_unit_source_value",
            "RAW_VX_ROUTE": "route_source_value",
            "RAW_VX_BODY_SITE": "body_site_source_value",
            "RAW_VX_STATUS": "vx_status",
            "RAW_VX_STATUS_REASON": "vx_status_reason",
            "RAW_VX_MANUFACTURER": "vx_manufatcurer",
        },
    ),
    "LAB_RESULT_CM": Job(
        source="measurement",
        lookups=(measured(clinical=False), MEASUREMENT_SUP, VALUE, OPERATOR, UNIT),
        columns={
            "LAB_RESULT_CM_ID": "measurement_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_occurrence_id",
            "SPECIMEN_SOURCE": "measure_code",
            "LAB_LOINC": "measure_code",
            "LAB_RESULT_SOURCE": Const("OD"),
            "LAB_LOINC_SOURCE": "measurement_loinc_source",
            "PRIORITY": "priority",
            "RESULT_LOC": use("lab_location", "measure_code", prefix="POC", missing="L"),
            "LAB_PX": BLANK,
            "LAB_PX_TYPE": BLANK,
            "LAB_ORDER_DATE": use("format_date", "measurement_order_date"),
            "SPECIMEN_DATE": use("format_date", "measurement_date"),
            "SPECIMEN_TIME": use("format_time", "measurement_datetime"),
            "RESULT_DATE": use("format_date", "measurement_date"),
            "RESULT_TIME": use("format_time", "measurement_datetime"),
            "RESULT_QUAL": "value_code",
            "RESULT_SNOMED": BLANK,
            "RESULT_NUM": "value_as_number",
            "RESULT_MODIFIER": "operator_name",
            "RESULT_UNIT": "unit_code",
            "NORM_RANGE_LOW": "range_low",
            "NORM_MODIFIER_LOW": "operator_name",
            "NORM_RANGE_HIGH": "range_high",
            "NORM_MODIFIER_HIGH": "operator_name",
            "ABN_IND": BLANK,
            "RAW_LAB_NAME": "measure_name",
            "RAW_LAB_CODE": "measurement_source_value",
            "RAW_PANEL": BLANK,
            "RAW_RESULT": "value_source_value",
            "RAW_UNIT": "unit_source_value",
            "RAW_ORDER_DEPT": BLANK,
            "RAW_FACILITY_CODE": BLANK,
        },
    ),
    "LDS_ADDRESS_HISTORY": Job(
        source="address",
        lookups=(
            Lookup(
                "location", on=("location_id", "location_id"), take={"city": "city", "state": "state", "zip": "zip"}
            ),
        ),
        columns={
            "ADDRESSID": "address_id",
            "PATID": "person_id",
            "ADDRESS_USE": "address_use",
            "ADDRESS_TYPE": "address_type",
            "ADDRESS_PREFERRED": "address_preferred",
            "ADDRESS_CITY": "city",
            "ADDRESS_STATE": "state",
            "ADDRESS_ZIP5": "zip",
            "ADDRESS_ZIP9": BLANK,
            "ADDRESS_COUNTY": BLANK,
            "ADDRESS_PERIOD_START": "address_period_start",
            "ADDRESS_PERIOD_END": "address_period_end",
        },
    ),
    "MED_ADMIN": Job(
        source="drug_exposure",
        lookups=(
            exposure_type("concept_class_id = 'Drug Type' AND lower(concept_name) LIKE '%admin%'"), DRUG, DRUG_SUP, ROUTE,
        ),
        columns={
            "MEDADMINID": "drug_exposure_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_occurrence_id",
            "PRESCRIBINGID": BLANK,
            "MEDADMIN_PROVIDERID": "provider_id",
            "MEDADMIN_START_DATE": "drug_exposure_start_date",
            "MEDADMIN_START_TIME": use("format_time", "drug_exposure_start_datetime"),
            "MEDADMIN_STOP_DATE": "drug_exposure_end_date",
            "MEDADMIN_STOP_TIME": use("format_time", "drug_exposure_end_datetime"),
            "MEDADMIN_TYPE": "drug_vocabulary",
            "MEDADMIN_CODE": "drug_code",
            "MEDADMIN_DOSE_ADMIN": "days_supply",
            "MEDADMIN_DOSE_ADMIN_UNIT": "dose_unit_source_value",
            "MEDADMIN_ROUTE": "route_name",
            "MEDADMIN_SOURCE": Const("OD"),
            "RAW_MEDADMIN_MED_NAME": "drug_name",
            "RAW_MEDADMIN_CODE": "drug_source_value",
            "RAW_MEDADMIN_DOSE_ADMIN": "days_supply",
            "RAW_MEDADMIN_DOSE_ADMIN_UNIT": "dose_unit_source_value",
            "RAW_MEDADMIN_ROUTE": "route_source_value",
        },
    ),
    "OBS_CLIN": Job(
        source="measurement",
        lookups=(measured(clinical=True), MEASUREMENT_SUP, VALUE, OPERATOR, UNIT),
        columns={
            "OBSCLINID": "measurement_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_occurrence_id",
            "OBSCLIN_PROVIDERID": "provider_id",
            "OBSCLIN_START_DATE": use("format_date", "measurement_date"),
            "OBSCLIN_START_TIME": use("format_time", "measurement_datetime"),
            "OBSCLIN_STOP_DATE": use("format_date", "measurement_date"),
            "OBSCLIN_STOP_TIME": use("format_time", "measurement_datetime"),
            "OBSCLIN_TYPE": "measure_vocabulary",
            "OBSCLIN_CODE": "measure_code",
            "OBSCLIN_RESULT_QUAL": "value_code",
            "OBSCLIN_RESULT_TEXT": "measure_code",
            "OBSCLIN_RESULT_SNOMED": "measure_code",
            "OBSCLIN_RESULT_NUM": "value_as_number",
            "OBSCLIN_RESULT_MODIFIER": "operator_name",
            "OBSCLIN_RESULT_UNIT": "unit_code",
            "OBSCLIN_SOURCE": Const("OD"),
            "OBSCLIN_ABN_IND": BLANK,
            "RAW_OBSCLIN_NAME": "measure_code",
            "RAW_OBSCLIN_CODE": "measure_code",
            "RAW_OBSCLIN_TYPE": "measure_vocabulary",
            "RAW_OBSCLIN_RESULT": use("dash_join", "measure_code", "value_as_number"),
            "RAW_OBSCLIN_MODIFIER": "operator_name",
            "RAW_OBSCLIN_UNIT": "unit_source_value",
        },
    ),
    "OBS_GEN": Job(
        source="observation",
        lookups=(
            concept(
                "observation_concept_id",
                domain("Observation"),
                {"code": "concept_code", "vocabulary": "vocabulary_id"},
            ),
            supplement("observation", "observation_id", "observation_data_origin", "abn_ind"),
            UNIT,
        ),
        columns={
            "OBSGENID": "observation_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_occurrence_id",
            "OBSGEN_PROVIDERID": "provider_id",
            "OBSGEN_START_DATE": use("format_date", "observation_start_date"),
            "OBSGEN_START_TIME": use("format_time", "observation_start_datetime"),
            "OBSGEN_STOP_DATE": use("format_date", "observation_start_date"),
            "OBSGEN_STOP_TIME": use("format_time", "observation_start_datetime"),
            "OBSGEN_TYPE": "vocabulary",
            "OBSGEN_CODE": "code",
            "OBSGEN_RESULT_QUAL": "qualifier_source_value",
            "OBSGEN_RESULT_TEXT": "code",
            "OBSGEN_RESULT_SNOMED": "code",
            "OBSGEN_RESULT_NUM": "value_as_number",
            "OBSGEN_RESULT_MODIFIER": "qualifier_source_value",
            "OBSGEN_RESULT_UNIT": "unit_code",
            "OBSGEN_TABLE_MODIFIED": BLANK,
            "OBSGEN_ID_MODIFIED": BLANK,
            "OBSGEN_SOURCE": "observation_data_origin",
            "OBSGEN_ABN_IND": "abn_ind",
            "RAW_OBSGEN_NAME": "code",
            "RAW_OBSGEN_CODE": "code",
            "RAW_OBSGEN_TYPE": "vocabulary",
            "RAW_OBSGEN_RESULT": use("dash_join", "value_as_string", "value_as_number"),
            "RAW_OBSGEN_MODIFIER": "qualifier_source_value",
            "RAW_OBSGEN_UNIT": "unit_source_value",
        },
    ),
    "PRESCRIBING": Job(
        source="drug_exposure",
        lookups=(
            exposure_type(f"{domain('Type Concept')} AND lower(concept_name) LIKE '%prescri%'"), DRUG, DRUG_SUP, ROUTE,
        ),
        columns={
            "PRESCRIBINGID": "drug_exposure_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_occurrence_id",
            "RX_PROVIDERID": "provider_id",
            "RX_ORDER_DATE": "drug_exposure_start_date",
            "RX_ORDER_TIME": use("format_time", "drug_exposure_start_datetime"),
            "RX_START_DATE": "drug_exposure_start_date",
            "RX_END_DATE": "drug_exposure_end_date",
            "RX_DOSE_ORDERED": "days_supply",
            "RX_DOSE_ORDERED_UNIT": "dose_unit_source_value",
            "RX_QUANTITY": use("to_double_without_commas", "quantity"),
            "RX_DOSE_FORM": "drug_code",
            "RX_REFILLS": "refills",
            "RX_DAYS_SUPPLY": "days_supply",
            "RX_FREQUENCY": "rx_frequency",
            "RX_PRN_FLAG": "sig",
            "RX_ROUTE": "route_name",
            "RX_BASIS": "drug_vocabulary",
            "RXNORM_CUI": "drug_code",
            "RX_SOURCE": Const("OD"),
            "RX_DISPENSE_AS_WRITTEN": Const("OD"),
            "RAW_RX_MED_NAME": "drug_name",
            "RAW_RX_FREQUENCY": "rx_frequency",
            "RAW_RXNORM_CUI": "drug_code",
            "RAW_RX_QUANTITY": "quantity",
            "RAW_RX_NDC": "drug_code",
            "RAW_RX_DOSE_ORDERED": "days_supply",
            "RAW_RX_DOSE_ORDERED_UNIT": "dose_unit_source_value",
            "RAW_RX_ROUTE": "route_source_value",
            "RAW_RX_REFILLS": "refills",
        },
    ),
    "PROCEDURES": Job(
        source="procedure_occurrence",
        lookups=(
            concept(
                "procedure_concept_id",
                domain("Procedure"),
                {"code": "concept_code", "vocabulary": "vocabulary_id"},
            ),
            visit(visit_start="visit_start_date", visit_concept_id="visit_concept_id"),
            concept("visit_concept_id", domain("Visit"), {"visit_name": "concept_name"}),
        ),
        columns={
            "PROCEDURESID": "procedure_occurrence_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_occurrence_id",
            "ENC_TYPE": "visit_name",
            "ADMIT_DATE": use("format_date", "visit_start"),
            "PROVIDERID": "provider_id",
            "PX_DATE": use("format_date", "procedure_date"),
            "PX": "code",
            "PX_TYPE": "vocabulary",
            "PX_SOURCE": Const("OD"),
            "PPX": BLANK,
            "RAW_PX": "procedure_source_value",
            "RAW_PX_TYPE": "vocabulary",
            "RAW_PPX": BLANK,
        },
    ),
    "PROVIDER": Job(
        source="provider",
        lookups=(
            Lookup("provider_sup", on=("provider_id", "provider_id"), take={"provider_note": "provider_id"}),
            concept(
                "specialty_concept_id",
                f"{domain('Provider')} AND vocabulary_id = 'NUCC'",
                {"specialty_code": "concept_code"},
            ),
            GENDER,
        ),
        columns={
            "PROVIDERID": "provider_id",
            "PROVIDER_SEX": "gender_code",
            "PROVIDER_SPECIALTY_PRIMARY": "specialty_code",
            "PROVIDER_NPI": "npi",
            "PROVIDER_NPI_FLAG": use("npi_flag", "npi"),
            "RAW_PROVIDER_SPECIALTY_PRIMARY": "specialty_source_value",
        },
    ),
}


def id_list(values: list[str]) -> str:
    return "('" + "', '".join(values) + "')"


VITAL_SIGNS = {"HT": HEIGHT, "WT": WEIGHT, "DIASTOLIC": DIASTOLIC, "SYSTOLIC": SYSTOLIC, "ORIGINAL_BMI": BODY_MASS}
VITAL_KEYS = ("ENCOUNTERID", "PATID")
VITAL_ORDER = ("MEASURE_DATE", "MEASURE_TIME", "VITALID")
NOTHING = "CAST(NULL AS STRING)"


def _vital(source: str, stem: str, date: str) -> Job:
    """One part of VITAL: the columns that differ from row to row."""
    return Job(
        source=source,
        columns={
            "VITALID": f"{stem}_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_occurrence_id",
            "MEASURE_DATE": use("format_date", f"{date}_date"),
            "MEASURE_TIME": use("format_time", f"{date}_datetime"),
            **{n: n for n in (*VITAL_SIGNS, "SMOKING")},
        },
    )


VITAL_FROM_MEASUREMENT = _vital("signs", "measurement", "measurement")
VITAL_FROM_OBSERVATION = _vital("smoking", "observation", "observation_start")
# What the collapsed row is made into: copies of a value, and columns this source never fills.
VITAL_COLUMNS = {
    **{n: n for n in ("VITALID", "PATID", "ENCOUNTERID", "MEASURE_DATE", "MEASURE_TIME")},
    "VITAL_SOURCE": "'OD'",
    **{n: n for n in VITAL_SIGNS},
    "BP_POSITION": NOTHING,
    "SMOKING": "SMOKING",
    "TOBACCO": "SMOKING",
    "TOBACCO_TYPE": NOTHING,
    "RAW_DIASTOLIC": "DIASTOLIC",
    "RAW_SYSTOLIC": "SYSTOLIC",
    "RAW_BP_POSITION": NOTHING,
    "RAW_SMOKING": "SMOKING",
    "RAW_TOBACCO": "SMOKING",
    "RAW_TOBACCO_TYPE": NOTHING,
}


def vital(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per (encounter, patient) from the vital signs and smoking answers recorded there."""
    every = [i for ids in VITAL_SIGNS.values() for i in ids]
    signs = tables["measurement"].where(f"trim(measurement_concept_id) IN {id_list(every)}").selectExpr(
        "*",
        *[f"CASE WHEN trim(measurement_concept_id) IN {id_list(ids)} THEN value_as_number END AS {n}" for n, ids in VITAL_SIGNS.items()],
        f"{NOTHING} AS SMOKING",
    )
    smoking = tables["observation"].where(f"trim(observation_concept_id) IN {id_list(SMOKING)}").selectExpr(
        "*", *[f"{NOTHING} AS {n}" for n in VITAL_SIGNS], "value_as_string AS SMOKING"
    )
    parts = {"signs": signs, "smoking": smoking}
    rows = run_job(VITAL_FROM_MEASUREMENT, parts).unionByName(run_job(VITAL_FROM_OBSERVATION, parts))
    one = collapse_first(rows, VITAL_KEYS, VITAL_ORDER)
    return one.selectExpr(*[f"{e} AS {n}" for n, e in VITAL_COLUMNS.items()])


def run(table: str, tables: dict[str, DataFrame]) -> DataFrame:
    return vital(tables) if table == "VITAL" else run_job(JOBS[table], tables)


TABLES = (*JOBS, "VITAL")
