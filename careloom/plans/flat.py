"""Format jobs for flat, already decoded clinical extracts (one file per domain)."""

from __future__ import annotations

from careloom.plans.spec import BLANK, Const, Job, Lookup, use

# Which rows of a shared file belong to which table.
PROBLEM_LIST = "condition_data_origin IN ('EHR problem list entry')"
ENCOUNTER_DIAGNOSES = "condition_data_origin IN ('Primary Condition', 'Secondary Condition')"
IMMUNIZATIONS = "drug_code_type IN ('CVX')"
ADMINISTERED = (
    "drug_type IN ('Inpatient Administration', 'Inpatient administration', 'Inpatient', 'Medication list entry', "
    "'Physician administered drug (identified from EHR order)')"
)
PRESCRIBED = "drug_type IN ('Prescription written', 'Prescription', 'Home-Med', 'Prescription dispensed in pharmacy')"
FROM_MEASUREMENT = "observation_data_origin IN ('Observation from Measurement', 'Observation from measurement')"
FROM_RECORD = "observation_data_origin IN ('Observation recorded from EHR')"
PRIMARY_PAYER = "payer_type IN ('Primary', 'primary', 'Primary Payer')"
SECONDARY_PAYER = "payer_type IN ('Secondary', 'secondary', 'Secondary Payer')"

VISIT = Lookup(
    "visit_occurrence",
    on=("visit_occurrence_id", "visit_occurrence_id"),
    take={"visit_type": "visit_type", "admit_date": "visit_start_date"},
    last_by=("visit_start_date", "visit_type"),
)


def _payer(rank: str, rows: str) -> Lookup:
    return Lookup(
        "visit_payer",
        on=("visit_occurrence_id", "visit_occurrence_id"),
        take={f"{rank}_class": "plan_class", f"{rank}_name": "plan_name", f"{rank}_id": "visit_payer_id"},
        where=rows,
        last_by=("visit_payer_id", "plan_class", "plan_name"),
    )


JOBS: dict[str, Job] = {
    "CONDITION": Job(
        source="condition_occurrence",
        where=PROBLEM_LIST,
        columns={
            "CONDITIONID": "condition_occurrence_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_occurrence_id",
            "REPORT_DATE": "condition_start_date",
            "RESOLVE_DATE": "condition_end_date",
            "ONSET_DATE": BLANK,
            "CONDITION_STATUS": use("condition_status", "condition_end_date"),
            "CONDITION": "condition_code",
            "CONDITION_TYPE": "condition_code_type",
            "CONDITION_SOURCE": Const("HC"),
            "RAW_CONDITION_STATUS": "condition_status",
            "RAW_CONDITION": "condition_code",
            "RAW_CONDITION_TYPE": "condition_code",
            "RAW_CONDITION_SOURCE": "poa",
        },
    ),
    "DEATH": Job(
        source="death",
        columns={
            "PATID": "person_id",
            "DEATH_DATE": "death_date",
            "DEATH_DATE_IMPUTE": "death_date_input",
            "DEATH_SOURCE": "death_date_origin",
            "DEATH_MATCH_CONFIDENCE": BLANK,
        },
    ),
    "DEMOGRAPHIC": Job(
        source="person",
        columns={
            "PATID": "person_id",
            "BIRTH_DATE": use("date_of_datetime", "birth_datetime"),
            "BIRTH_TIME": use("time_of_datetime", "birth_datetime"),
            "SEX": "sex",
            "SEXUAL_ORIENTATION": "sexual_orientation",
            "GENDER_IDENTITY": "sex",
            "HISPANIC": "ethnicity_source_value",
            "RACE": "race",
            "BIOBANK_FLAG": Const("N"),
            "PAT_PREF_LANGUAGE_SPOKEN": "spoken_language",
            "RAW_SEX": "sex",
            "RAW_SEXUAL_ORIENTATION": BLANK,
            "RAW_GENDER_IDENTITY": BLANK,
            "RAW_HISPANIC": "ethnicity_source_value",
            "RAW_RACE": "race_source_value",
            "RAW_PAT_PREF_LANGUAGE_SPOKEN": "spoken_language_source_value",
            "ZIP_CODE": BLANK,
        },
    ),
    "DIAGNOSIS": Job(
        source="condition_occurrence",
        where=ENCOUNTER_DIAGNOSES,
        lookups=(VISIT,),
        columns={
            "DIAGNOSISID": "condition_occurrence_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_occurrence_id",
            "ENC_TYPE": "visit_type",
            "ADMIT_DATE": "admit_date",
            "PROVIDERID": "provider_id",
            "DX": "condition_code",
            "DX_TYPE": "condition_code_type",
            "DX_DATE": "condition_start_date",
            "DX_SOURCE": "condition_status_source_value",
            "DX_ORIGIN": "condition_data_origin",
            "PDX": "condition_data_origin",
            "DX_POA": "poa",
            "RAW_DX": "condition_code",
            "RAW_DX_TYPE": "condition_code_type",
            "RAW_DX_SOURCE": "condition_status_source_value",
            "RAW_PDX": "condition_data_origin",
            "RAW_DX_POA": "poa",
        },
    ),
    "ENCOUNTER": Job(
        source="visit_occurrence",
        lookups=(
            _payer("primary", PRIMARY_PAYER),
            _payer("secondary", SECONDARY_PAYER),
            Lookup(
                "care_site",
                on=("care_site_id", "care_site_id"),
                take={"place_of_service": "place_of_service", "site_location": "location_id"},
            ),
            Lookup("location", on=("site_location", "location_id"), take={"facility_zip": "zip_5"}),
        ),
        columns={
            "ENCOUNTERID": "visit_occurrence_id",
            "PATID": "person_id",
            "ADMIT_DATE": "visit_start_date",
            "ADMIT_TIME": use("time_of_datetime", "visit_start_datetime"),
            "DISCHARGE_DATE": "visit_end_date",
            "DISCHARGE_TIME": use("time_of_datetime", "visit_end_datetime"),
            "PROVIDERID": "provider_id",
            "FACILITY_LOCATION": "facility_zip",
            "ENC_TYPE": "visit_type",
            "FACILITYID": "care_site_id",
            "DISCHARGE_DISPOSITION": "discharge_status",
            "DISCHARGE_STATUS": "discharge_to",
            "DRG": "drg",
            "DRG_TYPE": use("drg_version", "visit_start_date"),
            "ADMITTING_SOURCE": "admitted",
            "PAYER_TYPE_PRIMARY": "primary_class",
            "PAYER_TYPE_SECONDARY": "secondary_class",
            "FACILITY_TYPE": "place_of_service",
            "RAW_SITEID": "care_site_id",
            "RAW_ENC_TYPE": "visit_type",
            "RAW_DISCHARGE_DISPOSITION": "discharge_status",
            "RAW_DISCHARGE_STATUS": "discharge_to",
            "RAW_DRG_TYPE": use("drg_label", "visit_start_date"),
            "RAW_ADMITTING_SOURCE": "admitted_source_value",
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
        columns={
            "PATID": "person_id",
            "ENR_START_DATE": "observation_period_start_date",
            "ENR_END_DATE": "observation_period_end_date",
            "CHART": "chart",
            "ENR_BASIS": "enrollment_basis",
        },
    ),
    "IMMUNIZATION": Job(
        source="drug_exposure",
        where=IMMUNIZATIONS,
        columns={
            "IMMUNIZATIONID": "drug_exposure_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_occurrence_id",
            "PROCEDURESID": "procedure_occurrence_id",
            "VX_PROVIDERID": "provider_id",
            "VX_RECORD_DATE": "drug_exposure_record_date",
            "VX_ADMIN_DATE": "drug_exposure_start_date",
            "VX_CODE_TYPE": "drug_code_type",
            "VX_CODE": "drug_code",
            "VX_STATUS": "vx_status",
            "VX_STATUS_REASON": "vx_status_reason",
            "VX_SOURCE": BLANK,
            "VX_DOSE": "dose_ordered",
            "VX_DOSE_UNIT": "dose_unit",
            "VX_ROUTE": "route",
            "VX_BODY_SITE": "body_site_source_value",
            "VX_MANUFACTURER": "vx_manufacturer",
            "VX_LOT_NUM": "lot_number",
            "VX_EXP_DATE": "drug_exposure_end_date",
            "RAW_VX_NAME": "drug_type_source_value",
            "RAW_VX_CODE": "drug_code",
            "RAW_VX_CODE_TYPE": "drug_code_type",
            "RAW_VX_DOSE": "dose_ordered",
            "RAW_VX_DOSE_UNIT": "dose_unit",
            "RAW_VX_ROUTE": "route_source_value",
            "RAW_VX_BODY_SITE": "body_site_source_value",
            "RAW_VX_STATUS": "vx_status",
            "RAW_VX_STATUS_REASON": "vx_status_reason",
            "RAW_VX_MANUFACTURER": "vx_manufacturer",
        },
    ),
    "LAB_RESULT_CM": Job(
        source="measurement",
        columns={
            "LAB_RESULT_CM_ID": "measurement_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_occurrence_id",
            "SPECIMEN_SOURCE": "measurement_code",
            "LAB_LOINC": "measurement_code",
            "LAB_RESULT_SOURCE": Const("OD"),
            "LAB_LOINC_SOURCE": "measurement_loinc_source",
            "PRIORITY": "priority",
            "RESULT_LOC": use("lab_location", "measurement_code_source_value", prefix=" POC", missing="UN"),
            "LAB_PX": BLANK,
            "LAB_PX_TYPE": BLANK,
            "LAB_ORDER_DATE": "measurement_order_date",
            "SPECIMEN_DATE": "measurement_date",
            "SPECIMEN_TIME": use("time_of_datetime", "measurement_datetime"),
            "RESULT_DATE": "measurement_date",
            "RESULT_TIME": use("time_of_datetime", "measurement_datetime"),
            "RESULT_QUAL": "value_as_string",
            "RESULT_SNOMED": BLANK,
            "RESULT_NUM": use("strip_signs", "value_as_number"),
            "RESULT_MODIFIER": "operator",
            "RESULT_UNIT": "unit",
            "NORM_RANGE_LOW": "range_low",
            "NORM_MODIFIER_LOW": "operator",
            "NORM_RANGE_HIGH": "range_high",
            "NORM_MODIFIER_HIGH": "operator",
            "ABN_IND": "abn_ind",
            "RAW_LAB_NAME": "measurement_code_source_value",
            "RAW_LAB_CODE": "measurement_code_source_value",
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
                "location",
                on=("location_id", "location_id"),
                take={"city": "city", "state": "state", "zip_5": "zip_5", "zip_9": "zip_9"},
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
            "ADDRESS_ZIP5": "zip_5",
            "ADDRESS_ZIP9": "zip_9",
            "ADDRESS_COUNTY": BLANK,
            "ADDRESS_PERIOD_START": "address_period_start",
            "ADDRESS_PERIOD_END": "address_period_end",
        },
    ),
    "MED_ADMIN": Job(
        source="drug_exposure",
        where=ADMINISTERED,
        columns={
            "MEDADMINID": "drug_exposure_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_occurrence_id",
            "PRESCRIBINGID": BLANK,
            "MEDADMIN_PROVIDERID": "provider_id",
            "MEDADMIN_START_DATE": "drug_exposure_start_date",
            "MEDADMIN_START_TIME": use("time_of_datetime", "drug_exposure_start_datetime"),
            "MEDADMIN_STOP_DATE": "drug_exposure_end_date",
            "MEDADMIN_STOP_TIME": use("time_of_datetime", "drug_exposure_end_datetime"),
            "MEDADMIN_TYPE": "drug_code_type",
            "MEDADMIN_CODE": "drug_code",
            "MEDADMIN_DOSE_ADMIN": "dose_ordered",
            "MEDADMIN_DOSE_ADMIN_UNIT": "dose_unit",
            "MEDADMIN_ROUTE": "route",
            "MEDADMIN_SOURCE": Const("OD"),
            "RAW_MEDADMIN_MED_NAME": "drug_code",
            "RAW_MEDADMIN_CODE": "drug_code",
            "RAW_MEDADMIN_DOSE_ADMIN": "dose_ordered_source_value",
            "RAW_MEDADMIN_DOSE_ADMIN_UNIT": "dose_unit",
            "RAW_MEDADMIN_ROUTE": "route_source_value",
        },
    ),
    "OBS_CLIN": Job(
        source="observation",
        where=FROM_MEASUREMENT,
        columns={
            "OBSCLINID": "observation_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_occurrence_id",
            "OBSCLIN_PROVIDERID": "provider_id",
            "OBSCLIN_START_DATE": "observation_start_date",
            "OBSCLIN_START_TIME": use("time_of_datetime", "observation_start_datetime"),
            "OBSCLIN_STOP_DATE": "observation_end_date",
            "OBSCLIN_STOP_TIME": use("time_of_datetime", "observation_end_datetime"),
            "OBSCLIN_TYPE": "observation_code_type",
            "OBSCLIN_CODE": "observation_code",
            "OBSCLIN_RESULT_QUAL": "qualifier",
            "OBSCLIN_RESULT_TEXT": use("ratio_text", "value_as_number"),
            "OBSCLIN_RESULT_SNOMED": "observation_code_type",
            "OBSCLIN_RESULT_NUM": use("non_ratio_number", "value_as_number"),
            "OBSCLIN_RESULT_MODIFIER": Const("OT"),
            "OBSCLIN_RESULT_UNIT": "unit",
            "OBSCLIN_SOURCE": "observation_data_origin",
            "OBSCLIN_ABN_IND": BLANK,
            "RAW_OBSCLIN_NAME": "observation_code",
            "RAW_OBSCLIN_CODE": "observation_code",
            "RAW_OBSCLIN_TYPE": "observation_code_type",
            "RAW_OBSCLIN_RESULT": use("dash_join", "value_as_string", "value_as_number"),
            "RAW_OBSCLIN_MODIFIER": "qualifier_source_value",
            "RAW_OBSCLIN_UNIT": "unit_source_value",
        },
    ),
    "OBS_GEN": Job(
        source="observation",
        where=FROM_RECORD,
        columns={
            "OBSGENID": "observation_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_occurrence_id",
            "OBSGEN_PROVIDERID": "provider_id",
            "OBSGEN_START_DATE": "observation_start_date",
            "OBSGEN_START_TIME": use("time_of_datetime", "observation_start_datetime"),
            "OBSGEN_STOP_DATE": "observation_end_date",
            "OBSGEN_STOP_TIME": use("time_of_datetime", "observation_end_datetime"),
            "OBSGEN_TYPE": "observation_code_type",
            "OBSGEN_CODE": "observation_code",
            "OBSGEN_RESULT_QUAL": "qualifier",
            "OBSGEN_RESULT_TEXT": "tobacco_type",
            "OBSGEN_RESULT_NUM": "value_as_number",
            "OBSGEN_RESULT_MODIFIER": "qualifier",
            "OBSGEN_RESULT_UNIT": "unit",
            "OBSGEN_TABLE_MODIFIED": BLANK,
            "OBSGEN_ID_MODIFIED": BLANK,
            "OBSGEN_SOURCE": "observation_data_origin",
            "OBSGEN_ABN_IND": "abn_ind",
            "RAW_OBSGEN_NAME": "observation_code",
            "RAW_OBSGEN_CODE": "observation_code",
            "RAW_OBSGEN_TYPE": "observation_code_type",
            "RAW_OBSGEN_RESULT": "tobacco_type",
            "RAW_OBSGEN_UNIT": "unit_source_value",
        },
    ),
    "PRESCRIBING": Job(
        source="drug_exposure",
        where=PRESCRIBED,
        columns={
            "PRESCRIBINGID": "drug_exposure_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_occurrence_id",
            "RX_PROVIDERID": "provider_id",
            "RX_ORDER_DATE": "drug_exposure_start_date",
            "RX_ORDER_TIME": use("time_of_datetime", "drug_exposure_start_datetime"),
            "RX_START_DATE": "drug_exposure_start_date",
            "RX_END_DATE": "drug_exposure_end_date",
            "RX_DOSE_ORDERED": "dose_ordered",
            "RX_DOSE_ORDERED_UNIT": "dose_unit",
            "RX_QUANTITY": use("leading_quantity", "quantity"),
            "RX_DOSE_FORM": Const("UN"),
            "RX_REFILLS": use("whole_or_decimal", "refills"),
            "RX_DAYS_SUPPLY": "days_supply",
            "RX_FREQUENCY": "rx_frequency",
            "RX_PRN_FLAG": use("prn_flag", "rx_frequency"),
            "RX_ROUTE": "route",
            "RX_BASIS": "drug_type",
            "RXNORM_CUI": "drug_code",
            "RX_SOURCE": Const("OD"),
            "RX_DISPENSE_AS_WRITTEN": Const("OT"),
            "RAW_RX_MED_NAME": "drug_code_source_value",
            "RAW_RX_FREQUENCY": "rx_frequency",
            "RAW_RXNORM_CUI": "drug_code",
            "RAW_RX_QUANTITY": "quantity",
            "RAW_RX_NDC": "drug_code",
            "RAW_RX_DOSE_ORDERED": "dose_ordered_source_value",
            "RAW_RX_DOSE_ORDERED_UNIT": "dose_unit",
            "RAW_RX_ROUTE": "route_source_value",
            "RAW_RX_REFILLS": "refills",
        },
    ),
    "PROCEDURES": Job(
        source="procedure_occurrence",
        lookups=(VISIT,),
        columns={
            "PROCEDURESID": "procedure_occurrence_id",
            "PATID": "person_id",
            "ENCOUNTERID": "visit_occurrence_id",
            "ENC_TYPE": "visit_type",
            "ADMIT_DATE": "admit_date",
            "PROVIDERID": "provider_id",
            "PX_DATE": "procedure_date",
            "PX": "procedure_code",
            "PX_TYPE": "procedure_code_type",
            "PX_SOURCE": Const("OD"),
            "PPX": BLANK,
            "RAW_PX": "procedure_code_source_value",
            "RAW_PX_TYPE": "procedure_code_type",
            "RAW_PPX": "procedure_data_origin",
        },
    ),
    "PROVIDER": Job(
        source="provider",
        columns={
            "PROVIDERID": "provider_id",
            "PROVIDER_SEX": "gender",
            "PROVIDER_SPECIALTY_PRIMARY": "provider_specialty",
            "PROVIDER_NPI": "npi",
            "PROVIDER_NPI_FLAG": use("npi_flag", "npi"),
            "RAW_PROVIDER_SPECIALTY_PRIMARY": "provider_specialty_source_value",
        },
    ),
}
