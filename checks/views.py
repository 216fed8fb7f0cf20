"""Clinical stand-ins derived from the given tables.

Every view is a plain projection in SQL that both engines read alike; ``{orders}``
and so on stand for the given tables.  All columns are text, as partner files are.
"""

from __future__ import annotations

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

ORDER_DAY = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
SHIP_DAY = "CAST(CAST(l_shipdate AS DATE) AS STRING)"
LINE_ID = "CAST(l_orderkey * 10 + l_linenumber AS STRING)"


def text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def clock(day: str, number: str) -> str:
    """A datetime text on a day, with hour and minute from a number."""
    return f"{day} || ' ' || lpad({text(f'{number} % 24')}, 2, '0') || ':' || lpad({text(f'{number} % 60')}, 2, '0') || ':00'"


ORDER_CLOCK = clock(ORDER_DAY, "o_orderkey")
SHIP_CLOCK = clock(SHIP_DAY, "l_partkey")
# part keys are dealt to sixteen domains; see CONCEPT
DOMAINS = (
    "Condition", "Drug", "Measurement", "Procedure", "Observation", "Type Concept", "Visit", "Place of service",
    "Gender", "Ethnicity", "Race", "Unit", "Route", "Meas Value", "Meas Value Operator", "Provider",
)


def concept_of(domain: str, number: str) -> str:
    """A concept id of a domain, among the first ten."""
    return text(f"{number} % 10 * 16 + {DOMAINS.index(domain)}")


def pick(number: str, *values: str | None) -> str:
    """One of several texts, dealt by a number; None is NULL."""
    cases = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else chr(39) + v + chr(39)}" for i, v in enumerate(values)
    )
    return f"CASE CAST({number} AS BIGINT) % {len(values)} {cases} END"


SHARED = {
    "location": f"""SELECT {text('n_nationkey')} AS location_id, n_name AS city,
        {pick('n_nationkey', 'FL', 'GA', 'tx', 'ZZ')} AS state, lpad({text('n_nationkey * 137')}, 5, '0') AS zip_5,
        lpad({text('n_nationkey * 137')}, 5, '0') || '0001' AS zip_9, lpad({text('n_nationkey * 137')}, 5, '0') AS zip
        FROM {{nation}}""",
    "care_site": f"""SELECT {text('s_suppkey')} AS care_site_id, {text('s_nationkey')} AS location_id,
        {pick('s_suppkey', 'Hospital', 'Clinic', None)} AS place_of_service,
        {pick('s_suppkey', 'Hospital', 'Clinic', None)} AS place_of_service_source_value FROM {{supplier}}""",
    "visit_payer": f"""SELECT {text('o_orderkey')} AS visit_occurrence_id, {pick('o_custkey', 'Primary', 'primary')} AS payer_type,
        {pick('o_custkey', 'Medicare', 'Private', None)} AS plan_class, 'Plan ' || {text('o_custkey % 25')} AS plan_name,
        {text('o_orderkey')} || '-1' AS visit_payer_id FROM {{orders}}
        UNION ALL SELECT {text('o_orderkey')}, 'Primary Payer', 'Self pay', 'Plan ' || o_orderstatus,
        {text('o_orderkey')} || '-2' FROM {{orders}} WHERE o_orderstatus = 'P'
        UNION ALL SELECT {text('o_orderkey')}, 'Secondary', o_orderpriority, 'Plan S', {text('o_orderkey')} || '-3'
        FROM {{orders}} WHERE o_orderstatus <> 'F'""",
    "address": f"""SELECT {text('o_orderkey')} AS address_id, {text('o_custkey')} AS person_id,
        {text('o_custkey % 30')} AS location_id, {pick('o_orderkey', 'HO', 'WO')} AS address_use,
        {pick('o_orderkey', 'BO', 'PH', 'PO')} AS address_type, {pick('o_orderkey', 'Y', 'N')} AS address_preferred,
        {ORDER_DAY} AS address_period_start, CAST(NULL AS STRING) AS address_period_end FROM {{orders}}""",
    "observation_period": f"""SELECT {text('o_custkey')} AS observation_period_id, {text('o_custkey')} AS person_id,
        min({ORDER_DAY}) AS observation_period_start_date, max({ORDER_DAY}) AS observation_period_end_date,
        'Y' AS chart, {pick('o_custkey', 'E', 'I')} AS enrollment_basis FROM {{orders}} GROUP BY o_custkey""",
}

FLAT = SHARED | {
    "person": f"""SELECT {text('c_custkey')} AS person_id,
        CASE WHEN c_custkey % 11 = 0 THEN 'unknown' ELSE '19' || lpad({text('c_custkey % 90 + 10')}, 2, '0') || '-0' ||
        {text('c_custkey % 9 + 1')} || '-1' || {text('c_custkey % 10')} || ' 0' || {text('c_custkey % 10')} || ':30:00' END
        AS birth_datetime, {pick('c_custkey', 'F', 'M', None)} AS sex, {pick('c_custkey', 'ST', None)} AS sexual_orientation,
        c_mktsegment AS race, c_mktsegment AS race_source_value, {pick('c_custkey', 'Y', 'N')} AS ethnicity_source_value,
        {pick('c_custkey', 'ENG', 'SPA')} AS spoken_language, {pick('c_custkey', 'English', 'Spanish')} AS spoken_language_source_value
        FROM {{customer}}""",
    "visit_occurrence": f"""SELECT {text('o_orderkey')} AS visit_occurrence_id, {text('o_custkey')} AS person_id,
        {ORDER_DAY} AS visit_start_date, {ORDER_CLOCK} AS visit_start_datetime,
        CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INT) AS STRING) AS visit_end_date,
        CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE {ORDER_CLOCK} END AS visit_end_datetime,
        {text('o_custkey % 40')} AS provider_id, {text('o_custkey % 25')} AS care_site_id, o_orderpriority AS visit_type,
        o_orderstatus AS discharge_status, {pick('o_orderkey', 'Home', 'SNF', None)} AS discharge_to,
        lpad({text('o_orderkey % 999')}, 3, '0') AS drg, {pick('o_orderkey', 'ED', 'Clinic')} AS admitted,
        {pick('o_orderkey', 'Emergency', 'Clinic')} AS admitted_source_value FROM {{orders}}""",
    "condition_occurrence": f"""SELECT {LINE_ID} AS condition_occurrence_id, {text('l_partkey')} AS person_id,
        {text('l_orderkey')} AS visit_occurrence_id, {text('l_suppkey')} AS provider_id, {SHIP_DAY} AS condition_start_date,
        CASE WHEN l_linenumber = 2 THEN '' WHEN l_linenumber = 3 THEN NULL ELSE {SHIP_DAY} END AS condition_end_date,
        'C' || {text('l_partkey % 500')} AS condition_code, {pick('l_partkey', 'ICD10', 'SNOMED')} AS condition_code_type,
        l_linestatus AS condition_status, l_returnflag AS condition_status_source_value,
        CASE l_returnflag WHEN 'R' THEN 'EHR problem list entry' WHEN 'A' THEN 'Primary Condition' ELSE 'Secondary Condition' END
        AS condition_data_origin, {pick('l_partkey', 'Y', 'N', None)} AS poa FROM {{lineitem}}""",
    "procedure_occurrence": f"""SELECT {LINE_ID} AS procedure_occurrence_id, {text('l_partkey')} AS person_id,
        {text('l_orderkey')} AS visit_occurrence_id, {text('l_suppkey')} AS provider_id, {SHIP_DAY} AS procedure_date,
        'P' || {text('l_partkey % 500')} AS procedure_code, {pick('l_partkey', 'CH', 'HC')} AS procedure_code_type,
        'raw ' || {text('l_partkey % 500')} AS procedure_code_source_value, l_returnflag AS procedure_data_origin
        FROM {{lineitem}}""",
    "drug_exposure": f"""SELECT {LINE_ID} AS drug_exposure_id, {text('l_partkey')} AS person_id,
        {text('l_orderkey')} AS visit_occurrence_id, {LINE_ID} AS procedure_occurrence_id, {text('l_suppkey')} AS provider_id,
        {SHIP_DAY} AS drug_exposure_record_date, {SHIP_DAY} AS drug_exposure_start_date,
        {SHIP_CLOCK} AS drug_exposure_start_datetime, {SHIP_DAY} AS drug_exposure_end_date,
        CASE WHEN l_linenumber = 3 THEN 'bad' ELSE {SHIP_CLOCK} END AS drug_exposure_end_datetime,
        'D' || {text('l_partkey')} AS drug_code, {pick('l_partkey', 'CVX', 'RXNORM', 'NDC')} AS drug_code_type,
        'drug ' || {text('l_partkey')} AS drug_code_source_value,
        {pick('l_linenumber', 'Other', 'Prescription written', 'Inpatient', 'Home-Med', 'Inpatient Administration', 'Prescription')}
        AS drug_type, l_returnflag AS drug_type_source_value, {text('CAST(l_quantity AS BIGINT)')} AS dose_ordered,
        {text('CAST(l_quantity AS BIGINT)')} || ' mg' AS dose_ordered_source_value, {pick('l_partkey', 'mg', 'mL')} AS dose_unit,
        CASE l_linenumber WHEN 1 THEN {text('CAST(l_quantity AS BIGINT)')} || ' tablets' WHEN 3 THEN 'some'
        WHEN 5 THEN NULL ELSE {text('CAST(l_quantity AS BIGINT)')} || '.5' END AS quantity,
        {pick('l_linenumber', '2', '3.5', 'none', None)} AS refills, {text('l_linenumber * 30')} AS days_supply,
        {pick('l_partkey', 'daily', 'daily *as needed*', None)} AS rx_frequency, {pick('l_partkey', 'oral', 'iv')} AS route,
        {pick('l_partkey', 'PO', 'IV')} AS route_source_value, {pick('l_partkey', 'arm', None)} AS body_site_source_value,
        'L' || {text('l_suppkey')} AS lot_number, {pick('l_partkey', 'CP', 'RF')} AS vx_status,
        {pick('l_partkey', None, 'OT')} AS vx_status_reason, {pick('l_suppkey', 'PFR', 'MOD')} AS vx_manufacturer
        FROM {{lineitem}}""",
    "measurement": f"""SELECT {LINE_ID} AS measurement_id, {text('l_partkey')} AS person_id,
        {text('l_orderkey')} AS visit_occurrence_id, {SHIP_DAY} AS measurement_date, {SHIP_CLOCK} AS measurement_datetime,
        {SHIP_DAY} AS measurement_order_date, {text('l_partkey % 500')} || '-' || {text('l_linenumber')} AS measurement_code,
        {pick('l_linenumber', ' POC glucose', 'glucose', None)} AS measurement_code_source_value,
        {pick('l_partkey', 'LM', 'PC')} AS measurement_loinc_source, {pick('l_partkey', 'R', 'S')} AS priority,
        CASE l_linenumber WHEN 1 THEN '+' || {text('CAST(l_quantity AS BIGINT)')} WHEN 2 THEN {text('CAST(l_quantity AS BIGINT)')} || '-'
        WHEN 3 THEN 'high' WHEN 4 THEN NULL ELSE {text('CAST(l_quantity AS BIGINT)')} END AS value_as_number,
        {pick('l_partkey', 'POSITIVE', 'negative', None)} AS value_as_string, 'raw' AS value_source_value,
        {pick('l_partkey', 'EQ', 'LT')} AS operator, {pick('l_partkey', 'mg/dL', 'mL')} AS unit,
        {pick('l_partkey', 'MG/DL', 'ML')} AS unit_source_value, '1' AS range_low, '9' AS range_high, l_returnflag AS abn_ind
        FROM {{lineitem}}""",
    "observation": f"""SELECT {LINE_ID} AS observation_id, {text('l_partkey')} AS person_id,
        {text('l_orderkey')} AS visit_occurrence_id, {text('l_suppkey')} AS provider_id,
        {SHIP_DAY} AS observation_start_date, {SHIP_CLOCK} AS observation_start_datetime,
        {SHIP_DAY} AS observation_end_date, {SHIP_CLOCK} AS observation_end_datetime,
        'O' || {text('l_partkey % 500')} AS observation_code, {pick('l_partkey', 'LC', 'SM')} AS observation_code_type,
        CASE l_returnflag WHEN 'R' THEN 'Observation from Measurement' WHEN 'A' THEN 'Observation recorded from EHR' ELSE 'Other' END
        AS observation_data_origin, {pick('l_partkey', 'HIGH', None)} AS qualifier, l_linestatus AS qualifier_source_value,
        CASE l_linenumber WHEN 1 THEN '120/80' WHEN 2 THEN 'nan' WHEN 3 THEN NULL ELSE {text('CAST(l_quantity AS BIGINT)')} END
        AS value_as_number, {pick('l_linenumber', 'seen', None)} AS value_as_string, {pick('l_partkey', 'mmHg', 'kg')} AS unit,
        'u' AS unit_source_value, {pick('l_partkey', '01', '02')} AS tobacco_type, l_returnflag AS abn_ind FROM {{lineitem}}""",
    "death": f"""SELECT {text('c_custkey')} AS person_id, '2001-0' || {text('c_custkey % 9 + 1')} || '-11' AS death_date,
        {pick('c_custkey', 'N', 'D')} AS death_date_input, {pick('c_custkey', 'L', 'S')} AS death_date_origin
        FROM {{customer}} WHERE c_acctbal < 0""",
    "provider": f"""SELECT {text('s_suppkey')} AS provider_id, {pick('s_suppkey', 'F', 'M')} AS gender,
        {pick('s_suppkey', '207Q00000X', '208D00000X')} AS provider_specialty, s_name AS provider_specialty_source_value,
        {pick('s_suppkey', '1234567890', '123456789', 'A234567890', None)} AS npi FROM {{supplier}}""",
}

OMOP = SHARED | {
    "concept": f"""SELECT {text('p_partkey')} AS concept_id, {pick('p_partkey', *DOMAINS)} AS domain_id,
        CASE p_partkey % 16 WHEN 5 THEN {pick('floor(p_partkey / 16)', 'Prescription dispensed in pharmacy',
        'Inpatient administration', 'PRESCRIPTION written', 'EHR encounter diagnosis')} ELSE p_name END AS concept_name,
        CASE p_partkey % 16 WHEN 1 THEN {pick('floor(p_partkey / 16)', 'CVX', 'RxNorm')} WHEN 15 THEN 'NUCC' ELSE p_brand END
        AS vocabulary_id, CASE p_partkey % 16 WHEN 5 THEN 'Drug Type' WHEN 2 THEN {pick('floor(p_partkey / 16)',
        'Lab Test', 'Clinical Observation')} ELSE p_type END AS concept_class_id,
        CASE WHEN p_partkey % 5 = 0 THEN 'POC' ELSE 'K' END || {text('p_partkey')} AS concept_code FROM {{part}}""",
    "person": f"""SELECT {text('c_custkey')} AS person_id, '19' || {text('c_custkey % 90 + 10')} || '-0' || {text('c_custkey % 9 + 1')}
        || '-1' || {text('c_custkey % 10')} || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ' 05:30:00' END AS birth_datetime,
        {concept_of('Gender', 'c_custkey')} AS gender_concept_id, {concept_of('Race', 'c_custkey')} AS race_concept_id,
        {concept_of('Ethnicity', 'c_custkey')} AS ethnicity_concept_id, {pick('c_custkey', 'F', 'M')} AS gender_source_value,
        c_mktsegment AS race_source_value, {pick('c_custkey', 'Y', 'N')} AS ethnicity_source_value FROM {{customer}}""",
    "person_sup": f"""SELECT {text('c_custkey')} AS person_id, {pick('c_custkey', 'F', 'M')} AS sex,
        {pick('c_custkey', 'Female', 'Male')} AS sex_source_value, {pick('c_custkey', 'ST', None)} AS sexual_orientation,
        {pick('c_custkey', 'Straight', None)} AS sexual_orientation_source_value, {pick('c_custkey', 'ENG', 'SPA')} AS spoken_language,
        {pick('c_custkey', 'English', 'Spanish')} AS spoken_language_source_value FROM {{customer}} WHERE c_acctbal >= 0""",
    "visit_occurrence": f"""SELECT {text('o_orderkey')} AS visit_occurrence_id, {text('o_custkey')} AS person_id,
        {concept_of('Visit', 'o_orderkey')} AS visit_concept_id, {ORDER_DAY} AS visit_start_date,
        {ORDER_CLOCK} AS visit_start_datetime,
        CAST(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INT) AS STRING) AS visit_end_date,
        CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE {ORDER_CLOCK} END AS visit_end_datetime,
        {text('o_custkey % 40')} AS provider_id, {text('o_custkey % 25')} AS care_site_id,
        {concept_of('Place of service', 'o_orderkey')} AS admitting_source_concept_id, o_orderstatus AS admitting_source_value,
        {concept_of('Place of service', 'o_custkey')} AS discharge_to_concept_id, o_orderpriority AS discharge_to_source_value
        FROM {{orders}}""",
    "visit_occurrence_sup": f"""SELECT {text('o_orderkey')} AS visit_occurrence_id, lpad({text('o_orderkey % 999')}, 3, '0') AS drg,
        o_orderstatus AS discharge_status FROM {{orders}} WHERE o_orderstatus <> 'P'""",
    "condition_occurrence": f"""SELECT {LINE_ID} AS condition_occurrence_id, {text('l_partkey')} AS person_id,
        {text('l_orderkey')} AS visit_occurrence_id, {concept_of('Condition', 'l_partkey')} AS condition_concept_id,
        CASE l_returnflag WHEN 'R' THEN {pick('l_linenumber', '32840', '32865', '38000245')} WHEN 'A' THEN NULL
        ELSE {concept_of('Type Concept', 'l_partkey')} END AS condition_type_concept_id, {SHIP_DAY} AS condition_start_date,
        CASE WHEN l_linenumber = 2 THEN '' WHEN l_linenumber = 3 THEN NULL ELSE {SHIP_CLOCK} END AS condition_end_date,
        l_returnflag AS condition_status_source_value FROM {{lineitem}}""",
    "condition_occurrence_sup": f"""SELECT {text('o_orderkey * 10 + 1')} AS condition_occurrence_id,
        {pick('o_orderkey', 'Y', 'N')} AS poa FROM {{orders}}""",
    "procedure_occurrence": f"""SELECT {LINE_ID} AS procedure_occurrence_id, {text('l_partkey')} AS person_id,
        {text('l_orderkey')} AS visit_occurrence_id, {text('l_suppkey')} AS provider_id,
        {concept_of('Procedure', 'l_partkey')} AS procedure_concept_id, {SHIP_CLOCK} AS procedure_date,
        'raw ' || {text('l_partkey % 500')} AS procedure_source_value FROM {{lineitem}}""",
    "drug_exposure": f"""SELECT {LINE_ID} AS drug_exposure_id, {text('l_partkey')} AS person_id,
        {text('l_orderkey')} AS visit_occurrence_id, {text('l_suppkey')} AS provider_id,
        {concept_of('Drug', 'l_partkey')} AS drug_concept_id, {concept_of('Type Concept', 'l_linenumber')} AS drug_type_concept_id,
        {concept_of('Route', 'l_partkey')} AS route_concept_id, {SHIP_DAY} AS drug_exposure_start_date,
        {SHIP_CLOCK} AS drug_exposure_start_datetime, {SHIP_DAY} AS drug_exposure_end_date,
        {SHIP_CLOCK} AS drug_exposure_end_datetime,
        CASE l_linenumber WHEN 1 THEN '1,' || lpad({text('CAST(l_quantity AS BIGINT)')}, 3, '0') || '.5' WHEN 3 THEN 'some'
        ELSE {text('CAST(l_quantity AS BIGINT)')} END AS quantity, {pick('l_linenumber', '2', None)} AS refills,
        {text('l_linenumber * 30')} AS days_supply, {pick('l_partkey', 'take one', None)} AS sig, 'L' || {text('l_suppkey')} AS lot_number,
        {pick('l_partkey', 'mg', 'mL')} AS dose_unit_source_value, {pick('l_partkey', 'PO', 'IV')} AS route_source_value,
        'drug ' || {text('l_partkey')} AS drug_source_value FROM {{lineitem}}""",
    "drug_exposure_sup": f"""SELECT {text('o_orderkey * 10 + o_custkey % 7 + 1')} AS drug_exposure_id, '5' AS dose,
        {pick('o_orderkey', 'daily', 'weekly')} AS rx_frequency, {ORDER_DAY} AS drug_exposure_record_date,
        'CP' AS vx_status, 'OT' AS vx_status_reason, {pick('o_orderkey', 'PFR', 'MOD')} AS vx_manufatcurer,
        'arm' AS body_site_source_value, {text('o_orderkey')} AS procedure_occurrence_id FROM {{orders}}""",
    "measurement": f"""SELECT {LINE_ID} AS measurement_id, {text('l_partkey')} AS person_id,
        {text('l_orderkey')} AS visit_occurrence_id, {text('l_suppkey')} AS provider_id,
        CASE l_linenumber WHEN 1 THEN '3036277' WHEN 2 THEN ' 3013762' WHEN 3 THEN '3012888' WHEN 4 THEN '3004249'
        WHEN 5 THEN '3038553' ELSE {concept_of('Measurement', 'l_partkey')} END AS measurement_concept_id,
        {SHIP_DAY} AS measurement_date, {SHIP_CLOCK} AS measurement_datetime,
        CASE WHEN l_returnflag = 'A' THEN '' ELSE {text('CAST(l_quantity AS BIGINT)')} END AS value_as_number,
        {concept_of('Meas Value', 'l_partkey')} AS value_as_concept_id,
        {concept_of('Meas Value Operator', 'l_partkey')} AS operator_concept_id, {concept_of('Unit', 'l_partkey')} AS unit_concept_id,
        '1' AS range_low, '9' AS range_high, 'm' || {text('l_partkey')} AS measurement_source_value, 'u' AS unit_source_value,
        l_returnflag AS value_source_value FROM {{lineitem}}""",
    "measurement_sup": f"""SELECT {text('o_orderkey * 10 + 6')} AS measurement_id, {ORDER_CLOCK} AS measurement_order_date,
        {pick('o_orderkey', 'LM', 'PC')} AS measurement_loinc_source, {pick('o_orderkey', 'R', 'S')} AS priority FROM {{orders}}""",
    "observation": f"""SELECT {LINE_ID} AS observation_id, {text('l_partkey')} AS person_id,
        {text('l_orderkey')} AS visit_occurrence_id, {text('l_suppkey')} AS provider_id,
        CASE l_linenumber WHEN 1 THEN '4218197' ELSE {concept_of('Observation', 'l_partkey')} END AS observation_concept_id,
        {SHIP_DAY} AS observation_start_date, {SHIP_CLOCK} AS observation_start_datetime,
        {text('CAST(l_quantity AS BIGINT)')} AS value_as_number, {pick('l_partkey', 'Former smoker', 'Never', '', None)} AS value_as_string,
        {concept_of('Unit', 'l_partkey')} AS unit_concept_id, 'u' AS unit_source_value, l_returnflag AS qualifier_source_value
        FROM {{lineitem}}""",
    "observation_sup": f"""SELECT {text('o_orderkey * 10 + 2')} AS observation_id, 'EHR' AS observation_data_origin,
        {pick('o_orderkey', 'AB', 'NL')} AS abn_ind FROM {{orders}}""",
    "observation_period": f"""SELECT {text('o_custkey')} AS observation_period_id, {text('o_custkey')} AS person_id,
        min({ORDER_DAY}) AS observation_period_start_date, max({ORDER_DAY}) AS observation_period_end_date
        FROM {{orders}} GROUP BY o_custkey""",
    "observation_period_sup": f"""SELECT {text('c_custkey')} AS observation_period_id, 'Y' AS chart,
        {pick('c_custkey', 'E', 'I')} AS enrollment_basis FROM {{customer}} WHERE c_acctbal >= 0""",
    "death": f"""SELECT {text('c_custkey')} AS person_id, '2001-0' || {text('c_custkey % 9 + 1')} || '-11' AS death_date,
        {concept_of('Type Concept', 'c_custkey')} AS death_type_concept_id, {concept_of('Observation', 'c_custkey')} AS cause_concept_id
        FROM {{customer}} WHERE c_acctbal < 0""",
    "death_sup": f"""SELECT {text('c_custkey')} AS person_id, {pick('c_custkey', 'N', 'D')} AS death_date_impute,
        'E' AS death_match_confidence, 'L' AS death_cause_source, 'F' AS death_cause_confidence
        FROM {{customer}} WHERE c_nationkey < 13""",
    "provider": f"""SELECT {text('s_suppkey')} AS provider_id, {concept_of('Gender', 's_suppkey')} AS gender_concept_id,
        {concept_of('Provider', 's_suppkey')} AS specialty_concept_id, s_name AS specialty_source_value,
        {pick('s_suppkey', '1234567890', '123456789', 'A234567890', None)} AS npi FROM {{supplier}}""",
    "provider_sup": f"SELECT {text('s_suppkey')} AS provider_id FROM {{supplier}}",
    "hash_token": "SELECT " + text("c_custkey") + " AS pat_id, "
    + ", ".join(
        f"'t{n}' || " + text(f"c_custkey * {n}") + f" AS token_{n}"
        for n in [*range(1, 10), 12, *range(14, 19), *range(23, 27), 29, 30, *range(101, 112)]
    )
    + ", c_mktsegment AS token_encryption_key FROM {customer}",
}

# --- tables that already have the target's columns --------------------------------

LINE = "{lineitem}"
PERSON = "{customer}"
SPECIAL = {
    "PDX": pick("l_linenumber", "Primary", "Secondary", "x", None),
    "RAW_DX": pick("l_linenumber", "E11", "", "NONE", None, "I10"),
    "RAW_PPX": pick("l_linenumber", "0", "1", "2", "3", "10", "x", None),
    "RAW_DISCHARGE_DISPOSITION": pick("l_partkey", "30000000|638666", "1", None),
    "ADDRESS_STATE": pick("l_partkey", "fl", "GA", "ZZ", None),
    "ADDRESS_ZIP5": pick("l_partkey", "12345", "1234", "32608", "abcde", None),
    "ADDRESS_ZIP9": pick("l_partkey", "12345-6789", "123456789", "12345", None),
    "LAB_PX": pick("l_partkey", "123|85025", "85025", None),
    "RESULT_QUAL": pick("l_partkey", "POSITIVE", "low", "NONE", "", None),
    "OBSCLIN_RESULT_QUAL": pick("l_partkey", "POSITIVE", "low", "NONE", "", None),
    "DEATH_CAUSE": "'cause of ' || " + text("l_partkey % 3"),
    "ENC_TYPE": pick("l_partkey", "ip", "AV", "Emergency", None),
    "RAW_RESULT": pick("l_partkey", "12.5", "1e3", "nan", "1,000", None),
    "RESULT_UNIT": pick("l_partkey", "mg/dL", "MG/DL", "mL", None),
}
PARENT_KEYS = {
    "PATID": "CASE WHEN l_linenumber = 7 THEN NULL ELSE " + text("l_partkey") + " END",
    "ENCOUNTERID": "CASE WHEN l_linenumber = 6 THEN NULL ELSE " + text("l_orderkey") + " END",
}
MIXED_DATE = (
    f"CASE l_linenumber WHEN 1 THEN substr({SHIP_DAY}, 6, 2) || '/' || substr({SHIP_DAY}, 9, 2) || '/' || substr({SHIP_DAY}, 1, 4) "
    f"WHEN 2 THEN {SHIP_CLOCK} WHEN 3 THEN '' WHEN 4 THEN 'bad' WHEN 5 THEN NULL ELSE {SHIP_DAY} END"
)


def column(name: str, position: int, dirty: bool) -> str:
    """What a target column holds, by rules on its name."""
    upper = name.upper()
    if upper in PARENT_KEYS:
        return PARENT_KEYS[upper]
    if upper.endswith("PROVIDERID"):
        return text("l_suppkey")
    if upper in SPECIAL:
        return SPECIAL[upper]
    if upper.endswith(("ID", "ID_1", "ID_2")):
        return LINE_ID
    if upper.endswith(("_DATE", "_START", "_END")):
        return MIXED_DATE if dirty else SHIP_DAY
    if upper.endswith("_TIME"):
        return f"CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN 'bad' ELSE {SHIP_CLOCK} END" if dirty else "'10:30'"
    if upper.endswith(("DOSE", "QUANTITY", "REFILLS", "SUPPLY", "_NUM", "HT", "WT", "STOLIC", "BMI", "ORDERED")):
        number = text("CAST(l_quantity AS BIGINT)")
        return pick_number(number) if dirty else number
    return pick(f"l_partkey + {position}", "alpha", "Beta", "GAMMA", "delta", None)


def pick_number(number: str) -> str:
    return (
        f"CASE l_linenumber WHEN 1 THEN '1,' || lpad({number}, 3, '0') WHEN 2 THEN 'inf' WHEN 3 THEN '-' || {number} "
        f"WHEN 4 THEN '' WHEN 5 THEN NULL ELSE {number} || '.25' END"
    )


def shaped(columns: list[str], dirty: bool) -> str:
    """A table of the target's shape from lineitem."""
    picked = ", ".join(f"{column(c, i, dirty)} AS {c}" for i, c in enumerate(columns))
    return f"SELECT {picked} FROM {LINE}"


def for_duckdb(sql: str) -> str:
    for t in TABLES:
        sql = sql.replace(f"{{{t}}}", t)
    return sql


def for_spark(sql: str, sf_dir: str) -> str:
    for t in TABLES:
        sql = sql.replace(f"{{{t}}}", f"parquet.`{sf_dir}/{t}.parquet`")
    return sql
