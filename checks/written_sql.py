"""SQL of some table jobs, written from the target tables' rules and not from the job specs they check."""

from __future__ import annotations

from checks import views


def flat_encounter() -> str:
    """Visits with their last payers by id, the place of their care site, and its location's zip."""

    def payer(kinds: str) -> str:
        last = "arg_max({'plan': plan_class, 'name': plan_name, 'id': visit_payer_id}, visit_payer_id)"
        return f"(SELECT visit_occurrence_id AS visit, {last} AS payer FROM payers WHERE payer_type IN ({kinds}) GROUP BY 1)"

    return views.for_duckdb(f"""
    WITH visits AS ({views.FLAT['visit_occurrence']}), payers AS ({views.FLAT['visit_payer']}),
    sites AS ({views.FLAT['care_site']}), places AS ({views.FLAT['location']})
    SELECT v.visit_occurrence_id AS ENCOUNTERID, v.person_id AS PATID, v.visit_start_date AS ADMIT_DATE,
        substr(v.visit_start_datetime, 12, 5) AS ADMIT_TIME, v.visit_end_date AS DISCHARGE_DATE,
        nullif(substr(v.visit_end_datetime, 12, 5), '') AS DISCHARGE_TIME, v.provider_id AS PROVIDERID,
        (SELECT p.zip_5 FROM sites s JOIN places p ON s.location_id = p.location_id WHERE s.care_site_id = v.care_site_id) AS FACILITY_LOCATION,
        v.visit_type AS ENC_TYPE, v.care_site_id AS FACILITYID, v.discharge_status AS DISCHARGE_DISPOSITION,
        v.discharge_to AS DISCHARGE_STATUS, v.drg AS DRG, if(v.visit_start_date < '2007-10-01', '01', '02') AS DRG_TYPE,
        v.admitted AS ADMITTING_SOURCE, one.payer.plan AS PAYER_TYPE_PRIMARY, two.payer.plan AS PAYER_TYPE_SECONDARY,
        (SELECT s.place_of_service FROM sites s WHERE s.care_site_id = v.care_site_id) AS FACILITY_TYPE,
        v.care_site_id AS RAW_SITEID, v.visit_type AS RAW_ENC_TYPE, v.discharge_status AS RAW_DISCHARGE_DISPOSITION,
        v.discharge_to AS RAW_DISCHARGE_STATUS,
        if(v.visit_start_date < '2007-10-01', 'CMS-DRG (old system)', 'MS-DRG (current system)') AS RAW_DRG_TYPE,
        v.admitted_source_value AS RAW_ADMITTING_SOURCE, v.care_site_id AS RAW_FACILITY_TYPE,
        one.payer.plan AS RAW_PAYER_TYPE_PRIMARY, one.payer.name AS RAW_PAYER_NAME_PRIMARY, one.payer.id AS RAW_PAYER_ID_PRIMARY,
        two.payer.plan AS RAW_PAYER_TYPE_SECONDARY, two.payer.name AS RAW_PAYER_NAME_SECONDARY, two.payer.id AS RAW_PAYER_ID_SECONDARY
    FROM visits v LEFT JOIN {payer("'Primary', 'primary', 'Primary Payer'")} one ON one.visit = v.visit_occurrence_id
    LEFT JOIN {payer("'Secondary', 'secondary', 'Secondary Payer'")} two ON two.visit = v.visit_occurrence_id
    """)


def map_address_history(view: str, digest, updated: str, source: str, zips: str) -> str:
    """Two ids as pseudonyms, five coded columns by a dictionary without case, and the zip's rural code."""

    def code(c: str) -> str:
        return f"CASE upper({c}) WHEN 'ALPHA' THEN 'AA' WHEN 'BETA' THEN 'NI' WHEN 'GAMMA' THEN 'OT' WHEN 'IP' THEN 'IP' WHEN 'EMERGENCY' THEN 'ED' ELSE {c} END AS {c}"

    return views.for_duckdb(f"""
    SELECT src.* REPLACE ({digest('ADDRESSID')} AS ADDRESSID, {digest('PATID')} AS PATID, {code('ADDRESS_USE')}, {code('ADDRESS_TYPE')},
        {code('ADDRESS_PREFERRED')}, {code('ADDRESS_STATE')}, {code('CURRENT_ADDRESS_FLAG')}, coalesce(z.code, '') AS RUCA_ZIP),
        '{updated}' AS UPDATED, '{source}' AS SOURCE
    FROM ({view}) src LEFT JOIN ({zips}) z ON z.zip = upper(src.ADDRESS_ZIP5)
    """)


def repair_diagnoses(view: str, patients: str, encounters: str, providers: str) -> str:
    """Diagnoses of known patients; unknown encounters and providers are none; date and type are the encounter's."""
    return views.for_duckdb(f"""
    SELECT d.* REPLACE (e.ENCOUNTERID AS ENCOUNTERID, p.PROVIDERID AS PROVIDERID, e.ADMIT_DATE AS ADMIT_DATE, e.ENC_TYPE AS ENC_TYPE)
    FROM ({view}) d SEMI JOIN ({patients}) k ON k.PATID = d.PATID
    LEFT JOIN ({encounters}) e ON e.ENCOUNTERID = d.ENCOUNTERID LEFT JOIN ({providers}) p ON p.PROVIDERID = d.PROVIDERID
    """)
