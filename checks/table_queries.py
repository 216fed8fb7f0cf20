"""The table jobs on stand-ins: format (three families), map, repair."""

from __future__ import annotations

from checks import job_sql, views, written_sql
from checks.registry import Inputs, Views, query
from careloom.plans import chains, flat, mapping, omop, pcornet
from careloom.plans.spec import Const, Job, columns_used, override, run_job, use
from careloom.sources.reference import code_map

SITE = mapping.Site(code="ABC", key="test-key", updated="2024-01-01 00:00:00")
RUCA = (
    "SELECT lpad(CAST(12300 + n_nationkey * 3 AS STRING), 5, '0') AS zip, CAST(n_nationkey % 10 + 1 AS STRING) AS code "
    "FROM {nation}"
)


def _flat(table: str) -> None:
    sql = written_sql.flat_encounter() if table == "ENCOUNTER" else views.for_duckdb(job_sql.job_sql(flat.JOBS[table], views.FLAT))

    @query(f"fmt_flat_{table.lower()}", sql)
    def run(t: Inputs):
        return run_job(flat.JOBS[table], Views(t, views.FLAT))


@query(
    "column_override",
    f"SELECT * REPLACE ('HOSPITAL' AS FACILITY_TYPE, substr(PATID, 1, 8) AS RAW_SITEID) FROM ({written_sql.flat_encounter()})",
)
def _(t: Inputs):
    job = override(flat.JOBS["ENCOUNTER"], FACILITY_TYPE=Const("HOSPITAL"), RAW_SITEID=use("first_eight", "person_id"))
    return run_job(job, Views(t, views.FLAT))


def _omop(table: str) -> None:
    sql = VITAL_SQL if table == "VITAL" else views.for_duckdb(job_sql.job_sql(omop.JOBS[table], views.OMOP))

    @query(f"fmt_omop_{table.lower()}", sql)
    def run(t: Inputs):
        return omop.run(table, Views(t, views.OMOP))


def _vital_sql() -> str:
    """The collapse of vital signs: first filled value by date, time and id."""
    every = omop.id_list([i for ids in omop.VITAL_SIGNS.values() for i in ids])
    cases = ", ".join(
        f"CASE WHEN trim(measurement_concept_id) IN {omop.id_list(ids)} THEN value_as_number END AS {n}"
        for n, ids in omop.VITAL_SIGNS.items()
    )
    blanks = ", ".join(f"'' AS {n}" for n in omop.VITAL_SIGNS)
    m = f"SELECT *, {cases}, '' AS SMOKING FROM ({views.OMOP['measurement']}) WHERE trim(measurement_concept_id) IN {every}"
    o = (
        f"SELECT *, {blanks}, value_as_string AS SMOKING FROM ({views.OMOP['observation']}) "
        f"WHERE trim(observation_concept_id) IN {omop.id_list(omop.SMOKING)}"
    )
    parts = []
    for job, source in ((omop.VITAL_FROM_MEASUREMENT, m), (omop.VITAL_FROM_OBSERVATION, o)):
        columns = ", ".join(f"{job_sql.value_sql(v)} AS {n}" for n, v in job.columns.items())
        parts.append(f"SELECT {columns} FROM ({source})")
    order = ", ".join(f"{c} NULLS FIRST" for c in omop.VITAL_ORDER)

    def first(n: str) -> str:
        return f"first({n} ORDER BY {order}) FILTER (WHERE {n} <> '')"

    copies = {
        "TOBACCO": "SMOKING", "RAW_SMOKING": "SMOKING", "RAW_TOBACCO": "SMOKING",
        "RAW_DIASTOLIC": "DIASTOLIC", "RAW_SYSTOLIC": "SYSTOLIC",
    }
    own = ["VITALID", "MEASURE_DATE", "MEASURE_TIME", *omop.VITAL_SIGNS, "SMOKING"]
    empty = ("BP_POSITION", "TOBACCO_TYPE", "RAW_BP_POSITION", "RAW_TOBACCO_TYPE")
    out = [f"{first(n)} AS {n}" for n in own] + [f"{first(c)} AS {n}" for n, c in copies.items()]
    out += [f"NULL::VARCHAR AS {n}" for n in empty] + ["'OD' AS VITAL_SOURCE"]
    return f"SELECT ENCOUNTERID, PATID, {', '.join(out)} FROM ({' UNION ALL '.join(parts)}) GROUP BY ENCOUNTERID, PATID"


VITAL_SQL = views.for_duckdb(_vital_sql())


def _pcornet(table: str, sep: str = "~", called: str = "") -> None:
    job: Job = override(pcornet.JOBS[table], **pcornet.OTHER_VALUES.get((table, sep), {}))
    columns = list(dict.fromkeys(c.upper() for c in columns_used(job)))
    view = views.shaped(columns, dirty=True)

    @query(f"fmt_pcornet_{table.lower()}{called}", views.for_duckdb(job_sql.job_sql(job, {job.source: view})))
    def run(t: Inputs):
        return pcornet.run(table, t.view(view), sep)


# --- mapping -----------------------------------------------------------------------

DATED = {
    "CONDITION": "REPORT_DATE", "DEATH": "DEATH_DATE", "DIAGNOSIS": "DX_DATE ADMIT_DATE DX", "ENCOUNTER": "ADMIT_DATE DRG",
    "ENROLLMENT": "ENR_START_DATE ENR_END_DATE", "IMMUNIZATION": "VX_ADMIN_DATE VX_CODE VX_DOSE",
    "LAB_RESULT_CM": "RESULT_DATE LAB_LOINC RESULT_NUM", "LDS_ADDRESS_HISTORY": "ADDRESS_ZIP5 ADDRESS_PERIOD_START RUCA_ZIP",
    "MED_ADMIN": "MEDADMIN_START_DATE", "OBS_CLIN": "OBSCLIN_START_DATE OBSCLIN_CODE", "OBS_GEN": "OBSGEN_START_DATE OBSGEN_CODE",
    "PRESCRIBING": "RX_ORDER_DATE RXNORM_CUI", "PROCEDURES": "ADMIT_DATE PX PX_DATE", "VITAL": "MEASURE_DATE HT WT",
    "DISPENSING": "DISPENSE_DATE NDC", "PAT_RELATIONSHIP": "RELATIONSHIP_START", "PCORNET_TRIAL": "TRIALID TRIAL_ENROLL_DATE",
    "HARVEST": "NETWORKID DATAMART_NAME CDM_VERSION REFRESH_DEATH_DATE", "HASH_TOKEN": "TOKEN_01 TOKEN_ENCRYPTION_KEY",
    "DEATH_CAUSE": "DEATH_CAUSE", "PRO_CM": "PRO_DATE PRO_CODE", "EXTERNAL_MEDS": "EXT_RECORD_DATE RXNORM_CUI",
    "PROVIDER": "PROVIDER_NPI", "DEMOGRAPHIC": "BIRTH_DATE",
}


def target_columns(table: str) -> list[str]:
    """All columns of a target table, as its widest format job writes them."""
    widest = max((list(jobs[table].columns) for jobs in (pcornet.JOBS, flat.JOBS) if table in jobs), key=len, default=[])
    return widest + ([f"TOKEN_{k:02d}" for k in range(1, 33)] if table == "HASH_TOKEN" else [])


def mapped_columns(table: str) -> list[str]:
    job = mapping.JOBS[table]
    names = [*job.ids, *job.codes, *job.exact_codes, *job.strict_codes, *DATED[table].split(), "RAW_EXTRA_COLUMN"]
    return list(dict.fromkeys([*names, *target_columns(table)]))


def dictionaries(table: str) -> dict[tuple[str, str], dict[str, str]]:
    """A dictionary per coded field that covers some of what occurs, in another case."""
    job = mapping.JOBS[table]
    entries = {"ALPHA": "AA", "beta": "NI", "Gamma": "OT", "IP": "IP", "EMERGENCY": "ED"}
    units = {"alpha": "a", "BETA": "never", "mg/dL": "mg/dl", "MG/DL": "mg/dl"}
    fields = {(table, f): entries for f in job.codes + job.strict_codes}
    return fields | {(table, f): units for f in job.exact_codes}


def _map(table: str) -> None:
    columns, job = mapped_columns(table), mapping.JOBS[table]
    view, codes = views.shaped(columns, dirty=False), dictionaries(table)
    ruca = RUCA if table == "LDS_ADDRESS_HISTORY" else None
    stored = codes or {(table, "NONE"): {"x": "y"}}
    if ruca:
        sql = written_sql.map_address_history(view, lambda c: job_sql.keyed(SITE.key, SITE.code, c), SITE.updated, SITE.code, ruca)
    else:
        sql = views.for_duckdb(job_sql.map_sql(table, job, columns, view, stored, SITE))

    @query(f"map_{table.lower()}", sql)
    def run(t: Inputs):
        zips = t.view(f"SELECT zip AS ZIPCode, code AS PrimaryRUCA FROM ({RUCA})") if ruca else None
        return mapping.run(table, t.view(view), code_map(t.spark, stored), SITE, zips)


# --- repair chains -----------------------------------------------------------------

PARENTS = {
    "DEMOGRAPHIC": "SELECT CAST(c_custkey AS STRING) AS PATID FROM {customer} WHERE c_acctbal >= 0",
    "ENCOUNTER": "SELECT CAST(o_orderkey AS STRING) AS ENCOUNTERID, CAST(CAST(o_orderdate AS DATE) AS STRING) AS ADMIT_DATE, "
    "o_orderpriority AS ENC_TYPE FROM {orders} WHERE o_orderstatus <> 'P'",
    "PROVIDER": "SELECT CAST(s_suppkey AS STRING) AS PROVIDERID FROM {supplier} WHERE s_acctbal >= 1000",
}


def _chain(table: str) -> None:
    steps = chains.CHAINS[table]
    columns = [c for c in mapped_columns(table) if c != "RAW_EXTRA_COLUMN"]
    view = views.shaped(columns, dirty=False)

    if table == "DIAGNOSIS":
        sql = written_sql.repair_diagnoses(view, PARENTS["DEMOGRAPHIC"], PARENTS["ENCOUNTER"], PARENTS["PROVIDER"])
    else:
        sql = views.for_duckdb(job_sql.chain_sql(steps, columns, view, PARENTS))

    @query(f"chain_{table.lower()}", sql)
    def run(t: Inputs):
        return chains.run_chain(t.view(view), steps, chains.Context(Views(t, PARENTS)))[0]


for _table in flat.JOBS:
    _flat(_table)
for _table in omop.TABLES:
    _omop(_table)
for _table in pcornet.JOBS:
    _pcornet(_table)
_pcornet("PROCEDURES", "\t", "_tab")
_pcornet("ENCOUNTER", ";", "_semicolon")
for _table in mapping.JOBS:
    _map(_table)
for _table in chains.CHAINS:
    _chain(_table)
