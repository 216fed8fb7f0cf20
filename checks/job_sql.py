"""Table jobs in the other engine's SQL."""

from __future__ import annotations

from careloom.functions.clinical import EXPIRED_CODES, RESULT_QUALIFIERS
from careloom.functions.text import US_STATES
from careloom.plans.chains import Step
from careloom.plans.mapping import MapJob
from careloom.plans.spec import Const, Job, Lookup, Use, Value

NUMERIC = r"'^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'"
_DAYS = (
    "'%Y-%m-%d', '%Y-%m-%d %H:%M:%S', '%m/%d/%y', '%m/%d/%Y', '%m/%d/%Y %H:%M', '%m/%d/%Y %H:%M:%S', '%m/%d/%Y %I:%M %p', '%m/%d/%Y %I:%M:%S %p', "
    "'%Y%m%d', '%Y%m%d %H%M%S', '%Y/%m/%d', '%m-%d-%Y', '%d %b %Y', '%d-%b-%Y', '%d%b%Y', '%b %d, %Y'"
)
DATES = f"[{_DAYS}]"
TIMES = f"[{_DAYS}, '%H:%M:%S', '%H:%M']"
STRICT = "'%Y-%m-%d %H:%M:%S'"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def numeric(c: str) -> str:
    return f"regexp_matches(trim({c}), {NUMERIC})"


def double(c: str) -> str:
    return f"CASE WHEN {numeric(c)} THEN TRY_CAST(trim({c}) AS DOUBLE) END"


def _drg(c: str, before: str, after: str) -> str:
    day = f"CAST(try_strptime({c}, '%Y-%m-%d') AS DATE)"
    return f"CASE WHEN {day} < DATE '2007-10-01' THEN '{before}' WHEN {day} IS NOT NULL THEN '{after}' END"


def _whole_or_decimal(c: str) -> str:
    whole = f"CASE WHEN regexp_matches(trim({c}), '^[+-]?[0-9]+$') THEN CAST(TRY_CAST(trim({c}) AS BIGINT) AS VARCHAR) END"
    return f"coalesce({whole}, CAST({double(c)} AS VARCHAR))"


def _ppx(c: str) -> str:
    rank = f"CASE WHEN regexp_matches(trim({c}), '^[0-9]+$') THEN TRY_CAST(trim({c}) AS BIGINT) END"
    return f"CASE WHEN ({rank}) = 1 THEN 'P' WHEN ({rank}) = 2 THEN 'S' WHEN ({rank}) > 2 THEN 'OT' ELSE 'UN' END"


def _first_date(*cs: str) -> str:
    return f"coalesce({', '.join(f'nullif({c}, {chr(39) * 2})' for c in cs)}, '1900-01-01')"


FUNCTIONS = {
    "format_date": lambda c: f"strftime(try_strptime(trim({c}), {DATES}), '%Y-%m-%d')",
    "format_time": lambda c: f"strftime(try_strptime(trim({c}), {TIMES}), '%H:%M')",
    "date_of_datetime": lambda c: f"strftime(try_strptime({c}, {STRICT}), '%Y-%m-%d')",
    "time_of_datetime": lambda c: f"strftime(try_strptime({c}, {STRICT}), '%H:%M')",
    "time_by_position": lambda c: f"CASE WHEN {c} <> '' THEN substr({c}, 12, 5) END",
    "us_date": lambda c: f"strftime(try_strptime({c}, '%m/%d/%Y'), '%Y-%m-%d')",
    "date_or_default": lambda c: f"coalesce(strftime(try_strptime({c}, '%Y-%m-%d'), '%Y-%m-%d'), '1900-01-01')",
    "datetime_or_default": lambda c: f"coalesce(strftime(try_strptime({c}, '%Y-%m-%d'), '%Y-%m-%d'), '1900-01-01') || ' 00:00:00'",
    "first_date": _first_date,
    "to_double": double,
    "keep_if_numeric": lambda c: f"CASE WHEN {numeric(c)} THEN {c} END",
    "to_double_without_commas": lambda c: double(f"replace({c}, ',', '')"),
    "leading_quantity": lambda c: f"coalesce({double(c)}, {double(f'split_part({c}, chr(32), 1)')}, 0.0)",
    "whole_or_decimal": _whole_or_decimal,
    "strip_signs": lambda c: f"CASE WHEN {numeric(c)} THEN {c} WHEN {numeric(f'regexp_replace({c}, {chr(39)}[+-]{chr(39)}, {chr(39) * 2}, {chr(39)}g{chr(39)})')} "
    f"THEN regexp_replace({c}, '[+-]', '', 'g') END",
    "ratio_text": lambda c: f"CASE WHEN contains({c}, '/') THEN {c} END",
    "non_ratio_number": lambda c: f"CASE WHEN NOT contains({c}, '/') AND {numeric(c)} THEN {c} END",
    "null_word": lambda c: f"nullif({c}, 'NULL')",
    "after_pipe": lambda c: f"CASE WHEN contains({c}, '|') THEN split_part({c}, '|', 2) END",
    "first_eight": lambda c: f"substr({c}, 1, 8)",
    "strip_exponent_marks": lambda c: f"trim(trim({c}, 'eE'))",
    "zip5": lambda c: f"CASE WHEN regexp_matches({c}, '^[0-9]{{5}}$') THEN {c} END",
    "zip9": lambda c: f"CASE WHEN regexp_matches(replace({c}, '-', ''), '^[0-9]{{9}}$') THEN replace({c}, '-', '') END",
    "us_state": lambda c: f"CASE WHEN upper({c}) IN {_in(US_STATES)} THEN upper({c}) END",
    "npi_flag": lambda c: f"CASE WHEN regexp_matches({c}, '^[0-9]{{10}}$') THEN 'Y' ELSE 'N' END",
    "dash_join": lambda a, b: f"{a} || ' - ' || {b}",
    "without_controls": lambda c: f"regexp_replace({c}, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g')",
    "drg_version": lambda c: _drg(c, "01", "02"),
    "drg_label": lambda c: _drg(c, "CMS-DRG (old system)", "MS-DRG (current system)"),
    "condition_status": lambda c: f"CASE WHEN coalesce({c}, '') = '' THEN 'AC' ELSE 'RS' END",
    "lab_location": lambda c, prefix="POC", missing="L": f"CASE WHEN {c} IS NULL THEN '{missing}' WHEN starts_with({c}, '{prefix}') THEN 'P' ELSE 'L' END",
    "prn_flag": lambda c: f"CASE WHEN contains({c}, '*as needed*') THEN 'Y' WHEN {c} IS NOT NULL THEN 'N' END",
    "principal_diagnosis": lambda c: f"CASE {c} WHEN 'Primary' THEN 'P' WHEN 'Secondary' THEN 'S' ELSE 'NI' END",
    "present_on_admission": lambda c: f"CASE WHEN coalesce({c}, '') IN ('', 'NONE') THEN 'N' ELSE 'Y' END",
    "principal_procedure": _ppx,
    "discharge_disposition": lambda c: f"CASE WHEN {c} IN {_in(EXPIRED_CODES)} THEN 'E' ELSE 'A' END",
    "result_qualifier": lambda c: f"CASE WHEN coalesce({c}, '') IN ('', 'NONE') THEN 'NI' WHEN {c} IN {_in(RESULT_QUALIFIERS)} THEN {c} ELSE 'OT' END",
    "other_or_no_information": lambda c: f"CASE WHEN coalesce({c}, '') = '' THEN 'NI' ELSE 'OT' END",
}


def keyed(key: str, site: str, c: str, salt: str = "") -> str:
    """The digest of key, site and salt, each after its length in eight bytes, before the id."""
    parts = " || ".join(f"unhex('{len(p.encode()):016x}') || encode('{p}')" for p in (key, site, salt))
    return f"sha256(sha256({parts}) || {c})"


def value_sql(value: Value) -> str:
    if isinstance(value, Const):
        return f"'{value.value}'"
    if isinstance(value, Use):
        return FUNCTIONS[value.function](*value.inputs, **dict(value.options))
    return value


def _join(look: Lookup, n: int) -> str:
    taken = ", ".join(f"{c} AS {name}" for name, c in look.take.items())
    where = f" WHERE {look.where}" if look.where else ""
    last = ""
    if look.last_by:
        order = ", ".join(f"{c} DESC NULLS LAST" for c in look.last_by)
        last = f" QUALIFY row_number() OVER (PARTITION BY {look.on[1]} ORDER BY {order}) = 1"
    side = f"(SELECT {look.on[1]} AS k{n}, {taken} FROM {look.dim}{where}{last}) AS d{n}"
    return f"{look.how.upper()} JOIN {side} ON {look.on[0]} = k{n}"


def job_sql(job: Job, views: dict[str, str]) -> str:
    """A format job over views given as SQL."""
    names = {job.source, *[look.dim for look in job.lookups]}
    ctes = ", ".join(f"{n} AS ({views[n]})" for n in sorted(names))
    columns = ", ".join(f"{value_sql(v)} AS {n}" for n, v in job.columns.items())
    joins = " ".join(_join(look, i) for i, look in enumerate(job.lookups))
    source = f"(SELECT * FROM {job.source}{f' WHERE {job.where}' if job.where else ''}) AS s"
    return f"WITH {ctes} SELECT {columns} FROM {source} {joins}"


def code_values(dictionary: dict[tuple[str, str], dict[str, str]]) -> str:
    rows = ", ".join(
        f"('{t}', '{f}', '{s}', '{v}')" for (t, f), entries in dictionary.items() for s, v in entries.items()
    )
    return f"(VALUES {rows}) AS m(tbl, field, source_value, target_value)"


def map_sql(table: str, job: MapJob, columns: list[str], view: str, dictionary, site) -> str:
    """A map job over a view given as SQL."""
    out = []
    for c in columns:
        if c in job.ids:
            out.append(f"{keyed(site.key, site.code, c, table if c == job.salted else '')} AS {c}")
        elif c in job.codes + job.exact_codes + job.strict_codes:
            key = c if c in job.exact_codes else f"upper({c})"
            stored = "source_value" if c in job.exact_codes else "upper(source_value)"
            found = f"(SELECT max(target_value) FROM codes WHERE tbl = '{table}' AND field = '{c}' AND {stored} = {key})"
            out.append(f"{found} AS {c}" if c in job.strict_codes else f"coalesce({found}, {c}) AS {c}")
        else:
            out.append(c)
    out += [f"'{site.updated}' AS UPDATED", f"'{site.code}' AS SOURCE"]
    return (
        f"WITH codes AS (SELECT * FROM {code_values(dictionary)}), src AS ({view}) "
        f"SELECT {', '.join(out)} FROM src"
    )


def chain_sql(steps: tuple[Step, ...], columns: list[str], view: str, parents: dict[str, str]) -> str:
    """A repair chain over a view, one subquery per step."""
    sql = f"SELECT * FROM ({view})"
    for s in steps:
        options = dict(s.options)
        if s.fix == "patient_orphans":
            sql = f"SELECT * FROM ({sql}) AS c WHERE EXISTS (SELECT 1 FROM ({parents['DEMOGRAPHIC']}) p WHERE p.PATID = c.PATID)"
        elif s.fix in ("encounter_orphans", "provider_orphans"):
            parent, key, own = (
                ("ENCOUNTER", "ENCOUNTERID", "ENCOUNTERID")
                if s.fix == "encounter_orphans"
                else ("PROVIDER", "PROVIDERID", options["field"])
            )
            sql = (
                f"SELECT * REPLACE (CASE WHEN {own} IN (SELECT {key} FROM ({parents[parent]}) WHERE {key} IS NOT NULL) "
                f"THEN {own} END AS {own}) FROM ({sql})"
            )
        elif s.fix == "replicate_encounter":
            sql = (
                f"SELECT c.* REPLACE (e.a AS ADMIT_DATE, e.t AS ENC_TYPE) FROM ({sql}) AS c LEFT JOIN "
                f"(SELECT ENCOUNTERID AS k, min((ADMIT_DATE, ENC_TYPE))[1] AS a, min((ADMIT_DATE, ENC_TYPE))[2] AS t "
                f"FROM ({parents['ENCOUNTER']}) GROUP BY 1) AS e ON c.ENCOUNTERID = e.k"
            )
    return f"SELECT {', '.join(columns)} FROM ({sql})"
