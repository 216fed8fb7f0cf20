"""Clinical code rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from careloom.functions.dates import DRG_CUTOFF, iso_date

# Result qualifiers kept as they are.
RESULT_QUALIFIERS = (
    "DETECTED", "NOT DETECTED", "POSITIVE", "NEGATIVE", "BORDERLINE", "HIGH", "LOW",
    "NORMAL", "ABNORMAL", "UNDETERMINED", "NO INFROMATION", "UNKNOWN", "OT", "OTHER",
)
# Discharge codes that mean the patient died.
EXPIRED_CODES = ("30000000|638666", "30000000|638667")


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def drg_version(admit_date: Column) -> Column:
    return _by_drg_cutoff(admit_date, "01", "02")


def drg_label(admit_date: Column) -> Column:
    return _by_drg_cutoff(admit_date, "CMS-DRG (old system)", "MS-DRG (current system)")


def _by_drg_cutoff(admit_date: Column, before: str, after: str) -> Column:
    day = iso_date(admit_date)
    return F.when(day < F.lit(DRG_CUTOFF).cast("date"), before).when(day.isNotNull(), after)


def condition_status(end_date: Column) -> Column:
    return F.when(_blank(end_date), "AC").otherwise("RS")


def lab_location(name: Column, prefix: str = "POC", missing: str = "L") -> Column:
    """Point-of-care tests carry a name prefix."""
    return F.when(name.isNull(), missing).when(F.startswith(name, F.lit(prefix)), "P").otherwise("L")


def prn_flag(frequency: Column) -> Column:
    asked = F.contains(frequency, F.lit("*as needed*"))
    return F.when(asked, "Y").when(frequency.isNotNull(), "N")


def principal_diagnosis(c: Column) -> Column:
    return F.when(c == "Primary", "P").when(c == "Secondary", "S").otherwise("NI")


def present_on_admission(c: Column) -> Column:
    return F.when(_blank(c) | (c == "NONE"), "N").otherwise("Y")


def principal_procedure(c: Column) -> Column:
    """Rank of a procedure: 1 principal, 2 secondary, above that other; 0 or no number unknown."""
    rank = F.when(F.trim(c).rlike("^[0-9]+$"), F.trim(c).try_cast("bigint"))
    return F.when(rank == 1, "P").when(rank == 2, "S").when(rank > 2, "OT").otherwise("UN")


def discharge_disposition(c: Column) -> Column:
    return F.when(c.isin(*EXPIRED_CODES), "E").otherwise("A")


def result_qualifier(c: Column) -> Column:
    return F.when(_blank(c) | (c == "NONE"), "NI").when(c.isin(*RESULT_QUALIFIERS), c).otherwise("OT")


def other_or_no_information(c: Column) -> Column:
    return F.when(_blank(c), "NI").otherwise("OT")


# --- encounter type of a claim -------------------------------------------------

# Claim codes, as published for institutional (U) and professional (H) forms.
BILL_INPATIENT = ("11", "12", "41", "84")
BILL_INSTITUTIONAL_STAY = (
    "15", "16", "18", "21", "22", "25", "26", "28", "31", "32", "35", "36", "38", "42", "81", "82", "85", "86",
)
BILL_AMBULATORY = ("13", "14", "23", "24", "33", "34", "7", "83")
REVENUE_EMERGENCY = ("045", "0981")
REVENUE_OBSERVATION = ("0760", "0761", "0762", "0769")
HCPCS_OBSERVATION = ("G0244", "G0378", "99217", "99218", "99219", "99220", "99224", "99225", "99226")
HCPCS_VISIT = (
    "99202", "99203", "99204", "99205", "99211", "99212", "99213", "99214", "99215", "99241", "99242",
    "99243", "99244", "99245", "99341", "99342", "99343", "99344", "99345", "99347", "99348", "99349",
    "99350", "99381", "99382", "99383", "99384", "99385", "99386", "99387", "99391", "99392", "99393",
    "99394", "99395", "99396", "99397", "99401", "99402", "99403", "99404", "99411", "99412", "99429",
    "99455", "99456", "99483", "G0402", "G0438", "G0439", "G0463", "T1015",
)
HCPCS_EMERGENCY_RANGE = (99281, 99285)
HCPCS_CONSULT_RANGE = (99251, 99255)
PLACE_TELEHEALTH = ("02", "10")
PLACE_FACILITY_CONSULT = ("21", "23", "25")
PLACE_AMBULATORY = (
    "03", "05", "07", "09", "11", "12", "13", "14", "15", "16", "17", "18", "19", "20", "22", "33",
    "49", "50", "71", "72",
)
PLACE_OTHER = (
    "", "01", "1", "10", "12", "13", "14", "15", "16", "27", "28", "29", "30", "31", "32", "34", "41",
    "42", "51", "52", "54", "55", "56", "61", "81", "99", "XX", "FI",
)
MODIFIER_TELEHEALTH = ("GT", "GQ", "95", "G0")


def clean_code(c: Column) -> Column:
    return F.upper(F.trim(F.coalesce(c, F.lit(""))))


def code_number(c: Column) -> Column:
    """The digits of a code, read as one number."""
    return F.regexp_replace(c, "[^0-9]", "").try_cast("bigint")


def starts_with_any(c: Column, prefixes: tuple[str, ...]) -> Column:
    return c.rlike(f"^(?:{'|'.join(prefixes)})")


def within(number: Column, bounds: tuple[int, int]) -> Column:
    return F.coalesce(number.between(*bounds), F.lit(False))


def encounter_type(
    form: Column, bill: Column, revenue: Column, hcpcs: Column, hcpcs_number: Column, place: Column, *modifiers: Column
) -> Column:
    """Encounter type of a claim line, from cleaned codes.  Rules are tried in order within a form."""

    def billed(types: tuple[str, ...]) -> Column:
        # a bill type may carry a leading zero
        return starts_with_any(bill, types + tuple("0" + t for t in types))

    emergency_care = within(hcpcs_number, HCPCS_EMERGENCY_RANGE)
    emergency = starts_with_any(revenue, REVENUE_EMERGENCY) | emergency_care
    observation = hcpcs.isin(*HCPCS_OBSERVATION)
    remote = reduce(
        Column.__or__, [m.isin(*MODIFIER_TELEHEALTH) for m in modifiers], place.isin(*PLACE_TELEHEALTH)
    )
    institutional = [
        (billed(BILL_INPATIENT) & emergency, "EI"),
        (billed(BILL_INPATIENT), "IP"),
        (billed(BILL_INSTITUTIONAL_STAY), "IS"),
        (emergency, "ED"),
        (revenue.isin(*REVENUE_OBSERVATION) | observation, "OS"),
        (billed(BILL_AMBULATORY), "AV"),
        (remote, "TH"),
        (bill != "", "OT"),
    ]
    professional = [
        (emergency_care, "ED"),
        (place.isin(*PLACE_FACILITY_CONSULT) | within(hcpcs_number, HCPCS_CONSULT_RANGE), "IC"),
        (observation, "OS"),
        (remote, "TH"),
        (place.isin(*PLACE_AMBULATORY) | hcpcs.isin(*HCPCS_VISIT), "AV"),
        (place.isin(*PLACE_OTHER), "OT"),
        (F.lit(True), "AV"),
    ]

    def first_match(rules: list[tuple[Column, str]]) -> Column:
        return F.coalesce(*[F.when(test, code) for test, code in rules], F.lit("NI"))

    return F.when(form == "U", first_match(institutional)).when(form == "H", first_match(professional)).otherwise("NI")
