"""Typed schemas from the data model's field list.

The spec is a table ``TABLE_NAME, FIELD_NAME, RDBMS_DATA_TYPE``; a text type is
``RDBMS Text(n)`` or, with open width, ``RDBMS Text(x)``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from careloom.functions.dates import iso_date
from careloom.operators.profile import width_profile

# Widths agreed for open-width keys.
KEY_WIDTHS = {
    "PATID": 64,
    "PATID_1": 64,
    "PATID_2": 64,
    "PERSON_ID": 64,
    "ENCOUNTERID": 128,
    "PROVIDERID": 64,
    "VX_PROVIDERID": 64,
    "MEDADMIN_PROVIDERID": 64,
    "OBSGEN_PROVIDERID": 64,
    "OBSCLIN_PROVIDERID": 64,
    "RX_PROVIDERID": 64,
    "PROCEDURESID": 128,
    "PRESCRIBINGID": 128,
}
# Audit columns of a loaded table.
AUDIT_WIDTHS = {"UPDATED": 19, "SOURCE": 20}
EMPTY_TABLE_WIDTH = 20
EMPTY_UPDATED_WIDTH = 100


def table_fields(spec: DataFrame, table: str) -> list[tuple[str, str]]:
    """(field, type) of one table in the spec's order."""
    rows = spec.where(F.col("TABLE_NAME") == table).select("FIELD_NAME", "RDBMS_DATA_TYPE")
    return [tuple(r) for r in rows.collect()]  # one table's fields: tens of rows


def observed_widths(df: DataFrame) -> dict[str, int]:
    """Longest text per column, from one aggregate over the table."""
    return {r["field"]: r["width"] for r in width_profile(df).collect()}  # one row per column


def _field(name: str, rdbms: str, observed: dict[str, int] | None) -> T.StructField:
    if "RDBMS Date" in rdbms:
        return T.StructField(name, T.DateType())
    if "RDBMS Number" in rdbms:
        return T.StructField(name, T.DoubleType())
    if "RDBMS Text" not in rdbms:
        return T.StructField(name, T.StringType())
    declared = re.search(r"\((\w+)\)", rdbms)[1]
    if observed is None:
        width = int(declared) if declared.isdigit() else KEY_WIDTHS.get(name, EMPTY_TABLE_WIDTH)
    else:
        seen = observed.get(name, 1)
        base = int(declared) if declared.isdigit() else (seen if "RAW" in name else KEY_WIDTHS.get(name, 0))
        width = max(base, seen)
    return T.StructField(name, T.StringType(), metadata={"maxlength": width})


def table_schema(fields: list[tuple[str, str]], observed: dict[str, int] | None = None) -> T.StructType:
    """Typed schema of a table; with observed widths the columns outside the spec follow as text."""
    schema = [_field(n, t, observed) for n, t in fields]
    known = {n for n, _ in fields} | set(AUDIT_WIDTHS)
    if observed is not None:
        schema += [
            T.StructField(n, T.StringType(), metadata={"maxlength": w}) for n, w in observed.items() if n not in known
        ]
    audit = dict(AUDIT_WIDTHS)
    if observed is None:
        audit["UPDATED"] = EMPTY_UPDATED_WIDTH
    schema += [T.StructField(n, T.StringType(), metadata={"maxlength": w}) for n, w in audit.items()]
    return T.StructType(schema)


def sql_type(field: T.StructField) -> str:
    if isinstance(field.dataType, T.DateType):
        return "DATE"
    if isinstance(field.dataType, T.DoubleType):
        return "FLOAT"
    width = field.metadata.get("maxlength")
    return f"VARCHAR({width})" if width else "STRING"


def ddl(schema: T.StructType) -> str:
    """Column list for CREATE TABLE, as the JDBC writer's createTableColumnTypes takes it."""
    return ",\n".join(f"{f.name} {sql_type(f)}" for f in schema)


def parse_ddl(text: str) -> T.StructType:
    """The schema that a column list describes."""
    fields = []
    for line in filter(None, (part.strip() for part in text.split(",\n"))):
        name, kind = line.split(None, 1)
        width = re.search(r"\((\d+)\)", kind)
        rdbms = {"DATE": "RDBMS Date", "FLOAT": "RDBMS Number(x)"}.get(kind.rstrip(",").upper())
        fields.append(_field(name, rdbms or (f"RDBMS Text({width[1]})" if width else "plain"), None))
    return T.StructType(fields)


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast by name; a value that does not fit its type becomes NULL, a missing column is NULL."""

    def typed(f: T.StructField):
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType)
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            return iso_date(c) if df.schema[f.name].dataType.typeName() == "string" else c.cast("date")
        return c.try_cast(f.dataType)

    return df.select(*[typed(f).alias(f.name, metadata=f.metadata) for f in schema])
