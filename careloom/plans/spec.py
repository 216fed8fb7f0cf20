"""Declarative table jobs.

A job names its source table, the rows to keep, the lookups and, for every target
column, where its value comes from: a source column (a plain string), a constant
or a library function over source columns.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from careloom.functions import BY_NAME
from careloom.operators.lookup import lookup
from careloom.operators.project import project


@dataclass(frozen=True)
class Const:
    value: str


@dataclass(frozen=True)
class Use:
    function: str
    inputs: tuple[str, ...]
    options: tuple[tuple[str, Any], ...] = ()


def use(function: str, *inputs: str, **options: Any) -> Use:
    return Use(function, inputs, tuple(options.items()))


Value = str | Const | Use
BLANK = Const("")


def same(names: str, **others: Value) -> dict[str, Value]:
    """Target columns that keep their name, then those that do not."""
    return {**{n: n for n in names.split()}, **others}


@dataclass(frozen=True)
class Lookup:
    dim: str
    on: tuple[str, str]
    take: dict[str, str]
    where: str | None = None
    how: str = "left"
    last_by: tuple[str, ...] = ()


@dataclass(frozen=True)
class Job:
    source: str
    columns: dict[str, Value]
    where: str | None = None
    lookups: tuple[Lookup, ...] = field(default=())


def override(job: Job, **columns: Value) -> Job:
    """A job with a partner's own values for some columns."""
    return replace(job, columns={**job.columns, **columns})


def to_column(value: Value) -> Column:
    if isinstance(value, Const):
        return F.lit(value.value)
    if isinstance(value, Use):
        return BY_NAME[value.function](*[F.col(c) for c in value.inputs], **dict(value.options))
    return F.col(value)


def columns_used(job: Job) -> list[str]:
    used = [job_input for v in job.columns.values() for job_input in _inputs(v)]
    return used + [look.on[0] for look in job.lookups]


def _inputs(value: Value) -> tuple[str, ...]:
    if isinstance(value, Use):
        return value.inputs
    return () if isinstance(value, Const) else (value,)


def run_job(job: Job, tables: Mapping[str, DataFrame], passthrough: bool = False) -> DataFrame:
    """One lazy plan: filter, lookups, projection."""
    df = tables[job.source]
    if job.where:
        df = df.where(job.where)
    for look in job.lookups:
        df = lookup(
            df, tables[look.dim], dict([look.on]), look.take, how=look.how, where=look.where, last_by=look.last_by
        )
    return project(df, {n: to_column(v) for n, v in job.columns.items()}, passthrough, used=columns_used(job))
