"""Repair chains: the fixes of every table, in order, as one plan."""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame

from careloom.operators import orphans, repairs
from careloom.operators.result import Result

Fix = Callable[[DataFrame, "Context"], Result]


@dataclass(frozen=True)
class Context:
    """Parent tables and lists that fixes look up by name."""

    tables: Mapping[str, DataFrame] = field(default_factory=dict)
    lists: Mapping[str, DataFrame] = field(default_factory=dict)


@dataclass(frozen=True)
class Step:
    fix: str
    options: tuple[tuple[str, Any], ...] = ()

    @property
    def name(self) -> str:
        return "_".join([self.fix, *[str(v) for _, v in self.options]])


def step(fix: str, **options: Any) -> Step:
    return Step(fix, tuple(options.items()))


def _patient(df: DataFrame, at: Context) -> Result:
    return orphans.drop_orphans(df, at.tables["DEMOGRAPHIC"], "PATID")


def _encounter(df: DataFrame, at: Context) -> Result:
    return orphans.nullify_orphans(df, at.tables["ENCOUNTER"], "ENCOUNTERID")


def _provider(df: DataFrame, at: Context, field: str) -> Result:
    return orphans.nullify_orphans(df, at.tables["PROVIDER"], field, "PROVIDERID")


def _replicate(df: DataFrame, at: Context, how: str = "left") -> Result:
    return orphans.replicate(df, at.tables["ENCOUNTER"], "ENCOUNTERID", ["ADMIT_DATE", "ENC_TYPE"], how=how)


FIXES: dict[str, Callable[..., Result]] = {
    "patient_orphans": _patient,
    "encounter_orphans": _encounter,
    "provider_orphans": _provider,
    "replicate_encounter": _replicate,
    "copy_when_null": lambda df, at, field, other: repairs.copy_when_null(df, field, other),
    "delete_when_null": lambda df, at, field: repairs.delete_when_null(df, field),
    "invalid_to_null": lambda df, at, field, valueset: repairs.invalid_to_null(df, field, at.lists[valueset]),
    "clamp_early_date": lambda df, at, field: repairs.clamp_early_date(df, field),
    "remove_listed": lambda df, at, codes, column: repairs.remove_listed(df, column, at.lists[codes]),
    "remove_patterns": lambda df, at, patterns, column: repairs.remove_patterns(df, column, at.lists[patterns]),
}


def register_fix(name: str, fix: Callable[..., Result]) -> None:
    """Add a partner's own fix: ``(df, context, **options) -> Result``."""
    FIXES[name] = fix


def _usual(provider: str | None = None, encounter: bool = True, replicate: bool = False) -> tuple[Step, ...]:
    steps = [step("patient_orphans")]
    if encounter:
        steps.append(step("encounter_orphans"))
    if provider:
        steps.append(step("provider_orphans", field=provider))
    if replicate:
        steps.append(step("replicate_encounter"))
    return tuple(steps)


CHAINS: dict[str, tuple[Step, ...]] = {
    "CONDITION": _usual(),
    "DEATH_CAUSE": _usual(encounter=False),
    "DEATH": _usual(encounter=False),
    "DEMOGRAPHIC": (),
    "DIAGNOSIS": _usual("PROVIDERID", replicate=True),
    "DISPENSING": _usual(encounter=False),
    "ENCOUNTER": _usual("PROVIDERID", encounter=False),
    "ENROLLMENT": _usual(encounter=False),
    "HASH_TOKEN": (),
    "IMMUNIZATION": _usual("VX_PROVIDERID"),
    "LAB_RESULT_CM": _usual(),
    "LDS_ADDRESS_HISTORY": _usual(encounter=False),
    "MED_ADMIN": _usual("MEDADMIN_PROVIDERID"),
    "OBS_CLIN": _usual("OBSCLIN_PROVIDERID"),
    "OBS_GEN": _usual("OBSGEN_PROVIDERID"),
    "PRESCRIBING": _usual("RX_PROVIDERID"),
    "PROCEDURES": _usual("PROVIDERID", replicate=True),
    "PROVIDER": (),
    "VITAL": _usual(),
}
# Parents are repaired before the tables that point to them.
ORDER = ("DEMOGRAPHIC", "PROVIDER", "ENCOUNTER", *[t for t in CHAINS if t not in ("DEMOGRAPHIC", "PROVIDER", "ENCOUNTER")])


def run_chain(
    df: DataFrame, steps: Sequence[Step], context: Context, settle: Callable[[DataFrame, str], DataFrame] | None = None
) -> tuple[DataFrame, dict[str, Result]]:
    """The repaired table, and what each step touched.

    Without ``settle`` all is one lazy plan.  What a step touched is read off the rows that it judged, so whoever reads
    that for every step gives a ``settle`` that writes a table under a name and reads it back: each repair then runs
    once, and its good rows, rejects and report come from that table.
    """
    results: dict[str, Result] = {}
    for number, s in enumerate(steps):
        result = FIXES[s.fix](df, context, **dict(s.options))
        if settle:
            result = result.settle(functools.partial(settle, name=f"{number}_{s.name}"))
        results[s.name] = result
        df = result.good
    return df, results
