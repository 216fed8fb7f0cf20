"""What a repair returns: the repaired rows, the rows it touched, and a report."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# columns that a repair adds to the rows it judged
TOUCHED, DROPPED, RENEWED = "__touched", "__dropped", "__new_"


@dataclass(frozen=True)
class Result:
    """``settle`` takes the judged rows where a repair has them, so that what follows reads them from a table."""

    good: DataFrame
    rejects: DataFrame | None = None
    report: DataFrame | None = None
    judged: DataFrame | None = None
    again: Callable[[DataFrame], Result] | None = None

    def settle(self, write: Callable[[DataFrame], DataFrame]) -> Result:
        """The same from rows that were written once; a repair of its own kind has only its good rows written."""
        if self.judged is None or self.again is None:
            return replace(self, good=write(self.good))
        return self.again(write(self.judged))


def from_judged(judged: DataFrame, columns: Sequence[str], shown: dict[str, str] | None = None, report: Callable[[DataFrame], DataFrame] | None = None) -> Result:
    """All parts of a result from rows that were judged once.

    ``TOUCHED`` marks the rows that a repair shows, as they were, with the columns of ``shown`` under their names
    there; ``DROPPED`` those that it takes away; a column with ``RENEWED`` before its name holds the repaired value.
    The report is made of the touched rows.
    """
    touched = judged.where(TOUCHED)
    kept = judged.where(f"NOT {DROPPED}") if DROPPED in judged.columns else judged
    return Result(
        good=kept.select(*[F.col(RENEWED + c).alias(c) if RENEWED + c in judged.columns else F.col(c) for c in columns]),
        rejects=touched.select(*columns, *[F.col(c).alias(n) for c, n in (shown or {}).items()]),
        report=report(touched) if report else None,
        judged=judged,
        again=lambda written: from_judged(written, columns, shown, report),
    )
