"""Merge an address history with newly received addresses."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careloom.functions.dates import earlier_of, later_of, parse_date
from careloom.operators.keys import SPREAD, WIDTH, spread, with_spread


@dataclass(frozen=True)
class HistoryColumns:
    entity: str = "PATID"
    attribute: str = "ADDRESS_ZIP5"
    start: str = "ADDRESS_PERIOD_START"
    end: str = "ADDRESS_PERIOD_END"


def merge_history(
    existing: DataFrame, incoming: DataFrame, columns: HistoryColumns = HistoryColumns(), *, add_new: bool = True, parity: bool = False
) -> DataFrame:
    """Every existing period once, widened, closed or as it was, plus the new periods.

    * the same attribute came in again: the period is widened to the earliest and latest
      starts received;
    * else, only others came in: it ends at the earliest of their starts that is later
      than its own;
    * else it stays as it is;
    * incoming rows whose entity and attribute are not there yet are added; without
      ``add_new`` only those of unknown entities.

    A missing entity or attribute equals a missing one.  So the result has the existing
    rows and the new ones, and a second run adds nothing.

    Incoming rows are reduced to one summary per (entity, attribute) and one per entity,
    which lists its different days; no step builds all pairs of an entity's rows.  With
    ``parity`` an existing row comes out once for each of the first two cases that apply,
    as in data already released.
    """
    c = columns
    types = {n: F.col(n).try_cast(existing.schema[n].dataType) for n in (c.entity, c.attribute)}
    incoming = incoming.withColumns(types)
    if parity:
        return _fanned_out(existing, incoming, c, add_new)
    day = parse_date(F.col(c.start))
    starts = F.struct(day.alias("day"), F.col(c.start).alias("text"))
    known = F.when(day.isNotNull(), starts)
    same = incoming.groupBy(F.col(c.entity).alias("__e"), F.col(c.attribute).alias("__a")).agg(
        F.min(known).alias("__first"), F.max(known).alias("__last"), F.lit(True).alias("__same")
    )
    # an entity has at most as many entries as the calendar has days
    days = incoming.where(day.isNotNull()).groupBy(F.col(c.entity).alias("__o"), day.alias("__day")).agg(F.min(c.start).alias("__text"))
    days = days.groupBy("__o").agg(F.array_sort(F.collect_list(F.struct(F.col("__day").alias("day"), F.col("__text").alias("text")))).alias("__days"))

    joined = _beside(existing, same, [(c.entity, "__e"), (c.attribute, "__a")])
    joined = _beside(joined, days, [(c.entity, "__o")])
    later = F.filter("__days", lambda d: d["day"] > day)
    following = F.when(day.isNotNull(), later).otherwise(F.col("__days"))
    end = F.when(F.col("__same"), later_of(F.coalesce(c.start, "__last.text"), F.col("__last.text")))
    end = end.otherwise(F.coalesce(F.get(following, F.lit(0))["text"], F.col(c.end)))
    start = F.when(F.col("__same"), earlier_of(F.coalesce(c.start, "__first.text"), F.col("__first.text"))).otherwise(F.col(c.start))
    kept = joined.withColumns({"__start": start, "__end": end})
    kept = kept.withColumns({c.start: F.col("__start"), c.end: F.col("__end")}).select(*existing.columns)
    return kept.unionByName(_fresh(existing, incoming, [c.entity, c.attribute] if add_new else [c.entity]))


def _beside(df: DataFrame, side: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Rows beside the one row of the other side that equals them, a missing value equalling a missing one.

    The second key is made of the values themselves, so the join has exchanges of its own and a hot value is split.
    """
    mark = F.pmod(F.xxhash64(*[F.col(k) for _, k in on]), F.lit(WIDTH))
    own = F.pmod(F.xxhash64(*[F.col(k) for k, _ in on]), F.lit(WIDTH))
    test = reduce(lambda a, b: a & b, [F.col(x).eqNullSafe(F.col(y)) for x, y in on])
    side, df = side.withColumn("__mark", mark), df.withColumn("__own", own)
    return df.join(side, test & (F.col("__own") == F.col("__mark")), "left").drop("__own", "__mark", *[y for _, y in on])


def _fresh(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    known = existing.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    test = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return incoming.join(known, test, "left_anti").select(*existing.columns)


def _fanned_out(existing: DataFrame, incoming: DataFrame, c: HistoryColumns, add_new: bool) -> DataFrame:
    per_value = incoming.groupBy(F.col(c.entity).alias("__e"), F.col(c.attribute).alias("__a")).agg(
        F.min_by(c.start, parse_date(F.col(c.start))).alias("__first"),
        F.max_by(c.start, parse_date(F.col(c.start))).alias("__last"),
    )
    others = _earliest_two(per_value)

    held = with_spread(existing, c.entity)
    joined = held.join(
        others.withColumn("__side", spread(F.col("__e"))),
        (F.col(c.entity) == F.col("__e")) & (F.col(SPREAD) == F.col("__side")),
        "left",
    )
    other = F.when(F.col(c.attribute).isNull(), F.col("__any")).when(
        F.col("__v1.a") != F.col(c.attribute), F.col("__v1")
    )
    other = F.coalesce(other, F.when(F.col(c.attribute).isNotNull(), F.col("__v2")))
    untouched = joined.where(F.col("__any").isNull()).select(*existing.columns)
    closed = (
        joined.withColumn("__other", other)
        .where(F.col("__other").isNotNull())
        .withColumn(c.end, later_of(F.col(c.start), F.col("__other.start")))
        .select(*existing.columns)
    )
    same = held.join(
        per_value.withColumn("__side", spread(F.col("__e"))),
        (F.col(c.entity) == F.col("__e")) & (F.col(c.attribute) == F.col("__a")) & (F.col(SPREAD) == F.col("__side")),
        "inner",
    )
    widened = (
        same.withColumn("__end", later_of(F.col(c.start), F.col("__last")))
        .withColumn(c.start, earlier_of(F.col(c.start), F.col("__first")))
        .withColumn(c.end, F.col("__end"))
        .select(*existing.columns)
    )
    known = existing.select(F.col(c.entity), F.col(c.attribute)) if add_new else existing.select(c.entity)
    fresh = incoming.join(known, known.columns, "left_anti").select(*existing.columns)
    return untouched.unionByName(closed).unionByName(widened).unionByName(fresh)


def _earliest_two(per_value: DataFrame) -> DataFrame:
    """Per entity: the earliest start of all, and of the two earliest different attributes.

    Two are enough to find the earliest start of an attribute other than a given one.
    The rank filter also runs before the shuffle.
    """
    by_start = [parse_date(F.col("__first")).asc_nulls_last(), F.col("__a")]
    pair = F.struct(F.col("__a").alias("a"), F.col("__first").alias("start"))
    ranked = (
        per_value.withColumn("__known", F.col("__a").isNotNull())
        .withColumn("__rank", F.row_number().over(Window.partitionBy("__e", "__known").orderBy(*by_start)))
        .where("__rank <= 2")
    )

    def nth(n: int):
        return F.max(F.when(F.col("__known") & (F.col("__rank") == n), pair))

    first_of_all = F.min_by(pair, F.struct(parse_date(F.col("__first")).isNull(), parse_date(F.col("__first")), F.col("__a")))
    return ranked.groupBy("__e").agg(nth(1).alias("__v1"), nth(2).alias("__v2"), first_of_all.alias("__any"))
