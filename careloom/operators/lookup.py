"""Lookups: bring columns of a dimension to the rows of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from careloom.functions.text import county_key, zip_key
from careloom.operators.dedup import last_per_key
from careloom.operators.keys import SPREAD, left_join_grouped, spread, with_spread


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    *,
    how: str = "left",
    where: str | None = None,
    last_by: Sequence[str] = (),
) -> DataFrame:
    """Join ``dim`` on ``{column of df: column of dim}`` and take ``{new name: column of dim}``.

    Only the key and the taken columns of the dimension travel.  ``last_by`` keeps
    the last dimension row per key first.  No broadcast is forced: Spark compares
    the measured size of the dimension with its threshold and otherwise sorts.
    """
    side = dim.where(where) if where else dim
    keys = [f"__k{i}" for i in range(len(on))]
    if last_by:
        side = last_per_key(side, list(on.values()), last_by)
    side = side.select(
        *[F.col(c).alias(k) for c, k in zip(on.values(), keys)], *[F.col(c).alias(n) for n, c in take.items()]
    )
    test = [df[left] == side[k] for left, k in zip(on, keys)]
    if last_by:
        # the side is grouped by its key already; see keys.spread
        first = next(iter(on))
        df = with_spread(df, first)
        side = side.withColumn(keys[0], F.col(keys[0]).try_cast(df.schema[first].dataType))
        side = side.withColumn("__side", spread(F.col(keys[0])))
        test = [df[left] == side[k] for left, k in zip(on, keys)] + [df[SPREAD] == side["__side"]]
    return df.join(side, test, how).drop(*keys, SPREAD, "__side")


def remap_ids(df: DataFrame, id_map: DataFrame, column: str, old: str, new: str) -> DataFrame:
    """Replace ids by those of a map; rows without an entry are left out."""
    side = id_map.select(F.col(old).alias("__old"), F.col(new).alias("__new"))
    joined = df.join(side, F.col(column) == F.col("__old"), "inner")
    return joined.withColumn(column, F.col("__new")).select(*df.columns)


def zip_to_ruca(df: DataFrame, ruca_zip: DataFrame, zip_column: str, name: str = "RUCA_ZIP") -> DataFrame:
    side = ruca_zip.groupBy(zip_key(F.col("ZIPCode").cast("string")).alias("__zip")).agg(
        F.max(F.col("PrimaryRUCA").cast("string")).alias("__ruca")
    )
    joined = left_join_grouped(df, side, F.upper(F.col(zip_column)), "__zip")
    return joined.withColumn(name, F.coalesce("__ruca", F.lit(""))).drop("__ruca")


def county_to_fips(df: DataFrame, tracts: DataFrame, county_column: str, name: str = "COUNTY_FIPS") -> DataFrame:
    side = tracts.groupBy(county_key(F.col("CountyName20")).alias("__county")).agg(
        F.max(F.col("CountyFIPS20").cast("string")).alias("__fips")
    )
    joined = left_join_grouped(df, side, F.upper(F.col(county_column)), "__county")
    return joined.withColumn(name, F.col("__fips")).drop("__fips")


def zip_to_state_fips(
    df: DataFrame, ruca_zip: DataFrame, tracts: DataFrame, zip_column: str, name: str = "STATE_FIPS"
) -> DataFrame:
    """Zip to state, then state to its FIPS code, as read from the urban area's last two letters."""
    state = (
        tracts.where(F.length("UrbanAreaName20") >= 2)
        .groupBy(F.right(F.col("UrbanAreaName20"), F.lit(2)).alias("__state"))
        .agg(F.max(F.col("StateFIPS20").cast("string")).alias("__fips"))
    )
    zips = (
        ruca_zip.groupBy(zip_key(F.col("ZIPCode").cast("string")).alias("__zip"))
        .agg(F.max("State").alias("__state"))
        .join(state, "__state", "left")
        .drop("__state")
    )
    joined = left_join_grouped(df, zips, F.col(zip_column), "__zip")
    return joined.withColumn(name, F.col("__fips")).drop("__fips")
