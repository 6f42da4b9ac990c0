"""Resolve the place of an entity through the postcode bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GEO_COLUMNS = (
    "unique_id",
    "name",
    "facility_type",
    "operator_type",
    "num_doctors",
    "capacity_beds",
    "address_city",
    "pincode",
    "district_norm",
    "state_name",
    "facility_state_norm",
    "latitude",
    "longitude",
)


def lookup(facts: DataFrame, dimension: DataFrame, key: str, spread_by: str) -> DataFrame:
    """Left join of facts to a dimension that has one row per key, the same way at every size.

    No hint and no count: the optimizer broadcasts a dimension it knows to be small, and
    otherwise both sides are shuffled and adaptive execution splits a very frequent key.
    Facts without a key match nothing; a second join column spreads them by ``spread_by``,
    so that they do not meet in one task.
    """
    spread = F.when(F.col(key).isNull(), F.xxhash64(spread_by)).otherwise(F.lit(0))
    # always 0, yet no constant: the optimizer would make a constant a filter, and then all facts without a
    # key meet in one task after all
    keyed = dimension.withColumn("_spread", F.pmod(F.xxhash64(key), F.lit(1)))
    return facts.withColumn("_spread", spread).join(keyed, [key, "_spread"], "left").drop("_spread")


def resolve(entities: DataFrame, bridge: DataFrame) -> DataFrame:
    """Entities with district and state; the own region is the fallback for the state.

    Keeps all entity columns.
    """
    return with_state(lookup(entities, bridge, "pincode", "unique_id"))


def with_state(joined: DataFrame) -> DataFrame:
    """The state of the place, else the entity's own region."""
    return joined.withColumn("state_name", F.coalesce("state_name", "state_norm"))


def geo_table(profiles: DataFrame) -> DataFrame:
    return profiles.withColumn("facility_state_norm", F.col("state_norm")).select(*GEO_COLUMNS)
