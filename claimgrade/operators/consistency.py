"""Whether the state an entity names is that of its postcode.

The directory gives runs of neighbouring postcodes of one state, so a postcode that the directory does not
list still has a state when it lies inside a run. Runs end at the borders of bins of postcodes: the interval
join is then an equality join on the bin, and a bin holds no more runs than postcodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimgrade.operators.geo import lookup

# postcodes in a bin
BIN = 1000


def state_ranges(bridge: DataFrame, width: int = BIN) -> DataFrame:
    """(bin, low, high, range_state): runs of listed postcodes with one state, none across bins.

    Rows of ``bridge`` without a postcode or state are left out; runs of a bin do not overlap.
    """
    listed = bridge.where("pincode IS NOT NULL AND state_name IS NOT NULL").select(F.expr(f"pincode div {width}").alias("bin"), "pincode", "state_name")
    here = Window.partitionBy("bin").orderBy("pincode")
    run = F.row_number().over(here) - F.row_number().over(Window.partitionBy("bin", "state_name").orderBy("pincode"))
    return (
        listed.withColumn("run", run)
        .groupBy("bin", F.col("state_name").alias("range_state"), "run")
        .agg(F.min("pincode").alias("low"), F.max("pincode").alias("high"))
        .select("bin", "low", "high", "range_state")
    )


def state_consistency(entities: DataFrame, bridge: DataFrame, width: int = BIN) -> DataFrame:
    """(unique_id, pincode, state_norm, postcode_state, consistency), one row per entity.

    ``consistency``: ``no_postcode``, ``outside`` (in no run), ``no_state`` (the entity names none),
    ``agrees`` or ``differs``, by the names without regard to case. Entities without a postcode are spread.
    """
    # one row per bin, so that the lookup stays one to one; its runs are bounded by the bin
    runs = state_ranges(bridge, width).groupBy("bin").agg(F.collect_list(F.struct("low", "high", "range_state")).alias("runs"))
    facts = entities.select("unique_id", "pincode", "state_norm", F.expr(f"pincode div {width}").alias("bin"))
    met = lookup(facts, runs, "bin", "unique_id")
    inside = F.filter("runs", lambda r: F.col("pincode").between(r["low"], r["high"]))
    # a bin without runs, or a postcode between two of them, gives null
    placed = met.withColumn("postcode_state", F.get(inside, 0)["range_state"])
    kind = (
        F.when(F.col("pincode").isNull(), "no_postcode")
        .when(F.col("postcode_state").isNull(), "outside")
        .when(F.col("state_norm").isNull(), "no_state")
        .when(F.lower("state_norm") == F.lower("postcode_state"), "agrees")
        .otherwise("differs")
    )
    return placed.select("unique_id", "pincode", "state_norm", "postcode_state", kind.alias("consistency"))
