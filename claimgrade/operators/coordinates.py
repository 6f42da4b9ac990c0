"""Coordinates that cannot be right, replaced by the centre of their postcode.

The centre is the median of each coordinate over the entities of a postcode that lie inside the box, so a few
wrong points do not move it. Values are counted on a grid before they meet: a postcode never sends more rows than
the box has grid values on an axis, however many entities it holds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimgrade.operators.geo import lookup

EARTH_KM = 6371.0


@dataclass(frozen=True)
class Repair:
    """Box of valid coordinates in degrees, entities that make a centre, kilometres that count as far,
    decimals of the grid (four are some eleven metres)."""

    latitude: tuple[float, float] = (6.0, 38.0)
    longitude: tuple[float, float] = (68.0, 98.0)
    least: int = 3
    far_km: float = 100.0
    decimals: int = 4


def _inside(rule: Repair) -> Column:
    """True or false, also for coordinates that are missing or no numbers."""
    both = F.col("latitude").between(*rule.latitude) & F.col("longitude").between(*rule.longitude)
    return F.coalesce(both, F.lit(False))


def centres(entities: DataFrame, rule: Repair = Repair()) -> DataFrame:
    """(pincode, centre_latitude, centre_longitude, n_points): lower medians on the grid, for postcodes with at
    least ``rule.least`` entities inside the box."""
    axes = [F.struct(F.lit(a).alias("axis"), F.round(a, rule.decimals).alias("v")) for a in ("latitude", "longitude")]
    values = entities.where(F.col("pincode").isNotNull() & _inside(rule)).select("pincode", F.inline(F.array(*axes)))
    counted = values.groupBy("pincode", "axis", "v").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("pincode", "axis")
    upto = group.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    half = counted.withColumns({"upto": F.sum("n").over(upto), "n_points": F.sum("n").over(group)}).where("2 * upto >= n_points")

    def median(axis: str) -> Column:
        return F.min(F.when(F.col("axis") == axis, F.col("v"))).alias(f"centre_{axis}")

    found = half.groupBy("pincode").agg(median("latitude"), median("longitude"), F.max("n_points").alias("n_points"))
    return found.where(F.col("n_points") >= rule.least)


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance of two points given in degrees; NULL where a coordinate is missing."""
    a, b = F.radians(lat1), F.radians(lat2)
    half_lat, half_lon = (b - a) / 2, F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), F.lit(2)) + F.cos(a) * F.cos(b) * F.pow(F.sin(half_lon), F.lit(2))
    return 2 * EARTH_KM * F.asin(F.sqrt(F.when(chord > 1, 1.0).otherwise(chord)))


def repair(entities: DataFrame, rule: Repair = Repair()) -> DataFrame:
    """(unique_id, pincode, latitude, longitude, distance_km, coordinates), one row per entity.

    ``coordinates``: ``kept``; ``far`` (kept as well, but over ``far_km`` from the centre of the postcode);
    ``repaired`` (outside the box) or ``filled`` (one or both missing), both with the centre of the postcode;
    ``hidden`` (neither usable coordinates nor a centre), with nulls. ``distance_km``, rounded to 0.1, is that of
    usable coordinates from the centre. Entities without a postcode are spread.
    """
    facts = entities.select("unique_id", "pincode", "latitude", "longitude")
    met = lookup(facts, centres(entities, rule), "pincode", "unique_id")
    inside, known = _inside(rule), F.col("centre_latitude").isNotNull()
    gap = great_circle_km(F.col("latitude"), F.col("longitude"), F.col("centre_latitude"), F.col("centre_longitude"))
    marked = met.withColumn("distance_km", F.when(inside & known, F.round(gap, 1)))
    kind = (
        F.when(inside & F.coalesce(F.col("distance_km") > rule.far_km, F.lit(False)), "far")
        .when(inside, "kept")
        .when(~known, "hidden")
        .when(F.col("latitude").isNull() | F.col("longitude").isNull(), "filled")
        .otherwise("repaired")
    )
    shown = [F.when(inside, F.col(a)).otherwise(F.col(f"centre_{a}")).alias(a) for a in ("latitude", "longitude")]
    return marked.select("unique_id", "pincode", *shown, "distance_km", kind.alias("coordinates"))
