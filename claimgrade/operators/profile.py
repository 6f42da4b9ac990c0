"""Data-quality profiles of the raw tables.

Counts of distinct values are taken by grouping and counting the groups: each
grouping combines on the map side first, and a frequent value costs one row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgrade.config import FACILITY, CapabilityTerms, GradingConfig
from claimgrade.functions.text import contains_any, json_array
from claimgrade.operators.clean import region, remap
from claimgrade.operators.geo import lookup

KEY_COLUMNS = {"id": "unique_id", "cluster": "cluster_id", "region": "address_stateOrRegion"}
SUPPORTS = (25, 50, 100, 250)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def keys(raw: DataFrame) -> DataFrame:
    """Per key column: rows, distinct values, values and rows that repeat."""

    def one(label: str, column: str) -> DataFrame:
        groups = raw.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
        present = F.col("v").isNotNull()
        repeated = present & (F.col("n") > 1)
        return groups.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count_if(present).alias("distinct_values"),
            F.count_if(repeated).alias("repeated_values"),
            F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("repeated_rows"),
        ).select(F.lit(label).alias("key"), "*")

    return _union([one(label, column) for label, column in KEY_COLUMNS.items()])


def top_groups(raw: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Rows per value, most frequent first; a limit is optional."""
    counted = raw.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    if n is None:
        return counted
    return counted.orderBy(F.col("n_rows").desc(), F.col("value").asc_nulls_last()).limit(n)


def invalid_codes(raw: DataFrame, cfg: GradingConfig = FACILITY) -> DataFrame:
    """Rows whose type or operator code is not an accepted one."""
    bad_type = ~F.coalesce(F.col("facilityTypeId").isin(*cfg.valid_types), F.lit(False))
    bad_operator = ~F.coalesce(F.col("operatorTypeId").isin(*cfg.valid_operators), F.lit(False))
    return raw.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(bad_type).alias("invalid_type"),
        F.count_if(bad_operator).alias("invalid_operator"),
    )


def geo_bounds(
    raw: DataFrame,
    latitude: tuple[float, float] = (6.0, 38.0),
    longitude: tuple[float, float] = (68.0, 98.0),
) -> DataFrame:
    """Rows inside and outside a bounding box, and rows without coordinates."""
    known = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    inside = F.col("latitude").between(*latitude) & F.col("longitude").between(*longitude)
    return raw.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(known & inside).alias("inside"),
        F.count_if(known & ~inside).alias("outside"),
        F.count_if(~known).alias("unknown"),
    )


def null_literals(
    raw: DataFrame,
    numeric: tuple[str, ...] = ("numberDoctors", "capacity"),
    text: tuple[str, ...] = ("officialWebsite",),
    literal: str = "null",
) -> DataFrame:
    """Per column: numbers, the text that stands for nothing, missing values. One scan."""

    def counts(column: str) -> Column:
        c = F.col(column)
        number = F.count_if(c.try_cast("int").isNotNull()) if column in numeric else F.lit(None).cast("bigint")
        return F.struct(
            F.lit(column).alias("column_name"),
            number.alias("numeric_values"),
            F.count_if(c == literal).alias("null_literals"),
            F.count_if(c.isNull()).alias("missing"),
        )

    return raw.agg(F.array(*[counts(c) for c in (*numeric, *text)]).alias("c")).select(F.inline("c"))


def join_quality(
    raw: DataFrame, bridge: DataFrame, indicators: DataFrame, cfg: GradingConfig = FACILITY
) -> DataFrame:
    """How well postcodes resolve: readable, matched, state agreeing or not, and how many rows
    reach district indicators through them."""
    rows = raw.select(
        "source_content_id",
        F.col("address_zipOrPostcode").try_cast("bigint").alias("pincode"),
        region(F.col("address_stateOrRegion"), cfg.regions).alias("own_state"),
    )
    # districts are marked in the bridge, which has one row per postcode, not in the facts
    known = indicators.select("district_norm").distinct().withColumn("indicated", F.lit(True))
    marked = bridge.join(known, "district_norm", "left").select(
        "pincode", "state_name", "indicated", F.lit(True).alias("matched")
    )
    joined = lookup(rows, marked, "pincode", "source_content_id")
    matched = F.coalesce("matched", F.lit(False))
    agree = F.coalesce(F.lower("own_state") == F.lower("state_name"), F.lit(False))
    return joined.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("pincode").between(100000, 999999)).alias("parseable"),
        F.count_if(matched).alias("matched"),
        F.count_if(matched & agree).alias("state_agrees"),
        F.count_if(matched & ~agree).alias("state_differs"),
        F.count_if(F.coalesce("indicated", F.lit(False))).alias("with_indicators"),
    )


def _mentions(column: str, terms: CapabilityTerms) -> str:
    every = dict.fromkeys([*terms.structured, *terms.structured_prefix, *terms.claim, *terms.prose])
    return contains_any(column, every)


def capability_by_type(raw: DataFrame, cfg: GradingConfig = FACILITY) -> DataFrame:
    """Rows whose name or texts mention a capability, in all and by entity type."""
    columns = ("name", "description", "specialties", "procedure", "equipment", "capability")
    text = F.lower(F.concat_ws(" ", *[F.col(c) for c in columns]))
    mentioned = raw.select(
        remap(F.col("facilityTypeId"), cfg.type_remap).alias("facility_type"), text.alias("t")
    ).select(
        "facility_type",
        F.explode(
            F.array_compact(
                F.array(*[F.when(F.expr(_mentions("t", t)), F.lit(t.capability)) for t in cfg.lexicon])
            )
        ).alias("capability"),
    )
    types = list(dict.fromkeys(cfg.type_remap.get(t, t) for t in cfg.valid_types))
    return mentioned.groupBy("capability").agg(
        F.count(F.lit(1)).alias("any_match"),
        *[F.count_if(F.col("facility_type") == t).alias(t) for t in types],
    )


def _phrases(raw: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Normalised phrases of list columns with their counts."""
    lists = F.array(
        *[F.struct(F.lit(c).alias("column_name"), json_array(F.col(c)).alias("items")) for c in columns]
    )
    return (
        raw.select(F.inline(lists))
        .select("column_name", F.explode("items").alias("item"))
        .select("column_name", F.lower(F.trim("item")).alias("phrase"))
        .where("phrase <> ''")
        .groupBy("column_name", "phrase")
        .agg(F.count(F.lit(1)).alias("n"))
    )


VOCABULARY_COLUMNS = ("capability", "specialties", "procedure", "equipment")


def vocabulary(raw: DataFrame, cfg: GradingConfig = FACILITY) -> DataFrame:
    """Distinct phrases per list column, and how many mention a known capability."""
    known = [t for terms in cfg.lexicon for t in (*terms.structured, *terms.claim, *terms.prose)]
    phrases = _phrases(raw, VOCABULARY_COLUMNS)
    hit = F.expr(contains_any("phrase", dict.fromkeys(known)))
    return phrases.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("distinct_phrases"),
        F.sum("n").alias("mentions"),
        F.count_if(hit).alias("lexicon_phrases"),
    )


def min_support(
    raw: DataFrame, columns: tuple[str, ...] = ("specialties",), supports: tuple[int, ...] = SUPPORTS
) -> DataFrame:
    """Distinct phrases that occur at least so many times."""
    return (
        _phrases(raw, columns)
        .groupBy("column_name")
        .agg(
            F.count(F.lit(1)).alias("distinct_phrases"),
            *[F.count_if(F.col("n") >= k).alias(f"at_least_{k}") for k in supports],
        )
    )
