"""Raw entity profiles -> typed, de-duplicated entities with text channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimgrade.config import FACILITY, GradingConfig, RegionRules
from claimgrade.operators.geo import lookup, with_state

# raw column -> entity column, for the columns that are only carried over
CARRIED = {
    "unique_id": "unique_id",
    "source_content_id": "source_content_id",
    "cluster_id": "cluster_id",
    "name": "name",
    "operatorTypeId": "operator_type",
    "capability": "capability",
    "specialties": "specialties",
    "procedure": "procedure",
    "equipment": "equipment",
    "description": "description",
    "officialWebsite": "official_website",
    "facebookLink": "facebook_link",
    "source": "source",
    "recency_of_page_update": "recency_of_page_update",
    "address_line1": "address_line1",
    "address_line2": "address_line2",
    "address_line3": "address_line3",
    "address_city": "address_city",
    "address_stateOrRegion": "state_raw",
    "address_country": "address_country",
    "address_countryCode": "address_countryCode",
    "latitude": "latitude",
    "longitude": "longitude",
}
PARSED_ARRAYS = {
    "capability": "capability_arr",
    "specialties": "specialties_arr",
    "procedure": "procedure_arr",
    "equipment": "equipment_arr",
    "websites": "websites_arr",
    "source_urls": "source_urls_arr",
    "source_types": "source_types_arr",
}
# columns of ``text_channels``
CHANNELS = ("spec_eq_text", "claim_text", "prose_text", "full_text")


def is_valid(cfg: GradingConfig = FACILITY) -> Column:
    """A name and an accepted type code, compared with exact case."""
    return F.col("name").isNotNull() & F.col("facilityTypeId").isin(*cfg.valid_types)


def region(raw: Column, rules: RegionRules) -> Column:
    """Canonical region: synonyms first, then null literals, else title case."""
    trimmed = F.trim(raw)
    out = None
    for canonical, synonyms in rules.synonyms.items():
        hit = F.lower(trimmed).isin(*synonyms)
        out = F.when(hit, canonical) if out is None else out.when(hit, canonical)
    # the null literals are compared with exact case
    nothing = trimmed.isin(*rules.null_literals)
    other = F.when(~nothing, F.initcap(trimmed))
    return other if out is None else out.otherwise(other)


def remap(c: Column, mapping: dict[str, str]) -> Column:
    out = c
    for old, new in mapping.items():
        out = F.when(c == old, new).otherwise(out)
    return out


PINCODE = "try_cast(address_zipOrPostcode AS bigint)"
# 0 without a source list, NULL when the list cannot be read
SOURCE_COUNT = "CASE WHEN source_urls IS NULL THEN 0 ELSE size(from_json(source_urls, 'array<string>')) END"


def _joined(*columns: str) -> Column:
    parts = ", ".join(f"coalesce({c}, '')" for c in columns)
    return F.expr(f"lower(concat_ws(' ', {parts}))")


def text_channels(df: DataFrame) -> DataFrame:
    """Lower-case text to match against, built from the raw JSON text as it stands."""
    return df.select(
        "*",
        _joined("specialties", "equipment").alias("spec_eq_text"),
        _joined("capability").alias("claim_text"),
        _joined("description", "procedure").alias("prose_text"),
        _joined("capability", "specialties", "procedure", "equipment", "description").alias("full_text"),
    )


def typed(raw: DataFrame, cfg: GradingConfig = FACILITY, also: tuple[str, ...] = ()) -> DataFrame:
    """Raw columns -> entity columns, one to one, without text channels; ``also`` are kept as they are."""
    plain = [f"{source} AS {entity}" for source, entity in CARRIED.items()]
    parsed = [f"from_json({source}, 'array<string>') AS {entity}" for source, entity in PARSED_ARRAYS.items()]
    counts = [
        "try_cast(numberDoctors AS int) AS num_doctors",
        "try_cast(capacity AS int) AS capacity_beds",
        "try_cast(distinct_social_media_presence_count AS int) AS social_presence_count",
        f"{PINCODE} AS pincode",
        "affiliated_staff_presence = 'true' AS staff_present",
        "custom_logo_presence = 'true' AS logo_present",
        # the choice of the richest row has counted already
        "n_source_urls" if "n_source_urls" in raw.columns else f"{SOURCE_COUNT} AS n_source_urls",
    ]
    return raw.select(
        *[F.expr(e) for e in (*plain, *parsed, *counts)],
        remap(F.col("facilityTypeId"), cfg.type_remap).alias("facility_type"),
        region(F.col("address_stateOrRegion"), cfg.regions).alias("state_norm"),
        *also,
    )


def first_per(df: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order``, which must be total.

    ``row_number() = 1`` is pruned before the shuffle, so each task sends at most
    one row per key and a very frequent key does not fill one partition.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def _richest() -> list[Column]:
    return [
        F.col("n_source_urls").desc_nulls_last(),
        F.col("unique_id").asc_nulls_last(),
        F.col("source_content_id").asc_nulls_last(),
    ]


def dedupe_richest(valid_raw: DataFrame) -> DataFrame:
    """Raw rows -> one row per cluster, then one row per id, richest source list first.

    Works on raw rows with the source count added, so that nothing derived from
    the text goes through the two shuffles. The result is partitioned by id.
    """
    counted = valid_raw.withColumn("n_source_urls", F.expr(SOURCE_COUNT))
    clusters = first_per(counted, [F.coalesce("cluster_id", "unique_id")], _richest())
    return first_per(clusters, [F.col("unique_id")], _richest())


def entities(raw: DataFrame, cfg: GradingConfig = FACILITY) -> DataFrame:
    """Clean entities: valid rows, de-duplicated, typed, with text channels."""
    kept = dedupe_richest(raw.where(is_valid(cfg)))
    return text_channels(typed(kept, cfg))


def profiles(raw: DataFrame, bridge: DataFrame, cfg: GradingConfig = FACILITY) -> DataFrame:
    """``entities`` with district and state, resolved in between.

    The place is joined after the choice within clusters and before that by id, so that
    the rows come partitioned by id whatever way the join takes.
    """
    counted = raw.where(is_valid(cfg)).withColumn("n_source_urls", F.expr(SOURCE_COUNT))
    clusters = first_per(counted, [F.coalesce("cluster_id", "unique_id")], _richest())
    places = bridge.withColumnRenamed("pincode", "_pincode")
    placed = lookup(clusters.withColumn("_pincode", F.expr(PINCODE)), places, "_pincode", "unique_id")
    kept = first_per(placed, [F.col("unique_id")], _richest())
    return with_state(text_channels(typed(kept, cfg, ("district_norm", "state_name"))))


def quarantine(raw: DataFrame, cfg: GradingConfig = FACILITY) -> DataFrame:
    """Rows that never become entities, each with the reason.

    Invalid rows need no shuffle. Rows that lose the choice within their cluster
    are duplicates, not faults, and are not listed; rows that win it and still
    share their id with a richer row are.
    """
    no_name = F.col("name").isNull()
    bad_type = ~F.coalesce(F.col("facilityTypeId").isin(*cfg.valid_types), F.lit(False))
    invalid = raw.where(no_name | bad_type).withColumn(
        "reason",
        F.concat_ws(",", F.when(no_name, "missing_name"), F.when(bad_type, "invalid_type")),
    )
    return invalid.unionByName(_duplicate_ids(raw, cfg))


def _duplicate_ids(raw: DataFrame, cfg: GradingConfig) -> DataFrame:
    counted = raw.where(is_valid(cfg)).withColumn("n_source_urls", F.expr(SOURCE_COUNT))
    clusters = first_per(counted, [F.coalesce("cluster_id", "unique_id")], _richest())
    # One row per cluster is left, so the cluster tells the rows of an id apart. The winner of an
    # id is found on narrow columns, one row per task and id; the others meet it in a join, which
    # does not rank or hold the rows of an id that very many clusters share.
    keyed = clusters.withColumn("_key", F.coalesce("cluster_id", "unique_id"))
    narrow = keyed.select("_key", "unique_id", "n_source_urls", "source_content_id")
    heads = first_per(narrow, [F.col("unique_id")], _richest()).select("unique_id", F.col("_key").alias("_head"))
    # rows without an id are one group with one head; they are dealt by cluster, and all but the head
    # find no partner
    lost = keyed.where("unique_id IS NOT NULL").join(heads, "unique_id").where("_key <> _head").select(*raw.columns)
    head = heads.where("unique_id IS NULL").select("_head")
    without = keyed.where("unique_id IS NULL").join(head, F.col("_key").eqNullSafe(F.col("_head")), "left_anti").select(*raw.columns)
    return lost.unionByName(without).withColumn("reason", F.lit("duplicate_id"))
