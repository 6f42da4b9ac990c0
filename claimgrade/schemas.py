"""Explicit schemas of the raw inputs, the review landing table and its records."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _doubles(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


RAW_FACILITIES = T.StructType(
    _strings(
        "unique_id",
        "source_content_id",
        "cluster_id",
        "name",
        "facilityTypeId",
        "operatorTypeId",
        "numberDoctors",
        "capacity",
        "capability",
        "specialties",
        "procedure",
        "equipment",
        "description",
        "officialWebsite",
        "websites",
        "facebookLink",
        "source",
        "source_urls",
        "source_types",
        "affiliated_staff_presence",
        "custom_logo_presence",
        "distinct_social_media_presence_count",
        "recency_of_page_update",
        "address_line1",
        "address_line2",
        "address_line3",
        "address_city",
        "address_stateOrRegion",
        "address_zipOrPostcode",
        "address_country",
        "address_countryCode",
    )
    + _doubles("latitude", "longitude")
)

RAW_PINCODE_DIRECTORY = T.StructType(
    [T.StructField("pincode", T.LongType()), *_strings("district", "statename")]
)

# Source column -> curated column. The antenatal column arrives as
# text with footnote marks, the others as numbers.
INDICATOR_COLUMNS = {
    "institutional_birth_5y_pct": "institutional_birth_5y_pct",
    "institutional_birth_in_public_facility_5y_pct": "institutional_birth_in_public_facility_5y_pct",
    "births_delivered_by_csection_5y_pct": "births_delivered_by_csection_5y_pct",
    "mothers_who_had_at_least_4_anc_visits_lb5y_pct": "anc_4plus_visits_pct",
    "hh_member_covered_health_insurance_pct": "health_insurance_pct",
    "women_age_30_49_years_ever_undergone_a_breast_exam_pct": "breast_exam_pct",
    "women_age_30_49_years_ever_undergone_a_cervical_screen_pct": "cervical_screen_pct",
    "women_age_30_49_years_ever_undergone_an_oral_cancer_exam_pct": "oral_cancer_exam_pct",
    "all_w15_49_who_are_anaemic_pct": "anaemia_women_pct",
    "w15_plus_with_high_bp_sys_gte_140_mmhg_and_or_dia_gte_90_mm_pct": "hypertension_women_pct",
    "w15_plus_with_high_or_very_high_gt_140_mg_dl_blood_sugar_or_pct": "high_bloodsugar_women_pct",
}
FOOTNOTED_INDICATORS = ("mothers_who_had_at_least_4_anc_visits_lb5y_pct",)

RAW_DISTRICT_INDICATORS = T.StructType(
    _strings("district_name", "state_ut")
    + [
        T.StructField(c, T.StringType() if c in FOOTNOTED_INDICATORS else T.DoubleType())
        for c in INDICATOR_COLUMNS
    ]
)

# Append-only landing table of review results.
REVIEWS_RAW = T.StructType(
    _strings(
        "unique_id",
        "capability",
        "evidence_fingerprint",
        "prompt_version",
        "model_name",
        "model_version",
        "run_id",
    )
    + [
        T.StructField("source_snapshot_ts", T.TimestampType()),
        T.StructField("inference_ts", T.TimestampType()),
    ]
    + _strings("raw_response_json", "parsed_json")
)

DEAD_LETTERS = T.StructType(
    [
        *_strings("run_id"),
        T.StructField("batch_number", T.IntegerType()),
        *_strings("request_id", "unique_id", "facility_name"),
        T.StructField("capabilities", T.ArrayType(T.StringType())),
        *_strings("prompt_version", "provider", "target", "error"),
        T.StructField("timestamp_utc", T.TimestampType()),
    ]
)

OVERRIDE_EVENTS = T.StructType(
    [
        *_strings("unique_id", "capability", "action", "tier", "note"),
        T.StructField("ts", T.LongType()),
        *_strings("actor_email"),
    ]
)

# Result contracts of the serving functions.
RANKED_COLUMNS = (
    "unique_id",
    "name",
    "facility_type",
    "district_norm",
    "state_name",
    "tier",
    "score",
    "n_source_urls",
)
DETAIL_COLUMNS = (
    "capability",
    "tier",
    "explanation",
    "evidence_json",
    "citation_urls_json",
    "name",
    "facility_type",
    "district_norm",
    "state_name",
    "num_doctors",
    "capacity_beds",
    "specialties_json",
    "capabilities_json",
    "equipment_json",
)
DETAIL_COMPACT_COLUMNS = (
    "capability",
    "tier",
    "score",
    "evidence_json",
    "citation_urls_json",
    "name",
    "facility_type",
    "district_norm",
    "state_name",
)
