"""Inputs for an outside review: one auditable row per entity and capability."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgrade.operators.grading import RENAMED
from claimgrade.functions.text import EMPTY_JSON_ARRAY, quote

# The parts of the evidence fingerprint, in order. Every part is its
# text form, or the empty text where it is NULL; lists are JSON text.
FINGERPRINT_PARTS = (
    "unique_id",
    "capability",
    "name",
    "facility_type",
    "operator_type",
    "district_norm",
    "state_name",
    "address_city",
    "pincode",
    "latitude",
    "longitude",
    "capability_raw",
    "specialties_raw",
    "procedure_raw",
    "equipment_raw",
    "description_raw",
    "tier",
    "score",
    "explanation",
    "structured_hit",
    "claim_hit",
    "prose_hit",
    "screening_only",
    "well_corroborated",
    "implausible",
    "citation_urls",
    "source_types_arr",
    "n_source_urls",
    "official_website",
    "staff_present",
    "recency_of_page_update",
    "source_content_id",
    "source",
    "num_doctors",
    "capacity_beds",
)
FINGERPRINT_LISTS = ("citation_urls", "source_types_arr")
FINGERPRINT_SEPARATOR = "||"
# what an evidence-only fingerprint leaves out: values that the grading derives, of
# which score and explanation also depend on the day of grading
DERIVED_PARTS = ("tier", "score", "explanation")

# Fixed value
NOTES = ("Use the LLM to refine sub-signals only. The final trust tier stays deterministic.",)

# graded column -> input column
HEURISTIC = {
    "tier": "heuristic_tier",
    "score": "heuristic_score",
    "explanation": "heuristic_explanation",
    "evidence_json": "heuristic_evidence_json",
    "structured_hit": "heuristic_structured_hit",
    "claim_hit": "heuristic_claim_hit",
    "prose_hit": "heuristic_prose_hit",
    "screening_only": "heuristic_screening_only",
    "well_corroborated": "heuristic_well_corroborated",
    "implausible": "heuristic_implausible",
}
# one row per entity and capability: what changes with the capability
ROW_COLUMNS = (
    "unique_id",
    "capability",
    "name",
    "input_snapshot_ts",
    "evidence_fingerprint",
    *HEURISTIC.values(),
)
# one row per entity: the evidence all its capabilities share
EVIDENCE_COLUMNS = (
    "unique_id",
    "facility_type",
    "operator_type",
    "district_norm",
    "state_name",
    "address_city",
    "pincode",
    "latitude",
    "longitude",
    "num_doctors",
    "capacity_beds",
    "source_content_id",
    "n_source_urls",
    "official_website",
    "staff_present",
    "recency_of_page_update",
    "source",
    "citation_urls",
    "source_types_arr",
    "capability_raw",
    "specialties_raw",
    "procedure_raw",
    "equipment_raw",
    "description_raw",
    "capability_arr",
    "specialties_arr",
    "procedure_arr",
    "equipment_arr",
    "claim_text",
    "prose_text",
    "full_text",
)
# what a rendered input has besides
RENDERED = ("citation_urls_json", "source_types_json", "llm_input_json")


# runs of parts that all capabilities of an entity share: first, last, and the column ``prepared`` puts them in
SHARED_PARTS = {
    "_evidence_head": ("name", "description_raw"),
    "_evidence_tail": ("citation_urls", "capacity_beds"),
}


def _part(name: str, column: str | None = None) -> str:
    column = column or name
    if name in FINGERPRINT_LISTS:
        return f"coalesce(to_json({column}), {quote(EMPTY_JSON_ARRAY)})"
    return f"coalesce(cast({column} AS string), '')"


def _run(shared: str) -> tuple[str, ...]:
    first, last = (FINGERPRINT_PARTS.index(p) for p in SHARED_PARTS[shared])
    return FINGERPRINT_PARTS[first : last + 1]


def prepared(profiles: DataFrame) -> DataFrame:
    """Profiles with the parts of the fingerprint that all capabilities of an entity share made to text, once
    per entity and not once per row. Whoever selects no fingerprint does not pay for them."""
    own = {new: old for old, new in RENAMED.items()} | {"citation_urls": "source_urls_arr"}
    return profiles.withColumns(
        {
            shared: F.expr(f"concat_ws({quote(FINGERPRINT_SEPARATOR)}, {', '.join(_part(p, own.get(p)) for p in _run(shared))})")
            for shared in SHARED_PARTS
        }
    )


def fingerprint(evidence_only: bool = False, shared: bool = False) -> Column:
    """SHA-256 over the evidence a review rests on, as hex text.

    With ``evidence_only`` the parts derived by the grading are left out, so that a
    review does not go stale by the passing of time alone. With ``shared`` the rows
    come from profiles that are ``prepared``.
    """
    runs = {p: name for name in SHARED_PARTS for p in _run(name)} if shared else {}
    parts = [p for p in FINGERPRINT_PARTS if not (evidence_only and p in DERIVED_PARTS)]
    text = ", ".join(dict.fromkeys(runs.get(p) or _part(p) for p in parts))
    return F.expr(f"sha2(concat_ws({quote(FINGERPRINT_SEPARATOR)}, {text}), 256)")


def with_fingerprint(graded: DataFrame, evidence_only: bool = False) -> DataFrame:
    shared = set(SHARED_PARTS) <= set(graded.columns)
    return graded.withColumn("evidence_fingerprint", fingerprint(evidence_only, shared)).drop(*SHARED_PARTS)


def snapshot(ts: datetime | str | None) -> Column:
    return F.current_timestamp() if ts is None else F.lit(str(ts)).cast("timestamp")


# The payload, field -> column, in order
PAYLOAD = {
    "facility": {
        c: c
        for c in (
            "unique_id",
            "name",
            "facility_type",
            "operator_type",
            "district_norm",
            "state_name",
            "address_city",
            "pincode",
            "latitude",
            "longitude",
            "num_doctors",
            "capacity_beds",
        )
    },
    "capability": "capability",
    "heuristic_assessment": {
        c: c
        for c in (
            "tier",
            "score",
            "explanation",
            "structured_hit",
            "claim_hit",
            "prose_hit",
            "screening_only",
            "well_corroborated",
            "implausible",
        )
    },
    "source_evidence": {
        "capability_claims": "capability_arr",
        "specialties": "specialties_arr",
        "procedures": "procedure_arr",
        "equipment": "equipment_arr",
        "description": "description_raw",
        "claim_text": "claim_text",
        "prose_text": "prose_text",
        "full_text": "full_text",
        "citation_urls": "citation_urls",
        "source_types": "source_types_arr",
        "n_source_urls": "n_source_urls",
        "official_website": "official_website",
        "staff_present": "staff_present",
        "source_content_id": "source_content_id",
    },
    "audit": {
        "input_snapshot_ts": "cast(input_snapshot_ts AS string)",
        "evidence_fingerprint": "evidence_fingerprint",
    },
    "notes": f"array({', '.join(quote(n) for n in NOTES)})",
}


def _struct(fields: dict[str, str | dict[str, str]]) -> str:
    inner = (f"{_struct(c) if isinstance(c, dict) else c} AS {name}" for name, c in fields.items())
    return f"struct({', '.join(inner)})"


def _payload() -> Column:
    return F.expr(f"to_json({_struct(PAYLOAD)})")


def inputs(
    graded: DataFrame, snapshot_ts: datetime | str | None = None, evidence_only: bool = False
) -> DataFrame:
    """Review input rows from graded rows: keys, fingerprint and heuristic verdict, no texts."""
    stamped = with_fingerprint(graded, evidence_only).withColumn("input_snapshot_ts", snapshot(snapshot_ts))
    return stamped.withColumnsRenamed(HEURISTIC).select(*ROW_COLUMNS)


def with_payload(graded: DataFrame, snapshot_ts: datetime | str | None = None) -> DataFrame:
    """Graded rows with fingerprint and payload, as ``render`` makes them from stored rows: no join, as graded rows
    still have the evidence of their entity."""
    stamped = with_fingerprint(graded).withColumn("input_snapshot_ts", snapshot(snapshot_ts))
    return stamped.withColumn("llm_input_json", _payload())


def evidence(profiles: DataFrame) -> DataFrame:
    """The evidence behind the inputs, once per entity."""
    named = profiles.withColumnsRenamed(RENAMED).withColumnRenamed("source_urls_arr", "citation_urls")
    return named.select(*EVIDENCE_COLUMNS)


def render(rows: DataFrame, shared: DataFrame, placed: bool = False) -> DataFrame:
    """Input rows with their entity's evidence and the nested payload, for those who ask for it.

    ``rows`` are rows of ``inputs``, all or some, and ``shared`` is ``evidence``. With ``placed`` both come
    partitioned by id and stay where they are; only rows without an id are moved.
    """
    # null-safe: an entity may have no id
    own = shared.withColumnRenamed("unique_id", "_id")
    same = F.col("unique_id").eqNullSafe(F.col("_id"))
    if placed:
        # Spark does not see the partitioning by id in a null-safe join
        joined = rows.join(own, F.col("unique_id") == F.col("_id")).unionByName(
            rows.where("unique_id IS NULL").join(own.where("_id IS NULL"), same)
        )
    else:
        joined = rows.join(own, same)
    whole = joined.drop("_id").withColumnsRenamed({new: old for old, new in HEURISTIC.items()})
    made = whole.withColumns(
        {
            "citation_urls_json": F.to_json("citation_urls"),
            "source_types_json": F.to_json("source_types_arr"),
            "llm_input_json": _payload(),
        }
    )
    return made.withColumnsRenamed(HEURISTIC).select(*ROW_COLUMNS, *EVIDENCE_COLUMNS[1:], *RENDERED)
