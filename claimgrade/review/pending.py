"""Which inputs still need a review, and one request per row or per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgrade.functions.text import blank_to_null
from claimgrade.operators.clean import first_per
from claimgrade.review.inputs import render

KEY = ["unique_id", "capability"]

# What a request tells the reviewer about an entity
FACILITY_FIELDS = (
    "unique_id",
    "name",
    "facility_type",
    "operator_type",
    "district_norm",
    "state_name",
    "address_city",
    "pincode",
    "num_doctors",
    "capacity_beds",
)
EVIDENCE_FIELDS = {
    "capability_claims": "capability_arr",
    "specialties": "specialties_arr",
    "procedures": "procedure_arr",
    "equipment": "equipment_arr",
    "description": "description",
    "source_types": "source_types_arr",
    "n_source_urls": "n_source_urls",
    "official_website": "official_website",
    "staff_present": "staff_present",
}


def latest_for_prompt(reviews: DataFrame, prompt_version: str) -> DataFrame:
    """Latest review per key among those made with one prompt version."""
    order = [
        F.col(c).desc_nulls_last()
        for c in ("inference_ts", "source_snapshot_ts", "run_id", "parsed_json", "evidence_fingerprint")
    ]
    of_version = reviews.where(F.col("prompt_version") == prompt_version).select(
        *KEY,
        "evidence_fingerprint",
        "inference_ts",
        "source_snapshot_ts",
        "run_id",
        "parsed_json",
    )
    return first_per(of_version, [F.col(k) for k in KEY], order).select(*KEY, "evidence_fingerprint")


def pending(
    inputs: DataFrame,
    reviews: DataFrame,
    prompt_version: str,
    capability: str | None = None,
    unique_id: str | None = None,
    force: bool = False,
    mode: str = "entity",
    limit: int | None = None,
    failed: DataFrame | None = None,
    also: tuple[str, ...] = (),
    placed: bool = False,
) -> DataFrame:
    """Inputs whose evidence has no latest review under this prompt version.

    ``mode='row'`` takes the first ``limit`` rows by capability and id,
    ``mode='entity'`` all rows of the first ``limit`` entities. Without a limit all
    pending rows are returned, unsorted: the caller runs them in one distributed pass.
    ``failed`` holds keys that were given up in this run and are not taken again.

    Works on keys and fingerprints alone; texts are put to the rows that are left. ``also`` are
    columns of the inputs that are kept. With ``placed`` the inputs come partitioned by id: they stay
    where they are, meet a hash table of the reviews of their task, and are not sorted.
    """
    rows = inputs.select(
        *KEY,
        F.col("name").alias("facility_name"),
        "evidence_fingerprint",
        F.date_format("input_snapshot_ts", "yyyy-MM-dd HH:mm:ss").alias("source_snapshot_ts"),
        *also,
    )
    if capability is not None:
        rows = rows.where(F.col("capability") == capability)
    if unique_id is not None:
        rows = rows.where(F.col("unique_id") == unique_id)
    if not force:
        latest = latest_for_prompt(reviews, prompt_version)
        if placed:
            latest = latest.hint("shuffle_hash")
        rows = rows.join(latest, [*KEY, "evidence_fingerprint"], "left_anti")
    if failed is not None:
        rows = rows.join(failed.select(*KEY).distinct(), KEY, "left_anti")
    if limit is None:
        return rows
    limit = max(limit, 1)
    if mode == "row":
        return rows.orderBy("capability", "unique_id").limit(limit)
    chosen = rows.select("unique_id").distinct().orderBy("unique_id").limit(limit)
    return rows.join(chosen, "unique_id", "left_semi").orderBy("unique_id", "capability")


def batches(pending_rows: DataFrame, profiles: DataFrame) -> DataFrame:
    """One request per entity: the capabilities asked for and the shared evidence.

    Only keys are grouped, at most one row per capability of the lexicon; the
    evidence is taken from the one profile row per entity, not carried through the
    grouping once per capability. Empty fields are left out of the payload.
    """
    item = F.struct("capability", "evidence_fingerprint", "source_snapshot_ts")
    grouped = pending_rows.groupBy("unique_id").agg(F.sort_array(F.collect_list(item)).alias("requested"))
    facts = {}
    for name in (*FACILITY_FIELDS, *EVIDENCE_FIELDS.values()):
        c = F.col(name)
        facts[name] = blank_to_null(c) if dict(profiles.dtypes)[name] == "string" else c
    facility = F.struct(*[facts[n].alias(n) for n in FACILITY_FIELDS])
    shared = F.struct(*[facts[c].alias(n) for n, c in EVIDENCE_FIELDS.items()])
    described = profiles.select(
        "unique_id",
        F.col("name").alias("facility_name"),
        facility.alias("_facility"),
        shared.alias("_shared"),
    )
    capabilities = F.transform("requested", lambda r: r["capability"])
    payload = F.struct(
        F.col("_facility").alias("facility"),
        F.col("capabilities").alias("requested_capabilities"),
        F.col("_shared").alias("shared_source_evidence"),
    )
    return (
        grouped.join(described.withColumnRenamed("unique_id", "_id"), F.col("unique_id").eqNullSafe(F.col("_id")))
        .withColumn("capabilities", capabilities)
        .withColumn("llm_input_json", F.to_json(payload))
        .select("unique_id", "facility_name", "requested", "capabilities", "llm_input_json")
    )


def single_requests(pending_rows: DataFrame, inputs: DataFrame, shared: DataFrame) -> DataFrame:
    """One request per row, in the same shape as :func:`batches`.

    The payload is made for the pending rows only, from their ``inputs`` and the
    evidence of their entity.
    """
    asked = pending_rows.select(F.col("unique_id").alias("_id"), F.col("capability").alias("_capability"))
    # null-safe: an entity may have no id
    same = F.col("unique_id").eqNullSafe(F.col("_id")) & (F.col("capability") == F.col("_capability"))
    chosen = inputs.join(asked, same, "left_semi")
    payloads = render(chosen, shared).select(F.col("unique_id").alias("_id"), F.col("capability").alias("_capability"), "llm_input_json")
    return as_requests(pending_rows.join(payloads, same))


def as_requests(rows: DataFrame) -> DataFrame:
    """Pending rows that have their payload, one request each."""
    item = F.struct("capability", "evidence_fingerprint", "source_snapshot_ts")
    return rows.select(
        "unique_id",
        "facility_name",
        F.array(item).alias("requested"),
        F.array("capability").alias("capabilities"),
        "llm_input_json",
    )
