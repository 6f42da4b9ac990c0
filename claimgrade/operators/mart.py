"""The serving mart: baseline evidence overlaid with current reviews, decided again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgrade.config import FACILITY, GradingConfig
from claimgrade.operators.grading import decide, evidence_fields, explanation

REVIEW_COLUMNS = (
    "has_llm_review",
    "llm_review_status",
    "claim_hit_llm",
    "prose_hit_llm",
    "screening_only_llm",
    "capability_scope_llm",
    "supporting_snippets_llm",
    "confidence_llm",
    "reasoning_llm",
    "prompt_version",
    "model_name",
    "model_version",
    "run_id",
    "source_snapshot_ts",
    "inference_ts",
)
# baseline column -> column kept beside the final one
AUDIT = {
    "tier": "heuristic_tier",
    "score": "heuristic_score",
    "explanation": "heuristic_explanation",
    "evidence_json": "heuristic_evidence_json",
    "claim_hit": "heuristic_claim_hit",
    "prose_hit": "heuristic_prose_hit",
    "screening_only": "heuristic_screening_only",
}
MART_COLUMNS = (
    "unique_id",
    "capability",
    "name",
    "facility_type",
    "operator_type",
    "district_norm",
    "state_name",
    "latitude",
    "longitude",
    "tier",
    "score",
    "explanation",
    "structured_hit",
    "claim_hit",
    "prose_hit",
    "screening_only",
    "well_corroborated",
    "implausible",
    "n_source_urls",
    "official_website",
    "staff_present",
    "evidence_json",
    "citation_urls",
    *AUDIT.values(),
    "current_llm_review",
    "has_llm_review",
    "llm_review_status",
    "capability_scope",
    *REVIEW_COLUMNS[2:],
)

_DOCUMENT = (
    "recent_update boolean, page_updated string, capacity_supported boolean, beds int, num_doctors int"
)


def evidence_readback(stored_baseline: DataFrame) -> DataFrame:
    """Typed fields from the evidence document of a stored baseline, in one parse."""
    document = F.from_json("evidence_json", _DOCUMENT)
    return (
        stored_baseline.withColumn("_doc", document)
        .withColumns(
            {
                "recent_update": F.coalesce("_doc.recent_update", F.lit(False)),
                "page_updated": F.when(F.col("_doc.page_updated") != "", F.col("_doc.page_updated")),
                "capacity_supported": F.col("_doc.capacity_supported"),
                "beds_sane": F.col("_doc.beds"),
                "docs_sane": F.col("_doc.num_doctors"),
            }
        )
        .drop("_doc")
    )


def overlay(reviewed: DataFrame) -> DataFrame:
    """Replace sub-signals by those of a current review; never the structured ones.

    ``reviewed`` is the baseline with the review columns beside it. A review that is
    missing or stale, or is silent on a signal, leaves the baseline value. What was
    derived from the baseline hits (plausibility) is deliberately not derived again.
    """
    current = F.coalesce(F.col("llm_review_status") == "current", F.lit(False))
    kept = reviewed.withColumnsRenamed(AUDIT).withColumn("current_llm_review", current)
    scope = F.when(F.col("current_llm_review"), F.col("capability_scope_llm"))

    def effective(name: str) -> Column:
        reviewed_value = F.when(F.col("current_llm_review"), F.col(f"{name}_llm"))
        return F.coalesce(reviewed_value, F.col(f"heuristic_{name}"))

    scoped = kept.withColumn("capability_scope", scope)
    return scoped.withColumns(
        {
            "claim_hit": effective("claim_hit"),
            "prose_hit": effective("prose_hit"),
            "screening_only": F.when(
                F.col("capability_scope") == "screening_or_diagnostics_only", F.lit(True)
            ).otherwise(effective("screening_only")),
        }
    )


def decide_final(overlaid: DataFrame, cfg: GradingConfig = FACILITY, also: tuple[str, ...] = ()) -> DataFrame:
    """The columns of the mart, and ``also`` as they are."""
    decided = decide(overlaid, cfg.final_ladder, cfg)
    document = [
        *evidence_fields(),
        F.col("capability_scope"),
        F.col("current_llm_review").alias("has_current_llm_review"),
        F.col("llm_review_status"),
        F.col("claim_hit_llm"),
        F.col("prose_hit_llm"),
        F.col("screening_only_llm"),
        F.col("supporting_snippets_llm"),
        F.col("confidence_llm"),
        F.col("reasoning_llm"),
    ]
    return decided.withColumns(
        {"explanation": explanation(final=True), "evidence_json": F.to_json(F.struct(*document))}
    ).select(*MART_COLUMNS, *also)


def final(reviewed: DataFrame, cfg: GradingConfig = FACILITY, also: tuple[str, ...] = ()) -> DataFrame:
    """Mart from graded rows that already carry their review columns (no further join); ``also`` are kept."""
    return decide_final(overlay(reviewed), cfg, also)


def final_from_tables(
    stored_baseline: DataFrame, stored_signals: DataFrame, cfg: GradingConfig = FACILITY
) -> DataFrame:
    """Mart from the two stored tables, as needed when only reviews have changed."""
    signals = stored_signals.select("unique_id", "capability", *REVIEW_COLUMNS)
    joined = evidence_readback(stored_baseline).join(signals, ["unique_id", "capability"], "left")
    return final(joined, cfg)
