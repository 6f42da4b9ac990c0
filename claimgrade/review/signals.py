"""Stored reviews -> typed signals beside every graded row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgrade.functions.text import EMPTY_JSON_ARRAY, json_array
from claimgrade.operators.clean import first_per
from claimgrade.review.inputs import with_fingerprint
from claimgrade.review.pending import KEY

PROVENANCE = ("prompt_version", "model_name", "model_version", "run_id", "source_snapshot_ts", "inference_ts")
TYPED = (
    "claim_hit_llm",
    "prose_hit_llm",
    "screening_only_llm",
    "capability_scope_llm",
    "supporting_snippets_llm",
    "confidence_llm",
    "reasoning_llm",
)
# keys of a stored record
FIELDS = tuple(c.removesuffix("_llm") for c in TYPED)
SIGNAL_COLUMNS = (
    *KEY,
    "heuristic_tier",
    "heuristic_score",
    "heuristic_explanation",
    "current_evidence_fingerprint",
    "reviewed_evidence_fingerprint",
    "has_llm_review",
    "llm_review_status",
    *TYPED,
    *PROVENANCE,
)


def latest(reviews: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Latest review per key over all prompt versions.

    The raw answers are left behind before the shuffle; of a long review history
    each task sends one row per key. ``also`` are columns that are kept; among equal
    reviews their smallest counts.
    """
    order = [
        F.col(c).desc_nulls_last()
        for c in (
            "inference_ts",
            "source_snapshot_ts",
            "prompt_version",
            "run_id",
            "parsed_json",
            "evidence_fingerprint",
        )
    ]
    narrow = reviews.select(*KEY, "evidence_fingerprint", *PROVENANCE, "parsed_json", *also)
    return first_per(narrow, [F.col(k) for k in KEY], [*order, *map(F.asc, also)])


def _name(field: str) -> str:
    return f"_said_{field}"


def _field(name: str) -> Column:
    return F.col(_name(name))


def _tri_state(name: str) -> Column:
    text = _field(name)
    return F.when(text == "true", F.lit(True)).when(text == "false", F.lit(False))


def _filled(name: str) -> Column:
    text = _field(name)
    return F.when(text != "", text)


def typed(reviews: DataFrame) -> DataFrame:
    """Typed signals from ``parsed_json``; whatever cannot be read is NULL."""
    # all fields in one parse of the document
    read = reviews.select("*", F.json_tuple("parsed_json", *FIELDS).alias(*map(_name, FIELDS)))
    return read.withColumns(
        {
            "claim_hit_llm": _tri_state("claim_hit"),
            "prose_hit_llm": _tri_state("prose_hit"),
            "screening_only_llm": _tri_state("screening_only"),
            "capability_scope_llm": _filled("capability_scope"),
            "supporting_snippets_llm": json_array(
                F.coalesce(_field("supporting_snippets"), F.lit(EMPTY_JSON_ARRAY))
            ),
            "confidence_llm": _field("confidence").try_cast("double"),
            "reasoning_llm": _filled("reasoning"),
        }
    ).drop("parsed_json", *map(_name, FIELDS))


def attach(rows: DataFrame, reviews: DataFrame, placed: bool = False) -> DataFrame:
    """Put the latest review and its status beside rows that carry a fingerprint, or from which it can be made.

    Rows keep all their columns, so the mart needs no second join. Rows that come
    partitioned by id stay where they are; only the reviews are moved. A fingerprint that
    is missing is made behind the join, so only for rows that have a review if nothing else asks for it.
    With ``placed`` the rows do come that way: they meet a hash table of the reviews of their task, and are not sorted.
    """
    reviewed = (
        typed(latest(reviews))
        .withColumnRenamed("evidence_fingerprint", "reviewed_evidence_fingerprint")
        .withColumn("_reviewed", F.lit(True))
    )
    joined = rows.join(reviewed.hint("shuffle_hash") if placed else reviewed, KEY, "left")
    made = joined if "evidence_fingerprint" in rows.columns else with_fingerprint(joined)
    joined = made.withColumnRenamed("evidence_fingerprint", "current_evidence_fingerprint")
    same = F.col("reviewed_evidence_fingerprint") == F.col("current_evidence_fingerprint")
    return joined.withColumns(
        {
            "has_llm_review": F.col("_reviewed").isNotNull(),
            "llm_review_status": F.when(F.col("_reviewed").isNull(), F.lit("missing"))
            .when(same, F.lit("current"))
            .otherwise(F.lit("stale")),
        }
    ).drop("_reviewed")


def signals(inputs: DataFrame, reviews: DataFrame) -> DataFrame:
    """The signals table: one row per input, with the review if there is one."""
    narrow = inputs.select(
        *KEY, "heuristic_tier", "heuristic_score", "heuristic_explanation", "evidence_fingerprint"
    )
    return attach(narrow, reviews).select(*SIGNAL_COLUMNS)
