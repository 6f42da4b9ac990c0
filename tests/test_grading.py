from __future__ import annotations

import itertools
import json

import pytest
from pyspark.sql import functions as F

from claimgrade.config import BASELINE_LADDER, FACILITY, FINAL_LADDER, TIERS
from claimgrade.operators import grading, mart


def test_worked_example(graded, supported):
    row = graded({**supported, "recency_of_page_update": "2020-01-01"})["id0", "oncology"]
    assert (row["tier"], row["score"]) == ("strong", 96)
    assert "6 sources" in row["explanation"]


def test_recent_update_adds_ten_and_a_bare_year_counts(graded, supported):
    rows = graded(
        {**supported, "recency_of_page_update": "2023-01-01"},
        {**supported, "recency_of_page_update": "2022-12-31"},
        {**supported, "recency_of_page_update": "2024"},
        {**supported, "recency_of_page_update": "soon"},
    )
    assert [rows[f"id{i}", "oncology"]["score"] for i in range(4)] == [106, 96, 106, 96]


def test_unknown_staff_is_not_strong(graded, supported):
    rows = graded({**supported, "affiliated_staff_presence": None}, {**supported, "source_urls": "junk"})
    for i in range(2):
        assert rows[f"id{i}", "oncology"]["tier"] == "partial"
    assert rows["id0", "oncology"]["well_corroborated"] is None


ICU = {"specialties": '["Intensive care"]'}


@pytest.mark.parametrize(
    ("fields", "implausible", "beds"),
    [
        ({"capacity": "0", "numberDoctors": "0"}, True, None),
        ({"capacity": "0", "numberDoctors": "2"}, False, None),
        ({"capacity": "4", "numberDoctors": "15000"}, True, 4),
        ({"capacity": "5"}, False, 5),
        ({"facilityTypeId": "clinic"}, True, None),
        ({"facilityTypeId": "clinic", "capacity": "20"}, False, 20),
        ({"facilityTypeId": "farmacy", "numberDoctors": "10"}, False, None),
        ({"facilityTypeId": "clinic", "capacity": "200000"}, True, None),
        ({"facilityTypeId": "nursing_home"}, False, None),
    ],
)
def test_plausibility(graded, fields, implausible, beds):
    row = graded({**ICU, **fields})["id0", "icu"]
    assert row["implausible"] is implausible
    assert row["beds_sane"] == beds
    assert (row["tier"] == "weak_suspicious") is implausible


def test_capacity_has_its_own_sentence(graded):
    rows = graded({**ICU, "capacity": "1"}, {**ICU, "facilityTypeId": "dentist"})
    assert "too small" in rows["id0", "icu"]["explanation"]
    assert rows["id1", "icu"]["explanation"].startswith("A dentist claiming icu is implausible")


def test_matching_runs_on_raw_text(graded):
    rows = graded(
        {"specialties": '["icu"]'},
        {"specialties": '["the icu"]'},
        {"specialties": "icu care"},
        {"capability": '["NICU"]'},
    )
    assert not rows["id0", "icu"]["structured_hit"]
    assert rows["id1", "icu"]["structured_hit"]
    assert rows["id2", "icu"]["structured_hit"]
    assert rows["id3", "icu"]["claim_hit"] and rows["id3", "nicu"]["claim_hit"]


def test_screening_language(graded):
    rows = graded(
        {"procedure": '["Cancer screening"]'},
        {"capability": '["Cancer care"]'},
        {"capability": '["Cancer care"]', "equipment": '["Linear accelerator"]'},
    )
    assert rows["id0", "oncology"]["tier"] == "no_claim" and rows["id0", "oncology"]["screening_only"]
    assert rows["id1", "oncology"]["tier"] == "weak_suspicious"
    assert "cancer-screening" in rows["id1", "oncology"]["explanation"]
    assert rows["id2", "oncology"]["tier"] == "partial"
    assert not any(r["screening_only"] for (_, c), r in rows.items() if c != "oncology")


def test_six_rows_per_entity_and_document_omits_nulls(graded):
    rows = graded({}, {})
    assert len(rows) == 2 * len(FACILITY.capabilities)
    document = json.loads(rows["id0", "icu"]["evidence_json"])
    assert "beds" not in document and document["recent_update"] is False
    assert rows["id0", "icu"]["explanation"] == "No evidence of this capability in the facility data."


def _expected(row, ladder) -> str:
    hits = row["structured_hit"], row["claim_hit"], row["prose_hit"]
    if not any(hits):
        return "no_claim"
    if "scope_screening" in ladder and row["capability_scope"] in (
        "screening_or_diagnostics_only",
        "adjacent_service",
    ):
        return "weak_suspicious"
    if row["capability"] == "oncology" and row["screening_only"] and not hits[0]:
        return "weak_suspicious"
    if row["implausible"]:
        return "weak_suspicious"
    if hits[0] and row["well_corroborated"]:
        return "strong"
    return "partial" if hits[0] or hits[1] else "weak_suspicious"


@pytest.mark.parametrize("ladder", [BASELINE_LADDER, FINAL_LADDER])
def test_ladder_on_every_combination(spark, ladder):
    flags = [False, True]
    scopes = [None, "full_capability", "adjacent_service", "screening_or_diagnostics_only", "unclear"]
    cases = list(
        itertools.product(
            flags, flags, flags, flags, flags, [None, False, True], ["icu", "oncology"], scopes, [None, 0, 4, 50], flags
        )
    )
    names = (
        "structured_hit boolean, claim_hit boolean, prose_hit boolean, screening_only boolean, implausible boolean,"
        " well_corroborated boolean, capability string, capability_scope string, n_source_urls int,"
        " recent_update boolean"
    )
    decided = grading.decide(spark.createDataFrame(cases, names), ladder, FACILITY).collect()
    base = FACILITY.scoring.tier_base
    for row in decided:
        assert row["tier"] == _expected(row, ladder), row
        assert base[row["tier"]] <= row["score"] <= base[row["tier"]] + 20
    assert {r["tier"] for r in decided} == set(TIERS)


def _reviewed(frame, capability, **review):
    columns = {
        "has_llm_review": F.lit(True),
        "llm_review_status": F.lit("current"),
        "claim_hit_llm": F.lit(None).cast("boolean"),
        "prose_hit_llm": F.lit(None).cast("boolean"),
        "screening_only_llm": F.lit(None).cast("boolean"),
        "capability_scope_llm": F.lit(None).cast("string"),
        "supporting_snippets_llm": F.array().cast("array<string>"),
        "confidence_llm": F.lit(None).cast("double"),
        **{
            n: F.lit(None).cast("string")
            for n in ("reasoning_llm", "prompt_version", "model_name", "model_version", "run_id")
        },
        **{n: F.lit(None).cast("timestamp") for n in ("source_snapshot_ts", "inference_ts")},
    }
    columns |= {k: F.lit(v) for k, v in review.items()}
    return mart.final(frame.where(F.col("capability") == capability).withColumns(columns)).first()


def test_review_overlay(graded_frame, supported):
    frame = graded_frame(supported)
    screening = {"capability_scope_llm": "screening_or_diagnostics_only"}
    current = _reviewed(frame, "oncology", **screening)
    assert (current["tier"], current["score"], current["screening_only"]) == ("weak_suspicious", 36, True)
    assert (current["heuristic_tier"], current["heuristic_score"]) == ("strong", 96)
    stale = _reviewed(frame, "oncology", llm_review_status="stale", claim_hit_llm=False, **screening)
    assert (stale["tier"], stale["score"], stale["capability_scope"], stale["claim_hit"]) == ("strong", 96, None, True)
    adjacent = _reviewed(frame, "oncology", capability_scope_llm="adjacent_service")
    assert adjacent["tier"] == "weak_suspicious" and "adjacent-service" in adjacent["explanation"]
    document = json.loads(adjacent["evidence_json"])
    assert document["has_current_llm_review"] is True and document["capability_scope"] == "adjacent_service"


def test_scope_does_not_make_a_claim(graded_frame):
    assert _reviewed(graded_frame({}), "icu", capability_scope_llm="adjacent_service")["tier"] == "no_claim"


def test_overlay_keeps_the_baseline_plausibility(graded_frame):
    frame = graded_frame({"facilityTypeId": "clinic", "description": "icu"})
    found = _reviewed(frame, "icu", claim_hit_llm=True)
    assert found["implausible"] and found["claim_hit"] and found["tier"] == "weak_suspicious"
    silent = _reviewed(frame, "icu", prose_hit_llm=False)
    assert silent["tier"] == "no_claim" and silent["implausible"]


def test_stored_baseline_gives_the_same_mart(graded_frame, spark, supported):
    """The document read back from storage carries what the final decision needs."""
    frame = graded_frame(supported, {**supported, "recency_of_page_update": "2023-06-01"}, {})
    nothing = spark.createDataFrame(
        [],
        "unique_id string, capability string, has_llm_review boolean, llm_review_status string, claim_hit_llm boolean,"
        " prose_hit_llm boolean, screening_only_llm boolean, capability_scope_llm string,"
        " supporting_snippets_llm array<string>, confidence_llm double, reasoning_llm string, prompt_version string,"
        " model_name string, model_version string, run_id string, source_snapshot_ts timestamp, inference_ts timestamp",
    )
    final = mart.final_from_tables(grading.baseline(frame), nothing).collect()
    assert len(final) == 18
    for row in final:
        assert (row["tier"], row["score"]) == (row["heuristic_tier"], row["heuristic_score"])
