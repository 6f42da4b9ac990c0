"""Rows that stay where they are, and texts that are made once: same results as through stored tables."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from claimgrade import schemas
from claimgrade.operators import clean, grading, mart, serve
from claimgrade.review import inputs, pending, run, signals

SNAPSHOT = "2024-01-01 00:00:00"
RECORD = {"claim_hit": False, "supporting_snippets": ["a", " a", "b"], "reasoning": "said"}


@pytest.fixture
def profiles(spark, facilities, supported):
    bridge = spark.createDataFrame([], "pincode bigint, district_norm string, state_name string")
    rows = [supported, {}, {"unique_id": None, "description": "chemotherapy"}, dict(supported, unique_id="x", recency_of_page_update="2023-06-01")]
    return clean.profiles(facilities(*rows), bridge)


@pytest.fixture
def reviews(spark):
    def make(graded):
        mark = {(r["unique_id"], r["capability"]): r["evidence_fingerprint"] for r in inputs.with_fingerprint(graded).collect()}
        rows = [("id0", "icu", mark["id0", "icu"]), ("id0", "trauma", "old"), ("x", "oncology", mark["x", "oncology"])]
        full = [
            (u, c, f, "v1", "m", None, "r", None, datetime(2024, 1, 1), "{}", json.dumps(RECORD)) for u, c, f in rows
        ]
        names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.REVIEWS_RAW)
        order = ("unique_id", "capability", "evidence_fingerprint", "prompt_version", "model_name", "model_version", "run_id")
        given = dict(zip(order, range(7), strict=True)) | {"source_snapshot_ts": 7, "inference_ts": 8, "raw_response_json": 9, "parsed_json": 10}
        return spark.createDataFrame([tuple(r[given[n]] for n in schemas.REVIEWS_RAW.names) for r in full], names)

    return make


def _rows(df):
    return sorted(df.collect(), key=str)


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_prompts_are_not_stored_with_requests(spark, monkeypatch):
    """they follow from the request."""
    stored = []
    kept = run.materialise
    monkeypatch.setattr(run, "materialise", lambda df, *a: (stored.append(df.columns), kept(df, *a))[1])

    def make():
        def reviewer(frame):
            import json

            return frame["request_id"].map(
                lambda r: json.dumps({"output_text": json.dumps({"claim_hit": True}) if ":b:" not in r or "repair" in r else "sorry"})
            )

        return reviewer

    asked = spark.sql("SELECT unique_id, unique_id AS facility_name, '{\"k\": 1}' AS llm_input_json FROM VALUES ('a'), ('b') t(unique_id)")
    item = F.struct(F.lit("icu").alias("capability"), F.lit("f").alias("evidence_fingerprint"), F.lit("t").alias("source_snapshot_ts"))
    asked = asked.withColumns({"capabilities": F.array(F.lit("icu")), "requested": F.array(item)})
    found = {r["unique_id"]: r for r in run.run(asked, make(), "r1", batch=False).collect()}
    assert found["a"]["error"] is None and found["b"]["error"] is None
    assert "sorry" in found["b"]["raw_response_json"] and found["b"]["user_prompt"].startswith('Does "b" (b) really offer "icu"')
    assert stored and not any({"user_prompt", "system_prompt"} & set(columns) for columns in stored)


def test_payload_of_graded_rows_is_that_of_stored_ones(profiles):
    """F6"""
    graded = grading.grade(inputs.prepared(profiles), as_of="2024-01-01")
    columns = ("unique_id", "capability", "evidence_fingerprint", "llm_input_json")
    stored = inputs.render(inputs.inputs(graded, SNAPSHOT), inputs.evidence(profiles))
    assert _rows(inputs.with_payload(graded, SNAPSHOT).select(*columns)) == _rows(stored.select(*columns))


def test_placed_rows_are_pending_as_stored_ones(spark, profiles, reviews):
    """the rows are dealt once, as profiles."""
    graded = grading.grade(inputs.prepared(profiles.repartition("unique_id")), as_of="2024-01-01")
    landed = reviews(graded)
    rows = pending.pending(inputs.with_payload(graded, SNAPSHOT), landed, "v1", also=("llm_input_json",), placed=True)
    stored = inputs.inputs(graded, SNAPSHOT)
    todo = pending.pending(stored, landed, "v1")
    assert _rows(rows.drop("llm_input_json")) == _rows(todo) and len(_rows(todo)) == 22
    asked = pending.single_requests(todo, stored, inputs.evidence(profiles))
    # the former join of the two leaves out an entity without an id nowhere
    assert _rows(pending.as_requests(rows)) == _rows(asked)


def test_fingerprints_behind_the_join_give_the_same_status(profiles, reviews):
    """what is compared with a review need not be made for rows without one."""
    graded = grading.grade(inputs.prepared(profiles.repartition("unique_id")), as_of="2024-01-01")
    landed = reviews(graded)
    before = mart.final(signals.attach(inputs.with_fingerprint(graded), landed))
    after = mart.final(signals.attach(graded, landed, placed=True))
    assert _rows(after) == _rows(before)
    assert {r["llm_review_status"] for r in after.collect()} == {"missing", "current", "stale"}


def test_signals_from_columns_are_those_of_the_documents(profiles, reviews):
    """documents are neither written nor read where the signals are columns."""
    graded = grading.grade(inputs.prepared(profiles), as_of="2024-01-01")
    reviewed = signals.attach(graded, reviews(graded))
    by_column = serve.signals(mart.final(reviewed, also=("recent_update", "capacity_supported")), profiles)
    assert _rows(by_column) == _rows(serve.signals(mart.final(reviewed), profiles))
    plan = _plan(by_column).split("== Optimized Logical Plan ==")[1]
    assert "evidence_json" not in plan
