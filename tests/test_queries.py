"""Registered queries against DuckDB, and the shape of their plans."""

from __future__ import annotations

import io
from contextlib import redirect_stdout

import pytest

import __spark_entry__ as contract
import verify
from claimgrade.plans import catalog, oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return verify.connect(SF)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(oracle.ORACLES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_oracle(spark, con, name):
    assert verify.difference(spark, con, name, SF) is None


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.count() > 0 and "tier" in frame.columns


def plan(frame) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        frame.explain("formatted")
    return out.getvalue().split("\n\n")[0]


def test_grading_scans_once_and_joins_no_entity_again(spark):
    text = plan(catalog.QUERIES["grade_heuristic"](spark, SF))
    assert text.count("Scan parquet") == 2  # entities and the directory
    assert text.count("Join") == 1
    assert text.count("WindowGroupLimit") == 6  # before and after each of three shuffles
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_hits_need_two_shuffles(spark):
    text = plan(catalog.QUERIES["evidence_hits"](spark, SF))
    assert text.count("Exchange") == 2 and text.count("Generate") == 1


def test_attaching_reviews_does_not_move_graded_rows(spark, graded_frame):
    from claimgrade.review import inputs, signals
    from claimgrade.schemas import REVIEWS_RAW

    row = dict.fromkeys(REVIEWS_RAW.names) | {"unique_id": "id0", "capability": "icu"}
    reviews = spark.createDataFrame([tuple(row.values())], REVIEWS_RAW)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(signals.attach(inputs.with_fingerprint(graded_frame({})), reviews))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # that with the reviews and that with the places
    assert text.count("SortMergeJoin LeftOuter") == 2
    lines = text.splitlines()
    joins = [i for i, line in enumerate(lines) if "SortMergeJoin" in line]
    # entities: by cluster, by place and by id; places: by key; reviews: by key, then by id
    assert len([line for line in lines if "- Exchange" in line]) == 6
    # nothing moves between the expansion and the join with the reviews, whatever way the place join takes
    graded = lines[joins[0] : joins[1]]
    expansion = next(i for i, line in enumerate(graded) if "Generate" in line)
    assert not any("Exchange" in line for line in graded[:expansion])


def test_ranking_keeps_only_the_top(spark):
    assert "TakeOrderedAndProject" in plan(catalog.QUERIES["serve_ranked"](spark, SF))


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_cross_join(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["review_payload", "story_payload", "review_batches", "evidence_document_final", "review_split"])
def test_documents_are_not_parsed_once_per_field(spark, name):
    """``notes[0]`` and the signals of reviews aside, fields come from one parse of their object."""
    assert catalog.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString().count("get_json_object(") <= 1


@pytest.mark.parametrize(
    ("name", "stored"),
    [("review_latest", []), ("review_typed", []), ("review_pending", ["keys"]), ("review_batches", ["profiles", "keys"]), ("review_append", ["reviews"])],
)
def test_only_what_is_used_twice_is_stored(spark, monkeypatch, name, stored):
    labels = []
    kept = catalog.materialise
    monkeypatch.setattr(catalog, "materialise", lambda df, label: labels.append(label) or kept(df, label))
    catalog.QUERIES[name](spark, SF)
    assert labels == stored


def test_shared_parts_of_a_fingerprint_change_nothing(spark):
    from claimgrade.operators import grading
    from claimgrade.review import inputs

    profiles = catalog.Stages(spark, SF).profiles()
    for evidence_only in (False, True):
        plain, shared = (inputs.with_fingerprint(grading.grade(p, as_of="2001-08-01"), evidence_only) for p in (profiles, inputs.prepared(profiles)))
        assert plain.columns == shared.columns
        key = ["unique_id", "capability", "evidence_fingerprint"]
        assert plain.select(key).exceptAll(shared.select(key)).isEmpty() and plain.count() == shared.count()
