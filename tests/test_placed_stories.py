"""Whole stories are stored once, dealt by id, and joined where they lie."""

from __future__ import annotations

import pytest

from claimgrade.operators import clean
from claimgrade.plans import catalog
from claimgrade.review import inputs

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, (r.asDict(recursive=True) for r in df.select(*sorted(df.columns)).collect())))


def test_stories_are_joined_where_they_are_stored(spark, no_broadcast):
    # only the rows without an id are moved, to each other
    assert plan(catalog.QUERIES["story_payload"](spark, SF)).count("Exchange") <= 2


def test_stored_stories_are_the_story_profiles(spark):
    s = catalog.Stages(spark, SF)
    stored, made = s.placed_stories().drop("slice"), s.story_profiles().drop(*catalog.UNREAD)
    assert set(clean.CHANNELS) < set(stored.columns) and rows(stored) == rows(made)


def test_placed_rows_are_rendered_as_others(spark, facilities, graded_frame):
    given = [{"description": "chemotherapy day care"}, {"unique_id": None, "cluster_id": "c"}, {"name": "B"}]
    bridge = spark.createDataFrame([], "pincode bigint, district_norm string, state_name string")
    found, shared = inputs.inputs(graded_frame(*given), "2024-01-01"), inputs.evidence(clean.profiles(facilities(*given), bridge))
    placed = inputs.render(found, shared, placed=True)
    assert placed.count() == 18 and rows(placed) == rows(inputs.render(found, shared))
