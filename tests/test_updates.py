"""What an update of the sliced mart makes anew, takes over and leaves alone."""

from __future__ import annotations

import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimgrade.operators import grading, mart
from claimgrade.plans import incremental
from claimgrade.review import inputs as review_inputs
from claimgrade.review import signals
from claimgrade.session import materialise
from claimgrade.sources.slices import SLICE, SlicedStore


@pytest.fixture
def store(spark, tmp_path):
    made = SlicedStore(spark, str(tmp_path / "slices"), f"u_{uuid.uuid4().hex}", slices=4)
    yield made
    made.drop()


@pytest.fixture(scope="module")
def tables(graded_frame):
    graded = graded_frame(*[{"description": "ICU beds"} for _ in range(12)], {"unique_id": None, "cluster_id": "none"})
    return materialise(grading.baseline(graded), "baseline"), materialise(review_inputs.inputs(graded, "2024-01-01"), "inputs")


@pytest.fixture
def said(spark, tables):
    """Reviews of entities about the ICU, one run each."""
    found = tables[1].where("capability = 'icu'").select("unique_id", "capability", "evidence_fingerprint")

    def make(run_id: str, at: str, *ids: str | None):
        wanted = spark.createDataFrame([(i, "icu") for i in ids], "unique_id string, capability string")
        rows = wanted.join(found, ["unique_id", "capability"], "left").withColumns(
            {
                "prompt_version": F.lit("v"),
                "model_name": F.lit("m"),
                "model_version": F.lit(None).cast("string"),
                "run_id": F.lit(run_id),
                "source_snapshot_ts": F.lit("2024-01-01").cast("timestamp"),
                "inference_ts": F.lit(at).cast("timestamp"),
                "parsed_json": F.lit('{"claim_hit": true, "reasoning": "r"}'),
            }
        )
        return materialise(rows.select(*incremental.CURRENT), "said")

    return make


def rows(df):
    return sorted(map(repr, (r.asDict(recursive=True) for r in df.drop(SLICE).collect())))


def rebuilt(tables, *reviews):
    every = reviews[0]
    for more in reviews[1:]:
        every = every.unionByName(more)
    return rows(mart.final_from_tables(tables[0], signals.signals(tables[1], every)))


def files(store):
    return {str(p): p.stat().st_mtime_ns for p in Path(store.root).rglob("part-*.parquet") if "changed" not in str(p)}


def test_what_is_no_news_writes_nothing(store, tables, said):
    first, late = said("r1", "2024-01-05", "id1", "id2"), said("r2", "2024-01-04", "id1")
    incremental.start(store, *tables, first)
    before = files(store)
    # the same run again, and a run that is older than what is there
    assert incremental.update(store, first) == [] and incremental.update(store, late) == []
    assert files(store) == before
    assert rows(store.read("mart")) == rebuilt(tables, first, late)


def test_only_rows_with_a_new_review_are_made_anew(store, tables, said):
    first, second = said("r1", "2024-01-05", "id1", "id2", "id3"), said("r2", "2024-01-06", "id1", None, "nobody")
    incremental.start(store, *tables, first)
    slices = list(range(4))
    store.replace(store.read("mart").withColumn("name", F.lit("as it stood")), "mart", slices)
    incremental.update(store, second)
    made = store.read("mart")
    assert [tuple(r) for r in made.where("name <> 'as it stood'").select("unique_id", "capability", "run_id").collect()] == [("id1", "icu", "r2")]
    assert rows(made.drop("name")) == rows(mart.final_from_tables(tables[0], signals.signals(tables[1], first.unionByName(second))).drop("name"))


def test_an_update_that_died_is_made_good_by_the_next(store, tables, said, monkeypatch):
    first, second, third = said("r1", "2024-01-05", "id1"), said("r2", "2024-01-06", "id1", "id5"), said("r3", "2024-01-07", "id7")
    incremental.start(store, *tables, first)
    kept = store.replace

    def dies(df, table, touched, like=None):
        if table == "mart":
            # some slices are gone, as when the last step of the write is cut off
            kept(store.read("mart").where("false"), "mart", touched)
            raise OSError("boom")
        return kept(df, table, touched, like)

    monkeypatch.setattr(store, "replace", dies)
    with pytest.raises(OSError, match="boom"):
        incremental.update(store, second)
    monkeypatch.setattr(store, "replace", kept)
    assert set(store.begun("mart")) <= set(incremental.update(store, third)) and store.begun("mart") == []
    assert rows(store.read("mart")) == rebuilt(tables, first, second, third)


def test_rows_are_not_sorted_or_moved_by_a_write_in_place(spark, store, tables, said):
    incremental.start(store, *tables, said("r1", "2024-01-05", "id1"))
    incremental.update(store, said("r2", "2024-01-06", "id1"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = incremental.renewed(store, [0, 1, 2, 3])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    # the rows that are taken over: those of the first part of the union
    assert "Sort" not in plan.split("+- Project")[0]
    assert spark.sql(f"DESCRIBE EXTENDED {store.name('mart')}").where("col_name = 'Sort Columns' AND data_type <> '[]'").isEmpty()
