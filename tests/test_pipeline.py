from __future__ import annotations

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from claimgrade import schemas
from claimgrade.plans import pipeline
from claimgrade.review import run
from claimgrade.session import materialise, shared_folder
from claimgrade.sources import tables
from claimgrade.sources.tables import StageStore


def make_reviewer():
    """A local function, as workers cannot import this file."""

    def reviewer(frame: pd.DataFrame) -> pd.Series:
        """Finds screening only everywhere; never answers about id1."""
        import json

        names = ("icu", "nicu", "maternity", "emergency", "oncology", "trauma")
        record = {"capability_scope": "screening_or_diagnostics_only", "claim_hit": True, "reasoning": "screening"}
        text = json.dumps({"results": [{**record, "capability": c} for c in names]})
        good = json.dumps({"model": "test", "output_text": text})
        return frame["request_id"].map(lambda r: "{}" if ":id1:" in r else good)

    return reviewer


@pytest.fixture
def raw(spark, facilities, supported):
    base = [dict(supported, address_zipOrPostcode=str(110000 + i % 2)) for i in range(3)]
    directory = spark.createDataFrame(
        [(110000, "North", "kerala"), (110000, "North", "kerala"), (110000, "South", "goa")],
        schemas.RAW_PINCODE_DIRECTORY,
    )
    indicators = spark.createDataFrame(
        [(" North ", "Kerala", 90.0, *[None] * 2, "(4) *", *[None] * 7)], schemas.RAW_DISTRICT_INDICATORS
    )
    return pipeline.Raw(facilities(*base), directory, indicators)


def test_rebuild_sweep_refresh(spark, raw, tmp_path):
    store = StageStore(spark, str(tmp_path / "stages"))
    landing, letters = str(tmp_path / "reviews"), str(tmp_path / "letters")
    built = pipeline.rebuild(raw, store, landing, as_of="2024-01-01", snapshot_ts="2024-01-01 00:00:00")
    assert {k: built[k].count() for k in ("entities", "geo", "baseline", "inputs", "signals", "mart")} == {
        "entities": 3,
        "geo": 3,
        "baseline": 18,
        "inputs": 18,
        "signals": 18,
        "mart": 18,
    }
    # without a review the final tier and score are those of the baseline
    assert built["mart"].where("tier <> heuristic_tier OR score <> heuristic_score").count() == 0
    assert {r["state_name"] for r in built["geo"].collect()} == {"Kerala", None}
    assert store.versions().where("n_rows IS NULL OR seconds IS NULL").count() == 0

    options = {
        "store": store,
        "landing": landing,
        "letters": letters,
        "reviewer": make_reviewer(),
        "prompt_version": "v1",
        "provider": "test",
        "target": "t",
    }
    counters = pipeline.sweep(run_id="r1", **options).first()
    assert tuple(counters) == ("r1", 3, 18, 12, 1)
    stored = spark.read.schema(schemas.REVIEWS_RAW).parquet(landing)
    assert stored.count() == 12 and stored.select("unique_id", "capability").distinct().count() == 12
    assert {r["model_name"] for r in stored.collect()} == {"test"}
    letter = tables.read_dead_letters(spark, letters).first()
    assert (letter["unique_id"], letter["run_id"], len(letter["capabilities"])) == ("id1", "r1", 6)
    mart = store.read("mart")
    assert {r["tier"] for r in mart.where("capability = 'oncology' AND unique_id <> 'id1'").collect()} == {
        "weak_suspicious"
    }
    assert mart.where("unique_id = 'id1' AND tier <> heuristic_tier").count() == 0

    # the same run does not ask again for what it gave up, another run does
    assert pipeline.sweep(run_id="r1", **options).count() == 0
    again = pipeline.sweep(run_id="r2", **options).first()
    assert tuple(again) == ("r2", 1, 6, 0, 1)


def test_append_twice_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "reviews")
    assert tables.create_landing(spark, path).schema.simpleString() == schemas.REVIEWS_RAW.simpleString()
    row = dict.fromkeys(schemas.REVIEWS_RAW.names) | {"unique_id": "a", "capability": "icu", "run_id": "r1"}
    rows = spark.createDataFrame([tuple(row.values())], schemas.REVIEWS_RAW)
    assert tables.append_reviews(rows, path, "r1").count() == 1
    assert tables.append_reviews(rows, path, "r1").count() == 1
    assert tables.append_reviews(rows.withColumn("run_id", F.lit("r2")), path, "r2").count() == 2


def test_row_mode(spark, raw, tmp_path):
    store = StageStore(spark, str(tmp_path / "stages"))
    landing, letters = str(tmp_path / "reviews"), str(tmp_path / "letters")
    pipeline.rebuild(raw, store, landing, as_of="2024-01-01")

    def single(frame: pd.DataFrame) -> pd.Series:
        return pd.Series([json.dumps({"output_text": json.dumps({"claim_hit": False})})] * len(frame))

    counters = pipeline.sweep(
        store, landing, letters, single, "r1", "v1", "test", "t", batch=False, capability="icu", limit=2
    ).first()
    assert tuple(counters) == ("r1", 2, 2, 2, 0)


def test_a_failed_rebuild_leaves_the_old_version(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    store.write(spark.range(3), "s")
    with pytest.raises(Exception, match="boom"):
        store.write(spark.range(5).select(F.raise_error(F.lit("boom")).alias("id")), "s")
    assert store.read("s").count() == 3
    store.write(spark.range(4), "s")
    assert store.read("s").count() == 4
    with pytest.raises(LookupError):
        store.read("other")


def test_materialised_frames_lie_in_the_shared_folder(spark):
    frame = materialise(spark.range(5), "t")
    assert frame.count() == 5
    assert all(shared_folder(spark) in f for f in frame.inputFiles())


def test_raw_sources_have_declared_schemas(spark, raw, tmp_path):
    path = str(tmp_path / "raw")
    raw.facilities.write.parquet(path)
    assert tables.read_raw(spark, "raw_facilities", path).schema.names == schemas.RAW_FACILITIES.names
    assert run.ROUNDS == 3
