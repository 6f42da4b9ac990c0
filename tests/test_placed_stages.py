"""The stages of a rebuild are stored dealt by id, and joined where they lie."""

from __future__ import annotations

import pytest

from claimgrade import schemas
from claimgrade.operators import mart
from claimgrade.plans import pipeline
from claimgrade.sources.tables import StageStore


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(repr, (r.asDict(recursive=True) for r in df.select(*sorted(df.columns)).collect())))


def test_stages_of_a_rebuild_are_joined_where_they_lie(spark, facilities, supported, tmp_path, no_broadcast):
    given = [dict(supported, unique_id=f"e{i}") for i in range(9)] + [{"unique_id": None, "cluster_id": "c"}]
    raw = pipeline.Raw(
        facilities(*given), spark.createDataFrame([], schemas.RAW_PINCODE_DIRECTORY), spark.createDataFrame([], schemas.RAW_DISTRICT_INDICATORS)
    )
    store = StageStore(spark, str(tmp_path / "stages"))
    built = pipeline.rebuild(raw, store, str(tmp_path / "reviews"), as_of="2024-01-01", snapshot_ts="2024-01-01 00:00:00")
    assert built["mart"].count() == 60
    assert "Exchange" not in plan(mart.final_from_tables(store.read("baseline"), store.read("signals")))

    # without the session's catalogue the same rows are read from the files
    known = {stage: rows(store.read(stage)) for stage in ("profiles", "baseline", "inputs", "signals")}
    assert [len(r) for r in known.values()] == [10, 60, 60, 60]
    for table in spark.catalog.listTables(pattern="stage_*"):
        spark.sql(f"DROP TABLE {table.name}")
    assert {stage: rows(store.read(stage)) for stage in known} == known
