"""Rows without an id: one entity, and all others of them in quarantine; requests for it."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimgrade.operators import clean
from claimgrade.review import inputs, pending


def test_rows_without_an_id_are_kept_or_listed(facilities):
    raw = facilities(*[{"unique_id": None, "cluster_id": f"c{i}", "source_urls": '["u"]' if i == 2 else None} for i in range(5)], {"unique_id": None}, {})
    kept = {r["source_content_id"] for r in clean.entities(raw).collect()}
    lost = {r["source_content_id"] for r in clean.quarantine(raw).where("reason = 'duplicate_id'").collect()}
    assert kept == {"s2", "s6"} and lost == {"s0", "s1", "s3", "s4", "s5"}


def test_an_entity_without_an_id_gets_its_payload(spark, facilities, graded_frame):
    row = {"unique_id": None, "cluster_id": "c", "description": "chemotherapy day care"}
    bridge = spark.createDataFrame([], "pincode bigint, district_norm string, state_name string")
    profiles = clean.profiles(facilities(row), bridge)
    rows = inputs.inputs(graded_frame(row), "2024-01-01")
    made = inputs.render(rows, inputs.evidence(profiles))
    assert made.count() == rows.count() > 0
    asked = rows.withColumnsRenamed({"input_snapshot_ts": "source_snapshot_ts"})
    asked = asked if "facility_name" in asked.columns else asked.withColumn("facility_name", F.lit("n"))
    assert pending.single_requests(asked, rows, inputs.evidence(profiles)).count() == rows.count()
    assert pending.batches(asked, profiles).count() == 1
