"""State of an entity against the runs of postcodes of its state."""

from __future__ import annotations

import random

from claimgrade.operators import consistency

BRIDGE = "pincode bigint, district_norm string, state_name string"
ENTITIES = "unique_id string, pincode bigint, state_norm string"


def test_classes_and_borders(spark):
    bridge = [(1001, "d", "Goa"), (1003, "d", "Goa"), (1005, "d", "Kerala"), (1007, "d", "Goa"), (1999, "d", "Goa"), (2001, "d", "Goa"), (1004, "d", None), (None, "d", "Goa")]
    entities = [
        ("a", 1002, "GOA"), ("b", 1004, "Goa"), ("c", 1005, "Goa"), ("d", 1008, None), ("e", None, "Goa"), ("f", 2000, "Goa"), ("g", 9999, "Goa"), (None, 1001, "Goa"),
    ]
    rows = consistency.state_consistency(spark.createDataFrame(entities, ENTITIES), spark.createDataFrame(bridge, BRIDGE)).collect()
    assert {r["unique_id"]: r["consistency"] for r in rows} == {
        "a": "agrees", "b": "outside", "c": "differs", "d": "no_state", "e": "no_postcode", "f": "outside", "g": "outside", None: "agrees",
    }
    assert len(rows) == len(entities)


def test_runs_against_a_plain_walk(spark):
    rng = random.Random(8)
    listed = {p: rng.choice(["Goa", "Kerala"]) for p in rng.sample(range(100, 400), 120)}
    entities = [(f"e{i}", rng.randrange(90, 410), rng.choice(["goa", "kerala", None])) for i in range(300)]

    def plain(p):
        low = max((q for q in listed if q <= p and q // 50 == p // 50), default=None)
        high = min((q for q in listed if q >= p and q // 50 == p // 50), default=None)
        return listed[low] if low is not None and high is not None and listed[low] == listed[high] else None

    rows = consistency.state_consistency(spark.createDataFrame(entities, ENTITIES), spark.createDataFrame([(p, "d", s) for p, s in listed.items()], BRIDGE), width=50).collect()
    assert {r["unique_id"]: r["postcode_state"] for r in rows} == {i: plain(p) for i, p, _ in entities}
