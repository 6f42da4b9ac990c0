"""Coordinates repaired from the centre of their postcode."""

from __future__ import annotations

import math
import random
import statistics

from claimgrade.operators import coordinates

ENTITIES = "unique_id string, pincode bigint, latitude double, longitude double"


def test_kinds(spark):
    good = [(f"g{i}", 1, 10.0 + i / 1000, 76.0 + i / 1000) for i in range(5)]
    odd = [
        ("outside", 1, 59.95, -38.26), ("swapped", 1, 76.0, 10.0), ("nothing", 1, None, None), ("half", 1, 10.0, None), ("nan", 1, math.nan, 76.0),
        ("far", 1, 30.0, 76.0), ("few", 2, 10.0, 76.0), ("few2", 2, -1.0, 0.0), ("lost", None, None, 76.0), ("own", None, 11.0, 77.0),
    ]
    rows = {r["unique_id"]: r for r in coordinates.repair(spark.createDataFrame(good + odd, ENTITIES)).collect()}
    assert len(rows) == len(good) + len(odd)
    assert {i: rows[i]["coordinates"] for i, *_ in odd} == {
        "outside": "repaired", "swapped": "repaired", "nothing": "filled", "half": "filled", "nan": "repaired",
        "far": "far", "few": "kept", "few2": "hidden", "lost": "hidden", "own": "kept",
    }
    # six points inside, the far one too: the lower median is the third
    assert (rows["outside"]["latitude"], rows["outside"]["longitude"]) == (10.002, 76.001)
    assert rows["few2"]["latitude"] is None and rows["lost"]["longitude"] is None and rows["own"]["distance_km"] is None
    assert rows["far"]["latitude"] == 30.0 and rows["far"]["distance_km"] > 2000
    assert all(rows[i]["coordinates"] == "kept" and rows[i]["latitude"] == lat for i, _, lat, _ in good)


def test_centres_against_plain_medians(spark):
    rng = random.Random(3)
    # one postcode holds most rows, many of them equal
    rows = [(f"e{i}", rng.choice([1, 1, 1, 2, 3]), round(rng.uniform(5, 12), 1), round(rng.uniform(67, 80), 1)) for i in range(900)]
    found = {r["pincode"]: r for r in coordinates.centres(spark.createDataFrame(rows, ENTITIES)).collect()}
    for code in (1, 2, 3):
        inside = [(a, b) for _, p, a, b in rows if p == code and 6 <= a <= 38 and 68 <= b <= 98]
        assert found[code]["centre_latitude"] == statistics.median_low(a for a, _ in inside)
        assert found[code]["centre_longitude"] == statistics.median_low(b for _, b in inside)
        assert found[code]["n_points"] == len(inside)


def test_empty(spark):
    assert coordinates.repair(spark.createDataFrame([], ENTITIES)).count() == 0
