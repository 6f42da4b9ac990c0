"""Long lists of vectors whose dimension has fewer pivots than a pair must share."""

from __future__ import annotations

import numpy as np
import pytest

from claimgrade.llm import vectors
from claimgrade.llm.common import tune


@pytest.mark.parametrize("cones", [1, 2])
def test_long_lists_with_few_pivots(spark, monkeypatch, cones):
    tune(spark)
    monkeypatch.setattr(vectors, "LIST", 20)
    rng = np.random.default_rng(3)
    x = np.zeros((150, 8))
    x[np.arange(150), np.arange(150) % cones] = 1
    x += rng.normal(0, 0.11, x.shape)
    frame = spark.createDataFrame([(i, v.tolist(), "a") for i, v in enumerate(x)], "vec_id long, embedding array<double>, label string")
    classes = frame.selectExpr("vec_id AS rep", "8 AS dim", "embedding AS vector")
    assert len(vectors._pivots(classes)[8]) == cones
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= vectors.THRESHOLD
    want = dict(enumerate((near.sum(axis=1) - 1).tolist()))
    rows = vectors.near_duplicates(frame).collect()
    assert sum(want.values()) > 0 and {r["vec_id"]: r["n_links"] for r in rows} == want
