"""Mergeable distinct counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimgrade.operators import sketches

COLUMNS = {"a": "x", "b": "y"}


def estimates(frame):
    return {r["key"]: (r["loads"], r["n_rows"], r["n_present"], r["distinct_estimate"]) for r in sketches.merged(frame).collect()}


def rows(spark, start, end):
    return spark.range(start, end).select(F.col("id").alias("x"), F.when(F.col("id") % 10 > 0, F.col("id") % 7).alias("y"))


def test_a_second_load_adds_without_the_first(spark, tmp_path):
    path = str(tmp_path / "sketches")
    sketches.add(sketches.sketch(rows(spark, 0, 40_000), F.lit("l1"), COLUMNS), path)
    # half of it is known already; a load that comes twice counts once
    for _ in range(2):
        sketches.add(sketches.sketch(rows(spark, 20_000, 60_000), F.lit("l2"), COLUMNS), path)
    found = estimates(sketches.read(spark, path))
    assert found["a"][:3] == (2, 80_000, 80_000) and found["b"] == (2, 80_000, 72_000, 7)
    assert abs(found["a"][3] - 60_000) <= 60_000 * sketches.BOUND


def test_loads_in_one_frame_and_exact_counts(spark):
    frame = rows(spark, 0, 30_000)
    made = sketches.sketch(frame, F.col("x") % 3, COLUMNS)
    exact = spark.createDataFrame([("a", 30_000), ("b", 7)], "key string, distinct_values bigint")
    assert {(r["key"], r["loads"], r["within_bound"]) for r in sketches.compared(sketches.merged(made), exact).collect()} == {("a", 3, True), ("b", 3, True)}
    wrong = spark.createDataFrame([("a", 33_000)], "key string, distinct_values bigint")
    assert not sketches.compared(sketches.merged(made), wrong).first()["within_bound"]


def test_nulls_and_empty(spark):
    empty = sketches.sketch(spark.createDataFrame([], "x string, y string"), F.lit("l"), COLUMNS)
    assert empty.count() == 0 and sketches.merged(empty).count() == 0
    nulls = sketches.sketch(spark.createDataFrame([(None, None), (None, "v")], "x string, y string"), F.lit(None), COLUMNS)
    assert estimates(nulls) == {"a": (1, 2, 0, 0), "b": (1, 2, 1, 1)}
