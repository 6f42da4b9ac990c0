"""Sliced tables: what an update reads, writes and leaves alone."""

from __future__ import annotations

import re
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from claimgrade.operators import grading
from claimgrade.plans import incremental
from claimgrade.plans.catalog import Stages
from claimgrade.review import inputs as review_inputs
from claimgrade.review import signals
from claimgrade.session import materialise
from claimgrade.sources import testdata
from claimgrade.sources.slices import SLICE, SlicedStore

SF = "/root/testdata/sf0.001"


@pytest.fixture
def store(spark, tmp_path):
    made = SlicedStore(spark, str(tmp_path / "slices"), f"t_{uuid.uuid4().hex}", slices=4)
    yield made
    made.drop()


def files(store, table):
    return {str(p): p.stat().st_mtime_ns for p in Path(store.root, table).rglob("part-*.parquet")}


def rows(df):
    return sorted(map(repr, (r.asDict(recursive=True) for r in df.drop(SLICE).collect())))


def exchanges(df) -> list[str]:
    return re.findall(r"(?:Broadcast)?Exchange|\w+Join", df._jdf.queryExecution().executedPlan().toString())


def test_a_slice_is_a_bucket_and_a_file(spark, store):
    df = spark.range(200).select(F.concat(F.lit("k"), "id").alias("unique_id"), "id").unionAll(spark.sql("SELECT CAST(NULL AS string), -1L"))
    got = store.write(df, "a")
    assert rows(got) == rows(df)
    assert got.where(F.col(SLICE) != store.slice_of()).count() == 0
    assert len(files(store, "a")) == 4


def test_tables_of_one_key_join_where_they_are(spark, store):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(500).select((F.col("id") % 100).cast("string").alias("unique_id"), "id")
        a, b = store.write(df, "a"), store.write(df.withColumnRenamed("id", "other"), "b")
        assert exchanges(a.drop(SLICE).join(b.drop(SLICE), "unique_id")) == ["SortMergeJoin"]
        touched = [0, 2]
        part = store.read("a", touched).drop(SLICE).join(store.read("b", touched).drop(SLICE), "unique_id")
        assert exchanges(part) == ["SortMergeJoin"]
        assert part.count() == 25 * a.where(F.col(SLICE).isin(touched)).select("unique_id").distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_touched_slices_are_rewritten(spark, store):
    df = spark.range(100).select(F.col("id").cast("string").alias("unique_id"), F.lit("old").alias("v"))
    store.write(df, "a")
    before = files(store, "a")
    changed = df.where("unique_id = '7'")
    touched = store.touched(changed)
    assert len(touched) == 1
    new = store.read("a", touched).withColumn("v", F.when(F.col("unique_id") == "7", "new").otherwise(F.col("v")))
    store.replace(new, "a", touched)
    after = files(store, "a")
    same = {p for p in before if after.get(p) == before[p]}
    assert {int(re.search(r"slice=(\d+)", p)[1]) for p in same} == set(range(4)) - set(touched)
    assert rows(store.read("a")) == rows(df.withColumn("v", F.when(F.col("unique_id") == "7", "new").otherwise(F.col("v"))))
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_a_slice_can_become_empty_and_fill_again(spark, store):
    df = spark.range(40).select(F.col("id").cast("string").alias("unique_id"), "id")
    store.write(df, "a")
    store.replace(df.where("false"), "a", [1])
    assert rows(store.read("a")) == rows(df.where(store.slice_of() != 1))
    store.replace(df.where(store.slice_of() == 1), "a", [1])
    assert rows(store.read("a")) == rows(df)


@pytest.fixture(scope="module")
def graded(spark):
    s = Stages(spark, SF)
    graded = grading.grade(s.stored_profiles(), as_of=testdata.AS_OF)
    baseline = materialise(grading.baseline(graded), "baseline")
    found = materialise(review_inputs.inputs(graded, testdata.SNAPSHOT_TS), "inputs")
    return baseline, found, materialise(testdata.reviews(s.raw("responses"), found), "reviews")


def full(spark, graded):
    from claimgrade.operators import mart

    baseline, found, reviews = graded
    return rows(mart.final_from_tables(baseline, signals.signals(found, reviews)))


def test_updates_in_any_order_equal_a_rebuild(spark, store, graded):
    baseline, found, reviews = graded
    late = [r[0] for r in reviews.select("run_id").distinct().orderBy("run_id").limit(3).collect()]
    incremental.start(store, baseline, found, reviews.where(~F.col("run_id").isin(late)))
    for run in (late[2], late[0], late[2], late[1]):
        incremental.update(store, reviews.where(F.col("run_id") == run))
    assert rows(store.read("mart")) == full(spark, graded)
    # the history is kept as one row per key
    assert store.read("current").count() == reviews.select("unique_id", "capability").distinct().count()


def test_one_review_touches_one_slice(spark, store, graded):
    baseline, found, reviews = graded
    incremental.start(store, baseline, found, reviews)
    before = {t: files(store, t) for t in ("mart", "current", "baseline", "inputs")}
    one = reviews.orderBy("unique_id", "capability").limit(1).withColumn("inference_ts", F.lit("2030-01-01").cast("timestamp"))
    touched = incremental.update(store, one)
    assert len(touched) == 1
    for table in ("mart", "current"):
        kept = {p for p, at in files(store, table).items() if before[table].get(p) == at}
        assert {int(re.search(r"slice=(\d+)", p)[1]) for p in kept} == set(range(4)) - set(touched)
    assert all(files(store, t) == before[t] for t in ("baseline", "inputs"))
    assert incremental.update(store, reviews.where("false")) == []


def test_the_mart_of_an_update_moves_nothing(spark, store, graded):
    baseline, found, reviews = graded
    incremental.start(store, baseline, found, reviews)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in exchanges(incremental.joined(store, [1, 3]))
        assert exchanges(incremental.joined(store)).count("SortMergeJoin") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_table_made_from_others_is_written_once(spark, store, graded, monkeypatch):
    """The slices of the mart are neither stored beforehand nor moved; a slice without rows is emptied."""
    from claimgrade.sources import slices

    baseline, found, reviews = graded
    incremental.start(store, baseline, found, reviews)
    stored = []
    monkeypatch.setattr(slices, "materialise", lambda df, label: stored.append(label) or materialise(df, label))
    late = reviews.withColumn("inference_ts", F.lit("2030-01-01").cast("timestamp"))
    assert incremental.update(store, late) and stored == ["slices-current"]
    assert rows(store.read("mart")) == full(spark, (baseline, found, late))
    store.replace(store.read("baseline").where(F.col(SLICE) != 1), "baseline", [1])
    store.replace(incremental.joined(store, [1, 2]), "mart", [1, 2], like="baseline")
    assert store.read("mart").where(F.col(SLICE) == 1).isEmpty() and not store.read("mart").where(F.col(SLICE) == 2).isEmpty()
