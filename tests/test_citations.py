"""Classes of the pages an entity is cited from."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimgrade.operators import citations

ENTITIES = "unique_id string, official_website string, facebook_link string, source_urls_arr array<string>, websites_arr array<string>"
SUFFIXES = [("gov.in", "government"), ("IN", "directory"), ("pages.gov.in", "social"), ("com", "other"), ("face.com", "social"), ("face.com", "zzz"), (None, "social"), ("odd.org", "unheard")]


def test_classes(spark):
    entities = [
        ("a", "https://www.A.org/home", "https://m.face.com/a", ["http://a.org/x", "https://x.gov.in", "junk", None, " "], ["https://my.pages.gov.in/1", "https://x.gov.in"]),
        ("b", "null", None, None, None),
        ("c", None, "NULL", ["ftp://user:pw@surface.com:21/f", "https://notgov.in/", "https://odd.org"], []),
    ]
    frame = spark.createDataFrame(entities, ENTITIES)
    rows = {r["unique_id"]: r.asDict() for r in citations.quality(frame, spark.createDataFrame(SUFFIXES, "suffix string, class string")).collect()}
    names = ["n_citations", *(f"n_{c}" for c in citations.CLASSES), "best_citation"]
    assert {i: tuple(r[n] for n in names) for i, r in rows.items()} == {
        "a": (6, 2, 1, 0, 2, 0, 1, "official"),
        "b": (0, 0, 0, 0, 0, 0, 0, None),
        "c": (3, 0, 0, 1, 0, 2, 0, "directory"),
    }


def test_empty_tables(spark):
    none = spark.createDataFrame([], "suffix string, class string")
    assert citations.quality(spark.createDataFrame([], ENTITIES), none).count() == 0
    row = citations.quality(spark.createDataFrame([("a", None, "https://face.com", None, None)], ENTITIES), none).first()
    assert (row["n_other"], row["best_citation"]) == (1, "other")


def test_facts_without_a_key_are_dealt_to_all_tasks(spark):
    """Both columns are keys of the join, so that URLs without a host do not meet in one task."""
    from claimgrade.operators.geo import lookup

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.range(2000).select(F.col("id").alias("unique_id"), F.when(F.col("id") % 10 == 0, F.concat(F.lit("h"), "id")).alias("host"))
        kinds = spark.range(2000).select(F.concat(F.lit("h"), "id").alias("host"), F.lit("x").alias("class"))
        found = lookup(facts, kinds, "host", "unique_id")
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "_spread" in plan.split("SortMergeJoin [", 1)[1].split("]", 1)[0]
        assert found.count() == 2000 and found.where("class = 'x'").count() == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_hosts_the_table_decides_on_are_looked_up(spark, monkeypatch):
    moved = []
    kept = citations.lookup
    monkeypatch.setattr(citations, "lookup", lambda facts, *more: moved.append(facts) or kept(facts, *more))
    rows = [("a", "https://a.in", None, ["u1", "u2", "https://a.in/x", "https://b.gov.in/y"], None), ("b", None, None, None, None), (None, None, "https://c.d", ["u1"], None)]
    schema = "unique_id string, official_website string, facebook_link string, source_urls_arr array<string>, websites_arr array<string>"
    suffixes = spark.createDataFrame([("gov.in", "government")], "suffix string, class string")
    found = {r["unique_id"]: r.asDict() for r in citations.quality(spark.createDataFrame(rows, schema), suffixes).collect()}
    assert sorted(r["host"] for r in moved[0].collect()) == ["b.gov.in", "c.d"]
    assert len(found) == 3 and found["b"]["n_citations"] == 0 and found["b"]["best_citation"] is None
    assert [found["a"][c] for c in ("n_citations", "n_official", "n_government", "n_unreadable")] == [5, 2, 1, 2]
    assert [found[None][c] for c in ("n_citations", "n_other", "n_unreadable", "best_citation")] == [2, 1, 1, "other"]
