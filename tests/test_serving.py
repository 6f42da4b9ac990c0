from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from claimgrade.config import TIERS
from claimgrade.operators import overrides, profile, serve


@pytest.fixture
def mart(spark):
    rows = [
        (f"u{i:03d}", "icu", f"Name {i % 7}", "hospital", ["B", "a", None][i % 3], ["Kerala", "", None, "Goa"][i % 4],
         TIERS[i % 4], {0: 90, 1: 60, 2: 30, 3: 0}[i % 4] + i % 5, i % 11)
        for i in range(600)
    ]
    return spark.createDataFrame(
        rows,
        "unique_id string, capability string, name string, facility_type string, district_norm string,"
        " state_name string, tier string, score int, n_source_urls int",
    )


def test_regions(mart):
    assert [tuple(r) for r in serve.regions(mart).collect()] == [("Goa", 150), ("Kerala", 150)]


def test_ranked(mart):
    rows = serve.ranked(mart, "icu", n=200).collect()
    assert len(rows) == 200 and serve.ranked(mart, "icu").count() == 450
    keys = [(TIERS.index(r["tier"]), -r["score"], r["unique_id"]) for r in rows]
    assert keys == sorted(keys) and rows[0]["tier"] == "strong"
    assert {r["tier"] for r in serve.ranked(mart, "icu", tier="no_claim").collect()} == {"no_claim"}
    assert {r["state_name"] for r in serve.ranked(mart, "icu", region="Goa").collect()} <= {"Goa"}
    everything = serve.ranked(mart, "icu", "All", "All")
    assert everything.count() == 450 and everything.where("tier = 'no_claim'").count() == 0


@pytest.mark.parametrize("sort", ["name", "facility_type", "district_norm", "tier", "n_source_urls"])
def test_sorting_keeps_the_rows(mart, sort):
    ranked = {r["unique_id"] for r in serve.ranked(mart, "icu").collect()}
    up = serve.ranked_sorted(mart, "icu", sort=sort).collect()
    down = serve.ranked_sorted(mart, "icu", sort=sort, descending=True).collect()
    assert {r["unique_id"] for r in up} == {r["unique_id"] for r in down} == ranked

    def key(r):
        if sort == "tier":
            return TIERS.index(r["tier"]), -r["score"]
        return r[sort] if sort == "n_source_urls" else (r[sort] or "").lower()

    assert [key(r) for r in up] == sorted(key(r) for r in up)
    assert [key(r) for r in down] == sorted((key(r) for r in down), reverse=True)


def test_unknown_sort_key(mart):
    with pytest.raises(ValueError, match="cannot sort"):
        serve.ranked_sorted(mart, "icu", sort="price")


EVENTS = "unique_id string, capability string, action string, tier string, note string, ts bigint, actor_email string"


def test_overrides(spark, mart):
    events = spark.createDataFrame(
        [
            ("u000", "icu", "save", "partial", " first ", 1, None),
            ("u000", "icu", "save", "no_claim", "second", 2, "a@b.example"),
            ("u001", "icu", "save", "strong", "x", 1, None),
            ("u001", "icu", "clear", None, None, 2, None),
            ("u002", "icu", "save", "strong", "  ", 5, None),
            ("u002", "icu", "save", "strong", "x", None, None),
            ("u003", "icu", "save", None, "x", 1, None),
            ("u004", "icu", "drop", "strong", "x", 1, None),
            ("u005", "icu", "clear", None, None, 1, None),
            ("u005", "icu", "save", "strong", " again", 3, None),
        ],
        EVENTS,
    )
    assert {(r["unique_id"], r["problem"]) for r in overrides.rejected(events).collect()} == {
        ("u002", "no_note"),
        ("u002", "no_time"),
        ("u003", "no_tier"),
        ("u004", "bad_action"),
    }
    in_force = overrides.state(events)
    assert {(r["unique_id"], r["tier"], r["note"]) for r in in_force.collect()} == {
        ("u000", "no_claim", "second"),
        ("u005", "strong", "again"),
    }
    effective = overrides.effective(mart, in_force)
    assert effective.count() == 600
    changed = effective.where("has_local_override").select("unique_id", "effective_tier").collect()
    assert {tuple(r) for r in changed} == {("u000", "no_claim"), ("u005", "strong")}


def test_display_lists(spark):
    df = spark.createDataFrame(
        [([" a", "a ", "", "b", "c", "d", "e", "f"], [str(i) for i in range(30)]), ([], ["x"])],
        "s array<string>, b array<string>",
    )
    shown = df.select(
        serve.shown(serve.display_snippets(F.col("s")), 5).alias("s"),
        F.size(serve.shown(F.col("b"), 24)).alias("n"),
        serve.hidden(F.col("b"), 24).alias("more"),
    ).collect()
    assert [tuple(r) for r in shown] == [(["a", "b", "c", "d", "e"], 24, 6), ([], 1, 0)]


def test_signals_and_summary(spark):
    documents = [
        ('{"structured_hit":true,"claim_hit":true,"well_corroborated":true,"supporting_snippets_llm":["q"," q"]}', "why"),
        ('{"well_corroborated":true,"recent_update":true,"reasoning_llm":" reason "}', "why"),
        ('{"capacity_supported":true,"reasoning_llm":"  "}', "why"),
        ("{}", ""),
    ]
    rows = [(f"u{i}", "icu", d, e, None if i else [str(n) for n in range(12)]) for i, (d, e) in enumerate(documents)]
    mart = spark.createDataFrame(
        rows, "unique_id string, capability string, evidence_json string, explanation string, citation_urls array<string>"
    )
    a, b, c, d = serve.signals(mart).orderBy("unique_id").collect()
    assert a["evidence_signals"] == ["structured evidence matched", "capability claim matched"]
    assert a["context_note"] is None and a["snippets"] == ["q"]
    assert (a["n_citations"], len(a["citations"]), d["n_citations"]) == (12, 12, 0)
    page = serve.signals(mart, unique_id="u0", max_citations=10, max_snippets=0).first()
    assert (page["n_citations"], len(page["citations"]), page["snippets"], page["n_snippets"]) == (12, 10, [], 1)
    assert b["context_note"].startswith("The facility itself looks well-sourced and recently updated")
    assert c["context_note"] == "We found no direct evidence for this capability."
    assert d["context_note"] is None and d["context_signals"] == []
    effective = mart.withColumns({"effective_tier": F.lit("partial"), "has_local_override": F.lit(False)})
    found = [(r["source"], r["detail"]) for r in serve.summary(effective).orderBy("unique_id").collect()]
    assert found == [("heuristic", "why"), ("llm", "reason"), ("heuristic", "why"), ("none", "")]


def test_profiles(facilities):
    raw = facilities(
        {"unique_id": "x", "specialties": '[" Cardiology", "cardiology"]', "latitude": 20.0, "longitude": 75.0},
        {"unique_id": "x", "specialties": "junk", "latitude": 59.9, "longitude": -38.2, "numberDoctors": "null"},
        {"cluster_id": "c", "specialties": '["", "icu"]', "numberDoctors": "3"},
    )
    keys = {r["key"]: r for r in profile.keys(raw).collect()}
    assert tuple(keys["id"])[1:] == (3, 2, 1, 2)
    assert tuple(keys["cluster"])[1:] == (3, 1, 0, 0)
    assert tuple(profile.geo_bounds(raw).first()) == (3, 1, 1, 1)
    counts = {r["column_name"]: tuple(r)[1:] for r in profile.null_literals(raw).collect()}
    assert counts["numberDoctors"] == (1, 1, 1)
    words = {r["column_name"]: r for r in profile.vocabulary(raw).collect()}
    assert (words["specialties"]["distinct_phrases"], words["specialties"]["mentions"]) == (2, 3)
    support = profile.min_support(raw, supports=(1, 2, 3)).first()
    assert tuple(support)[1:] == (2, 2, 1, 0)
