from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from claimgrade.config import FACILITY
from claimgrade.functions.text import contains_any, json_array, quote, strip
from claimgrade.operators import clean, geo, reference_data


def test_region(spark):
    cases = {
        " Orissa ": "Odisha",
        "null": None,
        "NULL": "Null",
        "chennai": "Tamil Nadu",
        "": None,
        "  ": None,
        "uttar PRADESH": "Uttar Pradesh",
        "Navi Mumbai": "Maharashtra",
        None: None,
    }
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "raw string, want string")
    for row in df.withColumn("got", clean.region(F.col("raw"), FACILITY.regions)).collect():
        assert row["got"] == row["want"], row


def test_json_array_refuses_everything_else(spark):
    cases = {
        '["a", 1]': ["a", "1"],
        "[]": [],
        "null": None,
        "": None,
        '{"a": 1}': None,
        "junk": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").withColumn("a", json_array(F.col("t")))
    assert {r["t"]: r["a"] for r in df.collect()} == cases


def test_typed_values(facilities):
    rows = clean.typed(
        facilities(
            {"numberDoctors": "12.7", "capacity": " 12 ", "source_urls": None},
            {"numberDoctors": "null", "capacity": "7", "source_urls": "junk", "facilityTypeId": "farmacy"},
            {"affiliated_staff_presence": "True", "custom_logo_presence": "true", "source_urls": '["a"]'},
        )
    ).orderBy("unique_id")
    a, b, c = rows.collect()
    assert (a["num_doctors"], a["capacity_beds"], a["n_source_urls"], a["staff_present"]) == (None, 12, 0, None)
    assert (b["n_source_urls"], b["facility_type"], b["source_urls_arr"]) == (None, "pharmacy", None)
    assert (c["staff_present"], c["logo_present"], c["n_source_urls"]) == (False, True, 1)


def test_type_filter_is_exact_case_and_quarantine_is_its_complement(facilities):
    raw = facilities(
        {"facilityTypeId": "Hospital"},
        {"facilityTypeId": None},
        {"name": None},
        {"name": None, "facilityTypeId": "x"},
        {},
    )
    assert [r["unique_id"] for r in clean.entities(raw).collect()] == ["id4"]
    reasons = {r["unique_id"]: r["reason"] for r in clean.quarantine(raw).collect()}
    assert reasons == {
        "id0": "invalid_type",
        "id1": "invalid_type",
        "id2": "missing_name",
        "id3": "missing_name,invalid_type",
    }


@pytest.mark.parametrize("seed", range(3))
def test_dedupe_does_not_depend_on_row_order(facilities, seed):
    rng = random.Random(seed)
    rows = [
        {
            "unique_id": f"u{rng.randrange(12)}",
            "source_content_id": f"s{i}",
            "cluster_id": rng.choice([None, "c1", "c2", "c3"]),
            "source_urls": rng.choice([None, "junk", '["a"]', '["a", "b"]']),
        }
        for i in range(60)
    ]
    shuffled = rng.sample(rows, len(rows))

    def richness(row: dict) -> int:
        return {None: 0, "junk": -1, '["a"]': 1, '["a", "b"]': 2}[row["source_urls"]]

    def best(group: list[dict]) -> dict:
        return min(group, key=lambda r: (-richness(r), r["unique_id"], r["source_content_id"]))

    clusters: dict[str, list[dict]] = {}
    for row in rows:
        clusters.setdefault(row["cluster_id"] or row["unique_id"], []).append(row)
    heads = [best(g) for g in clusters.values()]
    ids: dict[str, list[dict]] = {}
    for row in heads:
        ids.setdefault(row["unique_id"], []).append(row)
    want = {best(g)["source_content_id"] for g in ids.values()}
    for order in (rows, shuffled):
        raw = facilities(*order)
        assert {r["source_content_id"] for r in clean.entities(raw).collect()} == want
        lost = {r["source_content_id"] for r in clean.quarantine(raw).collect()}
        assert lost == {r["source_content_id"] for r in heads} - want


def test_one_key_with_a_third_of_all_rows(facilities):
    rows = [{"unique_id": "hot", "cluster_id": f"c{i}"} for i in range(300)]
    rows += [{"cluster_id": "big"} for _ in range(300)] + [{} for _ in range(300)]
    raw = facilities(*[{**r, "source_content_id": f"s{i:04d}"} for i, r in enumerate(rows)])
    assert clean.entities(raw).count() == 1 + 1 + 300
    assert clean.quarantine(raw).where("reason = 'duplicate_id'").count() == 299


def test_footnotes(spark):
    cases = {"(45.6)": 45.6, "12.3 *": 12.3, "*": None, " 7 ": 7.0, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    got = df.withColumn("n", reference_data.footnoted_number(F.col("t"))).collect()
    assert {r["t"]: r["n"] for r in got} == cases


def test_need_index(spark):
    columns = (
        "district_norm string, state_ut string, institutional_birth_5y_pct double,"
        " births_delivered_by_csection_5y_pct double, breast_exam_pct double, cervical_screen_pct double,"
        " oral_cancer_exam_pct double, health_insurance_pct double, hypertension_women_pct double,"
        " high_bloodsugar_women_pct double, anaemia_women_pct double"
    )
    rows = [
        ("A", "x", 103.0, None, None, None, None, None, None, 1.25, 50.04),
        ("B", "x", None, None, 3.0, 6.0, None, None, 20.0, None, None),
    ]
    a, b = reference_data.need_index(spark.createDataFrame(rows, columns)).orderBy("district_norm").collect()
    assert (a["maternity_need"], a["oncology_screening_gap"], a["hypertension_burden"]) == (0.0, 100.0, 0.0)
    assert (b["maternity_need"], b["oncology_screening_gap"], b["hypertension_burden"]) == (50.0, 97.0, 20.0)


def test_bridge_has_one_row_per_pincode_and_breaks_ties(spark):
    rows = [(1, " b ", "x"), (1, "A", "x"), (2, "z", "KERALA"), (2, "Z ", "kerala"), (2, "a", "kerala")]
    found = reference_data.bridge(spark.createDataFrame(rows, "pincode bigint, district string, statename string"))
    assert {tuple(r) for r in found.collect()} == {(1, "A", "X"), (2, "Z", "Kerala")}


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_lookup_with_and_without_broadcast(spark, threshold):
    """One postcode holds most rows; rows without one match nothing."""
    facts = [("a", 1), ("b", 9), *[(f"n{i}", None) for i in range(50)], *[(f"h{i}", 2) for i in range(200)]]
    frame = spark.createDataFrame(facts, "unique_id string, pincode bigint")
    bridge = spark.createDataFrame([(1, "one"), (2, "two")], "pincode bigint, state_name string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        found = geo.lookup(frame, bridge, "pincode", "unique_id").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(found) == len(facts)
    got = {r["unique_id"]: r["state_name"] for r in found}
    assert got == {"a": "one", "b": None, **{f"n{i}": None for i in range(50)}, **{f"h{i}": "two" for i in range(200)}}


def test_terms_and_quotes(spark):
    texts = ["icu ward", "an icu", "micu", "it's a\\b"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select("t", F.expr(contains_any("t", [" icu"], ["icu"])).alias("h")).collect()
    assert [r["h"] for r in found] == [True, True, False, False]
    assert df.where(f"t = {quote(texts[3])}").count() == 1
    assert df.where(contains_any("t", [])).count() == 0


def test_strip_removes_all_white_space(spark):
    df = spark.createDataFrame([(" \t a b \r\n ",)], "t string")
    assert df.select(strip(F.col("t"))).first()[0] == "a b"
