from __future__ import annotations

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from claimgrade.config import FACILITY
from claimgrade.review import inputs, parse, pending, prompts, run, signals

RECORD = {
    "claim_hit": True,
    "prose_hit": False,
    "screening_only": None,
    "capability_scope": "full_capability",
    "supporting_snippets": ["a"],
    "confidence": 0.9,
    "reasoning": "because",
}


def _answers(spark, responses, capabilities=("icu",)):
    rows = [
        (
            str(i),
            f"id{i}",
            f"Name {i}",
            [(c, f"fp-{c}", "2024-01-01 00:00:00") for c in capabilities],
            list(capabilities),
            r if isinstance(r, str) else json.dumps(r),
        )
        for i, r in enumerate(responses)
    ]
    schema = (
        "request_id string, unique_id string, facility_name string,"
        " requested array<struct<capability:string,evidence_fingerprint:string,source_snapshot_ts:string>>,"
        " capabilities array<string>, raw_response_json string"
    )
    return spark.createDataFrame(rows, schema)


def _by_id(df):
    return [r for r in sorted(df.collect(), key=lambda r: int(r["request_id"]))]


TEXT_SHAPES = [
    ({"choices": [{"message": {"content": "x"}}]}, "x"),
    ({"choices": [{"message": {"content": ""}, "text": "y"}]}, "y"),
    ({"choices": [{"message": {"content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}}]}, "ab"),
    (
        {
            "choices": [
                {
                    "message": {
                        "content": [
                            {"type": "reasoning", "summary": [{"text": "s1"}, {"text": 5}]},
                            {"type": "other", "text": "o"},
                            7,
                        ]
                    }
                }
            ]
        },
        "s1\no",
    ),
    ({"choices": [{"message": {"content": [{"type": "other", "text": "o"}, {"type": "text", "text": "t"}]}}]}, "t"),
    ({"choices": [], "output": [{"content": []}, {"content": [{"type": "text", "text": "z"}]}]}, "z"),
    ({"output": [{"text": "direct"}]}, "direct"),
    ({"predictions": ["p"]}, "p"),
    ({"predictions": [{"content": "c", "text": "t"}]}, "c"),
    ({"predictions": [{"text": "t"}]}, "t"),
    ({"response": 5, "result": "r"}, "r"),
    ({"text": "t", "output_text": "first"}, "first"),
    ({"status": "busy"}, None),
    ([1, 2], None),
    ("not json", None),
]


def test_assistant_text(spark):
    found = _by_id(parse.extract_text(_answers(spark, [r for r, _ in TEXT_SHAPES])))
    for row, (shape, want) in zip(found, TEXT_SHAPES, strict=True):
        assert row["assistant_text"] == want, shape
        assert (row["error"] is None) == (want is not None)


@pytest.mark.parametrize(
    ("text", "value", "error"),
    [
        ('{"a": 1}', 1, None),
        (' \n{"a": 1}\t', 1, None),
        ('```json\n{"a": 1}\n```', 1, None),
        ("```\n```", None, parse.NO_OBJECT),
        ('So: {"a": 1}, I think', 1, None),
        ('{"a": 1} {"a": 2}', None, parse.NO_OBJECT),
        ('{"a": 1}, {"a": 2}', None, parse.NO_OBJECT),
        ('x {"b": {"c":\n 2}, "a": 1} y', 1, None),
        ('[{"a": 1}]', None, parse.NOT_AN_OBJECT),
        ('"text"', None, parse.NOT_AN_OBJECT),
        ("} nothing {", None, parse.NO_OBJECT),
        ('{"a": 1, "a": 3}', 3, None),
        ("", None, parse.NO_OBJECT),
    ],
)
def test_object_in_text(spark, text, value, error):
    row = parse.extract_object(parse.extract_text(_answers(spark, [{"output_text": text}]))).select(
        F.try_variant_get("payload", "$.a", "int").alias("a"), "error"
    ).first()
    assert (row["a"], row["error"]) == (value, error)


SINGLE = [
    ({}, None, {"claim_hit": True, "confidence": 0.9, "reasoning": "because"}),
    ({"claim_hit": "YES", "prose_hit": 0, "screening_only": 1.0}, None, {"claim_hit": True, "prose_hit": False, "screening_only": True}),
    ({"claim_hit": "maybe"}, "bad claim_hit", None),
    ({"claim_hit": 2}, "bad claim_hit", None),
    ({"claim_hit": []}, "bad claim_hit", None),
    ({"confidence": 1.2}, "bad confidence", None),
    ({"confidence": " 0.5 "}, None, {"confidence": 0.5}),
    ({"confidence": "0.5f"}, "bad confidence", None),
    ({"confidence": True}, None, {"confidence": 1.0}),
    ({"confidence": None}, None, {"confidence": None}),
    ({"confidence": 1}, None, {"confidence": 1.0}),
    ({"capability_scope": "full"}, "bad capability_scope", None),
    ({"capability_scope": None}, None, {"capability_scope": None}),
    ({"reasoning": 5}, "bad reasoning", None),
    ({"reasoning": {"claim_hit": True}}, "bad reasoning", None),
    ({"supporting_snippets": None}, "bad supporting_snippets", None),
    ({"supporting_snippets": "x"}, "bad supporting_snippets", None),
    ({"supporting_snippets": ["a", 1]}, "bad supporting_snippets", None),
    ({"supporting_snippets": ["a", None]}, "bad supporting_snippets", None),
    ({"supporting_snippets": []}, None, {"supporting_snippets": []}),
    (
        {"supporting_snippets": [" a ", "", "b", " ", "c", "d", "e", "f"]},
        None,
        {"supporting_snippets": ["a", "b", "c", "d", "e", "f"]},
    ),
    ({"tier": "strong"}, "unknown keys: tier", None),
    ({"capability": "icu"}, "unknown keys: capability", None),
]


def test_single_records(spark):
    answers = _answers(spark, [{"output_text": json.dumps({**RECORD, **change})} for change, _, _ in SINGLE])
    for row, (change, error, want) in zip(_by_id(parse.parse(answers, batch=False)), SINGLE, strict=True):
        assert row["error"] == error, change
        assert (row["records"] is None) == (error is not None)
        for field, value in (want or {}).items():
            assert row["records"][0][field] == value, change


def test_missing_fields_are_null(spark):
    row = parse.parse(_answers(spark, [{"output_text": "{}"}]), batch=False).first()
    assert row["error"] is None
    assert row["records"][0].asDict() == {
        "capability": "icu",
        **dict.fromkeys(parse.SIGNAL_FIELDS),
        "supporting_snippets": [],
    }


def _item(capability, **change):
    return {**RECORD, "capability": capability, **change}


BATCH = [
    ([_item("icu"), _item("trauma")], None),
    ([_item(" ICU "), _item("Trauma"), _item("icu", reasoning="later"), _item("other")], None),
    ([_item("icu")], "missing capabilities: trauma"),
    ([], "missing capabilities: icu, trauma"),
    ([_item("icu"), _item("trauma"), _item("x", confidence=7)], "bad confidence"),
    ([_item("icu"), _item(None), _item("trauma")], "a result without capability"),
    ([_item("icu"), _item("trauma"), _item(5)], "a result without capability"),
    ([_item("icu"), _item("trauma"), "x"], "not an object"),
    ({"icu": RECORD}, "no list of results"),
    (None, "no list of results"),
]


def test_batch_answers(spark):
    answers = _answers(
        spark, [{"output_text": json.dumps({"results": r})} for r, _ in BATCH], ("icu", "trauma")
    )
    parsed = parse.parse(answers, batch=True)
    found = _by_id(parsed)
    for row, (results, error) in zip(found, BATCH, strict=True):
        assert row["error"] == error, results
    assert [r["reasoning"] for r in found[1]["records"]] == ["later", "because"]
    rows = parse.split(parsed).collect()
    assert {(r["unique_id"], r["capability"], r["evidence_fingerprint"]) for r in rows} == {
        (f"id{i}", c, f"fp-{c}") for i in (0, 1) for c in ("icu", "trauma")
    }
    stored = json.loads(rows[0]["parsed_json"])
    assert list(stored) == list(parse.SIGNAL_FIELDS) and stored["screening_only"] is None


def test_unknown_key_beside_the_results(spark):
    answer = {"output_text": json.dumps({"results": [_item("icu")], "tier": "strong"})}
    assert parse.parse(_answers(spark, [answer])).first()["error"] == "unknown keys: tier"


def test_model_name_is_searched_near_first(spark):
    responses = [
        {"model": "top", "a": {"model": "deep"}},
        {"z": {"served_model_name": " z "}, "a": [{"model": "a"}], "model": 5},
        {"x": [{"y": {"served_entity_version": "v"}}], "model": " "},
        {"served_entity_name": "e", "served_model_name": "m"},
        {"a": [{"model": "deep", "model_version": "9"}, {"model_version": "8"}], "model": "top"},
        {"text": "says \"model\": x", "model": [], "b": {"model_version": " "}},
    ]
    found = run.with_model(_answers(spark, responses)).select("model_name", "model_version")
    assert [tuple(r) for r in found.collect()] == [("top", None), ("z", None), (None, "v"), ("m", None), ("top", "9"), (None, None)]


def test_template_places(spark):
    df = spark.createDataFrame([("$name", 3, None)], "a string, n int, z string")
    text = prompts.substitute("$$5 ${a}|$n|$z.", a=F.col("a"), n=F.col("n"), z=F.col("z"))
    assert df.select(text).first()[0] == "$5 $name|3|."
    with pytest.raises(KeyError):
        prompts.substitute("$missing")
    with pytest.raises(ValueError, match="bad placeholder"):
        prompts.substitute("cost: $ 5")


def test_fingerprint_follows_the_evidence(graded_frame, supported):
    def marks(as_of="2024-01-01", evidence_only=False, **change):
        frame = graded_frame({**supported, **change}, as_of=as_of)
        found = inputs.with_fingerprint(frame, evidence_only).select("capability", "evidence_fingerprint")
        return dict(found.collect())

    base = marks()
    assert len(set(base.values())) == len(FACILITY.capabilities)
    assert marks() == base
    for change in ({"description": "x"}, {"source_types": '["a"]'}, {"source": "s"}, {"capacity": None}):
        assert all(marks(**change)[c] != base[c] for c in base), change
    assert marks(facebookLink="elsewhere") == base
    dated = {"recency_of_page_update": "2023-06-01"}
    assert marks(**dated) != marks(as_of="2026-01-01", **dated)
    assert marks(evidence_only=True, **dated) == marks(as_of="2026-01-01", evidence_only=True, **dated)


REVIEWS = (
    "unique_id string, capability string, evidence_fingerprint string, prompt_version string, model_name string,"
    " model_version string, run_id string, source_snapshot_ts timestamp, inference_ts timestamp,"
    " raw_response_json string, parsed_json string"
)


@pytest.fixture
def review_rows(spark):
    from datetime import datetime

    def make(*rows):
        full = [
            (u, c, fp, version, "m", None, "r", None, datetime(2024, 1, day), "{}", json.dumps(RECORD))
            for u, c, fp, version, day in rows
        ]
        return spark.createDataFrame(full, REVIEWS)

    return make


def test_pending_is_per_prompt_version_but_signals_are_not(graded_frame, review_rows):
    frame = inputs.inputs(graded_frame({}, {}), "2024-01-01 00:00:00").cache()
    mark = {(r["unique_id"], r["capability"]): r["evidence_fingerprint"] for r in frame.collect()}
    reviews = review_rows(
        ("id0", "icu", mark["id0", "icu"], "v1", 1),
        ("id0", "icu", "old", "v2", 2),
        ("id0", "nicu", mark["id0", "nicu"], "v1", 1),
        ("id0", "nicu", "old", "v1", 2),
        ("id1", "icu", mark["id1", "icu"], "v2", 1),
    )
    todo = pending.pending(frame, reviews, "v1")
    assert ("id0", "icu") not in {(r["unique_id"], r["capability"]) for r in todo.collect()}
    assert todo.count() == 11
    assert pending.pending(frame, reviews, "v1", force=True).count() == 12
    assert pending.pending(frame, reviews, "v1", capability="nicu").count() == 2
    assert pending.pending(frame, reviews, "v1", unique_id="id0").count() == 5
    first = pending.pending(frame, reviews, "v1", mode="row", limit=3).collect()
    assert [(r["capability"], r["unique_id"]) for r in first] == [
        ("emergency", "id0"),
        ("emergency", "id1"),
        ("icu", "id1"),
    ]
    one = pending.pending(frame, reviews, "v1", mode="entity", limit=1).collect()
    assert {r["unique_id"] for r in one} == {"id0"} and len(one) == 5
    gone = pending.pending(frame, reviews, "v1", failed=todo.where("unique_id = 'id1'"))
    assert {r["unique_id"] for r in gone.collect()} == {"id0"}

    found = {(r["unique_id"], r["capability"]): r for r in signals.signals(frame, reviews).collect()}
    assert len(found) == 12
    assert found["id0", "icu"]["llm_review_status"] == "stale"
    assert found["id1", "icu"]["llm_review_status"] == "current" and found["id1", "icu"]["claim_hit_llm"] is True
    assert found["id1", "nicu"]["llm_review_status"] == "missing" and not found["id1", "nicu"]["has_llm_review"]


def test_stored_json_that_cannot_be_read_gives_nulls(spark):
    texts = ["junk", None, '{"claim_hit": "true", "confidence": "x", "supporting_snippets": "s", "reasoning": ""}']
    df = spark.createDataFrame([(t,) for t in texts], "parsed_json string")
    a, b, c = signals.typed(df).collect()
    assert a["claim_hit_llm"] is None and a["supporting_snippets_llm"] == [] and b["supporting_snippets_llm"] == []
    assert (c["claim_hit_llm"], c["confidence_llm"], c["reasoning_llm"]) == (True, None, None)
    assert c["supporting_snippets_llm"] is None


def _requests(spark, ids, capabilities=("icu", "trauma")):
    answers = _answers(spark, ["{}"] * len(ids), capabilities)
    named = spark.createDataFrame([(str(i), n) for i, n in enumerate(ids)], "request_id string, unique_id string")
    return answers.drop("unique_id", "raw_response_json").join(named, "request_id").drop("request_id").withColumn(
        "llm_input_json", F.lit("{}")
    )


def make_scripted():
    """A local function, as workers cannot import this file."""

    def scripted(frame: pd.DataFrame) -> pd.Series:
        """Answers by what the request id says: good, repaired, late or never."""
        import json

        record = {"claim_hit": True}
        good = json.dumps({"output_text": json.dumps({"results": [{**record, "capability": c} for c in ("icu", "trauma")]})})
        bad = json.dumps({"output_text": "sorry"})

        def one(request: str) -> str:
            name, repair = request.split(":")[2], request.endswith(":repair")
            late = "attempt2" in request
            if name == "good" or (name == "repaired" and repair) or (name == "late" and late):
                return good
            return bad

        return frame["request_id"].map(one)

    return scripted


def test_run_repairs_and_retries(spark):
    answered = run.run(_requests(spark, ["good", "repaired", "late", "never"]), make_scripted(), "r1").collect()
    by_name = {r["unique_id"]: r for r in answered}
    assert len(answered) == 4
    assert {n for n, r in by_name.items() if r["error"] is None} == {"good", "repaired", "late"}
    assert by_name["repaired"]["request_id"].endswith("attempt1")
    assert "sorry" in by_name["repaired"]["raw_response_json"]
    assert by_name["late"]["request_id"].endswith("attempt2")
    assert by_name["never"]["error"] == parse.NO_OBJECT
    assert by_name["never"]["request_id"].endswith("attempt3")


def make_failing(marker: str):
    """A reviewer that raises about some requests and notes every call in a folder."""

    def failing(frame: pd.DataFrame) -> pd.Series:
        import json
        import uuid
        from pathlib import Path

        for request in frame["request_id"]:
            if ":broken" in request or (":once" in request and "attempt1" in request):
                raise RuntimeError("no answer for " + request.split(":")[2])
        Path(marker, uuid.uuid4().hex).write_text("\n".join(frame["request_id"]))
        record = {"claim_hit": True}
        good = json.dumps({"output_text": json.dumps({"results": [{**record, "capability": c} for c in ("icu", "trauma")]})})
        return pd.Series([good] * len(frame))

    return failing


def test_a_reviewer_that_raises_costs_its_request_only(spark, tmp_path):
    names = [*[f"good{i}" for i in range(20)], "broken", "once"]
    answered = run.run(_requests(spark, names), make_failing(str(tmp_path)), "r1", concurrency=2, groups=2).collect()
    by_name = {r["unique_id"]: r for r in answered}
    assert len(answered) == len(names)
    assert by_name["broken"]["error"] == "call failed: RuntimeError: no answer for broken"
    assert by_name["once"]["error"] is None and by_name["once"]["request_id"].endswith("attempt2")
    assert all(by_name[n]["error"] is None for n in names if n.startswith("good"))
    # a failed call has no answer to repair
    asked = [line for p in tmp_path.iterdir() for line in p.read_text().splitlines()]
    assert not any(a.endswith(":repair") for a in asked)


def test_a_run_that_died_goes_on(spark, tmp_path):
    names = [f"n{i}" for i in range(30)]
    calls, answers = tmp_path / "calls", str(tmp_path / "answers")
    calls.mkdir()
    inner = make_failing(str(calls))

    def dying(frame: pd.DataFrame) -> pd.Series:
        import os

        os._exit(1)  # the worker is gone, not only the call

    def half(frame: pd.DataFrame) -> pd.Series:
        return inner(frame)

    frame = _requests(spark, names)
    run.run(frame.where("unique_id < 'n2'"), half, "r1", answers=answers, groups=4)
    first = {line for p in calls.iterdir() for line in p.read_text().splitlines()}
    assert 0 < len(first) < len(names)
    with pytest.raises(Exception, match="(?s)exited|crashed|EOF|Python worker"):
        run.run(frame, dying, "r1", answers=answers, groups=4)
    done = run.run(frame, half, "r1", answers=answers, groups=4).collect()
    asked = [line for p in calls.iterdir() for line in p.read_text().splitlines()]
    assert len(done) == len(names) and all(r["error"] is None for r in done)
    # nothing was asked twice
    assert len(asked) == len(set(asked)) == len(names)


def test_a_single_row_is_repaired_only_when_it_cannot_be_read(spark, tmp_path):
    calls = str(tmp_path)

    def reviewer(frame: pd.DataFrame) -> pd.Series:
        import json
        import uuid
        from pathlib import Path

        Path(calls, uuid.uuid4().hex).write_text("\n".join(frame["request_id"]))

        def one(request: str) -> str:
            text = "sorry" if ":unread" in request else '{"claim_hit": "maybe"}'
            return json.dumps({"output_text": text})

        return frame["request_id"].map(one)

    requests = _requests(spark, ["unread", "invalid"], ("icu",))
    failed = run.run(requests, reviewer, "r1", batch=False, rounds=2).collect()
    assert {r["unique_id"]: r["error"] for r in failed} == {"unread": parse.NO_OBJECT, "invalid": "bad claim_hit"}
    asked = [line for p in tmp_path.iterdir() for line in p.read_text().splitlines()]
    repaired = [a for a in asked if a.endswith(":repair")]
    assert len(asked) == 6 and len(repaired) == 2 and all(":unread" in a for a in repaired)


def test_fingerprint_of_a_literal_row(spark):
    """The hash of the parts of one row, written out by hand."""
    import hashlib

    columns = {p: f"<{p}>" for p in inputs.FINGERPRINT_PARTS}
    columns |= {"score": 7, "citation_urls": ["u1", "u2"], "source_types_arr": None, "num_doctors": None}
    fields = ", ".join(
        f"{p} {'int' if p in ('score', 'num_doctors') else 'array<string>' if p in inputs.FINGERPRINT_LISTS else 'string'}" for p in columns
    )
    row = spark.createDataFrame([tuple(columns.values())], fields)
    found = inputs.with_fingerprint(row).first()["evidence_fingerprint"]
    texts = ["[]" if p == "source_types_arr" else '["u1","u2"]' if p == "citation_urls" else "7" if p == "score" else "" if p == "num_doctors" else f"<{p}>" for p in columns]
    assert found == hashlib.sha256("||".join(texts).encode()).hexdigest()


def test_answers_are_trimmed_and_lowered_once(spark):
    """White space of any kind at either end goes; names are lowered per capability, not per pair."""
    from claimgrade.review import parse

    texts = ["x", " x", "x　", "  x\t", "", "\n", None, "```json\n x \n```", " ```\nx\n``` ", "a b"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(1)
    found = {r["i"]: r["u"] for r in rows.select("i", parse.unfenced(F.col("t")).alias("u")).collect()}
    assert [found[i] for i in range(len(texts))] == ["x", "x", "x", "x", "", "", None, "x", "x", "a b"]
    asked = spark.createDataFrame([("{}", ["icu"], None)], "assistant_text string, capabilities array<string>, error string")
    text = parse.validate_batch(parse.extract_object(asked))._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" in text and not any("lower(" in part.split(")", 1)[0] for part in text.split("lambdafunction(coalesce(")[1:])
