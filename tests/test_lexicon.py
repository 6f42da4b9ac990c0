"""Many terms at once against plain substring search."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimgrade.config import FACILITY
from claimgrade.functions import patterns
from claimgrade.operators import evidence, lexicon

CHANNELS = ("spec_eq_text", "claim_text", "prose_text", "full_text")


def plain(texts: list[tuple], terms: list[tuple]) -> dict:
    """(key, capability) -> the four flags, by one search per term."""
    out = {}
    for key, *channels in texts:
        by_name = {n: c or "" for n, c in zip(CHANNELS, channels, strict=True)}
        for capability in {t[0] for t in terms}:

            def has(rule, by_name=by_name, capability=capability):
                text = by_name[lexicon.CHANNELS[rule]]
                return any(
                    text.startswith(t) if anchored else t in text for c, r, t, anchored in terms if (c, r) == (capability, rule)
                )

            out[key, capability] = (has("structured"), has("claim"), has("prose"), has("screening_any") and not has("screening_none"))
    return out


def found(frame) -> dict:
    return {(r[0], r["capability"]): (r["structured_hit"], r["claim_hit"], r["prose_hit"], r["screening_only"]) for r in frame.collect()}


def frame(spark, texts):
    return spark.createDataFrame(texts, "unique_id string, spec_eq_text string, claim_text string, prose_text string, full_text string")


def test_overlapping_and_nested_terms(spark):
    rows = [("a", "abcde", None, "", "xabcab"), ("b", "bcd abc", "ab", "a|b.c*", "b"), (None, "", "de", "ABC", None)]
    terms = [
        ("one", "structured", "abcd", False), ("one", "structured", "bc", False), ("two", "structured", "ab", True),
        ("two", "claim", "ab", False), ("two", "claim", "abc", False), ("one", "prose", "a|b.c*", False), ("one", "prose", "\\E", False),
        ("one", "screening_any", "b", False), ("one", "screening_none", "abc", False), ("two", "screening_none", "q", False),
    ]
    assert found(lexicon.hits(frame(spark, rows), spark.createDataFrame(terms, lexicon.LEXICON))) == plain(rows, terms)


def test_random_terms(spark):
    rng = random.Random(7)

    def word(n):
        return "".join(rng.choice("abc é日.") for _ in range(n))

    rules = list(lexicon.CHANNELS)
    terms = sorted({(rng.choice("xyz"), rng.choice(rules), word(rng.randrange(1, 6)), rng.random() < 0.2) for _ in range(400)})
    rows = [(f"k{i}", *(rng.choice([None, "", word(rng.randrange(1, 40))]) for _ in CHANNELS)) for i in range(150)]
    assert found(lexicon.hits(frame(spark, rows), spark.createDataFrame(terms, lexicon.LEXICON))) == plain(rows, terms)


def test_shipped_lexicon_as_a_table(spark, facilities):
    from claimgrade.operators import clean

    entities = clean.entities(
        facilities(
            {"description": "ICU and cancer screening", "capability": '["24/7 emergency"]', "specialties": '["icu"]'},
            {"description": "tumour board, radiotherapy", "equipment": '["ventilator"]'},
            {"description": None},
        )
    )
    same = [tuple(r) for r in evidence.hits(entities).orderBy("unique_id", "capability").collect()]
    assert [tuple(r) for r in lexicon.hits(entities, lexicon.table(spark)).orderBy("unique_id", "capability").collect()] == same
    assert len(same) == 3 * len(FACILITY.lexicon)


def test_rows_that_are_no_terms(spark):
    terms = [("c", "claim", "", False), ("c", "claim", None, False), (None, "claim", "a", False), ("c", "other", "a", False), ("d", "claim", "a", None), ("d", "claim", "a", None)]
    got = found(lexicon.hits(frame(spark, [("k", "a", "a", "a", "a")]), spark.createDataFrame(terms, lexicon.LEXICON)))
    assert got == {("k", "d"): (False, True, False, False)}


def test_no_rows_and_no_terms(spark):
    terms = spark.createDataFrame([("d", "claim", "a", False)], lexicon.LEXICON)
    assert found(lexicon.hits(frame(spark, []), terms)) == {}
    assert found(lexicon.hits(frame(spark, [("k", "a", "a", "a", "a")]), terms.where("false"))) == {}


def test_too_many_terms_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(lexicon, "MOST_TERMS", 3)
    terms = spark.range(5).select(F.lit("c").alias("capability"), F.lit("claim").alias("rule"), F.concat(F.lit("t"), "id").alias("term"), F.lit(False).alias("anchored"))
    with pytest.raises(ValueError, match="at most 3 terms"):
        lexicon.read(terms)


def test_thousands_of_terms_have_one_matcher_and_no_wide_plan(spark):
    """The plan of 5,000 terms has the operators of the plan of 5."""
    import re

    def operators(n):
        terms = spark.range(n).select(F.lit("c").alias("capability"), F.lit("claim").alias("rule"), F.concat(F.lit("term "), "id").alias("term"), F.lit(False).alias("anchored"))
        plan = lexicon.hits(frame(spark, [("k", "", "a term 4 b", "", "")]), terms)
        assert plan.collect()[0]["claim_hit"]
        text = plan._jdf.queryExecution().executedPlan().toString()
        return re.findall(r"\w+Join|Exchange|Generate|Aggregate|Python", text), text.count("regexp_extract_all")

    assert operators(5) == operators(5000)
    assert not {"MapInArrow", "ArrowEvalPython"} & set(operators(5)[0])


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("ab.*(é", min_size=1, max_size=5), min_size=1, max_size=12), st.text("ab.*(é", max_size=20))
def test_pattern_finds_the_longest_at_each_place(terms, text):
    import re

    matcher = re.compile(f"(?=({patterns.pattern(patterns.trie(terms))}))")
    got = [(m.start(), m.group(1)) for m in matcher.finditer(text)]
    want = [(i, max((t for t in terms if text.startswith(t, i)), key=len)) for i in range(len(text)) if any(text.startswith(t, i) for t in terms)]
    assert got == want
    assert {(a, b) for a, b in patterns.begun_by(terms)} == {(a, b) for a in terms for b in terms if a.startswith(b)}


def test_a_text_is_read_until_it_has_met_all(monkeypatch):
    """Behind the place where nothing new can be met, no term is looked for."""
    asked = []

    def counted(terms):
        find = patterns.finder(terms)
        return lambda text: (asked.append(term) or term for term in find(text))

    monkeypatch.setattr(lexicon, "finder", counted)
    read = lexicon._reader({"a b": {0}, "b": {1}, "c": {2}}, {"d": {2}})
    assert read("d a b" + " a b b" * 1000) == {0, 1, 2} and asked == ["a b", "b"]
    asked.clear()
    assert read("b" * 1000) == {1} and len(asked) == 1000


def test_a_row_gives_pairs_and_not_terms(spark):
    """Thousands of different terms in a text are as few rows as there are pairs to meet."""
    words = [f"t{i}." for i in range(3000)]
    terms = spark.createDataFrame([(f"c{i % 2}", "claim", w, False) for i, w in enumerate(words)], lexicon.LEXICON)
    met = lexicon.matches(frame(spark, [("k", "", " ".join(words), "", ""), ("n", "", "t", "", "")]), terms)
    assert {r["unique_id"]: sorted(p["capability"] for p in r["met"]) for r in met.collect()} == {"k": ["c0", "c1"], "n": []}

    def given(plan):
        named = plan.getClass().getSimpleName()
        own = [plan.metrics().get("numOutputRows").get().value()] if named == "GenerateExec" else []
        if named == "AdaptiveSparkPlanExec":
            return given(plan.executedPlan())
        if named.endswith("QueryStageExec"):
            return given(plan.plan())
        children = plan.children()
        return own + [n for i in range(children.size()) for n in given(children.apply(i))]

    assert given(met._jdf.queryExecution().executedPlan()) == [3]


def test_long_terms_that_begin_one_another(spark):
    letters = "é日x"
    words = [(letters * 200)[:n] for n in range(1, 600, 7)]
    terms = [(f"c{i % 9}", rule, w, i % 5 == 0) for i, w in enumerate(words) for rule in ("structured", "prose")]
    rows = [(f"k{n}", (letters * 300)[n : n + 40 * n], "", "x" + (letters * 300)[n : n + 30 * n], "") for n in range(12)]
    assert found(lexicon.hits(frame(spark, rows), spark.createDataFrame(terms, lexicon.LEXICON))) == plain(rows, terms)


def test_bytes_that_are_no_text(spark):
    rows = spark.range(1).select(F.lit("k").alias("unique_id"), F.lit("").alias("spec_eq_text"), F.expr("cast(unhex('FF616263C3') AS string)").alias("claim_text"), F.lit("").alias("prose_text"), F.lit("").alias("full_text"))
    terms = spark.createDataFrame([("c", "claim", "abc", False), ("d", "claim", "é", False)], lexicon.LEXICON)
    assert {k: v[1] for k, v in found(lexicon.hits(rows, terms)).items()} == {("k", "c"): True, ("k", "d"): False}


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("ab.é", min_size=1, max_size=24), min_size=1, max_size=12), st.text("ab.é", max_size=60), st.data())
def test_finder_finds_every_term_at_every_place(terms, text, data):
    text += data.draw(st.sampled_from(sorted(terms)))
    got = sorted(patterns.finder(terms)(text))
    assert got == sorted(t for i in range(len(text)) for t in terms if text.startswith(t, i))
