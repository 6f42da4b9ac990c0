"""The corpus pipeline against a plain version of its stages."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from claimgrade.llm import graph
from claimgrade.llm.common import tune

from .test_shingles import plain_components
from .test_text_ops import WORD, normal, plain_targets


def plain_until_mixing(docs: list[tuple]) -> dict:
    """Documents (id, text) that the first three stages keep."""
    left = [(i, t) for i, t in docs if t and any(map(str.isalpha, t))]
    best = {}
    for i, t in left:
        best[normal(t)] = min(best.get(normal(t), (1, 0, "")), (-len(t), i, t))
    left = [(i, t) for _, i, t in best.values()]
    found = plain_components(left)
    return {i: t for i, t in left if found[i] == i}


def test_pipeline_equals_the_plain_version(spark, small):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    kept = plain_until_mixing([(i, r["text"]) for i, r in docs.items()])
    left = tune(spark).read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        left = stage(spark, left, small)
    assert sorted(r["doc_id"] for r in left.select("doc_id").collect()) == sorted(kept)
    rows = corpus_pipeline.run(spark, small).collect()
    taken = Counter(r["doc_id"] for r in rows)
    assert set(taken) <= set(kept) and max(taken.values()) <= 3
    sizes, largest, words = defaultdict(int), defaultdict(int), defaultdict(int)
    for i, text in kept.items():
        n, source = len(WORD.findall(text)), docs[i]["source"]
        sizes[source] += n
        largest[source] = max(largest[source], n)
        words[source] += n * taken[i]
    for source, goal in plain_targets(sizes).items():
        assert abs(words[source] - goal) <= largest[source]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in rows:
        given = docs[r["doc_id"]]
        assert all(r[c] == given[c] for c in ("text", "lang", "source", "n_chars"))
        assert r["token_ids"] == library.encode(given["text"], add_special_tokens=False).ids
        assert r["decoded"] == given["text"] and r["n_tokens"] == len(r["token_ids"])


@pytest.mark.parametrize("which", ["odd", "none"])
def test_every_stage_takes_any_rows(spark, odd_docs, no_docs, which):
    docs = odd_docs if which == "odd" else no_docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        before, after = Counter(map(repr, docs.collect())), Counter(map(repr, out.collect()))
        assert set(after) <= set(before)
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert last.columns == [*docs.columns, "token_ids", "decoded", "n_tokens"]
    assert last.count() == docs.count()
    assert (which == "none") == (last.count() == 0)


def test_language_stage_decides(spark):
    """Texts in a learned language stay; one that could be any of them goes, and so does one without letters."""
    tune(spark)
    words = {"aa": "alpha beta gamma delta", "bb": "uno dos tres quatro"}
    rows = [(i, " ".join([w] * 30), k) for i in range(40) for k, w in words.items()]
    rows += [(1000, "xyxyxy", None), (1001, "123 !!", None), (1002, None, None), (1003, "", None), (1004, "gamma alpha", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert set(range(40)) | {1004} <= kept and not kept & {1001, 1002, 1003}


def test_language_stage_without_labels_keeps_texts(spark):
    tune(spark)
    docs = spark.createDataFrame([(1, "some text", None), (2, "日本", None), (3, "12", None), (4, None, None)], "doc_id long, text string, lang string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, "").collect()) == [1, 2]


def test_stages_are_named_once():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(set(names)) == len(names) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_components_of_paths_stars_and_nothing(spark):
    tune(spark)
    path = [(i, i + 1) for i in range(1, 60)]
    star = [(500, i) for i in range(400, 480)]
    edges = spark.createDataFrame([*path, *star, (9, 9), (700, 600), (700, 600), (600, 700)], "a long, b long")
    found = {r["node"]: r["component"] for r in graph.components(edges).collect()}
    want = {i: 1 for i in range(1, 61)} | {i: 400 for i in [*range(400, 480), 500]} | {600: 600, 700: 600}
    assert found == want
    assert graph.components(edges.where("false")).count() == 0


def test_nothing_else_imports_the_subpackage():
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    for path in [*root.glob("claimgrade/**/*.py"), *root.glob("*.py")]:
        if "llm" not in path.parts and path.name not in ("corpus_pipeline.py", "__spark_entry__.py"):
            assert not re.search(r"claimgrade\.llm|from claimgrade import .*llm", path.read_text()), path
