"""Passages, quality and vectors against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from claimgrade.llm import fmindex, quality, queries, substring, vectors
from claimgrade.llm.common import tune

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


# passages


def plain_removal(texts: list[tuple[int, str | None]], width: int) -> dict:
    seen: dict[tuple, None] = {}
    out = {}
    for doc_id, text in sorted(texts):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            if window in seen:
                gone[i : i + width] = [True] * width
            seen[window] = None
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out[doc_id] = (len(words), sum(gone), sha(" ".join(kept)))
    return out


def check_removal(frame, texts, width=20):
    want = plain_removal(texts, width)
    rows = frame.collect()
    assert len(rows) == len(texts)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows} == want


def test_passages(spark, small):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    check_removal(queries.op6_substring(spark, small), texts)


def random_texts(seed: int, n: int) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passages = [[rng.choice(words) for _ in range(rng.randrange(5, 60))] for _ in range(6)]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(0, 5)):
            parts += rng.choice(passages) if rng.random() < 0.6 else [rng.choice(words) for _ in range(rng.randrange(30))]
        if rng.random() < 0.2:
            parts += ["again"] * rng.randrange(60)
        if rng.random() < 0.2:
            parts += ["to", "fro", "and"] * rng.randrange(25)
        out.append((i, " ".join(parts)))
    return out


@pytest.mark.parametrize(("frequent", "shard"), [(4096, 400_000), (2, 500), (40, 2000)])
def test_passages_of_any_kind(spark, monkeypatch, frequent, shard):
    """Small bounds force single windows and many shards."""
    tune(spark)
    monkeypatch.setattr(substring, "FREQUENT", frequent)
    monkeypatch.setattr(substring, "SHARD", shard)
    monkeypatch.setattr(substring, "TOGETHER", 64 if frequent == 40 else 1 << 20)
    texts = random_texts(frequent, 120)
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    check_removal(substring.remove_repeats(frame.repartition(3)), texts)


def test_passages_of_odd_rows(odd_docs, no_docs):
    rows = substring.remove_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = Counter(r["doc_id"] for r in rows)
    assert by_id[None] == 2 and by_id[3] == 2
    long, longer = (next(r for r in rows if r["doc_id"] == i) for i in (9, 10))
    assert longer["n_words"] == long["n_words"] + 1 and longer["n_removed"] == long["n_words"]
    blank = next(r for r in rows if r["doc_id"] == 0)
    assert (blank["n_words"], blank["n_removed"], blank["kept_sha256"]) == (0, 0, sha(""))
    assert substring.remove_repeats(no_docs).count() == 0


def test_rows_that_share_an_id(spark):
    tune(spark)
    passage = " ".join(f"p{i}" for i in range(25))
    frame = spark.createDataFrame([(1, passage), (1, passage), (2, passage + " x"), (2, "y " + passage)], "doc_id long, text string")
    rows = sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in substring.remove_repeats(frame).collect())
    assert rows == [(1, 25, 0), (1, 25, 0), (2, 26, 25), (2, 26, 25)]


def test_intervals_of_the_index():
    rng = np.random.default_rng(1)
    depth = 4
    values = rng.integers(1, 5, 400)
    index = fmindex.FMIndex(values, 5, depth, np.arange(400))
    stream = rng.integers(1, 5, 300)
    begin, length = np.array([0, 100, 103, 250]), np.array([100, 3, 147, 50])
    low, high = fmindex.window_intervals(index, stream, begin, length, depth)
    windows = [tuple(values[i : i + depth]) for i in range(400 - depth + 1)]
    for b, n in zip(begin, length, strict=True):
        for i in range(b, b + n):
            whole = i + depth <= b + n
            places = [j for j, w in enumerate(windows) if w == tuple(stream[i : i + depth])] if whole else []
            assert high[i] - low[i] == len(places)
            if places:
                assert index.places[low[i]] == places[0]


# quality


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op7_quality(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [(truth[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert sum(a == b for a, b in held) / len(held) > 0.85
    low = [b for a, b in held if a == 0]
    assert sum(b == 0 for b in low) / len(low) > 0.4


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labelled = spark.createDataFrame([("one two three", 1), ("### ### !!", 0), (None, 1)], "text string, quality int")
    model = quality.fit(labelled)
    rows = quality.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] == pytest.approx(2 / 3) for r in rows if not (r["text"] or "").strip())
    assert quality.score(odd_docs, model).columns == [*odd_docs.columns[:-1], "score"]
    assert quality.score(no_docs, model).count() == 0
    empty = quality.fit(labelled.where("false"))
    assert {r["score"] for r in quality.score(odd_docs, empty).collect()} == {0.5}


def test_quality_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i % 40, f"t{i}") for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i % 50, i % 2, None) for i in range(100)] + [(None, 1, 1), (3, None, 1)], "doc_id long, quality int, toxic int")
    assert quality.sample(docs, labels, rows=15).count() == 15
    assert quality.sample(docs, labels).count() == 80


# vectors


def plain_links(rows: list[tuple], threshold: float = 0.93) -> dict:
    def usable(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = [(i, np.array(v, float) / np.linalg.norm(np.array(v, float)), g) for i, v, g in rows if g is not None and usable(v)]
    near = {i: {i} for i, _, _ in rows}
    for a, (i, v, g) in enumerate(good):
        for j, w, h in good[a + 1 :]:
            if g == h and len(v) == len(w) and v @ w >= threshold:
                near[i].add(j)
                near[j].add(i)
    component = {i: i for i in near}
    moved = True
    while moved:
        moved = False
        for i in near:
            least = min(component[j] for j in near[i])
            if least < component[i]:
                component[i], moved = least, True
    return {i: (len(near[i]) - 1, component[i], component[i] == i) for i in near}


def check_vectors(spark, rows: list[tuple], least_recall: float = 1.0):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_duplicates(frame).collect()}
    want = plain_links(rows)
    assert found.keys() == want.keys()
    if least_recall == 1.0:
        assert found == want
    assert all(found[i][0] <= want[i][0] for i in want)
    links = sum(n for n, _, _ in want.values())
    assert not links or sum(n for n, _, _ in found.values()) / links >= least_recall


def test_vectors_of_the_table(spark, small):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in queries.op8_vectors(spark, small).collect()}
    assert found == plain_links(rows)


def test_recall_at_the_threshold(spark):
    """Pairs barely above the threshold, in 64 dimensions, among many others."""
    tune(spark)
    rng = np.random.default_rng(7)
    rows = []
    for i in range(0, 3000, 2):
        a, b = rng.normal(size=64), rng.normal(size=64)
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        cosine = rng.uniform(0.9301, 0.95)
        rows += [(i, a.tolist(), i % 3), (i + 1, (cosine * a + np.sqrt(1 - cosine**2) * b).tolist(), i % 3)]
    check_vectors(spark, rows, 0.97)


@pytest.mark.parametrize("size", [4096, 20])
def test_dense_groups_and_split_lists(spark, monkeypatch, size):
    tune(spark)
    monkeypatch.setattr(vectors, "LIST", size)
    rng = np.random.default_rng(size)
    centres = rng.normal(size=(4, 16))
    rows = [(i, (centres[i % 4] + 0.12 * rng.normal(size=16)).tolist(), 1) for i in range(160)]
    rows += [(1000 + i, centres[0].tolist(), 1) for i in range(30)] + [(2000 + i, (3 * centres[1]).tolist(), 2) for i in range(3)]
    check_vectors(spark, rows, 0.97)


def test_odd_vectors(spark):
    tune(spark)
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, nan], 1), (6, [inf, 1.0], 1), (7, [1.0, 2.0], None),
        (8, [1.0, 2.0], 1), (9, [2.0, 4.0], 1), (10, [1.0, 2.0], 2), (11, [1.0, 2.0, 0.0], 1), (12, [1.0, 2.0], 1), (13, [1e200, 2e200], 1),
        (14, [-1.0, -2.0], 1), (15, [1e-200, 2e-200], 1),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_duplicates(frame).collect()}
    linked = {8, 9, 12, 13, 15}
    assert found == {i: (4, 8, i == 8) if i in linked else (0, i, True) for i, _, _ in rows}
    assert vectors.near_duplicates(frame.where("false")).count() == 0
    assert vectors.near_duplicates(frame.where("vec_id < 8")).count() == 7
