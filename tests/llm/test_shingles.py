"""Near copies by five-word shingles against brute force."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np

import corpus_pipeline
from claimgrade.llm import shingles
from claimgrade.llm.common import tune


def plain_shingles(text: str | None) -> set:
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_components(docs: list[tuple]) -> dict:
    sets = [(i, plain_shingles(t)) for i, t in docs]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1 :]:
            if 5 * len(a & b) >= 4 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i in root}


def made(seed: int) -> list[tuple]:
    """Texts with copies of one to three changed words, chains of copies, and a common passage."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    common = [word() for _ in range(70)]
    texts = []
    for k in range(60):
        words = [word() for _ in range(100)]
        texts.append(words)
        for _ in range(k % 4):
            words = list(words)
            for _ in range(rng.randrange(1, 4)):
                words[rng.randrange(len(words))] = word()
            texts.append(words)
    texts += [[*common, *(word() for _ in range(30))] for _ in range(90)]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)] + [(900, "one"), (901, "ONE"), (902, ""), (903, None)]


def test_near_copies_equal_brute_force(spark, monkeypatch):
    tune(spark)
    docs = made(1)
    want = plain_components(docs)
    assert len(set(want.values())) < len(want) - 40
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    for block in (shingles.BLOCK_NODES, 4):
        monkeypatch.setattr(shingles, "BLOCK_NODES", block)
        found = {r["doc_id"]: r["component_id"] for r in shingles.near_duplicates(frame).collect()}
        assert found == want


def test_stage_removes_near_copies(spark):
    docs = [d for d in made(2) if d[0] < 900]
    groups = defaultdict(list)
    for i, c in plain_components(docs).items():
        groups[c].append(i)
    out = corpus_pipeline.near_dedup(spark, spark.createDataFrame(docs, "doc_id long, text string"), "")
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(map(min, groups.values()))

def template(n: int, shared: int, own: int, seed: int) -> list[tuple]:
    """Texts of one template: ``shared`` words in common, ``own`` words of each."""
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(shared)]
    return [(i, " ".join(common + [f"w{rng.randrange(10**9)}" for _ in range(own)])) for i in range(n)]


def test_a_template_just_below_the_threshold_takes_two_steps(spark, monkeypatch):
    """300 texts that meet in most bands and link with none, and some that do: the number of stored
    tables is that of any other input."""
    tune(spark)
    docs = template(300, 400, 51, 3)
    assert 0.78 < len(plain_shingles(docs[0][1]) & plain_shingles(docs[1][1])) / len(plain_shingles(docs[0][1]) | plain_shingles(docs[1][1])) < 0.8
    docs += [(1000 + i, t + " end") for i, t in docs[:40]]
    want = plain_components(docs)
    steps = []
    real = shingles.stored
    monkeypatch.setattr(shingles, "stored", lambda df, label: steps.append(label) or real(df, label))
    found = {r["doc_id"]: r["component_id"] for r in shingles.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    assert found == want
    template_steps = len(steps)
    steps.clear()
    shingles.near_duplicates(spark.createDataFrame(made(5), "doc_id long, text string")).collect()
    assert len(steps) == template_steps


def test_blocks_of_a_bucket_lose_nothing(spark, monkeypatch):
    tune(spark)
    monkeypatch.setattr(shingles, "BLOCK_NODES", 7)
    docs = template(60, 100, 10, 4)
    docs += [(100 + i, t.replace("c50 ", f"x{i} ")) for i, t in docs[:50]]
    found = {r["doc_id"]: r["component_id"] for r in shingles.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert found == plain_components(docs)


def test_links_of_a_bucket_join_what_all_pairs_join():
    rng = random.Random(6)
    for _ in range(100):
        base = rng.sample(range(1000), 40)
        sets = [np.unique(np.array(rng.sample(base, 34) + rng.sample(range(1000), 4), np.uint32)) for _ in range(rng.randrange(2, 30))]
        n = len(sets)
        labels = [rng.randrange(n) for _ in range(n)]
        root = {c: c for c in labels}

        def find(c, root=root):
            while root[c] != c:
                c = root[c]
            return c

        for i in range(n):
            for j in range(i):
                a, b = set(sets[i].tolist()), set(sets[j].tolist())
                if 5 * len(a & b) >= 4 * len(a | b):
                    root[find(labels[i])] = find(labels[j])
        want = {frozenset(i for i in range(n) if find(labels[i]) == c) for c in map(find, labels)}
        links = shingles.apart_links(list(range(n)), labels, sets)
        got = {c: c for c in labels}
        for a, b in links:
            got[find(labels[a], got)] = find(labels[b], got)
        assert {frozenset(i for i in range(n) if find(labels[i], got) == c) for c in (find(x, got) for x in labels)} == want
        assert len(links) < len(set(labels))


def test_masks_link_close_fingerprints_without_any_band(spark):
    """Texts whose fingerprints differ in 2 bits or fewer are compared by the covering masks alone; a pair that
    meets and is not similar does not link."""
    from pyspark.sql import functions as F

    rng = random.Random(5)
    texts = []
    for _ in range(12):
        words = [f"w{rng.randrange(5000)}" for _ in range(600)]
        texts.append(" ".join(words))
        for _ in range(3):
            texts.append(" ".join([*words[: rng.randrange(595, 600)], "end"]))
    tune(spark)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = shingles.sketches(docs, "text", ["doc_id", "text"]).withColumn("bands", F.array().cast("array<bigint>")).localCheckpoint()
    rows = {r["node"]: r for r in made.collect()}
    of_text = lambda asked: made.join(asked, "node", "left_semi").select("node", "text").dropDuplicates(["node"])
    links = shingles.copy_links(made.select("node", "n", "fp", "bands").dropDuplicates(["node"]), of_text).collect()
    sets = {n: shingles.shingle_set(r["text"]) for n, r in rows.items()}
    close = [(a, b) for a in rows for b in rows if a < b and ((rows[a]["fp"] ^ rows[b]["fp"]) & (1 << 64) - 1).bit_count() <= 2]
    alike = {p for p in close if shingles.similar(sets[p[0]], sets[p[1]])}
    assert len(alike) > 10
    assert {(r["a"], r["b"]) for r in links} <= {(a, b) for a in rows for b in rows if a < b and shingles.similar(sets[a], sets[b])}

    def parts(pairs):
        root = {n: n for n in rows}

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in pairs:
            x, y = sorted((find(a), find(b)))
            root[y] = x
        return {n: find(n) for n in rows}

    assert parts([(r["a"], r["b"]) for r in links]) == parts(alike)
