"""The audit of filters against plain Python over every order."""

from __future__ import annotations

import re
from itertools import permutations

import pytest

from claimgrade.llm import audit

LABELS = "doc_id long, quality int, toxic int"


def plain(docs: list[tuple], labels: list[tuple]) -> dict[tuple, tuple]:
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    heads: dict[str, int] = {}
    for doc_id, text, _ in docs:
        if doc_id is not None:
            heads[text or ""] = min(doc_id, heads.get(text or "", doc_id))
    rows: dict[str, list[tuple]] = {}
    for doc_id, text, part in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": text in heads and (doc_id is None or doc_id > heads[text]),
        }
        rows.setdefault(part or "", []).append(({f for f, bad in fails.items() if bad}, doc_id in good, doc_id in toxic))
    out = {}
    for part, some in rows.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = list(some)
            for step, f in enumerate(order, 1):
                lost = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                shapley[f] += len(lost)
                out[part, "".join(order), step] = [
                    f, len(left), len(lost), sum(f in r[0] for r in some) - len(lost), sum(r[0] == {f} for r in some), sum(r[1] for r in lost), sum(r[2] for r in lost)
                ]
        for (p, _, _), row in out.items():
            if p == part:
                row.append(shapley[row[0]])
    return out


def check(frame, docs, labels):
    rows = frame.collect()
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in rows}
    assert len(got) == len(rows)
    assert got == plain(docs, labels)


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    check(audit.interactions(docs, labels), [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()], [tuple(r) for r in labels.collect()])


def test_odd_rows(spark, odd_docs):
    labels = [(0, 1, 0), (1, 0, 1), (1, 1, None), (3, 1, 1), (None, 1, 1), (99, 1, 1)]
    docs = odd_docs.withColumnRenamed("Size", "mask")
    found = audit.interactions(docs, spark.createDataFrame(labels, LABELS))
    check(found, [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()], labels)


def test_no_rows(spark, no_docs):
    assert audit.interactions(no_docs, spark.createDataFrame([], LABELS)).collect() == []


def test_frequent_text_and_part(spark):
    words = " ".join(f"w{i}" for i in range(60))
    docs = [(i, words if i % 3 else "Short & LOUD", "hot" if i % 3 else f"s{i % 5}") for i in range(3000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    check(audit.interactions(frame, spark.createDataFrame([(5, 1, 1)], LABELS)), docs, [(5, 1, 1)])


def test_paths_cover_all_orders():
    reach, leave = audit.paths(5)
    assert reach[-1] == leave[0] == 120
    edges = [(s, f) for s in range(32) for f in range(5) if not s >> f & 1]
    assert all(sum(reach[s] * leave[s | 1 << f] for s, f in edges if f == k) == 120 for k in range(5))


@pytest.mark.parametrize("filters", ["", "AA", "ABCDEFGH"])
def test_filters_have_a_bound(spark, filters):
    with pytest.raises(ValueError):
        audit.audit(spark.createDataFrame([], "part string, mask int"), filters)
