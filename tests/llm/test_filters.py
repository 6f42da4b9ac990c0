"""URL filters and secret scans."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from claimgrade.llm import queries, secrets, urls
from claimgrade.llm.common import tune

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def plain_judgement(url: str | None) -> tuple:
    host = path = ""
    if url and "://" in url:
        m = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1])
        host, path = m[1].translate(LOWER), m[2]
    fits = [r for r in RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    return host, path, best and best[0] + best[1], best and best[2]


ODD_URLS = [
    None, "", "no scheme", "http://", "http://NET/", "HTTP://A.Example.NET/en/x", "http://example.net/en", "http://net", "http://net?x=/", "x://a.org/fr/#f",
    "http://a.org/fr", "http://borg/fr/", "http://example.com/de/y?z", "a://b://c.net/", "http://é.net/é", "http://a.net/\n/x", "http://a.net/" + "p/" * 3000,
    "http://notexample.net/en/", "http://sub.example.net/en/1", "//a.net/", "http://.net/",
]


def check_judged(rows, url_of):
    for r in rows:
        host, path, rule, verdict = plain_judgement(url_of(r))
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or ("block" if r["block_score"] >= 0.5 else "allow"))


def test_urls_of_the_table(spark, small):
    given = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    rows = queries.op9_urls(spark, small).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(given)
    check_judged(rows, lambda r: given[r["page_id"]])


def test_odd_urls(spark):
    tune(spark)
    rows = [(i, u, "own", "mine") for i, u in enumerate(ODD_URLS * 2)] + [(None, "http://a.org/q", None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, Host string, other string")
    rules = [urls.Rule(*r) for r in RULES]
    judged = urls.judge(frame, "url", rules)
    assert judged.columns == ["page_id", "url", "other", "host", "path", "rule", "verdict", "block_score"]
    found = judged.collect()
    assert len(found) == len(rows)
    check_judged(found, lambda r: r["url"])
    assert urls.judge(frame.where("false"), "url", rules).count() == 0
    one_kind = urls.judge(frame, "url", rules, F.lit(1)).where("rule IS NULL").collect()
    assert {r["verdict"] for r in one_kind} == {"block"}


def test_trees_learn_from_labelled_urls(spark):
    tune(spark)
    rng = random.Random(1)
    rows = []
    for i in range(1200):
        bad = i % 2
        host = "".join(rng.choice("abcdefgh0123456789" if bad else "aeioulmn") for _ in range(18 if bad else 6))
        rows.append((i, f"http://{host}.org/{'a/' * (4 if bad else 1)}{i}", bad if i % 3 else None, bad))
    frame = spark.createDataFrame(rows, "i int, url string, label int, truth int")
    found = urls.judge(frame, "url", [], F.col("label")).collect()
    held = [r for r in found if r["label"] is None]
    assert sum((r["verdict"] == "block") == bool(r["truth"]) for r in held) / len(held) > 0.95


# secrets


def made_secrets(n: int, seed: int) -> tuple[list[tuple], dict]:
    """Documents of plain words with secrets, plain long words, hashes of commits and made-up keys."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(3, 9))) for _ in range(150)]
    docs, truth = [], {}
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(40)]
        kind = i % 5
        if kind == 0:
            extra = "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))
        elif kind == 1:
            extra = "password=" + "".join(rng.choice("0123456789abcdef") for _ in range(18))
        elif kind == 2:
            extra = "".join(rng.choice(vocabulary) for _ in range(5))
        elif kind == 3:
            extra = 'token = "' + "".join(rng.choice("0123456789abcdef") for _ in range(40)) + '"'
        else:
            extra = "key EXAMPLE" + "".join(rng.choice("ABCDEFGHIJ") for _ in range(16))
        docs.append((i, " ".join([*words[:20], extra, *words[20:]]), "src"))
        truth[i] = kind in (0, 1, 3)
    return docs, truth


def test_secrets_are_found_and_words_are_not(spark):
    tune(spark)
    docs, truth = made_secrets(400, 1)
    rows = secrets.scan(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()
    flagged = {r["doc_id"] for r in rows if r["is_secret"]}
    assert flagged == {i for i, t in truth.items() if t}


def test_forest_learns_from_given_findings(spark):
    """Labels that say the opposite for hashes named a commit."""
    tune(spark)
    rng = random.Random(4)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(400)]
    docs = [(i, f"{'commit' if i % 2 else 'token ='} {h} end", "s") for i, h in enumerate(hexes)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    given = secrets.candidates(frame.where("doc_id < 300")).withColumn("is_finding", (1 - F.col("doc_id") % 2).cast("double"))
    rows = secrets.scan(frame.where("doc_id >= 300"), labelled=given).collect()
    assert len(rows) == 100 and all(r["is_secret"] == (r["doc_id"] % 2 == 0) for r in rows)


def plain_candidates(text: str | None) -> list[tuple[int, str]]:
    return [(m.start(), m[0]) for m in re.finditer(r"(?<![A-Za-z0-9+/_=\-])[A-Za-z0-9+/_=\-]{16,}", (text or "").translate({1: " ", 2: " "}))]


def test_candidates_of_odd_rows(spark, odd_docs, no_docs):
    extra = spark.createDataFrame(
        [(50, "a\x01b " + "k1" * 9 + " " + "k2" * 9 + '"' + "z" * 16, None), (51, "x" * 70_000 + "9", "s"), (52, "🙂 " + "q7" * 10, "s")], "doc_id long, text string, source string"
    )
    frame = odd_docs.select("doc_id", "text", "source").unionAll(extra)
    rows = secrets.scan(frame).collect()
    want = sorted(((r["doc_id"] is None, r["doc_id"] or 0, *c) for r in frame.collect() for c in plain_candidates(r["text"])))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["start"], r["candidate"]) for r in rows) == want
    assert all(0 <= r["score"] <= 1 and r["is_secret"] == (r["score"] >= 0.5) for r in rows)
    assert secrets.scan(no_docs).count() == 0
    assert secrets.scan(odd_docs, path=None).count() > 0


def test_every_candidate_of_the_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    rows = queries.op4_secrets(spark, small).collect()
    assert len(rows) == sum(len(plain_candidates(r["text"])) for r in docs)
    keys = {r["doc_id"] for r in docs if re.search(r"AKIA[0-9A-Z]{16}|password=[0-9a-f]{18}|token = \"[0-9a-f]{40}", r["text"] or "")}
    assert keys == {r["doc_id"] for r in rows if r["is_secret"]}


def test_secret_scan_has_no_python_in_its_plan(spark, small):
    plan = queries.op4_secrets(spark, small)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_sample_of_findings_is_bounded(spark, monkeypatch):
    tune(spark)
    monkeypatch.setattr(secrets, "SAMPLE", 30)
    docs, _ = made_secrets(100, 2)
    assert secrets.scan(spark.createDataFrame(docs, "doc_id long, text string, source string")).count() >= 100


@pytest.mark.parametrize("text", ["", "short", "pass=1"])
def test_no_candidates(spark, text):
    tune(spark)
    assert secrets.scan(spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")).count() == 0
