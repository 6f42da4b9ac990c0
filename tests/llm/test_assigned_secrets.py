"""Short and punctuated values of named secrets, and names that are long runs themselves."""

from __future__ import annotations

import random
import re
import time

from claimgrade.llm import secrets
from claimgrade.llm.common import tune

from .test_filters import made_secrets

TEXTS = {
    1000: ("see password: hunter2secret, ok", ["hunter2secret"]),
    1001: ("pwd = S3cr3t!pw#9", ["S3cr3t!pw#9"]),
    1002: ("https://me:pa55w.rd@host.example/x", ["pa55w.rd"]),
    1003: ('{"db_password": "two w0rds"}', ["two w0rds"]),
    1004: ('aws_secret_access_key: "wJalrXUtnFEMIK7MDENGbPxRfiCY"', ["aws_secret_access_key", "wJalrXUtnFEMIK7MDENGbPxRfiCY"]),
    1005: ("password=abcdefgh12345678!x", ["abcdefgh12345678!x"]),
    1007: ("token=abcdefgh12345678.x9, end", ["abcdefgh12345678.x9"]),
    1006: ("the author: somebody, a compass, pass=1", []),
}


def test_assigned_values_are_candidates(spark):
    tune(spark)
    docs, truth = made_secrets(300, 6)
    rng = random.Random(8)
    more = [(2000 + i, f"say password: {''.join(rng.choice('abcdef0123456789!#') for _ in range(9))}7 now", "src") for i in range(40)]
    frame = spark.createDataFrame([*docs, *more, *((i, t, "src") for i, (t, _) in TEXTS.items())], "doc_id long, text string, source string")
    found = secrets.candidates(frame).where("doc_id BETWEEN 1000 AND 1999").orderBy("doc_id", "start").collect()
    for i, (text, want) in TEXTS.items():
        rows = [r for r in found if r["doc_id"] == i]
        assert [r["candidate"] for r in rows] == want
        for r in rows:
            at = r["start"]
            assert text[at : at + len(r["candidate"])] == r["candidate"] and r["left"] == text[max(0, at - 80) : at]
    label = {r["candidate"]: r["is_finding"] for r in secrets.findings(secrets.candidates(frame)).collect()}
    assert label["wJalrXUtnFEMIK7MDENGbPxRfiCY"] == label["hunter2secret"] == label["pa55w.rd"] == 1
    flagged = {r["doc_id"] for r in secrets.scan(frame).collect() if r["is_secret"]}
    assert flagged >= {i for i in TEXTS if i != 1006} | {i for i, t in truth.items() if t}


FAR = {
    1: ("password" + " " * 30 + ": hunter2secret, ok", ["hunter2secret"]),
    2: ("token =" + "\t" * 40 + "S3cr3t!pw#9", ["S3cr3t!pw#9"]),
    3: ("https://" + "u" * 200 + ":pa55w.rd@host.example/x", ["//" + "u" * 200, "pa55w.rd"]),
    4: ('"secret"' + " " * 12 + '=>  "two w0rds" end', ["two w0rds"]),
    5: ("pwd = near1!x, pwd" + " " * 99 + "= far2!x", ["near1!x", "far2!x"]),
    6: ("x" + " " * 50 + "y://host/" + " " * 50 + "z", []),
    7: ("\x03abc\x04 a" + " " * 20 + "b", []),
}


def test_names_far_from_their_values(spark):
    tune(spark)
    frame = spark.createDataFrame([(i, t, "s") for i, (t, _) in FAR.items()], "doc_id long, text string, source string")
    found = secrets.candidates(frame).orderBy("doc_id", "start").collect()
    for i, (text, want) in FAR.items():
        rows = [r for r in found if r["doc_id"] == i]
        assert [r["candidate"] for r in rows] == want
        for r in rows:
            at, end = r["start"], r["start"] + len(r["candidate"])
            assert text[at:end] == r["candidate"]
            assert r["left"] == text[max(0, at - 80) : at]
            assert text[end : end + 80].startswith(r["right"])


NAME = re.compile(r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|auth)[\"']?[ \t]*(?:=>|:=|[:=])[ \t]*$", re.I)
KEY = re.compile(r"[A-Za-z0-9+/_=-]{16,}")


def plain(text: str) -> list[tuple[int, str]]:
    """Candidates by going from place to place: an assigned value, a password in a URL, a long run."""
    found, i = [], 0
    while i < len(text):
        m = None
        before = text[:i]
        if before[-1:] in (":", "=", ">", " ", "\t") and NAME.search(before):
            m = re.compile(r"[^\s\"']+[^\s\"',;.)\]}]").match(text, i)
        elif before[-1:] in ("'", '"') and NAME.search(before[:-1]):
            q = before[-1]
            m = re.compile(rf"[^{q}\r\n]{{2,}}(?={q})").match(text, i)
        if not m and re.search(r"://[^\s/:@]*:$", before):
            m = re.compile(r"[^\s/@]{2,}(?=@)").match(text, i)
        if not m and not re.search(r"[A-Za-z0-9+/_=-]$", before):
            m = KEY.match(text, i)
        if m:
            found.append((i, m[0]))
        i = m.end() if m else i + 1
    return found


def test_candidates_equal_a_plain_scan(spark):
    tune(spark)
    rng = random.Random(11)
    signs = [": ", " = ", "\" : ", " =>  ", "            = ", " :            "]
    values = ["a1", "x", "S3cr!t#9", "'two w0rds'", '"q\'uoted 1"', "q8" * 11, "end.", "(p9)", "ab,", "\n"]
    other = ["word", "k7" * 9, "https://me:pw12@host/x", "https://" + "n" * 70 + ":pw34@host", "a/b/c", "compass", "e=f", "\t", "author"]
    texts = []
    for _ in range(300):
        parts = []
        for _ in range(rng.randrange(1, 200 if len(texts) % 10 == 0 else 12)):
            name = rng.choice(["password", "my_Token", "api-key", "auth", "name"]) + rng.choice(signs) + rng.choice(values)
            parts.append(name if rng.random() < 0.5 else rng.choice(other))
        texts.append(" ".join(parts))
    frame = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    rows = secrets.candidates(frame).collect()
    got = sorted((r["doc_id"], r["start"], r["candidate"]) for r in rows)
    assert got == sorted((i, at, c) for i, t in enumerate(texts) for at, c in plain(t))
    assert all(r["left"] == texts[r["doc_id"]][max(0, r["start"] - 80) : r["start"]] for r in rows)


def test_many_candidates_of_one_text(spark):
    """A hundred thousand candidates of one text take seconds: no time by the square of their number."""
    tune(spark)
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdef0123456789") for _ in range(20)) for _ in range(100_000))
    frame = spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")
    began = time.monotonic()
    row = secrets.candidates(frame).selectExpr("count(*)", "sum(start)", "min(length(candidate))", "sum(length(left))").first()
    assert time.monotonic() - began < 60
    assert tuple(row) == (100_000, 21 * sum(range(100_000)), 20, sum(min(21 * i, 80) for i in range(100_000)))
