"""Segment-tree BPE against the tiktoken library."""

from __future__ import annotations

import hashlib
import random
import struct

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from claimgrade.llm import queries, treebpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return treebpe.Ranks(PATH, PATTERN)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks.ranks, special_tokens={})


def ids(packed: bytes) -> list[int]:
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_whole_table(spark, small, library):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = queries.op12_tree_bpe(spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = library.encode_ordinary(texts[r["doc_id"]])
        packed = struct.pack(f"<{len(want)}I", *want)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(want), hashlib.sha256(packed).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_odd_rows(spark, odd_docs, library):
    docs = odd_docs.withColumnsRenamed({"Size": "Token_IDs", "score": "decoded"})
    tokens = treebpe.encode(docs, PATH, PATTERN)
    assert tokens.columns == ["doc_id", "text", "lang", "source", "n_chars", "decoded", "token_ids"]
    for r in treebpe.decode(tokens, PATH, PATTERN).collect():
        assert r["token_ids"] == library.encode_ordinary(r["text"] or "")
        assert bytes(r["decoded"]) == (r["text"] or "").encode()


def test_no_rows(spark, no_docs):
    assert treebpe.with_digest(treebpe.encode(no_docs, PATH, PATTERN, keep=["doc_id"])).collect() == []


def test_every_kind_of_code_point(ranks, library):
    """One text for a stretch of code points, unassigned ones and letters of newer versions included."""
    starts = [*range(0, 0x3500, 997), 0x88F, 0xA7A0, 0x10940, 0x11DB0, 0x12475, 0x1E6C0, 0x1F600, 0x323B0]
    for start in starts:
        text = "".join(f"a{chr(c)} {chr(c)}1" for c in range(start, start + 997) if not 0xD800 <= c < 0xE000)
        assert ids(ranks.encode(text)) == library.encode_ordinary(text)


def test_long_words_and_ties(ranks, library):
    rng = random.Random(5)
    for n in (1, 2, 3, 17, 64, 65, 1000, 20_000):
        for letters in ("a", "ab", "abethin", "thé日 ", "  \t\n'sx"):
            text = "".join(rng.choice(letters) for _ in range(n))
            assert ids(ranks.encode(text)) == library.encode_ordinary(text)


def test_stretches_do_not_change_ids(ranks, library, monkeypatch):
    text = "one  two   three 123 -- don't \n\n x " * 40
    monkeypatch.setattr(treebpe, "STRETCH", 7)
    assert ids(ranks.encode(text)) == library.encode_ordinary(text)


def test_memory_is_bounded(ranks, library, monkeypatch):
    monkeypatch.setattr(treebpe, "REMEMBERED", 3)
    ranks.encode("alpha beta gamma delta epsilon")
    assert ids(ranks.encode("alpha beta")) == library.encode_ordinary("alpha beta")
    assert len(ranks.memory) <= 2


def test_a_small_file(tmp_path):
    import base64

    tokens = [bytes([b]) for b in range(256)] + [b"ab", b"bc", b"abc"]
    path = tmp_path / "small.tiktoken"
    path.write_text("".join(f"{base64.b64encode(t).decode()} {i}\n" for i, t in enumerate(tokens)))
    small = treebpe.Ranks(str(path), PATTERN)
    # the leftmost pair of least rank first: ab, then ab+c; of two equal pairs the left one
    assert small.merge(b"xabcbc") == [ord("x"), 258, 257]
    assert small.decode(np.array(small.merge(b"xabcbc"))) == b"xabcbc"
