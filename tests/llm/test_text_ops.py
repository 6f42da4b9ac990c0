"""Language ID, BPE, mixing, exact dedup and SimHash against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from claimgrade.llm import bpe, chunks, language, mixing, queries, simhash

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def given(spark, small):
    return [r.asDict() for r in spark.read.parquet(f"{small}/documents.parquet").collect()]


# language ID


def test_language_accuracy_on_held_out_rows(spark, small):
    truth = {r["doc_id"]: r["lang"] for r in given(spark, small)}
    rows = queries.op1_language(spark, small).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert held and sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def longest_phrases(text: str, sample: str) -> int:
    n = i = 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[i : j + 1] in sample:
            j += 1
        n, i = n + 1, j
    return n


def test_phrases_are_longest_matches():
    rng = random.Random(3)
    samples = {k: "".join(rng.choice(letters) for _ in range(700)) for k, letters in (("x", "abc "), ("y", "bcd "))}
    clean = {k: " ".join(v.split()) for k, v in samples.items()}
    parser = language.Parser(clean)
    texts = [" ".join("".join(rng.choice("abcdz ") for _ in range(rng.randrange(1, 300))).split()) for _ in range(60)]
    found = parser.phrases(texts)
    for text, counts in zip(texts, found.tolist(), strict=True):
        assert counts == [longest_phrases(text, clean[k]) for k in parser.languages]


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_phrases_go_on_across_pieces(monkeypatch, piece):
    """Also where the parse from a piece's start never meets the real one, as in periodic texts."""
    monkeypatch.setattr(language, "PIECE", piece)
    rng = random.Random(5)
    samples = {k: "".join(rng.choice(letters) for _ in range(500)) for k, letters in (("x", "abcd"), ("y", "cdef"))}
    samples |= {"z": "ababba", "ja": "日本語本日日語", "none": ""}
    parser = language.Parser(samples)
    texts = ["".join(rng.choice("abcdefé日本") for _ in range(rng.randrange(1, 400))) for _ in range(40)]
    texts += ["ab" * 150, "abba" * 70, "b" * 99, samples["x"] * 2, "", "é", samples["y"][100:400], "日本語" * 40]
    for text, counts in zip(texts, parser.phrases(texts).tolist(), strict=True):
        assert counts == [longest_phrases(text, samples[k]) for k in parser.languages]


def test_letters_of_one_script_differ():
    parser = language.Parser({"one": "".join(chr(0x4E00 + i) for i in range(600)), "two": "".join(chr(0x4E00 + i) for i in range(600, 1200))})
    text = "".join(chr(0x4E00 + i) for i in range(700, 760))
    assert parser.phrases([text]).tolist() == [[60, 1]]


def test_long_texts_share_the_sample(spark):
    rows = [(i, "en", f"{'abcdefghij'[i % 10]} " * (60_000 if i % 2 else 300)) for i in range(10)]
    sample = language.learn(spark.createDataFrame(rows, "doc_id long, lang string, text string"))["en"]
    assert language.SAMPLE_CHARS * 0.98 < len(sample) <= language.SAMPLE_CHARS
    counts = Counter(sample.replace(" ", ""))
    assert len(counts) == 10 and max(counts.values()) < len(sample) / 8


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    samples = {"en": "the quick brown fox jumps over one two three", "fr": "le renard brun saute ça va été"}
    rows = language.identify(odd_docs, samples).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        plain = not any(map(str.isalpha, r["text"] or ""))
        assert (r["lang_pred"] == "und") == plain and (r["score"] == 0) == plain
    assert language.identify(odd_docs, samples).columns == [*odd_docs.columns[:-1], "lang_pred", "score"]
    assert language.identify(no_docs, samples).count() == 0
    assert language.learn(no_docs) == {}
    assert {r["lang_pred"] for r in language.identify(odd_docs, {}).collect()} == {"und"}


def test_language_sample_is_bounded_and_ignores_held_out(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    samples = language.learn(docs)
    assert all(len(s) <= language.SAMPLE_CHARS for s in samples.values())
    assert samples == language.learn(docs.repartition(7))


# BPE


def test_bpe_equals_the_library(spark, small):
    library = Tokenizer.from_file(PATH)
    rows = queries.op2_bpe(spark, small).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in given(spark, small)}
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == sha(",".join(map(str, ids)))
        assert r["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))


def test_bpe_of_odd_rows(odd_docs, no_docs):
    library = Tokenizer.from_file(PATH)
    rows = bpe.decode(bpe.encode(odd_docs, PATH), PATH).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["token_ids"] == ids and r["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(no_docs, PATH), PATH).count() == 0


PIECES = ["a", "the", " ", "  ", "\n", "\t", " \n", "'s", "'re", "'", "'r", "12", "é", "日本", "🙂", "!", "...", "<|endoftext|>", "<|endo", "ftext|>", " ", " ", "\x1c", "\x85", "x" * 30]


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_bpe_streams_alike_in_any_pieces(size):
    library, vocabulary = Tokenizer.from_file(PATH), bpe.Vocabulary(PATH)
    rng = random.Random(size)
    for _ in range(300):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(40)))
        found = [i for ids in bpe.encode_pieces([text[i : i + size] for i in range(0, len(text), size)], vocabulary) for i in ids]
        assert found == library.encode(text, add_special_tokens=False).ids
        decoder, cut = bpe.Decoder(vocabulary), found[rng.randrange(len(found) + 1) :]
        assert decoder.feed(cut[:2]) + decoder.feed(cut[2:]) + decoder.finish() == library.decode(cut, skip_special_tokens=False)


def test_bpe_of_endless_pretokens_in_bounded_memory():
    library, vocabulary = Tokenizer.from_file(PATH), bpe.Vocabulary(PATH)
    rng = random.Random(5)
    letters = "".join(rng.choice("etaoin") for _ in range(40_000))
    for text in ("a" * 30_000, " " * 30_000 + "a", "!" * 30_000 + "'s ok", "é" * 20_000 + "1" * 20_000, "'" * 20_000 + "s", letters + "<|endoftext|>"):
        encoder, found, most = bpe.Encoder(vocabulary, most=100), [], 0
        for i in range(0, len(text), 500):
            found += encoder.feed(text[i : i + 500]).tolist()
            most = max(most, len(encoder.text) + len(encoder.bytes))
        assert found + encoder.finish().tolist() == library.encode(text, add_special_tokens=False).ids
        assert most <= 3 * encoder.most


def test_lookahead_of_a_small_merge_list():
    # in "abab...", what follows the end may reach back over one rule after the other
    assert bpe.lookahead([(b"a", b"b")]) == 1
    assert bpe.lookahead([(b"b", b"c"), (b"a", b"bc")]) == 2
    assert bpe.lookahead([(b"a", b"b"), (b"c", b"d")]) == 1


# mixing


def plain_targets(sizes: dict) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full, out = sum(sizes.values()), set(), {}
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        unit = sum(weight[s] for s in names if s not in full)
        out = {s: 3 * sizes[s] if s in full else rest * weight[s] / unit for s in names}
        over = {s for s in names if s not in full and out[s] > 3 * sizes[s]}
        if not over:
            return out
        full |= over


def check_mix(rows: list[dict], texts: list[tuple]):
    sizes = defaultdict(int)
    for _, text, source in texts:
        sizes[source] += len(WORD.findall(text or ""))
    goals = plain_targets(sizes)
    assert len(rows) == len(texts)
    taken, largest = defaultdict(int), defaultdict(int)
    source_of = {d: s for d, _, s in texts}
    for r in rows:
        s = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(goals[s])
        assert 0 <= r["copies"] <= 3
        taken[s] += r["size"] * r["copies"]
        largest[s] = max(largest[s], r["size"])
    for s, goal in goals.items():
        assert abs(taken[s] - goal) <= max(1, largest[s])
    return taken, goals


def test_mix_reaches_the_targets(spark, small):
    rows = [r.asDict() for r in queries.op3_mixing(spark, small).collect()]
    docs = given(spark, small)
    size = {d["doc_id"]: len(WORD.findall(d["text"] or "")) for d in docs}
    assert all(r["size"] == size[r["doc_id"]] and r["taken"] == r["size"] * r["copies"] for r in rows)
    check_mix(rows, [(d["doc_id"], d["text"], d["source"]) for d in docs])
    again = queries.op3_mixing(spark, small).collect()
    assert sorted(map(tuple, again)) == sorted(tuple(r.values()) for r in rows)


def test_mix_of_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 16)
    rng = random.Random(2)
    texts = [(i, "w " * rng.randrange(60), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(1500)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, source string")
    rows = [r.asDict() for r in mixing.mix(docs, keep=["doc_id"]).collect()]
    taken, goals = check_mix(rows, texts)
    for s, goal in goals.items():
        assert abs(taken[s] - goal) <= 30


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n = int(rng.integers(1, 200))
        chance, size = rng.random(n), rng.integers(0, 50, n).astype(float)
        x = mixing.flight(chance, size, rng)
        assert x.sum() == pytest.approx(chance.sum()) and (x @ size) == pytest.approx(chance @ size)
        assert ((x > 0) & (x < 1)).sum() <= 2


def test_flight_keeps_the_chances():
    chance, size = np.array([0.2, 0.5, 0.7, 0.6]), np.array([3.0, 1.0, 2.0, 5.0])
    runs = np.array([mixing.flight(chance, size, np.random.default_rng(i)) for i in range(4000)])
    assert np.abs(runs.mean(axis=0) - chance).max() < 0.03


def test_mix_of_odd_rows(odd_docs, no_docs):
    rows = mixing.mix(odd_docs)
    assert rows.count() == odd_docs.count()
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "size", "source_size", "target", "copies"]
    assert Counter(r["text"] for r in rows.collect()) == Counter(r["text"] for r in odd_docs.collect())
    assert mixing.mix(no_docs).count() == 0
    blank = mixing.mix(odd_docs.where("text IS NULL OR trim(text) = ''")).collect()
    assert blank and all(r["target"] == 0 and r["copies"] == 0 for r in blank)


# exact dedup


def normal(text: str | None) -> str:
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def check_groups(rows: list[dict], texts: list[tuple]):
    groups = defaultdict(list)
    for doc_id, text in texts:
        groups[normal(text)].append((-len(text or ""), doc_id is None, doc_id or 0))
    by_sha = {sha(k): v for k, v in groups.items()}
    assert len(rows) == len(texts)
    kept = Counter()
    for r in rows:
        group = by_sha[r["text_sha256"]]
        best = min(group)
        assert r["keep_id"] == (None if best[1] else best[2]) and r["group_size"] == len(group)
        kept[r["text_sha256"]] += r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert set(kept.values()) <= {1} and len(kept) == len(groups)


def test_exact_groups(spark, small):
    rows = [r.asDict() for r in queries.op5_exact_dedup(spark, small).collect()]
    check_groups(rows, [(d["doc_id"], d["text"]) for d in given(spark, small)])


def test_exact_groups_of_odd_rows(odd_docs, no_docs):
    rows = [r.asDict() for r in chunks.groups(odd_docs).collect()]
    check_groups(rows, [(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert chunks.groups(no_docs).count() == 0


def test_chunks_join_to_the_text_and_come_back_after_an_insertion(spark):
    rng = random.Random(4)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzéñ日") for _ in range(30_000))
    frame = spark.createDataFrame([(text,), (text[:5000] + "inserted" + text[5000:],)], "t string")
    a, b = (r[0] for r in frame.select(chunks.chunks(frame["t"])).collect())
    assert "".join(a) == text and max(map(len, a)) <= chunks.MOST
    assert len(set(a) & set(b)) > 0.9 * len(a)


def test_identifiers_that_two_chunks_share(spark, monkeypatch):
    monkeypatch.setattr(chunks.F, "xxhash64", lambda *c: (chunks.F.length(c[0]) % 2).cast("long"))
    texts = [(i, f"{'ab' * (i % 5)}{'xyz' * (i % 3)}") for i in range(40)]
    rows = [r.asDict() for r in chunks.groups(spark.createDataFrame(texts, "doc_id long, text string")).collect()]
    check_groups(rows, texts)


def test_exact_dedup_has_no_python_in_its_plan(spark, small):
    plan = queries.op5_exact_dedup(spark, small)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# SimHash


def plain_fingerprint(text: str | None) -> int:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def check_components(rows: list[dict], texts: list[tuple], radius: int = 2):
    print_ = {i: plain_fingerprint(t) for i, (_, t) in enumerate(texts)}
    values = sorted(set(print_.values()))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in combinations(values, 2):
        if (a ^ b).bit_count() <= radius:
            root[find(b)] = find(a)
    least = {}
    for i, (d, _) in enumerate(texts):
        r = find(print_[i])
        if d is not None:
            least[r] = min(least.get(r, d), d)
    want = Counter((d, f"{print_[i]:016x}", least.get(find(print_[i]))) for i, (d, _) in enumerate(texts))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows) == want


def hexed(df):
    return [r.asDict() for r in df.selectExpr("doc_id", "lower(lpad(hex(simhash), 16, '0')) AS fingerprint", "component_id").collect()]


def test_simhash_components(spark, small):
    rows = [r.asDict() for r in queries.op10_simhash(spark, small).collect()]
    check_components(rows, [(d["doc_id"], d["text"]) for d in given(spark, small)])


def test_simhash_of_odd_rows(odd_docs, no_docs):
    check_components(hexed(simhash.near_duplicates(odd_docs)), [(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert simhash.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks = simhash.covering_masks(list(range(64)), radius)
    rng = random.Random(radius)
    for _ in range(3000):
        difference = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not difference & m for m in masks)


@pytest.mark.parametrize("bucket", [3, 512])
def test_links_join_what_all_pairs_join(spark, monkeypatch, bucket):
    """Small buckets force the split over all levels."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(bucket)
    centre = rng.getrandbits(64)
    values = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for _ in range(400)} | {rng.getrandbits(64) for _ in range(200)}
    signed = sorted(simhash._signed(v) for v in values)
    links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()

    def parts(pairs):
        root = {v: v for v in signed}

        def find(v):
            while root[v] != v:
                v = root[v]
            return v

        for a, b in pairs:
            root[find(b)] = find(a)
        return {v: find(v) for v in signed}

    near = [(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    assert all(((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= 2 for r in links)
    got, want = parts((r["a"], r["b"]) for r in links), parts(near)
    assert all((got[a] == got[b]) == (want[a] == want[b]) for a, b in combinations(signed[:300], 2))


def test_registered_sql_agrees(spark, small):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    for name, sql in queries.ORACLES.items():
        if "documents" in sql:
            frame = queries.QUERIES[name](spark, small)
            result = con.execute(sql)
            columns = [d[0] for d in result.description]
            want = sorted(result.fetchall(), key=repr)
            assert sorted(map(tuple, frame.select(*columns).collect()), key=repr) == want
