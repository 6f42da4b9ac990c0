"""Conversation repair against an exhaustive search over all edits."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from claimgrade.llm import auction, conversations, queries

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(kinds: tuple[int, ...]) -> tuple[int, str]:
    """Least (cost, edits) by recursion over (rows done, last role, inserted in a row)."""

    @cache
    def rest(i: int, last: str, inserted: int) -> tuple[int, str]:
        after = "a" if last == "u" else "u"
        ways = []
        if i == len(kinds):
            if last in ("", "a"):
                ways.append((0, ""))
        else:
            initial, fault = "sua?"[kinds[i] // 3], kinds[i] % 3
            more = 3 if fault == 1 else 0
            ways.append(add(4, "D", rest(i + 1, last, 0)))
            if fault != 2:
                ways.append(add(3 + more, "R", rest(i + 1, after, 0)))
                if initial == after or (initial == "s" and last == ""):
                    ways.append(add(more, "K", rest(i + 1, initial, 0)))
        if inserted < 3:
            ways.append(add(3, "I", rest(i, after, inserted + 1)))
        return min(ways, default=(1 << 40, "~"))

    def add(cost: int, letter: str, tail: tuple[int, str]) -> tuple[int, str]:
        return cost + tail[0], letter + tail[1]

    return rest(0, "", 0)


def plain(rows: list[tuple]) -> dict:
    """The contract, read row by row: conv_id -> counts, audit, digest."""
    out: dict = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if what == 1:
            text = ""
        if what == 2:
            text = re.sub("[.!?]", "", text)
        if what == 4:
            role = "user"
        mine.extend([(turn, role, text)] * (0 if what == 0 else 2 if what == 3 else 1))
    return {conv: judged(mine) for conv, mine in out.items()}


def judged(rows: list[tuple]) -> tuple:
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    seen, counts, kinds = set(), [0, 0, 0], []
    for _, role, text in rows:
        visible = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = 0
        if not visible:
            counts[0] += 1
            fault = 2
        elif (role, text) in seen:
            counts[1] += 1
            fault = 2
        elif visible[-1] not in ".!?":
            counts[2] += 1
            fault = 1
        seen.add((role, text))
        kinds.append("sua".find(role[:1]) % 4 * 3 + fault if role[:1] else 9 + fault)
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    cost, edits = cheapest(tuple(kinds))
    lines = [f"{r}:{t}" for r, t in auction.apply(edits, [(r, t) for _, r, t in rows])]
    return gaps, *counts, illegal, cost, edits, hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()


def results(frame) -> dict:
    rows = frame.collect()
    out = {r["conv_id"]: tuple(r[c] for c in (*conversations.COUNTS, "audit", "repaired_sha256")) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("block", [3, 32])
def test_auction_finds_the_first_cheapest(monkeypatch, block):
    monkeypatch.setattr(auction, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(3000):
        kinds = tuple(rng.choice((rng.randrange(12), 3, 6)) for _ in range(rng.choice((0, 1, 2, 3, 5, 8, 13))))
        cost, edits = cheapest(kinds)
        assert auction.best(kinds) == (edits, cost)


def test_prices_are_dual():
    """Prices never exceed an arc's cost plus the price at its end."""
    rng = random.Random(1)
    for _ in range(200):
        kinds = [rng.randrange(12) for _ in range(20)]
        price = auction.prices(kinds, auction.END)
        auction.auction(kinds, price, 0)
        for i, k in enumerate(kinds):
            for q in range(4):
                assert all(price[4 * i + q] <= c + price[4 * (i + step) + to] for c, step, to, _ in auction.ARCS[k][q])


def test_pieces_join_to_the_whole():
    rng = random.Random(2)
    for _ in range(500):
        kinds = [rng.choice((rng.randrange(12), 3, 6)) for _ in range(rng.randrange(2, 30))]
        cut = rng.randrange(1, len(kinds))
        matrices = [auction.matrix(kinds[:cut]), auction.matrix(kinds[cut:])]
        beyond = auction.through(matrices[1], auction.END)
        first, state, _ = auction.Piece(kinds[:cut], beyond).path(0)
        second, end, _ = auction.Piece(kinds[cut:]).path(state)
        edits, cost = auction.best(kinds)
        assert first + second + auction.END_EDITS[end] == edits
        assert auction.through(conversations._product(matrices), auction.END)[0] == auction.through(matrices[0], beyond)[0] == cost


def test_repaired_roles_are_legal():
    rng = random.Random(3)
    for _ in range(300):
        rows = [(rng.choice(("system", "user", "assistant", "tool", "")), "x") for _ in range(rng.randrange(1, 12))]
        edits, _ = auction.best([auction.kind(auction.INITIALS.get(r[:1], 3), rng.randrange(3)) for r, _ in rows])
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in auction.apply(edits, rows)))


def test_whole_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert results(queries.op13_conversations(spark, small)) == plain(rows)


def odd_rows() -> list[tuple]:
    rng = random.Random(9)
    rows = []
    for conv in [None, *range(60)]:
        for turn in rng.sample([None, *range(14)], rng.randrange(1, 10)):
            rows.append((conv, turn, rng.choice([None, "", "system", "user", "assistant", "tool", "User"]), rng.choice([None, "", " \t", "yes.", "no", "what? ", "日本。", "same.", "a\nb!"])))
    return rows


def test_odd_rows(spark):
    rows = odd_rows()
    frame = spark.createDataFrame(rows, SCHEMA)
    assert results(conversations.digests(conversations.repair(conversations.damaged(frame)))) == plain(rows)


def test_long_conversations_take_the_other_way(spark, monkeypatch):
    """Every conversation in pieces of four rows, the tree with four children a node."""
    monkeypatch.setattr(conversations, "PIECE_BITS", 2)
    monkeypatch.setattr(conversations, "TREE_BITS", 2)
    rng = random.Random(4)
    rows = odd_rows()
    rows += [(500, t, rng.choice(["user", "assistant"]), rng.choice(["ja.", "nein.", f"t{t}", f"u{t}.", ""])) for t in range(400)]
    rows += [(501, None, "user", "same.")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    cut = conversations.repair(conversations.damaged(frame), long_rows=0)
    assert cut.where("pieces > 1").count() > 100
    assert results(conversations.digests(cut)) == plain(rows)


def test_equal_rows_of_one_turn_are_split(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PIECE_BITS", 3)
    rows = [(1, None, "user", "same.")] * 100 + [(1, 2, "assistant", "ok.")]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = conversations.digests(conversations.repair(frame, long_rows=10)).collect()[0]
    assert (found["duplicate"], found["cost"], found["audit"]) == (99, 396, "K" + "D" * 99 + "K")


def test_no_rows_and_extra_columns(spark):
    assert conversations.digests(conversations.repair(conversations.damaged(spark.createDataFrame([], SCHEMA)))).collect() == []
    rows = spark.createDataFrame([(1, 0, "user", "hi.", "own", False), (2, 0, "user", "hi.", "own", True)], SCHEMA + ", Audit string, there boolean")
    got = results(conversations.digests(conversations.repair(rows)))
    assert got[1] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[2][5:7] == (3, "KI")


def test_very_long_text(spark):
    rows = spark.createDataFrame([(1, 0, "user", "x " * 1_000_000 + "."), (1, 1, "assistant", "ok."), (2, 0, "system", "s.")], SCHEMA)
    got = results(conversations.digests(conversations.repair(rows, long_bytes=1000)))
    assert got[1][:7] == (0, 0, 0, 0, 0, 0, "KK")
    assert got[2][5:7] == (4, "D")
