"""Cheapest repair of a sequence of roles, by an auction for a shortest path.

The lattice has a node for (rows done, last role kept): nothing yet, system, user, assistant. Its arcs
are the edits, with whole costs:

* ``K`` keep the row, 0; its role must be the one that may come next,
* ``R`` give it the role user or assistant that comes next, 3,
* ``D`` delete it, 4,
* ``I`` insert the role that comes next before it, 3.

A row that ends in mid-sentence costs 3 more unless it is deleted; a blank or repeated row can only be
deleted. A sequence may end after nothing or after an assistant; otherwise the roles missing are inserted.

``auction`` keeps a path from the origin and a price at every node, never above the cost of an arc plus the
price at its end. At the end of the path it either raises the price to the cheapest arc and takes the node off
the path, or, where price and arc agree, goes along the arc. When the path arrives, the origin's price is the
least cost, and every cheapest path consists of tight arcs, so ``trace`` finds the first one in the order of the
letters by going along tight arcs only.

Rows are taken in blocks from last to first: the prices where a block begins are the costs beyond the
block before it. This bounds the prices that an auction can run through.
"""

from __future__ import annotations

from collections.abc import Sequence

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
# the state after the role that comes next, by state
FOLLOWS = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEEP, RELABEL, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3
# what the end of a sequence costs by state, and the edits it takes
END = (0, 2 * INSERT, INSERT, 0)
END_EDITS = ("", "II", "I", "")
FAR = 1 << 40
BLOCK = 32

# initials: s, u, a, any other; rows: whole, unfinished, to be deleted
INITIALS = {"s": 0, "u": 1, "a": 2}
OTHER = 3
LEGAL = {(0, 1), (1, 2), (2, 1)}
WHOLE, CUT, BAD = range(3)


def kind(initial: int, state: int) -> int:
    return initial * 3 + state


def _arcs(of: int) -> tuple[tuple[tuple[int, int, int, str], ...], ...]:
    """By state, the arcs (cost, rows done, state, letter) at a row of this kind, by letter."""
    initial, fault = divmod(of, 3)
    more = UNFINISHED if fault == CUT else 0
    out = []
    for state in range(STATES):
        then = FOLLOWS[state]
        arcs = [(DELETE, 1, state, "D"), (INSERT, 0, then, "I")]
        if fault != BAD:
            if initial == 0 and state == NOTHING:
                arcs.append((KEEP + more, 1, SYSTEM, "K"))
            elif (initial, then) in ((1, USER), (2, ASSISTANT)):
                arcs.append((KEEP + more, 1, then, "K"))
            arcs.append((RELABEL + more, 1, then, "R"))
        out.append(tuple(arcs))
    return tuple(out)


ARCS = tuple(_arcs(k) for k in range(12))
LEAST = tuple(DELETE if k % 3 == BAD else UNFINISHED if k % 3 == CUT else 0 for k in range(12))


def prices(kinds: Sequence[int], beyond: Sequence[int]) -> list[int]:
    """First prices of a block: at its end what lies ``beyond`` by state, before it the least that the
    rows left can cost. Node (i, state) is 4 i + state; the last is the goal."""
    out = [0] * (STATES * (len(kinds) + 1) + 1)
    rest = min(beyond)
    end = STATES * len(kinds)
    out[end : end + STATES] = beyond
    for i in range(len(kinds) - 1, -1, -1):
        rest += LEAST[kinds[i]]
        out[STATES * i : STATES * (i + 1)] = [rest] * STATES
    return out


def auction(kinds: Sequence[int], price: list[int], origin: int) -> int:
    """Raises ``price`` until it holds a cheapest path from state ``origin`` to the end; its cost."""
    end = STATES * len(kinds)
    path = [origin]
    while True:
        node = path[-1]
        if node >= end:
            return price[origin]
        row = node >> 2
        least = FAR
        for cost, step, state, _ in ARCS[kinds[row]][node & 3]:
            at = (row + step << 2) + state
            value = cost + price[at]
            if value < least:
                least, best = value, at
        if price[node] < least:
            price[node] = least
            if len(path) > 1:
                path.pop()
        else:
            path.append(best)


def trace(kinds: Sequence[int], price: list[int], origin: int) -> tuple[str, int]:
    """The first cheapest path by its letters, and the state at its end."""
    end = STATES * len(kinds)
    dead: set[int] = set()
    nodes, letters = [origin], []
    choices = [iter(ARCS[kinds[0]][origin])] if kinds else []
    while nodes[-1] < end:
        node = nodes[-1]
        row = node >> 2
        for cost, step, state, letter in choices[-1]:
            at = (row + step << 2) + state
            if at not in dead and price[node] == cost + price[at]:
                nodes.append(at)
                letters.append(letter)
                choices.append(iter(ARCS[kinds[at >> 2]][state]) if at < end else iter(()))
                break
        else:
            dead.add(nodes.pop())
            choices.pop()
            letters.pop()
    return "".join(letters), nodes[-1] & 3


class Piece:
    """Rows of one sequence in order, priced against what lies beyond their end."""

    def __init__(self, kinds: Sequence[int], beyond: Sequence[int] = END, origins: Sequence[int] = range(STATES)) -> None:
        self.blocks = []
        self.beyond = list(beyond)
        for start in range(max(0, len(kinds) - 1) // BLOCK * BLOCK, -1, -BLOCK):
            block = kinds[start : start + BLOCK]
            price = prices(block, beyond)
            beyond = [auction(block, price, q) for q in (range(STATES) if start else origins)]
            self.blocks.append((block, price))
        self.blocks.reverse()

    def path(self, origin: int) -> tuple[str, int, int]:
        """Edits from state ``origin``, the state they end in, and their cost."""
        letters, state = [], origin
        for block, price in self.blocks:
            some, state = trace(block, price, state)
            letters.append(some)
        return "".join(letters), state, self.blocks[0][1][origin] - self.beyond[state] if self.blocks else 0


def best(kinds: Sequence[int]) -> tuple[str, int]:
    """Edits of a whole sequence and their cost."""
    if not kinds:
        return "", 0
    edits, state, cost = Piece(kinds, END, [NOTHING]).path(NOTHING)
    return edits + END_EDITS[state], cost + END[state]


def matrix(kinds: Sequence[int]) -> list[int]:
    """Least costs from state to state over the rows, row by row; ``FAR`` where there is no way.

    Only deletion keeps nothing or system as they are, and system is reached by one kept row.
    """
    gone = DELETE * len(kinds)
    kept_first = min((UNFINISHED if k % 3 == CUT else KEEP for k in kinds if k // 3 == 0 and k % 3 != BAD), default=FAR)
    out = [FAR] * (STATES * STATES)
    out[NOTHING * STATES + NOTHING] = out[SYSTEM * STATES + SYSTEM] = gone
    if kept_first < FAR:
        out[NOTHING * STATES + SYSTEM] = gone - DELETE + kept_first
    for last in (USER, ASSISTANT):
        beyond = [FAR] * STATES
        beyond[last] = 0
        piece = Piece(kinds, beyond)
        for first in range(STATES):
            out[first * STATES + last] = piece.blocks[0][1][first]
    return out


def through(costs: Sequence[int], beyond: Sequence[int]) -> list[int]:
    """Least costs by state before rows with the matrix ``costs``, from those ``beyond`` them."""
    return [min(FAR, *(costs[q * STATES + r] + beyond[r] for r in range(STATES))) for q in range(STATES)]


def apply(edits: str, rows: Sequence[tuple[str, str]], state: int = NOTHING) -> list[tuple[str, str]]:
    """``rows`` (role, text) after ``edits`` that begin in ``state``."""
    out, at = [], iter(rows)
    for edit in edits:
        if edit == "I":
            state = FOLLOWS[state]
            out.append((ROLE[state], ""))
            continue
        role, text = next(at)
        if edit == "K":
            out.append((role, text))
            state = SYSTEM if state == NOTHING and role[:1] == "s" else FOLLOWS[state]
        elif edit == "R":
            state = FOLLOWS[state]
            out.append((ROLE[state], text))
    return out
