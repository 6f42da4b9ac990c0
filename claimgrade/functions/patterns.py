"""Many terms in one pass over a text: a pattern finds the places where a term may begin.

The pattern is a trie of how terms begin, so the cost of a place depends on how far terms agree with the text there,
not on how many there are. It is searched again from the next place on: every place is tried, and terms
that overlap are all found. Where it fits, the text is cut to the lengths of terms with that begin and looked up.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

_END = ""
# so many letters of a term are in the pattern: groups of it are nested no deeper, however long terms are
_DEPTH = 16


def trie(terms: Iterable[str]) -> dict:
    """Nested dicts by character; the empty key marks the end of a term. Empty terms are left out."""
    root: dict = {}
    for term in terms:
        node = root
        for letter in term:
            node = node.setdefault(letter, {})
        if term:
            node[_END] = {}
    return root


def _escaped(letter: str) -> str:
    return letter if letter.isalnum() or not letter.isascii() else f"\\x{ord(letter):02x}"


def pattern(node: dict) -> str:
    """The pattern of the longest term of a trie that begins at a place.

    Works on a list of open nodes instead of calling itself: terms may be long.
    """
    done: dict[int, str] = {}
    open_nodes = [node]
    while open_nodes:
        at = open_nodes[-1]
        waiting = [child for letter, child in at.items() if letter != _END and id(child) not in done]
        if waiting:
            open_nodes.extend(waiting)
            continue
        open_nodes.pop()
        ways = [_escaped(letter) + done.pop(id(child)) for letter, child in sorted(at.items()) if letter != _END]
        if not ways:
            done[id(at)] = ""
        elif len(ways) == 1 and _END not in at:
            done[id(at)] = ways[0]
        else:
            done[id(at)] = f"(?:{'|'.join(ways)})" + ("?" if _END in at else "")
    return done[id(node)]


def begun_by(terms: Iterable[str]) -> list[tuple[str, str]]:
    """(longest, term): each term with all terms that begin it, itself included."""
    known = set(terms) - {""}
    lengths = sorted({len(t) for t in known})
    return [(longest, longest[:n]) for longest in sorted(known) for n in lengths if n <= len(longest) and longest[:n] in known]


def finder(terms: Iterable[str]) -> Callable[[str], Iterator[str]]:
    """A function that gives the terms in a text from left to right, as often as they stand there.

    It finds them while they are asked for: who has enough does not have the rest of the text read.
    """
    known = set(terms) - {""}
    begins: dict[str, set[int]] = {}
    for term in known:
        begins.setdefault(term[:_DEPTH], set()).add(len(term))
    lengths: dict[str, set[int]] = {}
    for longest, begin in begun_by(begins):
        lengths.setdefault(longest, set()).update(begins[begin])
    fits = re.compile(pattern(trie(begins)))

    def find(text: str) -> Iterator[str]:
        place = fits.search(text) if known else None
        while place:
            start = place.start()
            for length in lengths[place.group()]:
                if (term := text[start : start + length]) in known:
                    yield term
            place = fits.search(text, start + 1)

    return find
