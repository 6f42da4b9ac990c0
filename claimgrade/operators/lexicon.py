"""Evidence matching with the lexicon as a table: any number of terms, one pass over each text.

A lexicon has one row per term: ``capability``, ``rule`` (what a hit means), ``term`` (a lower-case piece
of text) and ``anchored`` (only at the begin of the text). The terms of a channel become one pattern (see
``functions.patterns``), so neither the plan nor the time for a text grows with the number of terms. A row
gives the (capability, rule) pairs it meets as numbers, and a text is read until it has met all there are for it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgrade.config import FACILITY, GradingConfig
from claimgrade.functions.patterns import finder

LEXICON = "capability string, rule string, term string, anchored boolean"
# text channel of each rule
CHANNELS = {
    "structured": "spec_eq_text",
    "claim": "claim_text",
    "prose": "prose_text",
    "screening_any": "full_text",
    "screening_none": "full_text",
}
# a lexicon is made by people: beyond this it is no lexicon, and every task has it as a pattern
MOST_TERMS, MOST_CHARACTERS = 50_000, 2_000_000


def table(spark: SparkSession, cfg: GradingConfig = FACILITY) -> DataFrame:
    """The terms of a configuration as a lexicon."""
    rows = []
    for terms in cfg.lexicon:
        rules = {"structured": terms.structured, "claim": terms.claim, "prose": terms.prose}
        rules |= {"screening_any": terms.screening_any, "screening_none": terms.screening_none}
        rows += [(terms.capability, rule, term, False) for rule, some in rules.items() for term in some]
        rows += [(terms.capability, "structured", term, True) for term in terms.structured_prefix]
    return spark.createDataFrame(rows, LEXICON)


def read(lexicon: DataFrame) -> list[tuple[str, str, str, bool]]:
    """The rows of a lexicon, each once. Rows without a capability, a known rule or a term are left
    out; a table over the bound is an error, never cut."""
    kept = lexicon.where(F.col("capability").isNotNull() & F.col("rule").isin(*CHANNELS) & (F.length("term") > 0))
    distinct = kept.select("capability", "rule", "term", F.coalesce("anchored", F.lit(False)).alias("anchored")).distinct()
    rows = [tuple(r) for r in distinct.limit(MOST_TERMS + 1).collect()]
    if len(rows) > MOST_TERMS or sum(len(r[2]) for r in rows) > MOST_CHARACTERS:
        raise ValueError(f"a lexicon has at most {MOST_TERMS} terms and {MOST_CHARACTERS} characters")
    return sorted(rows)


def _place(rule: str, anchored: bool) -> str:
    """Where a rule's terms are looked for: the channel, or its begin."""
    return f"^{CHANNELS[rule]}" if anchored else CHANNELS[rule]


def _letters(utf8: bytes) -> str:
    """A text of one letter per byte. A letter's bytes never begin inside another's, so terms are found where they stand."""
    return utf8.decode("latin-1")


def _reader(anywhere: dict[str, set[int]], at_begin: dict[str, set[int]]) -> Callable[[str], set[int]]:
    """A function from a text to the numbers of the terms in it and at its begin, of which each term has some."""
    find = finder(anywhere)
    lengths = {len(term) for term in at_begin}
    all_numbers = set().union(*anywhere.values(), *at_begin.values())

    def read(text: str) -> set[int]:
        met: set[int] = set()
        for length in lengths:
            met |= at_begin.get(text[:length], set())
        for term in find(text):
            met |= anywhere[term]
            if len(met) == len(all_numbers):
                break
        return met

    return read


def _met(places: dict[str, dict[str, set[int]]]) -> Column:
    """The numbers that the channels of a row meet; ``places`` has them by place and term."""
    channels = sorted({place.removeprefix("^") for place in places})

    @F.arrow_udf("array<int>")
    def met(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        readers = [_reader(places.get(c, {}), places.get(f"^{c}", {})) for c in channels]
        for batch in batches:
            rows = zip(*batch.flatten(), strict=True)
            numbers = [set().union(*[read(_letters(t.as_py() or b"")) for read, t in zip(readers, row, strict=True)]) for row in rows]
            yield pa.array(map(sorted, numbers), pa.list_(pa.int32()))

    return met(F.struct(*[F.col(c).cast("binary").alias(c) for c in channels]))


def matches(texts: DataFrame, lexicon: DataFrame, key: str = "unique_id") -> DataFrame:
    """(``key``, met): for each row the (capability, rule) pairs with a term in the rule's channel.

    ``texts`` has ``key`` and the text channels; rows of one key count together. Rows without any
    match have an empty list. ``lexicon`` is read once, see ``read``.
    """
    rows = read(lexicon)
    pairs = sorted({r[:2] for r in rows})
    number = {pair: i for i, pair in enumerate(pairs)}
    places: dict[str, dict[str, set[int]]] = {}
    for capability, rule, term, anchored in rows:
        numbers = places.setdefault(_place(rule, anchored), {}).setdefault(_letters(term.encode()), set())
        numbers.add(number[capability, rule])
    found = _met(places) if places else F.array().cast("array<int>")
    # the matcher runs in a projection of its own: texts go no further, only numbers move
    each = texts.select(key, found.alias("found")).select(key, F.explode_outer("found").alias("number"))
    met = each.groupBy(key).agg(F.collect_set("number").alias("numbers"))
    # one literal, however many pairs there are
    said = F.from_json(F.lit(json.dumps([{"capability": c, "rule": r} for c, r in pairs])), "array<struct<capability:string,rule:string>>")
    return met.select(key, F.transform("numbers", lambda n: F.get(said, n)).alias("met"))


def hits(texts: DataFrame, lexicon: DataFrame, key: str = "unique_id") -> DataFrame:
    """(``key``, capability, and the four hit columns of ``evidence``) for every row and every
    capability of the lexicon, from a lexicon in a table."""
    capabilities = sorted({r[0] for r in read(lexicon)})
    names = F.array(*[F.lit(c) for c in capabilities]).cast("array<string>")

    def has(rule: str) -> Column:
        return F.array_contains("met", F.struct(F.col("capability"), F.lit(rule).alias("rule")))

    return matches(texts, lexicon, key).select(key, "met", F.explode(names).alias("capability")).select(
        key,
        "capability",
        has("structured").alias("structured_hit"),
        has("claim").alias("claim_hit"),
        has("prose").alias("prose_hit"),
        (has("screening_any") & ~has("screening_none")).alias("screening_only"),
    )
