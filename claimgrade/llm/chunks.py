"""Exact duplicates by content-defined chunk recipes, in DataFrame operations only.

A normalised text is cut where its content says so: after a pair of characters of a fixed class,
at least ``LEAST`` and at most ``MOST`` characters after the last cut, so that equal text is cut
alike wherever it stands. Distinct chunks get identifiers: a 64-bit hash, with a rank behind it
where two different chunks share one, which is verified on the chunks themselves. A text's recipe
is the ordered list of the identifiers of its chunks. Texts are equal when their recipes are, and
the recipe, not the text, is what moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimgrade.llm.common import stored

# Characters of a chunk. Between the two, a chunk ends after the first triple in ``CUT``; about
# one in sixty does, so equal passages soon have equal borders again whatever stands before them.
LEAST, MOST = 128, 2048
_FAR = r"\x80-\x{10FFFF}"
CUT = rf"(?<=[dhlptxDHLPTX048{_FAR}][aeimquyAEIMQUY159{_FAR}][bfjnrvzBFJNRVZ26{_FAR}])"
_CHUNK = rf"(?s).{{{LEAST},{MOST - 1}}}?{CUT}|(?s).{{1,{MOST}}}"
_WHITE = "".join(map(chr, (0x20, *range(0x09, 0x0E))))


def normalised(text: str) -> F.Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), _WHITE, "")


def chunks(text: F.Column) -> F.Column:
    """The chunks of a normalised text, in order; together they are the text."""
    return F.regexp_extract_all(text, F.lit(_CHUNK), F.lit(0))


def recipes(docs: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` and ``recipe``, array<long>: two rows have equal recipes exactly
    when their normalised texts in ``text`` are equal."""
    hashed = docs.select(*columns, chunks(F.col(text)).alias("chunks")).withColumn("ids", F.transform("chunks", lambda c: F.xxhash64(c)))
    pieces = docs.select(F.explode(chunks(F.col(text))).alias("chunk")).select(F.xxhash64("chunk").alias("id"), "chunk").distinct()
    # each distinct chunk moves once; identifiers of more than one chunk are the ones to mend
    shared = stored(pieces.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"), "shared-ids")
    if shared.isEmpty():
        return hashed.select(*columns, F.col("ids").alias("recipe"))
    order = Window.partitionBy("id").orderBy("chunk")
    ranks = stored(pieces.join(shared, "id").withColumn("rank", F.row_number().over(order)), "ranks")
    return _mended(hashed, ranks, columns)


def _mended(hashed: DataFrame, ranks: DataFrame, columns: list[str]) -> DataFrame:
    """Recipes in which an identifier that several chunks share is followed by a rank."""
    row = hashed.withColumn("__row", F.monotonically_increasing_id())
    row = stored(row, "rows")
    at = row.select("__row", F.posexplode("chunks").alias("pos", "chunk")).withColumn("id", F.xxhash64("chunk"))
    ranked = at.join(ranks, ["id", "chunk"]).groupBy("__row").agg(F.sort_array(F.collect_list(F.struct("pos", "rank"))).alias("ranked"))
    tail = F.flatten(F.transform("ranked", lambda x: F.array(x["pos"].cast("long"), x["rank"].cast("long"))))
    recipe = F.when(F.col("ranked").isNull(), F.col("ids")).otherwise(F.concat(F.col("ids"), tail))
    return row.join(ranked, "__row", "left").select(*columns, recipe.alias("recipe"))


def groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Of equal texts the row with the most code points in the original text stays, then the
    smallest id (a null id last). If several rows agree in id and length too, one of them stays.
    """
    added = {"keep_id", "group_size", "kept", "text_sha256"}
    own = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    facts = docs.select(
        *[F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(own)],
        F.col(f"`{doc_id}`").alias("__id"),
        F.length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("__n"),
        normalised(text).alias("__norm"),
    ).withColumn("text_sha256", F.sha2("__norm", 256))
    columns = [c for c in facts.columns if c != "__norm"]
    made = stored(recipes(facts, "__norm", columns).withColumn("__row", F.monotonically_increasing_id()), "recipes")
    # the longest, then the smallest id, then any one row: partial maxima before the shuffle
    best = F.max(F.struct("__n", F.col("__id").isNotNull().alias("k"), (-F.col("__id")).alias("i"), (-F.col("__row")).alias("r")))
    winners = stored(
        made.groupBy("recipe")
        .agg(F.count("*").alias("group_size"), best.alias("b"))
        .select("recipe", "group_size", (-F.col("b.i")).alias("keep_id"), (-F.col("b.r")).alias("first")),
        "winners",
    )
    return made.join(winners, "recipe").select(
        *[F.col(f"__{i}").alias(c) for i, c in enumerate(own)],
        "keep_id",
        "group_size",
        (F.col("__row") == F.col("first")).alias("kept"),
        "text_sha256",
    )
