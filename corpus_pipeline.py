"""From raw documents to tokens of a mixed corpus, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns the
columns of ``documents``; the last adds ``token_ids``, ``decoded`` and ``n_tokens``. Columns of the documents that
an operator would replace come back as they were, but for those three. Empty tables stay empty; rows that
repeat an id are rows of their own.

1. language: documents go that have no letter, or in which no language is likelier than all others together.
2. exact duplicates: of texts equal without white space, the longest stays.
3. near duplicates: of every group linked by five-word shingles (Jaccard 0.8), the smallest id stays.
4. mixing: a document stands as often as the mix takes it, 0 to 3 times.
5. tokens: ids of the whole text, and the text decoded from them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgrade.llm import bpe, chunks, language, mixing, shingles
from claimgrade.llm.common import stored, tune


# a language is found when it is likelier than all others together
LIKELY = 0.5


def _aside(docs: DataFrame, *added: str) -> tuple[DataFrame, list[F.Column]]:
    """``docs`` with the columns an operator would replace under other names, and the columns that
    bring all of ``docs`` back."""
    names = {c: f"__own{i}" if c.lower() in added else c for i, c in enumerate(docs.columns)}
    return docs.withColumnsRenamed(names), [F.col(f"`{now}`").alias(c) for c, now in names.items()]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language. The winner's posterior decides: below ``LIKELY`` the automata do not tell
    the languages apart, which also happens to ties. Null and empty texts go. Where no language was
    learned, because no row outside the held-out third has one, every text with a letter stays."""
    tune(spark)
    docs, own = _aside(docs, "lang_pred", "score")
    samples = language.learn(docs.where(~language.held_out("doc_id", 3, 1)))
    if not samples:
        return docs.where(F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).select(*own)
    found = language.identify(docs, samples)
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LIKELY)).select(*own)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal without white space the one with most code points, then the smallest id. Null
    counts as empty; rows without an id are kept apart from those with one by the operator's order."""
    tune(spark)
    docs, own = _aside(docs, "keep_id", "group_size", "kept", "text_sha256")
    return chunks.groups(docs).where("kept").select(*own)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, that of the smallest id. Texts without words are alike.
    Rows that repeat the smallest id stay."""
    tune(spark)
    docs, own = _aside(docs, "component_id", "__id", "__tag")
    found = shingles.near_duplicates(docs)
    return found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(*own)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; a null source is a source, a text without words
    counts no words. Reruns agree."""
    tune(spark)
    docs, own = _aside(docs, "size", "source_size", "target", "copies", "__copy")
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("__copy")
    return mixing.mix(docs).select(*own, copies).drop("__copy")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the whole text and the text decoded from them; null counts as empty. Columns named
    ``token_ids``, ``decoded`` or ``n_tokens`` are replaced."""
    tune(spark)
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokens = bpe.decode(bpe.encode(docs, path), path)
    return tokens.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("near-dedup", near_dedup),
    ("mixing sources", mix_sources),
    ("BPE", tokenize),
]

# Language, shingles, balanced sampling and BPE are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each stored before the next reads it."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.lower().replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
