"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimgrade.llm import audit, bpe, chunks, conversations, language, mixing, quality, secrets, simhash, substring, treebpe, urls, vectors
from claimgrade.llm.common import table


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out("doc_id", 3, 1))
    samples = language.learn(docs.where("NOT held_out"))
    return language.identify(docs, samples, keep=["doc_id", "held_out"])


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokens = bpe.encode(table(spark, sf_dir, "documents"), path, keep=["doc_id"])
    return bpe.decode(tokens, path).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", F.sha2("candidate", 256).alias("candidate_sha256"), "score", "is_secret")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.groups(table(spark, sf_dir, "documents"), keep=["doc_id"])


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", language.held_out("doc_id", 5, 0))
    labels = table(spark, sf_dir, "labels").where(~language.held_out("doc_id", 5, 0))
    model = quality.fit(quality.sample(docs, labels))
    return quality.score(docs, model, keep=["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op8_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


RULES = [
    urls.Rule("net", "/", "block"),
    urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"),
    urls.Rule("org", "/fr/", "allow"),
]


def op9_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the number in a page's path is the id of the document it shows: a label of the document, low
    # quality or toxic, labels the URL
    number = F.regexp_extract("url", r"/([0-9]{1,18})(?=\D*([?#]|$))", 1)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", number.try_cast("long").alias("number"))
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("number")).agg(F.max(bad.cast("int")).alias("bad"))
    judged = urls.judge(pages.join(labels, "number", "left"), "url", RULES, F.col("bad"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "block_score")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"), "component_id")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    tokens = treebpe.with_digest(treebpe.encode(table(spark, sf_dir, "documents"), path, pattern, keep=["doc_id"]))
    return treebpe.decode(tokens, path, pattern).select(
        "doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.digests(conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations"))))


QUERIES = {
    "op1_language": op1_language,
    "op2_bpe": op2_bpe,
    "op3_mixing": op3_mixing,
    "op4_secrets": op4_secrets,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_substring": op6_substring,
    "op7_quality": op7_quality,
    "op8_vectors": op8_vectors,
    "op9_urls": op9_urls,
    "op10_simhash": op10_simhash,
    "op11_filter_audit": op11_filter_audit,
    "op12_tree_bpe": op12_tree_bpe,
    "op13_conversations": op13_conversations,
}

ORACLES = {
    "op5_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(norm) AS text_sha256
FROM t
WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id)
""",
    "op11_filter_audit": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), f AS (
  SELECT w.doc_id, part,
         CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END AS fails
  FROM w
), l AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id
), c AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE toxic) AS t
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails
), o(filter_order) AS (
  SELECT ''
  UNION ALL
  SELECT filter_order || x FROM o, unnest(['A', 'B', 'C', 'D', 'E']) AS u(x) WHERE NOT contains(filter_order, x)
), s AS (
  SELECT filter_order, step::INTEGER AS step, filter_order[step] AS filter, left(filter_order, step - 1) AS before
  FROM o, range(1, 6) AS r(step) WHERE length(filter_order) = 5
), m AS (
  SELECT s.*, part, n, g, t,
         fails <> '' AND len(list_intersect(str_split(before, ''), str_split(fails, ''))) > 0 AND before <> '' AS gone,
         contains(fails, filter) AS hit, fails = filter AS alone
  FROM c, s
), a AS (
  SELECT part, filter_order, step, filter,
         sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN gone AND hit THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN alone THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN NOT gone AND hit THEN g ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN NOT gone AND hit THEN t ELSE 0 END)::BIGINT AS toxic_lost
  FROM m GROUP BY part, filter_order, step, filter
)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM a
""",
}
