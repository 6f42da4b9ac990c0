"""URL filters: host and path rules, and gradient-boosted trees for the URLs no rule decides.

The trees see lexical features only: lengths, depth, digits, entropy, parameters, and statistics
of the host's suffixes over all URLs. They are trained on a bounded sample of labelled URLs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimgrade.llm.common import stored, unused

# Bound of the labelled sample, in URLs.
SAMPLE = 20_000
TREES, DEPTH, SEED = 20, 4, 1
_HOST, _PATH = "__host", "__path"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def split_url(url: str) -> tuple[F.Column, F.Column]:
    """Host and path of the URL in a column; both empty without ``://``, or when it is null.

    The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
    case; the path is what follows up to ``?``, ``#`` or the end.
    """
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    given = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(given, parts, 1), upper, upper.lower()), F.regexp_extract(given, parts, 2)


def decide(rules: list[Rule], host: F.Column, path: F.Column) -> tuple[F.Column, F.Column]:
    """(rule, verdict) of the longest rule that fits, both null where none does. Of rules equally
    long the first by code point counts. The rules are part of the plan: hundreds, not millions."""
    rule = verdict = F.lit(None).cast("string")
    # the last one wrapped around the others is asked first
    for r in sorted(sorted(rules, key=lambda r: r.text, reverse=True), key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return rule, verdict


def _suffix(labels: int) -> F.Column:
    return F.substring_index(_HOST, ".", -labels)


def _entropy(text: F.Column) -> F.Column:
    """Bits per character of the character frequencies of a text."""
    letters = F.filter(F.split(text, ""), lambda c: c != "")
    share = F.transform(F.array_distinct(letters), lambda c: F.size(F.filter(letters, lambda x: x == c)) / F.size(letters))
    return -F.aggregate(F.transform(share, lambda p: p * F.log2(p)), F.lit(0.0), lambda a, b: a + b)


def _ratio(part: F.Column, whole: F.Column) -> F.Column:
    return part / F.greatest(whole, F.lit(1))


FEATURES = [
    "url_length", "host_length", "path_length", "host_labels", "depth", "digits_host", "digits_path", "hyphens_host",
    "entropy_host", "entropy_path", "parameters", "query_length", "fragment", "secure", "suffix1_count", "suffix1_rate", "suffix2_count", "suffix2_rate",
]


def lexical(urls: DataFrame, url: str) -> DataFrame:
    """``urls`` (with the parts of the URL) and its features that need no statistics."""
    u, host, path = F.coalesce(F.col(f"`{url}`"), F.lit("")), F.col(_HOST), F.col(_PATH)
    query = F.regexp_extract(u, r"(?s)\?([^#]*)", 1)
    made = {
        "url_length": F.length(u),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "host_labels": F.size(F.split(host, r"\.")),
        "depth": F.regexp_count(path, F.lit("/[^/]+")),
        "digits_host": _ratio(F.regexp_count(host, F.lit("[0-9]")), F.length(host)),
        "digits_path": _ratio(F.regexp_count(path, F.lit("[0-9]")), F.length(path)),
        "hyphens_host": F.regexp_count(host, F.lit("-")),
        "entropy_host": F.coalesce(_entropy(host), F.lit(0.0)),
        "entropy_path": F.coalesce(_entropy(path), F.lit(0.0)),
        "parameters": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "query_length": F.length(query),
        "fragment": F.contains(u, F.lit("#")),
        "secure": F.startswith(u, F.lit("https://")),
    }
    return urls.withColumns({k: v.cast("double") for k, v in made.items()})


def suffix_statistics(urls: DataFrame, labels: int) -> DataFrame:
    """Per suffix of ``labels`` host labels: how many URLs have it, and the smoothed share of
    blocked ones among its labelled URLs. Covers all URLs."""
    sums = urls.groupBy(_suffix(labels).alias(f"s{labels}")).agg(
        F.count("*").alias("n"), F.sum(F.when(F.col("__block") == 1, 1)).alias("bad"), F.count("__block").alias("known")
    )
    total = F.coalesce(F.col("bad"), F.lit(0))
    return stored(
        sums.select(
            f"s{labels}",
            F.log1p("n").alias(f"suffix{labels}_count"),
            ((total + 1) / (F.col("known") + 2)).alias(f"suffix{labels}_rate"),
        ),
        "suffixes",
    )


def train(rows: DataFrame) -> GBTClassificationModel | float:
    """The trees from featured rows with ``__block`` 0 or 1; where labels are of one kind only, or
    absent, the share of blocked ones (absent: 0)."""
    sample = stored(rows.where("__block IS NOT NULL").orderBy("__order", *FEATURES).limit(SAMPLE).select("__block", *FEATURES), "labelled-urls")
    kinds = {r["__block"]: r["count"] for r in sample.groupBy("__block").count().collect()}
    if len(kinds) < 2:
        return float(next(iter(kinds), 0.0))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample)
    learner = GBTClassifier(featuresCol="features", labelCol="__block", maxIter=TREES, maxDepth=DEPTH, seed=SEED, cacheNodeIds=False)
    return learner.fit(vectors)


def judge(urls: DataFrame, url: str, rules: list[Rule], block: F.Column | None = None, threshold: float = 0.5) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule``, ``verdict`` and ``block_score``.

    ``block`` is the label of a URL: 1, 0, or null where it is not known. A rule's verdict stands;
    the trees judge the others, trained on labelled URLs among these. Null URLs have an empty host.
    """
    added = ("host", "path", "rule", "verdict", "block_score")
    own = [c for c in urls.columns if c.lower() not in added]
    host, path = split_url(url)
    label = F.lit(None).cast("double") if block is None else block.cast("double")
    rule, verdict = decide(rules, F.col(_HOST), F.col(_PATH))
    given = (
        unused(urls.withColumn("__url", F.col(f"`{url}`")).withColumn("__block", label), "rule", "verdict")
        .withColumns({_HOST: host, _PATH: path})
        .withColumns({"rule": rule, "verdict": verdict})
        .withColumn("__order", F.xxhash64("__url"))
    )
    given = given.withColumn("__block", F.when(F.col("rule").isNull(), F.col("__block")))
    # statistics and trees need a few narrow columns
    narrow = stored(given.select("__url", _HOST, _PATH, "__block", "__order", F.col("rule").isNull().alias("__open")), "urls")
    one, two = suffix_statistics(narrow, 1), suffix_statistics(narrow, 2)

    def featured(rows: DataFrame) -> DataFrame:
        rows = rows.withColumns({"s1": _suffix(1), "s2": _suffix(2)})
        return lexical(rows.join(one, "s1", "left").join(two, "s2", "left").drop("s1", "s2"), "__url")

    distinct = narrow.where("__open").select("__url", _HOST, _PATH, "__block", "__order")
    model = train(featured(distinct.where("__block IS NOT NULL")))
    unknown = featured(distinct.select("__url", _HOST, _PATH).distinct())
    if isinstance(model, float):
        scored = unknown.select("__url", F.lit(model).alias("block_score"))
    else:
        vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(unknown.select("__url", *FEATURES))
        scored = model.transform(vectors).select("__url", vector_to_array("probability")[1].alias("block_score"))
    scored = stored(scored.withColumnRenamed("__url", "__scored"), "url-scores")
    out = given.join(scored, F.col("__url").eqNullSafe(F.col("__scored")) & F.col("rule").isNull(), "left")
    return out.select(
        *[F.col(f"`{c}`") for c in own],
        F.col(_HOST).alias("host"),
        F.col(_PATH).alias("path"),
        "rule",
        F.coalesce("verdict", F.when(F.col("block_score") >= threshold, "block").otherwise("allow")).alias("verdict"),
        "block_score",
    )
