"""How good the pages are that an entity is cited from: official site, government, directory, social, other.

Classes come from a table of domain suffixes. Each different host is split into its suffixes once, these meet the
table in a hash join, and the longest one wins; the table may be of any size and never enters the plan as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimgrade.operators.geo import lookup

# best first
CLASSES = ("official", "government", "directory", "social", "other", "unreadable")


def host(url: Column) -> Column:
    """The host of a URL in lower case, without user, port and ``www.``; NULL where there is none."""
    found = F.regexp_extract(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:@]+)", 1)
    return F.when(found != "", found)


def citations(entities: DataFrame) -> DataFrame:
    """(unique_id, url, host, own): different URLs of an entity, one row of nulls where it has none; ``own`` says that
    the host is that of its official site."""
    single = F.array("official_website", "facebook_link")
    none = F.array().cast("array<string>")
    every = F.concat(F.coalesce("source_urls_arr", none), F.coalesce("websites_arr", none), single)
    used = F.array_distinct(F.filter(F.transform(every, lambda u: F.trim(u)), lambda u: u.isNotNull() & ~F.lower(u).isin("", "null")))
    rows = entities.select("unique_id", host(F.col("official_website")).alias("site"), F.explode_outer(used).alias("url"))
    named = rows.withColumn("host", host(F.col("url")))
    return named.select("unique_id", "url", "host", F.coalesce(F.col("host") == F.col("site"), F.lit(False)).alias("own"))


def host_classes(hosts: DataFrame, suffixes: DataFrame) -> DataFrame:
    """(host, class) for the different hosts that end in a suffix of ``suffixes`` (suffix, class), whole labels only.

    Of several suffixes the longest counts; a suffix listed twice has its smallest class; case does not matter.
    """
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    split = hosts.where("host IS NOT NULL").select("host").distinct().select("host", F.explode(ends).alias("suffix"))
    known = suffixes.where("suffix IS NOT NULL AND class IS NOT NULL").groupBy(F.lower("suffix").alias("suffix")).agg(F.min("class").alias("class"))
    return split.join(known, "suffix").groupBy("host").agg(F.max_by("class", F.length("suffix")).alias("class"))


def quality(entities: DataFrame, suffixes: DataFrame) -> DataFrame:
    """One row per ``unique_id``: ``n_citations``, a count ``n_<class>`` for each class, and ``best_citation`` (NULL
    without any). A URL without a host is ``unreadable``; the official site's host comes before the table; a class that
    is not one of ``CLASSES`` counts as ``other``. One very frequent host is left to adaptive execution to split."""
    cited = citations(entities)
    # only hosts that the table decides on move; what can be said without it is counted where it stands
    asked = F.col("host").isNotNull() & ~F.col("own")
    named = cited.where(asked)
    listed = F.when(F.col("class").isin("government", "directory", "social"), F.col("class")).otherwise("other")
    told = F.when(F.col("url").isNull(), None).when(F.col("host").isNull(), "unreadable").otherwise("official")
    found = lookup(named.select("unique_id", "url", "host"), host_classes(named, suffixes), "host", "unique_id")
    rows = cited.where(~asked).select("unique_id", "url", told.alias("kind")).unionByName(found.select("unique_id", "url", listed.alias("kind")))
    counts = [F.count_if(F.col("kind") == c).alias(f"n_{c}") for c in CLASSES]
    best = F.coalesce(*[F.when(F.col(f"n_{c}") > 0, c) for c in CLASSES])
    counted = rows.groupBy("unique_id").agg(F.count("url").alias("n_citations"), *counts)
    return counted.withColumn("best_citation", best)
