from __future__ import annotations

import pytest
from pyspark.sql import DataFrame

from claimgrade.llm.common import tune

SMALL = "/root/testdata/sf0.001"

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small(spark):
    tune(spark)
    return SMALL


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty texts, white space only, short, repeated, long, foreign and odd ones."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    long = " ".join(words[(i * i + i // 7) % 10] + str(i % 13) for i in range(30_000))
    return [
        None,
        "",
        " \t\n",
        "one",
        "one two",
        "One  TWO three",
        "one two three",
        "one two three",
        "a" * 40_000,
        long,
        long + " end",
        "日本語の文章 ça va ÉTÉ 🙂",
        "x y z w\x1c1",
        "12345 67890 -- !!",
        "<|endoftext|> and <|endo",
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts) -> DataFrame:
    """``odd_texts`` as documents with nulls in every column and columns with clashing names."""
    tune(spark)
    rows = [(i, t, [None, "en", "fr"][i % 3], [None, "s1", "s2"][i % 3], i, "own", 1.5) for i, t in enumerate(odd_texts)]
    rows += [(3, "one", "en", "s1", 0, "own", 2.5), (None, "one two three", None, None, None, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCUMENTS + ", Size string, score double")


@pytest.fixture(scope="session")
def no_docs(spark) -> DataFrame:
    tune(spark)
    return spark.createDataFrame([], DOCUMENTS)


def rows_of(path_or_df) -> list[dict]:
    return [r.asDict(recursive=True) for r in path_or_df.collect()]
