from __future__ import annotations

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tests_llm import SCHEMA  # noqa: E402

# Columns named as inside the operators: they must neither clash nor matter.
EXTRA = ["size", "words", "cell", "order", "v", "shard", "slot", "kept", "node", "value", "label", "token", "rate", "target", "_source", "_group"]


def prose(seed: int, n: int) -> str:
    """Words that no two seeds share in the same order."""
    draw = random.Random(seed)
    return " ".join(draw.choice("abcdefghij") + draw.choice("aeiou") + str(draw.randrange(300)) for _ in range(n))


@pytest.fixture(scope="session")
def awkward_rows():
    """Nulls in any column, empty and blank and very long texts, repeated rows and ids."""
    long = "\n".join(prose(i, 50) for i in range(2000))
    return [
        (1, prose(1, 80), "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0), (4, " \t\n\u000b ", "en", None, 4),
        (None, prose(5, 60), "en", "b", 5), (None, None, None, None, None), (6, long, "en", "a", len(long)),
        (7, prose(7, 70), "en", "b", 1), (7, prose(7, 70), "en", "b", 1), (8, prose(7, 70), "en", "b", 1),
        (9, prose(9, 90), "en", "c", 1), (9, prose(10, 90), "en", "c", 1), (11, "one", "en", "", 3), (12, "É ß 日本 😀", "de", "d", 8),
    ]


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(awkward_rows, SCHEMA)
    return df.select("*", *[F.lit("x").alias(name) for name in EXTRA])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def given(documents):
    return documents.orderBy("doc_id").collect()

