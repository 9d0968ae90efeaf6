import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators' own steps use.
CLASHING = ["node", "key", "k", "u", "v", "id", "bucket", "digest", "size", "segment", "__rows", "pattern", "row"]


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(words))


def edge_rows():
    rng = random.Random(4)
    base = prose(rng, 300)
    shared = prose(rng, 60)
    changed = base.split()
    changed[7] = "changed"
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "b", 1), (2, base, "en", "b", 1), (3, " ".join(changed), "en", "a", 1),
        (4, None, None, None, None), (5, "", "en", "a", 0), (6, "", None, None, 0), (None, prose(rng, 80), "en", "a", 1),
        (7, " \t\n\x0b ", "fr", "b", 1), (8, "one", "fr", "b", 1), (9, prose(rng, 90) + " " + shared, "de", None, 1),
        (10, shared + " " + prose(rng, 90), "de", "c", 1), (11, "word " * 3000, "en", "c", 1),
        (12, prose(rng, 30_000), "en", "c", 1), (13, "né́ ▁ x\r\n日本語 \U0001f600\x00", "fr", "c", 1),
        (14, "### *** %%% !!", None, "b", 1), (15, "x" * 5000, "en", "a", 1), (16, shared, "en", "a", 1),
    ]
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names clash."""
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    for c in CLASHING:
        df = df.withColumn(c, F.lit("clash"))
    return df.cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 0), (9, 1, None), (14, 0, 1), (None, 1, 1)],
                                 "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
