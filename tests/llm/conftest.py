import random

import pytest
from pyspark.sql import types as T

FIELDS = [
    ("doc_id", T.LongType()),
    ("text", T.StringType()),
    ("lang", T.StringType()),
    ("source", T.StringType()),
    ("n_chars", T.LongType()),
    # Names that the operators use themselves.
    ("size", T.StringType()),
    ("score", T.StringType()),
    ("block_id", T.StringType()),
    ("n_bytes", T.StringType()),
    ("hash", T.StringType()),
    ("Range", T.StringType()),
    ("copy", T.StringType()),
]
SCHEMA = T.StructType([T.StructField(n, t) for n, t in FIELDS])


def awkward_rows():
    rnd = random.Random(7)
    words = ["alpha", "Beta", "gamma", "delta", "élan", "ñandú", "straße", "über", "x", "日本", "😀"]
    prose = [" ".join(rnd.choice(words) for _ in range(n)) for n in (40, 60, 80, 120, 200, 30)]
    texts = [
        (1, prose[0], "en", "a"),
        (2, prose[0], "en", "a"),
        (2, prose[0], "en", "a"),
        (3, prose[1] + "\n" + prose[2], "de", None),
        (3, prose[2], None, "b"),
        (None, prose[1], "de", "b"),
        (None, None, None, None),
        (4, None, "en", "c"),
        (5, "", "en", "c"),
        (6, " \t\n ", None, "c"),
        (7, "x" * 30_000, "en", None),
        (8, "lorem ipsum " * 15_000, "la", "d"),
        (9, prose[3] + " end", "en", "Ä"),
        (10, prose[3], "en", "😀"),
        (11, "one", "en", "a"),
        (12, "Two WORDS", "en", "a"),
        (13, "two words", "en", "a"),
        (-5, prose[4] + " !? 123", "de", "b"),
        (2**62, prose[5] + " \x1c" + prose[4], "fr", "b"),
    ]
    return [(i, t, lang, s, len(t or ""), "1", "2", "3", "4", "5", "6", "7") for i, t, lang, s in texts]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, more columns."""
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
