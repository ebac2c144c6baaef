import random

import pytest

from netsieve.llm.queries import find_package

COLUMNS = "doc_id long, text string, source string, shard string, size string, slot int, fp string, root int, taken string, kept string, bucket int"


@pytest.fixture(autouse=True)
def package(spark):
    find_package(spark)


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, copies, repeated rows."""
    rng = random.Random(5)
    words = ["tion", "the", "of", "reading", "naïve", "Über", "x", "end.", "a\x1cb"]
    passage = " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(60))
    texts = [
        None, "", "   \n\t", "word", "two words", "a b c d e f g h i j k l", passage, passage + " tail one", "head two " + passage, passage,
        " ".join(["same"] * 90), "Is Is Is " * 40 + passage, "x" * 5000, passage.upper() + "\n" + passage, "　 \u0085 z",
        " ".join(rng.choice(words) for _ in range(30_000)),
    ]
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(texts)]
    rows += [(None, passage, "s0"), (None, None, None), (6, passage, "s0"), (6, passage, "s0"), (40, passage, None), (41, None, "s1")]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "q", "q", 1, "q", 2, "q", "q", 3) for r in odd_rows()], COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
