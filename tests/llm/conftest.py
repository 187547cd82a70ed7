import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n):
    """n invented words; equal seeds give equal words."""
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghilmnorstu") for _ in range(r.randint(2, 8))) for _ in range(n)]


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty, blank, short, long and repeated texts, and letters of two to four bytes."""
    long = " ".join(words(1, 30_000))
    return [None, "", "  \n\t", "one", "One two THREE", " ".join(words(2, 40)), " ".join(words(2, 40)), long, long + " end",
            "été à Köln ß 日本 😀 " * 30, "a" * 5000, "na " * 900, "same same " * 3]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    """The odd texts as documents, with a null id, a repeated row and columns whose names operators use inside."""
    rows = [(i, t, ("en", "fr", None)[i % 3], ("a", "a", "b", None)[i % 4], 0) for i, t in enumerate(odd_texts)]
    rows += [rows[5], (None, odd_texts[5], "en", "a", 0), (None, "nothing like it at all", None, None, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.selectExpr("*", "1 as component", "'x' as tag", "2 as label", "3 as n", "'q' as queue", "4 as part", "5 as kept",
                         "6 as hit", "7 as text_hash", "8 as spans", "9 as score")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
