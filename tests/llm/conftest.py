from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

PROSE = "the river carried old boats past seven quiet towns while a heron watched from the reeds and nobody spoke of rain"


def base_rows():
    words = PROSE.split()
    return [
        (5, PROSE + ".\n" + " ".join(words[::-1]), "en", "a", 1),
        (3, PROSE + ".\n" + " ".join(words[::-1]), "en", "a", 2),
        (9, "In. " * 60, "en", "a", 3),
        (1, None, None, None, None),
        (2, "", "en", "b", 0),
        (None, "a null id has words too, more than ten of them in one line here", "fr", "b", 5),
        (7, "é ü 日本 😀 a\tb\x0bc\n\n\n", "de", "c", 9),
        (8, "token = \"abcdef0123456789abcdef0123456789\" and key", "en", "c", 9),
        (8, "token = \"abcdef0123456789abcdef0123456789\" and key", "en", "c", 9),
        (11, " ".join(f"w{i % 977}" for i in range(30_000)), "es", "a", 9),
    ]


#: More names that operators use inside.
CLASHING = "_base _secrets _text_ _text_hash _row _mix _mix_hash _mix_tokens _plan plan row file tokens hash epoch _kept_id _part _known _hash n_words _metadata text_hash bands key part root spans".split()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, ties, and columns whose names operators use themselves."""
    df = spark.createDataFrame(base_rows(), SCHEMA)
    return df.selectExpr("*", "'x' AS fp", "'y' AS repetition", "'z' AS secrets", "1 AS mix", "2 AS start", "3 AS _text", "4 AS _id", "5 AS score", "6 AS features", "7 AS lanes", *[f"{i} AS {c}" for i, c in enumerate(CLASHING)])


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
