import pytest

from tests.conftest import SF_DIR

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, n string, key string, h string, rep string"


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs in every column, empty, blank and very long texts, repeated rows, clashing column names."""
    prose = "\n".join(" ".join(f"w{i * 7 % 101}x{j}" for j in range(12)) for i in range(9))
    long = "a" * 1_200_000 + " " + " ".join(f"word{i}" for i in range(60_000))
    rows = [
        (1, prose, "en", "s"),
        (1, prose, "en", "s"),
        (2, prose, None, None),
        (3, None, "fr", "s"),
        (4, "", "fr", None),
        (5, " \n\t ", "de", "s"),
        (6, long, "en", "s"),
        (None, prose + " end", "en", "s"),
        (None, None, None, None),
        (7, "one", "en", "s"),
        (8, "123 !!", "es", "s"),
        (9, "äöü ß 😀 \x00 x", "de", "s"),
        (10, prose.replace("w7x3", "other"), "en", "s"),
    ]
    return spark.createDataFrame([(*r, len(r[1]) if r[1] else None, "s", "n", "k", "h", "r") for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
