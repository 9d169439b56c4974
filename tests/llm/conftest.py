import pytest

from tests.conftest import SF001

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, score double, size int, unit string"
LONG = "the long and winding road that leads to your door will never disappear " * 400


def frame(spark, rows):
    """(doc_id, text, source) rows with extra columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, None, s, 7, "x", 0.5, None, "u") for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and white texts, a very long one, repeated rows, equal texts."""
    base = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau. "
    return frame(spark, [
        (None, "a row without an id, and quite a few words in it to be counted here", "a"), (1, None, "a"), (2, "", None), (3, " \n\t ", "b"),
        (4, LONG, "a"), (5, base, "b"), (5, base, "b"), (6, base, None), (7, base + "Omega!", "c"), (8, "One two", "c"), (9, "one TWO", "a"),
        (10, "Größe naïve 漢字 ▁ \U0001F600 x　y", "b"), (11, "x" * 3000, "c"), (12, "b " + LONG, "b")])


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


def pairs(df):
    return sorted(((r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is not None, r[0] or 0))
