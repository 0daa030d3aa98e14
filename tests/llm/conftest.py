import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents from (doc_id, text) pairs."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and blank texts, repeated rows, one id with two texts, a very long text."""
    long = " ".join(f"w{i % 7919}x{i}" for i in range(60_000))
    return make_docs([(1, None), (2, ""), (3, " \n\t "), (4, "one two three four five six seven"),
                      (4, "one two three four five six seven"), (4, "another text under the same id"),
                      (None, "a text without an id"), (5, long), (6, "one two three four five six seven")])


def clashing(df, *names):
    from pyspark.sql import functions as F

    for n in names:
        df = df.withColumn(n, F.lit("extra"))
    return df


@pytest.fixture(scope="session")
def rng():
    import numpy as np

    return np.random.default_rng(5)


@pytest.fixture(scope="session")
def words(rng):
    """n random words from a vocabulary of 3,000."""
    def make(n):
        return [f"{'bcdfgklmnprst'[i % 13]}{'aeiou'[i % 5]}{'nrstlm'[i % 6]}{i}" for i in rng.integers(0, 3000, n)]

    return make
