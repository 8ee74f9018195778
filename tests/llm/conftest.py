import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("id", "key", "n", "size", "part", "kind", "shard", "slot", "score", "root", "hashes", "_text")


@pytest.fixture(scope="session", autouse=True)
def ready(spark):
    from tagloom.llm.scratch import let_workers_import

    let_workers_import(spark)


@pytest.fixture
def table(spark):
    """A table of documents; every other one also has columns named like the operators' own."""

    def make(rows, clashing=False):
        rows = [(r + (None,) * 5)[:5] if isinstance(r, tuple) else (r, None, None, None, None) for r in rows]
        df = spark.createDataFrame(rows, COLUMNS)
        if clashing:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})
        return df

    return make


def sentence(seed, n=40, words=60):
    """Some made-up words in a fixed order."""
    import random

    rng = random.Random(seed)
    letters = "abcdefghijklmnoprstu"
    pool = ["".join(rng.choices(letters, k=rng.randint(2, 8))) for _ in range(words)]
    return " ".join(rng.choices(pool, k=n))


@pytest.fixture
def awkward(table):
    """Nulls everywhere, empty and blank texts, a very long one, repeated rows, ties."""
    text = sentence(1)
    long = " ".join(sentence(k, 400) for k in range(60))
    rows = [
        (1, text, "en", "a", 5),
        (1, text, "en", "a", 5),
        (2, text, None, None, None),
        (3, None, "en", "b", None),
        (4, "", "de", "b", 0),
        (5, " \t\n ", "de", None, 4),
        (None, text, "en", "a", 5),
        (None, sentence(2), "fr", "c", 6),
        (6, long, "fr", "c", len(long)),
        (7, "one two", "en", "a", 7),
        (8, "ONE two", "en", "a", 7),
        (9, "été 漢字 🙂", "xx", "é", 9),
    ]
    return table(rows, clashing=True)
