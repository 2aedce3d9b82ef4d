import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties and repeats, and extra columns whose names
    clash with those the operators use inside."""
    line = "the quick brown fox jumps over a lazy dog and runs far away from here today"
    rows = [
        (1, line + "\n" + line, "en", "s", 5), (2, None, None, None, None), (3, "", "en", "s", 0),
        (4, "   \n\t ", "en", "s", 5), (5, line, "en", "s", 1), (6, line, "en", "s", 1),
        (7, "Grüße aus Köln, 4111 1111 1111 1111 und a.b@c.de", "de", "s", 3),
        (8, " ".join(f"w{i % 977}" for i in range(30000)), "en", "s", 1),
        (9, "one two", "xx", "s", 1), (None, line, "en", "s", 1), (10, "x" * 70000, "en", "s", 1),
        (11, "é" * 300 + " " + line.upper(), "fr", "s", 1), (5, line, "en", "s", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "source as part", "n_chars as n_words", "text as words", "lang as blob").repartition(3)


@pytest.fixture(scope="session")
def small(spark):
    """Rows of the smallest test tables."""
    def read(name, sf="/root/testdata/sf0.001"):
        return spark.read.parquet(f"{sf}/{name}.parquet")
    return read


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
