import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, score double, keep_id long, h int, c int, n_tokens int"
LONG = "alpha beta gamma delta " * 6000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, repeated rows, and columns named like the operators' own."""
    texts = [
        (1, "one two three four five six seven eight nine ten"),
        (1, "one two three four five six seven eight nine ten"),
        (2, "one  two\tthree four five six seven eight nine ten"),
        (3, None),
        (4, ""),
        (5, " \n "),
        (None, "no identifier here"),
        (None, "no identifier here"),
        (6, LONG),
        (7, LONG + "end"),
        (8, "short"),
        (9, "été 你好 \U0001f600 naïve"),
        (10, "123 456"),
    ]
    rows = [(i, t, "en", None, None, "x", None, 3, 4, 5, 6) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
