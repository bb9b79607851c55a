import pytest

DATA = "/root/testdata/sf0.001"

ODD_COLUMNS = "doc_id long, text string, source string, n_chars long, _block string, size string, node int, `key` int, _score string"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls everywhere, empty and blank texts, a very long one, repeated rows."""
    long_text = " ".join(f"w{i % 977} v{i % 1009}" for i in range(30_000))
    base = [(1, "one two three four five six seven", "a"), (2, None, "b"), (3, "", None), (4, " \n\t ", "a"),
            (None, "no id here at all", "a"), (None, None, None), (5, long_text, "b"), (6, "same text of the row", "a"),
            (6, "same text of the row", "a"), (7, "One two THREE four five six seven", "c"), (8, "é ñ 日本 ß", "c")]
    return [(i, t, s, None if t is None else len(t), "x", "y", 3, 4, "z") for i, t, s in base]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """Those rows as documents with extra columns whose names operators may use themselves."""
    return spark.createDataFrame(odd_rows, ODD_COLUMNS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], ODD_COLUMNS)
