import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, cid long, bucket int, content string"


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows and columns whose names clash."""
    long = " ".join(f"word{i % 977}x{i % 31}" for i in range(30000))
    rows = [(1, "The quick brown fox jumps over the lazy dog", "en"), (2, "the  quick brown\tfox jumps over the lazy dog", "en"),
            (2, "the  quick brown\tfox jumps over the lazy dog", "en"), (3, None, None), (4, "", "en"), (5, " \n\t ", "de"),
            (None, "no id here, but some words all the same", "fr"), (None, None, None), (6, long, "en"), (7, long + " tail", "en"),
            (8, "a" * 5000, None), (9, "ßtraße élan 123 !!! <|endoftext|> don't", "de"), (10, "12345 67890", "es"),
            (11, "one", "en"), (12, "one two", "en"), (13, "ONE TWO", "fr")]
    return spark.createDataFrame([(i, t, v, None, 0, 7, 1, "z") for i, t, v in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
