import pytest

pytest.importorskip("glimmer.llm")

#: doc_id, text, and columns whose names clash with those of results.
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again.\nAnother line that is long enough to be counted here.\nshort", "x", 1, 0.5),
    (2, "The quick brown fox jumps over the lazy dog again and again.\nAnother line that is long enough to be counted here.\nother", "x", 2, 0.5),
    (3, "", "y", 3, None),
    (4, None, "y", None, None),
    (None, "A text without an id, which has some words all the same.", None, 5, 1.0),
    (5, "é é Straße  STRASSE\t\n\n # | & 東京 \x00 <|endoftext|> </turn> don't", "z", 6, 1.0),
    (6, "word " * 9000, "z", 7, 1.0),
    (7, "x" * 40_000, "z", 8, 1.0),
    (8, "one two", "z", 9, 1.0),
    (8, "one two", "z", 9, 1.0),
    (9, "one two", "z", 9, 1.0),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, component_id string, n_tokens long, score double")


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
