import pytest

import registry

registry.load_all()  # also sends the package's code along with tasks

NAMES = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, row int, ids string, kept string, size int, component_id string, keep_id int, `class` string, accepted int"


@pytest.fixture
def docs(spark):
    """Frames of (doc_id, text, lang, source), with further columns whose names operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(*r, 1, "x", 2, "y", "z", 3, "c", 4, "k", 5) for r in rows], NAMES)

    return make


@pytest.fixture
def odd_rows():
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
    return [
        (1, "the same words in this short text here", "en", "a"),
        (2, "the same words in this short text here", "en", "b"),
        (3, "The SAME words in this short text here", None, "b"),
        (4, None, None, None),
        (5, "", "en", None),
        (6, " \n\t ", "de", "a"),
        (None, "no id at all but some words to read", "en", "a"),
        (None, None, None, None),
        (7, long, "en", "c"),
        (8, long + " end", "en", "c"),
        (9, "again and again", "de", "a"),
        (9, "again and again", "de", "a"),
        (10, "é中文字 日本 123 ½ <|endoftext|> it's \U0001f600", "zh", "ü"),
        (11, "12345 !!! 678", "en", "a"),
    ]
