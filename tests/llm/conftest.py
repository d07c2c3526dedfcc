import pytest


#: Names that operators use for columns of their own, beside the ones they read.
CLASHING = "_key string, _id long, _size long, _token long, _copies long, _row string, size long, score double, copies long, component long, kept string, _times string, _label int"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing extra columns."""
    long_ = "one more of the words in a very long text " * 3000
    prose = "The quick brown fox jumps over the lazy dog and then it sleeps under the old tree all day long."
    rows = [
        (1, prose, "en", "a", 5), (2, prose, "en", "a", 5), (2, prose, "en", "a", 5), (3, "", "de", "b", 0),
        (4, None, "fr", None, None), (5, long_, None, "c", 7), (6, long_ + "end", "es", "c", 7), (None, prose + " Yes.", "en", "a", 1),
        (8, " \n\t ", "en", "a", 3), (9, "word", None, None, None), (9, "another text, same id", "en", "b", 1), (None, None, None, None, None),
        (-3, "é ñ ü 中文 \U0001f600    x", "de", "\U0001f600", 2), (12, "1234 5678", "en", "Z", 1),
        (13, "one two three four", "en", "Z", 1), (14, "ONE two three FOUR", "en", "Z", 1), (15, "a\n\nb\nc\nd\nb\nc\n", "en", "z", 1),
    ]
    extra = [None] * len(CLASHING.split(","))
    return spark.createDataFrame([(*r, *extra) for r in rows], f"{COLUMNS}, {CLASHING}")


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], f"{COLUMNS}, {CLASHING}")
