import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SENTENCE = "the committee of the town said that it is to meet on the second day of the month and that all are welcome to speak in turn"
LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(60_000))


def odd_documents(spark, extra=()):
    """Nulls, empty and very long texts, repeated rows, and columns whose names operators use inside."""
    rows = [
        (1, None, "en"), (2, "", None), (3, " \n\t ", "en"), (4, SENTENCE, "en"), (5, SENTENCE, "en"), (5, SENTENCE, "en"),
        (None, "a text without any id at all", None), (None, None, None), (6, LONG, "fr"), (7, "..!? 12", "en"), (8, "word", "de"), *extra,
    ]
    df = spark.createDataFrame([(i, t, lang, "src", None if t is None else len(t), 1, "k", 2.0, "x") for i, t, lang in rows],
                               "doc_id long, text string, lang string, source string, n_chars long, name int, text_key string, _gone double, _doc string")
    return df


@pytest.fixture
def odd(spark):
    return odd_documents(spark)


@pytest.fixture
def none(spark):
    return odd_documents(spark).limit(0)
