import pytest
from pyspark.sql import types as T

from rollout_quality.llm.common import DOCUMENTS, ready

ODD = [
    (1, "Same line of text\nOnly here a b c d e f g", "en", "s1", 40),
    (1, "Same line of text\nOnly here a b c d e f g", "en", "s1", 40),
    (2, "Same  line of\ttext\nOnly here a b c d e f g", "en", None, None),
    (3, None, None, "s1", None),
    (4, "", "en", "s2", 0),
    (5, "", "de", "s2", 0),
    (None, "Same line of text\nOnly here a b c d e f g", None, None, None),
    (6, "long " * 30_000, "en", "s3", 150_000),
    (7, "Ünï çödé ß 'tis <|endoftext|> x_y 12", "fr", "s3", 3),
    (8, "one two three four five six seven eight nine ten eleven", "en", "s1", 5),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, and a column whose name an operator might use."""
    frame = ready(spark).createDataFrame([(*r, 9) for r in ODD], T.StructType([*DOCUMENTS.fields, T.StructField("score", T.LongType())]))
    return frame


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
