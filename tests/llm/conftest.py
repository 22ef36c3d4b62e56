import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tidemark.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def spark():
    yield build_session("local[*]", shuffle_partitions=8)


@pytest.fixture
def odd(spark):
    """Documents with nulls in any column, empty and very long texts, ties and repeated rows."""
    rows = [
        (1, "the cat sat on the mat and looked at the dog", "en", "a", 10),
        (2, None, "en", "a", None), (3, "", None, None, 0), (None, "the cat sat", "en", "b", 11),
        (None, None, None, None, None), (4, "Word " * 30000, "en", "b", 150000), (5, "x" * 50000, "en", "c", 50000),
        (6, "the cat sat on the mat and looked at the dog", "en", "a", 10), (6, "the cat sat on the mat and looked at the dog", "en", "a", 10),
        (7, " \t\n\x0b\x0c\r ", "fr", "c", 7), (8, "été \U0001f642 漢字 straße x", "fr", "d", 12), (-9, "the", "en", "d", 3),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], DOCS)
