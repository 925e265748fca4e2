import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from prose import prose  # noqa: E402

from snapledger.llm.shipping import ship_package  # noqa: E402


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


SCHEMA = """doc_id long, text string, lang string, source string, n_chars long, n long, part long, block long,
    row long, size long, content string, `start` long, known long, node long, guest int, `range` int, shard int,
    label double, vector array<double>, rep long, h long, chunk long, number int, length int, row_hash long"""


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty, blank and very long texts, repeats, and columns with the operators' own names."""
    long = prose(30_000, 1)
    rows = [
        (1, prose(50, 2), "en", "b"),
        (2, prose(50, 2), "en", "a"),
        (3, "", "en", "a"),
        (4, None, None, None),
        (5, " \t\n ", "de", "a"),
        (6, long, "en", "b"),
        (7, long + " end", "en", "c"),
        (8, "word", "fr", None),
        (9, "a <|endoftext|> b  c\n\n d", "en", "c"),
        (10, "中文 字 \U0001f600 ́x \x1c y", "zh", "c"),
        (11, prose(60, 3), "en", "a"),
        (11, prose(60, 3), "en", "a"),
        (None, prose(70, 4), "en", "b"),
        (None, None, None, None),
        (None, None, None, None),
        (12, "the " * 200, "en", "b"),
    ]
    rest = SCHEMA.count(",") + 1 - 4
    return spark.createDataFrame([r + (None,) * rest for r in rows], SCHEMA).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
