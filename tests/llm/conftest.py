"""Small tables with the awkward cases every operator must take."""

from __future__ import annotations

import pytest

from barograph.llm.tables import ship_code

LAYOUT = "doc_id long, text string, lang string, source string, n_chars long"
LONG_TEXT = "\n".join(" ".join(f"word{(k * n) % 977}" for k in range(400)) for n in range(1, 60))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today."),
    (3, "The quick brown fox jumps over the lazy dog near the river bank now!"),
    (4, None),
    (5, ""),
    (6, "  \n\t \n"),
    (None, "A text whose id is null, with five words and more."),
    (7, LONG_TEXT),
    (8, "Line one has five words here.\nLine one has five words here.\nshort\nshort"),
    (8, "Line one has five words here.\nLine one has five words here.\nshort\nshort"),
    (9, "naïve café — mixed 漢字 and emoji 😀 end  two  blanks \n next"),
    (10, "<|endoftext|> inside a text <|endoftext|>"),
]


@pytest.fixture
def docs(spark):
    """Documents with nulls, empty and long texts, copies, repeated rows, a clashing name."""
    ship_code(spark)
    rows = [(key, text, None, "src", 0, "kept", 7) for key, text in TEXTS]
    return spark.createDataFrame(rows, f"{LAYOUT}, component_id string, size int")


@pytest.fixture
def no_docs(docs):
    return docs.limit(0)


def as_tuples(rows):
    return sorted((tuple(row) for row in rows.collect()), key=repr)
