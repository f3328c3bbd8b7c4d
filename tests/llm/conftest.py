from __future__ import annotations

import pytest

#: Texts that are null, empty, white space, long, repeated or odd.
EDGE_TEXTS = [
    None, "", " ", "\n", "  \n\n  a", "a", "A", "the cat  sat\non   the mat ", "the cat  sat\non   the mat ", " x  y",
    "don't we'll  I'VE 123 45x _y_ \t\t z", "日本語のテキスト 🙂🙂 é ß ́", "<|endoftext|> <s>", "word " * 3000, "x" * 5000, "\x00\x1f\x85   z",
    "a\r\nb\r\n  c", "!!! ??? ...", "ÀÉÎ Straße ΑΒΓ", "the cat  sat\nON   the mat ",
]


@pytest.fixture(scope="session")
def frame(spark):
    """documents with the given texts, ids from 0 in order unless pairs are given."""
    def make(texts, extra=False):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        if extra:  # columns whose names an operator might use itself
            df = df.selectExpr("doc_id", "text", "'q' AS digest", "1 AS row", "2 AS n", "'k' AS key", "0.5D AS score", "3 AS piece", "'s' AS __key")
        return df
    return make


@pytest.fixture(scope="session")
def edge_texts():
    return EDGE_TEXTS
