"""Tables with everything an operator must take: nulls, empty and long texts, ties, repeated rows."""

from __future__ import annotations

import pytest
from tests_words import words

#: Extra columns named like what operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, score int, next string, unit string"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, langs=None):
        """``texts``: list of text, or of (doc_id, text)."""
        rows = []
        for i, t in enumerate(texts):
            key, text = t if isinstance(t, tuple) else (i, t)
            lang = langs[i] if langs else "en"
            rows.append((key, text, lang, None, len(text or ""), "f", 1, None, "u"))
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture(scope="session")
def awkward(make_docs):
    long = words(7, 30_000)
    return make_docs(
        [
            None,
            "",
            "   \n\t ",
            "one",
            "Two words",
            words(1, 60),
            words(1, 60),
            (5, words(1, 60)),
            words(2, 200) + "\n\n" + words(3, 70) + "\n" + words(4, 20),
            (None, words(5, 30)),
            (None, None),
            "x" * 5000 + " ünïcödé 中文 😀 ́",
            long,
            long + " more",
        ]
    )


@pytest.fixture(scope="session")
def nothing(make_docs, awkward):
    return awkward.filter("false")
