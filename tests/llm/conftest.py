from __future__ import annotations

import random

import pytest
from pyspark.sql import Row

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, score double, cuts string, tile int"


def row(doc_id, text, lang="en", source="s", **more):
    return Row(doc_id, text, lang, source, len(text or ""), -1, 0.5, "x", 7)


@pytest.fixture(scope="session")
def prose():
    """Sentence maker: invented words, the same for a seed."""

    def make(seed: int, words: int, syllables="the of ing er an re th on at es ti or".split()) -> str:
        rng = random.Random(seed)
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(words))

    return make


@pytest.fixture(scope="session")
def docs(spark, prose):
    """Awkward rows: null, empty, blank, short, very long, repeated, copied, near-copied, spliced, clashing columns."""
    long = prose(1, 6000)
    base = prose(2, 120)
    near = base.split()
    near[60] = "changed"
    passage = prose(3, 30)
    rows = [
        row(1, None), row(2, ""), row(3, " \n\t "), row(4, "one"), row(5, "one"), row(6, "One two three"),
        row(7, long), row(8, long), row(9, base), row(10, base), row(11, " ".join(near)), row(11, " ".join(near)),
        row(12, f"{prose(4, 60)} {passage} {prose(5, 60)}"), row(13, f"{prose(6, 40)}\n{passage}\t{prose(7, 50)}"),
        row(14, "spam " * 200), row(15, prose(8, 90), None, None), row(16, "###!! " * 60),
        row(17, prose(9, 25) + "\n" + "same line here\n" * 6), row(18, "é漢字 ß \x1f x" * 30, "xx"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
