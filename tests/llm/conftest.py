from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, _k1 int, shard string, score int"


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdefghiklmnoprstuv") for _ in range(rng.randint(2, 7))) for _ in range(words))


def text_of(rng: random.Random, lines: int) -> str:
    return "\n".join(sentence(rng, rng.randint(3, 20)) + "." for _ in range(lines))


def doc_rows():
    """Documents with nulls, empty and very long texts, ties, repeated rows and a hot source."""
    rng = random.Random(7)
    rows = [(i, text_of(rng, rng.randint(1, 8)), rng.choice(["en", "de"]), rng.choice(["a", "a", "b", "c"])) for i in range(60)]
    rows += [
        (60, None, "en", "a"),
        (61, "", None, "b"),
        (62, rows[3][1], "en", "c"),
        (63, rows[3][1], "de", None),
        (64, sentence(rng, 30_000), "en", "a"),
        (64, "same id, other text", "en", "a"),
        (None, "no id at all here", None, None),
        (None, None, None, None),
        (65, "repeated row", "en", "b"),
        (65, "repeated row", "en", "b"),
        (66, "\n\n  \n", "en", "b"),
        (67, "one", "fr", "é"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), 1, 2, "x", 3) for i, t, lang, s in rows]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(doc_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def some_docs(spark):
    """Documents with ids and texts only, as a function of the rows."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long",
        )

    return make
