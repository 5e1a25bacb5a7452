import random

import pytest

#: Names that the operators use themselves.
CLASHING = ["key", "places", "size", "target", "copies", "score", "terms", "node", "band", "component", "recipe", "row", "doc", "label", "rows", "a", "b", "u", "v"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def prose(seed: int, words: int, letters: str = "abcdefghij") -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(words))


@pytest.fixture
def table(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with columns of clashing names."""

    def make(rows):
        filled = [(*r, *(None,) * (4 - len(r)), len(r[1] or ""), *("x" for _ in CLASHING)) for r in rows]
        return spark.createDataFrame(filled, SCHEMA).repartition(3)

    return make


@pytest.fixture
def edges(table):
    """NULLs in any column, empty, blank, short and very long texts, repeated rows, ids and texts."""
    long = prose(1, 20_000)
    return table(
        [
            (1, None, None, None), (2, "", "en", "a"), (3, " \t\n ", None, "a"), (4, "word", "en", None), (5, "12 34", "en", "b"),
            (6, long, "en", "b"), (7, long, "en", "b"), (8, long + " end", "fr", "a"), (9, prose(2, 60), "en", "a"),
            (9, prose(2, 60), "en", "a"), (9, prose(3, 60), "fr", "a"), (None, prose(2, 60), "en", "a"), (None, None, None, None),
            (10, "aé\U0001f600 " * 40, "fr", "c"), (11, "x" * 30_000, None, "c"),
        ]
    )


@pytest.fixture
def nothing(table):
    return table([])
