import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, fp string, key int, _kept int"


def prose(seed, words):
    """Words of invented prose, a few of them frequent."""
    rng = random.Random(seed)
    stops = "the of and to a in is that it for".split()
    make = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "ou", "st", "ti"]) for _ in range(rng.randint(2, 4)))
    return [rng.choice(stops) if rng.random() < 0.3 else make() for _ in range(words)]


@pytest.fixture(scope="session")
def documents(spark):
    """Makes documents, with columns whose names clash with the operators' own, from (doc_id, text) pairs."""

    def make(*rows):
        full = [(i, t, None, "s", None if t is None else len(t), 1, "x", 2, 3) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd(documents):
    """Nulls, empty and long texts, ties, repeated rows and ids."""
    words = prose(5, 400)
    near = [*words[:200], "changed", *words[201:]]
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, " ".join(words)), (5, " ".join(words)), (5, " ".join(words)),
        (6, " ".join(near)), (7, "x" * 30_000), (8, " ".join(prose(8, 20_000))), (9, "été 中文 😀 naïve's"),
        (None, " ".join(words)), (None, None), (10, "a a a a a a"), (11, "line one\nline one\nLINE ONE  \n\nline two"),
    ]
    return documents(*rows)
