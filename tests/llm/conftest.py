import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Texts, or (doc_id, text) or whole rows -> documents."""

    def make(rows):
        whole = []
        for i, row in enumerate(rows):
            row = (i, row) if row is None or isinstance(row, str) else tuple(row)
            whole.append(row + ("en", "src0", len(row[1] or ""))[len(row) - 2 :] if len(row) < 5 else row)
        return spark.createDataFrame(whole, SCHEMA)

    return make


@pytest.fixture(scope="session")
def prose():
    """Invented text: words of a language are built from its own syllables."""
    syllables = {
        "en": "the an ing tion er wh of ed ly sh".split(),
        "de": "sch ung ein der ach keit ver ch zu ü".split(),
        "es": "ción do la ñ qu ez os ar mente ll".split(),
    }

    def write(seed, words=60, lang="en"):
        draw = random.Random(seed)
        return " ".join("".join(draw.choices(syllables[lang], k=draw.randint(1, 3))) for _ in range(words))

    return write


# Null ids and texts, empty and blank texts, one of symbols, a long one, a repeated row.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t\n "),
    (4, "!!! ??? 123"),
    (None, "the an ing tion"),
    (None, None),
    (6, "der ach keit " * 20_000),
    (7, "the an ing tion er wh"),
    (7, "the an ing tion er wh"),
]


@pytest.fixture(scope="session")
def odd(make_docs):
    return make_docs(ODD)
