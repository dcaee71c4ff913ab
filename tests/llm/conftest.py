from __future__ import annotations

import random
import re

import pytest

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, id STRING, row INT, key INT, node INT, size INT, h INT, label INT"
SPACE = "[^\x20\x09-\x0d]+"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def spaced(text):
    return re.findall(SPACE, lowered(text))


def prose(seed, n=200, size=300):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


@pytest.fixture(scope="session")
def docs(spark):
    """Documents of a table with other columns of clashing names."""

    def make(*rows):
        full = [(*r, "en", "web")[:4] if len(r) == 2 else r for r in rows]
        return spark.createDataFrame([(i, text, lang, source, len(text or ""), "x", 7, 7, 7, 7, 7, 7) for i, text, lang, source in full], SCHEMA)

    return make


#: Null in any column, empty, blank and short texts, equal rows, equal ids, a long text.
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "One"),
    (6, "two words"),
    (None, prose(6)),
    (8, prose(8)),
    (8, prose(8)),
    (9, prose(8) + " tail"),
    (10, prose(10, 60_000, 5_000)),
    (11, "été " * 50),
    (12, "!!! ??? 123"),
    (13, "a" * 3_000),
]


@pytest.fixture(scope="session")
def odd(docs):
    return docs(*ODD)


@pytest.fixture(scope="session")
def none(docs, spark):
    return spark.createDataFrame([], SCHEMA)
