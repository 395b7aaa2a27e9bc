import random

import pytest

from zonereach.llm.base import Scratch

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, digest string, key double, size int,"
    " node int, kept_id long, epochs int, shard int, epoch int, fingerprint string"
)


def row(doc_id, text, lang="en", source="a"):
    """A document with extra columns whose names the operators use inside."""
    return (doc_id, text, lang, source, len(text or ""), "x", 0.5, 1, 2, 3, 4, 5, 6, "y")


@pytest.fixture(scope="session")
def cases(spark):
    """Nulls, empty and long texts, ties, repeated rows, copies and near copies."""
    rng = random.Random(5)
    words = [f"{a}{b}" for a in ("ba", "to", "ri", "Me", "lu") for b in ("ka", "no", "s", "ver", "é")]
    text = lambda n: " ".join(rng.choices(words, k=n))
    rows = [row(i, text(rng.randint(1, 60)), rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", "é", None])) for i in range(80)]
    base = text(400)
    rows += [row(100, base), row(101, base), row(102, base + " end"), row(103, base.replace("baka", "bakas", 1)), row(101, base)]
    rows += [row(200, None, None, None), row(201, ""), row(202, " \t\n"), row(203, "x"), row(None, "x"), row(None, None)]
    rows += [row(300, text(9000), "en", "b"), row(301, "A" * 3000, None, "a")]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def scratch(spark):
    return Scratch(spark, "test")
