import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, key string, b int, _n int"


def row(i, text, source="s0"):
    """A documents row with extra columns whose names the operators use inside."""
    return (i, text, "en", source, None if text is None else len(text), 0.25, "k", 3, 9)


@pytest.fixture(scope="session")
def words():
    r = random.Random(5)
    return ["".join(r.choice(["an", "er", "th", "ion", "re", "st"]) for _ in range(r.randint(1, 4))) for _ in range(400)]


@pytest.fixture(scope="session")
def odd_docs(spark, words):
    """Nulls, empty and very long texts, repeated rows, odd white space, null sources and ids."""
    r = random.Random(7)
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    base = text(120)
    rows = [row(1, None), row(2, ""), row(3, " \n "), row(4, base), row(4, base), row(5, base, None), row(6, text(30_000)),
            row(7, "one two"), row(8, "one two", "s1"), row(None, text(40), "s1"), row(9, "a  b\t\tc \n\n d\x0be\x1cf g é  ß"),
            row(10, "x" * 5000), row(11, "stop <|endoftext|> now"), row(12, base + " extra words at the end", "s2")]
    rows += [row(100 + i, text(r.randint(1, 200)), f"s{i % 3}") for i in range(40)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
