import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use inside
    "size int, key string, fp string, place int, number int, rank int, value double, lead string, bundle int, spans string"
)


def words(seed: int, count: int, kinds: int = 400) -> str:
    """Seeded words out of a small vocabulary."""
    rng = random.Random(seed)
    return " ".join(f"{'abcdefghij'[k % 10]}{k}" for k in (rng.randrange(kinds) for _ in range(count)))


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty and blank texts, a very long one, ties, repeated rows, near copies."""
    base = words(1, 120)
    rows = [
        (0, base, "en", "a"), (1, base, "en", "b"), (1, base, "en", "b"), (2, base + " one", "en", None), (3, None, None, "a"),
        (4, "", "en", "a"), (5, " \n\t ", None, "B"), (None, words(2, 90), "de", "b"), (None, None, None, None),
        (6, "one", "en", "é"), (7, "one two", "en", "é"), (8, words(3, 20_000), "de", "a"), (9, "Ünï ﬁ 中文 😀 é " + words(4, 60), "fr", "b"),
        (10, words(1, 60) + " x y z " + words(5, 50), "en", "b"), (2**62, words(6, 40), "en", "c"), (-5, words(7, 300), "en", "c"),
    ]
    return [(*row, None if k % 3 else len(row[1] or ""), k, None, "x", k, None, 1, 0.5, "l", 3, "s") for k, row in enumerate(rows)]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
