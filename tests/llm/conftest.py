import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, h int, n double, size string, score string, "
    "fp string, t string, found int, dk string, taken int, contaminated string, held_out int, hits string, copies string"
)


def edge_rows():
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    prose = " ".join(words[(k * k + k // 3) % 10] + str(k % 17) for k in range(60))
    rng = random.Random(1)
    leak = "w0 w1 w4 w9 w16 w25"
    long = "\n".join([leak, *(" ".join(f"w{rng.randrange(9000)}" for _ in range(40)) for _ in range(1500))])
    rows = [
        (1, prose), (2, None), (3, ""), (None, prose + " tail"), (4, long), (4, "another text under the same id here"), (5, prose), (5, prose),
        (6, " \n\t\n"), (7, "é" * 300), (8, "one"), (9, "a " * 400), (10, "password = hunter2hunter2\n" * 3), (None, None),
    ]
    return [(i, t, "en", s, len(t or ""), "x", 1, 0.5, "y", "z", "f", "t", 2, "d", 3, "c", 4, "q", "r") for (i, t), s in zip(rows, ["a", None, "", "b"] * 4, strict=False)]


@pytest.fixture(scope="session")
def edges(spark):
    """Null, empty, blank and very long texts, repeated rows, shared and null ids, and columns with clashing names."""
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_rows(edges):
    return edges.limit(0)
