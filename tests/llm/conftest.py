import random

import pytest

SCHEMA = "doc_id long, text string, key long, name string, id string, part int, gram long, root long, start int"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 7, "x", "y", 3, 4, 5, 6) for i, t in rows], SCHEMA)


def words(rng, n, pool="abcdefgh"):
    return " ".join("".join(rng.choices(pool, k=rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and blank texts, repeated rows, copies, near copies, shared runs, a long text."""
    rng = random.Random(5)
    base = words(rng, 120)
    shared = words(rng, 60)
    near = base.split()
    near[40] = "changed"
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, base), (5, base), (6, " ".join(near)), (6, " ".join(near)),
            (7, words(rng, 50) + " " + shared + " " + words(rng, 30)), (8, shared + "\n" + words(rng, 80)),
            (9, words(rng, 20000)), (None, words(rng, 40)), (10, "one two three"), (11, "One two THREE"), (12, "a b"),
            (13, "the end " * 60), (14, words(rng, 45) + "  x\r\n\x0b" + words(rng, 10)), (15, base.upper()),
            (16, "<|endoftext|> it's 中文 😀 ▁ ½   é"), (17, "x" * 3000)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return frame(spark, edge_rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
