"""Recall of the leak search: every planted copy is to be found, for many items, long items and small samples."""

import random

import pytest

from wayfare.llm import decontam

from .conftest import frame

POOL = [f"w{i}" for i in range(6000)]
WEIGHTS = [1 / (i + 20) for i in range(6000)]  # frequent and rare words


def planted(n, shortest, longest, seed=1):
    """Items, a document for each (every third holds a paraphrase) and as many documents without any."""
    rng = random.Random(seed)
    draw = lambda k: rng.choices(POOL, WEIGHTS, k=k)
    items, rows = [], []
    for i in range(n):
        words = draw(rng.randint(shortest, longest))
        items.append((i, " ".join(words) + ". " + " ".join(draw(5)) + "."))
        copy = list(words)
        if i % 3 == 0:
            for k in rng.sample(range(len(copy)), len(copy) // 12):
                copy[k] = rng.choice(POOL)
        rows.append((i, " ".join([*draw(100), *copy]) + "." + items[i][1].split(".")[1] + ".\n" + " ".join(draw(100))))
        rows.append((100000 + i, " ".join(draw(200))))
    return rows, items, {(i, i) for i in range(n)}


def found(spark, rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in decontam.find(spark, frame(spark, rows), bench).collect()}


def test_many_items(spark):
    rows, items, want = planted(600, 20, 60)
    got = found(spark, rows, items)
    assert got == want, f"{len(want - got)} of {len(want)} missed"


@pytest.mark.parametrize("length", [300, 1000])
def test_long_items(spark, length):
    rows, items, want = planted(20, length, length)
    got = found(spark, rows, items)
    assert got == want, f"{len(want - got)} of {len(want)} missed"


def test_sample_decides_nothing(spark, monkeypatch):
    rows, items, want = planted(300, 20, 60)
    for sample in (2000, 20):
        monkeypatch.setattr(decontam, "SAMPLE", sample)
        got = found(spark, rows, items)
        assert got == want, f"{len(want - got)} of {len(want)} missed with a sample of {sample}"
