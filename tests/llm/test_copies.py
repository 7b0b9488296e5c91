import hashlib
import random

import numpy as np

from tests.llm.conftest import bag, frame
from wayfare.llm import copies


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    low = lambda i: (i is not None, i or 0)
    return sorted(((i, max(groups[t or ""], key=low), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
                   for i, t in rows), key=repr)


def check(spark, rows, docs):
    got = copies.equal_texts(spark, docs)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    got = got.collect()
    assert sorted((tuple(r[c] for c in (0, 1, 2, 4)) for r in got), key=repr) == brute(rows)
    kept = [r for r in got if r["kept"]]
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    assert len(kept) == len({t or "" for _, t in rows}) == len({r["text_sha256"] for r in kept})


def test_edges(spark, edge_rows, edge_docs, no_docs):
    check(spark, edge_rows, edge_docs)
    assert copies.equal_texts(spark, no_docs).count() == 0 == copies.drop_copies(spark, no_docs).count()


def test_deep_groups(spark):
    """Texts that part only at their last byte, at every level, zeros at the end, copies in several batches."""
    rng = random.Random(1)
    rows = []
    for size in (1, 31, 32, 33, 64, 2079, 2080, 2081, 40_000, 600_000):
        base = "".join(rng.choices("ab\0é", k=size))
        rows += [base, base, base[:-1] + "c", base[:-1] + "\0", base + "\0", base + "\0\0"]
    rows = [(i, t) for i, t in enumerate(rows * 2 + ["hot text " * 20] * 900)]
    rng.shuffle(rows)
    check(spark, rows, frame(spark, rows).repartition(7))


def test_local_partitioning():
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(0, 2, rng.integers(0, 40), dtype=np.uint8)) for _ in range(3000)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    first = {}
    want = [first.setdefault(t, i) for i, t in enumerate(texts)]
    assert copies.radix_leaders(np.frombuffer(b"".join(texts), np.uint8), offsets).tolist() == want


def test_drop_copies(spark):
    docs = spark.createDataFrame([(1, "a", 5), (2, "a", 6), (2, "a", 7), (None, None, 8), (3, "", 9)],
                                 "doc_id long, text string, digest long")
    out = copies.drop_copies(spark, docs)
    assert out.columns == docs.columns
    assert [r[:2] for r in bag(out)] == [(2, "a"), (3, "")]
