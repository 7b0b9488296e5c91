import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tests.llm.conftest import frame
from wayfare.llm import periodic


def brute_runs(words, least=6, times=4):
    """All maximal stretches, from their definition."""
    n, found = len(words), []
    for q in range(1, n):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j + q - i
            if size >= max(least, times * q) and not any(
                    all(words[x] == words[x + d] for x in range(i, i + size - d)) for d in range(1, q)):
                found.append((i, size, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, plant=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    g = h // 10
    if plant and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    text = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in runs).encode()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest())


def repetitive(rng, n):
    out = []
    while len(out) < n:
        unit = [rng.choice("abc") for _ in range(rng.randint(1, 7))]
        out += unit * rng.choice([1, 1, 2, 4, 5, 9]) + unit[:rng.randint(0, len(unit))]
    return out[:n]


@pytest.mark.parametrize("least,times", [(6, 4), (2, 2), (5, 3), (9, 4)])
def test_runs_of_equal_brute_force(least, times):
    rng = random.Random(least)
    texts = [repetitive(rng, rng.randint(0, 90)) for _ in range(120)] + [["a"] * k for k in (0, 1, 5, 6, 300)]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    words = np.array([ord(w) for t in texts for w in t], np.int64)
    got = list(zip(*(x.tolist() for x in periodic.runs_of(words, bounds, least, times))))
    assert got == [(t, *r) for t, text in enumerate(texts) for r in brute_runs(text, least, times)]


def test_digests(spark, edge_rows):
    rng = random.Random(3)
    rows = edge_rows + [(i, " ".join(repetitive(rng, rng.randint(1, 120)))) for i in range(100, 260)]
    rows = [r for r in rows if len(r[1] or "") < 50_000] + [(i, "a b c d e f g h " * 20 + "end") for i in range(300, 330)]
    got = periodic.digest_runs(frame(spark, rows), rewrite=periodic.planted_tail)
    assert got.columns[:6] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((brute_row(*r) for r in rows), key=repr)


def test_find_and_collapse(spark, no_docs):
    rows = [(1, "x a b a b a b a b y"), (2, "no run here"), (3, None), (3, "z " * 7)]
    docs = frame(spark, rows)
    assert sorted(map(tuple, periodic.find_runs(docs).collect())) == [(1, 1, 8, 2), (3, 0, 7, 1)]
    assert sorted(map(tuple, periodic.collapse(docs).collect())) == [(1, "x a b y"), (2, "no run here"), (3, ""), (3, "z")]
    assert periodic.find_runs(no_docs).count() == 0 and periodic.digest_runs(no_docs).count() == 0


def test_long_texts(spark):
    rows = [(1, "the " * 200_000), (2, " ".join(str(i % 1000) for i in range(100_000))), (3, " ".join(map(str, range(100_000))))]
    got = {r[0]: tuple(r)[1:6] for r in periodic.digest_runs(frame(spark, rows)).collect()}
    assert got == {1: (1, 0, 200_000, 1, 200_000_000), 2: (1, 0, 100_000, 1000, 100_000), 3: (0, None, None, None, None)}
