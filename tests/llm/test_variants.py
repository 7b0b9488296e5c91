import random
import re
import zlib

from tests.llm.conftest import frame
from wayfare.llm import variants


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i:] == b[i + 1:] or (len(a) == len(b) and a[i + 1:] == b[i + 1:])


def brute_counts(rows):
    n = {}
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] = n.get(run, 0) + 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def brute_groups(n):
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    rows = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(rows, key=repr)


def result(spark, docs):
    return sorted(map(tuple, variants.group_variants(spark, variants.count_words(docs, damage=31)).collect()), key=repr)


def test_edges(spark, edge_rows, edge_docs, no_docs):
    assert result(spark, edge_docs) == brute_groups(brute_counts(edge_rows))
    assert result(spark, no_docs) == []


def test_variants_equal_brute_force(spark):
    rng = random.Random(11)
    words = ["".join(rng.choices("abÉé", k=rng.randint(7, 9))) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "ÿ" * 400]
    words += [w[:k] + rng.choice("abc") * rng.randint(0, 1) + w[k + 1:] for w in words for k in rng.sample(range(7), 3)]
    weight = [rng.choice([1, 2, 3, 30, 400]) for _ in words]
    rows = [(i, " ".join(rng.choices(words, weight, k=400)) + " Straße7 naïveté_X") for i in range(60)]
    want = brute_groups(brute_counts(rows))
    assert result(spark, frame(spark, rows)) == want
    assert any(r[1] and r[1] != r[2] for r in want) and sum(r[4] for r in want) > 200


def test_all_pairs_of_short_words(spark):
    rng = random.Random(4)
    words = {"".join(rng.choices("ab", k=rng.randint(1, 6))) for _ in range(300)} | {"a", "b", "ab" * 300, "ab" * 299 + "a"}
    got = variants.neighbours(spark, spark.createDataFrame([(w, 1) for w in words], "word string, n long"))
    want = sorted((a, b, 1) for a in words for b in words if one_edit(a, b))
    assert sorted(map(tuple, got.collect())) == want


def test_chains(spark):
    counts = [("aaaaaaa" + "b" * k, 10 ** (8 - k)) for k in range(8)]
    out = variants.group_variants(spark, spark.createDataFrame(counts, "word string, n long")).collect()
    assert {r["root"] for r in out} == {"aaaaaaa"}
