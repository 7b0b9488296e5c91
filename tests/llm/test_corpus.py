"""Operators that compare documents, against brute force, and the pipeline."""

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import __spark_entry__ as registered
import check
import corpus_pipeline
from conftest import SF
from wayfare.llm import decontam, jaccard, pii, rules, substrings
from wayfare.llm.graph import components

from .conftest import bag, frame, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def cut(rows, length):
    lists = [WORD.findall(t or "") for _, t in rows]
    runs = collections.Counter(tuple(w[i:i + length]) for w in lists for i in range(len(w) - length + 1))
    out = []
    for (i, _), w in zip(rows, lists):
        gone = {k + j for k in range(len(w) - length + 1) if runs[tuple(w[k:k + length])] > 1 for j in range(length)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length", [35, 5, 2])
def test_repeats(spark, edge_docs, edge_rows, no_docs, length):
    assert bag(substrings.digest_repeats(edge_docs, length)) == cut(edge_rows, length)
    assert substrings.digest_repeats(no_docs, length).count() == 0


def test_repeats_of_loops_and_shifted_runs(spark):
    rng = random.Random(3)
    phrase = words(rng, 12)
    rows = [(i, words(rng, rng.randint(0, 60), "ab") + " " + " ".join([phrase] * rng.randint(0, 9))) for i in range(60)]
    docs = frame(spark, rows).repartition(7)
    assert bag(substrings.digest_repeats(docs)) == cut(rows, 35)
    kept = {r.doc_id: r.text for r in substrings.remove_repeats(docs).collect()}
    assert all(hashlib.sha256(kept[i].encode()).hexdigest() == sha for i, _, _, sha in cut(rows, 35))


def test_factors_point_at_equal_words(spark, edge_docs, edge_rows):
    text = {r.key: r.text for r in substrings._keyed(edge_docs, "doc_id", "text").collect()}
    for r in substrings.factors(edge_docs).collect():
        a, b = (WORD.findall(text[k])[s:s + r.n + 34] for k, s in ((r.key, r.start), (r.ref_key, r.ref_start)))
        assert a == b and len(a) == r.n + 34


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def groups(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and 100 * k >= 75 * (len(sets[i]) + len(sets[j]) - k):
                parent[top(i)] = top(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[top(i)] = min(low.get(top(i), d), d)
    return sorted(((d, len(s), low.get(top(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def test_near_copies(spark, edge_docs, edge_rows, no_docs):
    assert bag(jaccard.near_copies(spark, edge_docs)) == groups(edge_rows)
    assert jaccard.near_copies(spark, no_docs).count() == 0


@pytest.mark.parametrize("per_row", [8, 0])
def test_near_copies_of_many_variants(spark, monkeypatch, per_row):
    """Chains of variants around the threshold: no link may be lost, whichever way finds it."""
    monkeypatch.setattr(jaccard, "PAIRS_PER_ROW", per_row)
    rng = random.Random(8)
    rows = []
    for family in range(4):
        base = words(rng, 90).split()
        for k in range(30):
            w = list(base)
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(90)] = words(rng, 1)
            rows.append((len(rows), " ".join(w)))
    assert bag(jaccard.near_copies(spark, frame(spark, rows))) == groups(rows)


def test_one_of_each(spark, edge_docs, edge_rows):
    kept = jaccard.one_of_each(spark, edge_docs)
    want = {(d, t) for (d, t), (i, _, c) in zip(sorted(set(edge_rows), key=repr), groups(sorted(set(edge_rows), key=repr))) if d == c}
    assert kept.columns == edge_docs.columns
    assert collections.Counter((r.doc_id, r.text) for r in kept.collect()) == collections.Counter(
        {(d, t) for d, t in want} | {(d, t) for d, t in edge_rows if d is None})


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(35)]
    parent = {x: x for e in edges for x in e}
    for _ in parent:
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    got = dict(components(spark, spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {x: parent[x] for a, b in edges for x in (a, b) if a != b}


def leak_case(spark):
    rng = random.Random(4)
    items = [(i, words(rng, rng.randint(15, 50), "abcdefghijklmnop").capitalize() + ". " + words(rng, 5, "abcdefghijklmnop") + ".") for i in range(30)]
    rows, want = [], set()
    for d in range(200):
        text = words(rng, rng.randint(0, 300), "abcdefghijklmnop")
        if d % 5 == 0:
            i, leak = items[rng.randrange(30)]
            w = leak.split()
            if d % 10 == 0:  # a paraphrase: some words dropped or changed
                for _ in range(len(w) // 12):
                    w[rng.randrange(len(w) - 5)] = "other"
            text = text + "\n" + " ".join(w).upper() + "!\n" + words(rng, rng.randint(0, 100), "abcdefghijklmnop")
            want.add((d, i))
        rows.append((d, text))
    return rows + [(900, None), (901, ""), (None, "x")], items, want


def test_leaks_and_paraphrases(spark):
    rows, items, want = leak_case(spark)
    docs = frame(spark, rows)
    bench = spark.createDataFrame(items + [(77, None), (78, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.find(spark, docs, bench).collect()}
    assert set(got) <= want and len(set(got)) >= 0.95 * len(want)  # exact pairs; recall against all planted ones
    assert all(r.share >= decontam.SAME and r.cosine >= decontam.COSINE for r in got.values())
    clean = decontam.remove_leaks(spark, docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - {d for d, _ in got}


def test_leaks_edges(spark, no_docs, edge_docs, monkeypatch):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontam.find(spark, edge_docs, bench).count() == 0
    assert decontam.remove_leaks(spark, edge_docs, bench).count() == edge_docs.count()
    rows, items, want = leak_case(spark)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.find(spark, no_docs, bench).count() == 0
    whole = {(r.doc_id, r.item_id) for r in decontam.find(spark, frame(spark, rows), bench).collect()}
    monkeypatch.setattr(decontam, "ITEMS", 11)  # several blocks
    parts = {(r.doc_id, r.item_id) for r in decontam.find(spark, frame(spark, rows), bench).collect()}
    assert len(whole ^ parts) <= 1 and parts <= want


def test_common_subsequence():
    a, b = np.array([1, 2, 3, 4, 5]), np.array([9, 1, 3, 2, 4, 4, 5])
    assert decontam.common_subsequence(a, b, np.ones(5)) == 4
    assert decontam.common_subsequence(a, b[:0], np.ones(5)) == 0


@pytest.mark.parametrize("name", ["op2_quality_rules", "op4_substrings", "op7_ngram_jaccard"])
def test_oracle(spark, name):
    text, ok, _ = check.compare(spark, check.connect(SF), name, registered.queries()[name], registered.oracle_sql()[name], SF)
    assert ok, text


def test_pipeline(spark):
    """Each stage against brute force over what the stage before has kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    kept = {}
    for i, t in rows.items():
        texts = rules.Texts(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
        if not any(r.rejects(texts)[0] for r in rules.RULES):
            kept[i] = t
    kept = {i: kept[i] for i, _, c in groups(list(kept.items())) if i == c}

    def plain(t):
        return " " + " ".join(re.findall(r"[A-Za-z0-9\x80-\U0010ffff]+", t.lower())) + " "

    items = [plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {i: t for i, t in kept.items() if not any(x in plain(t) for x in items)}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {}
    for i, t in kept.items():
        text = pii.masked(t, pii.base_spans(t))
        want[i] = hashlib.sha256(library.decode(library.encode(text)).encode()).hexdigest()
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == want
