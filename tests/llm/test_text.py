"""Rules, personal data, main text and quality votes."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF
from wayfare.llm import maintext, neighbours, pii, rules
from wayfare.llm.tagger import Tagger

from .conftest import bag, frame

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    w = WORD.findall(text)
    seen, copies, lines = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            copies += line in seen
            seen.add(line)
    c = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    twice = {i + k for i in range(len(w) - 2) for k in range(3) if c[tuple(w[i:i + 3])] > 1}
    return len(w), sum(map(len, w)), sum(x in rules.SYMBOLS for x in text), copies, len(twice), lines


def verdict(text):
    n, chars, symbols, copies, twice, lines = counts(text)
    base = n < 50 or 100 * twice > 50 * n
    up, low, digits = (len(re.findall(x, text)) for x in ("[A-Z]", "[a-z]", "[0-9]"))
    bad = base or 100 * symbols > 10 * n or 100 * copies > 60 * lines or not 3 * n <= chars <= 12 * n \
        or 100 * up > 40 * (up + low) or 100 * digits > 20 * chars
    return n, chars, symbols, copies, twice, base, not bad


@pytest.mark.parametrize("order", [rules.METHOD_RULES, rules.METHOD_RULES[::-1]])
def test_rules(edge_docs, edge_rows, no_docs, order):
    want = [(i, *verdict(t or "")) for i, t in edge_rows]
    assert bag(rules.count_and_judge(edge_docs, order)) == sorted(want, key=repr)
    assert rules.count_and_judge(no_docs, order).count() == 0


def test_filter_keeps_columns_and_clean_rows(edge_docs, edge_rows, no_docs):
    order = rules.order_rules(edge_docs)
    assert {r.name for r in order} == {r.name for r in rules.RULES}
    kept = rules.filter_documents(edge_docs, order)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted((i, t) for i, t in edge_rows if verdict(t or "")[-1])
    assert rules.filter_documents(no_docs, rules.order_rules(no_docs)).count() == 0


def test_cheap_strict_rules_run_first(spark):
    docs = frame(spark, [(i, "only a few words") for i in range(50)])
    assert rules.order_rules(docs)[0].name in ("few_words", "symbols", "shouting", "word_length", "digits")
    texts = rules.Texts(np.frombuffer(b"a b", np.uint8), np.array([0, 3]))
    assert rules.cascade(texts, rules.RULES).tolist() == [0]
    assert "n_repeat_words" not in texts.made  # the cascade stopped before


PRIVATE = ["mail joe.smith+x@mail.example.com, or a@b.co.", "at 10.20.30.40 and 300.1.1.1 and 1.2.3.4.5",
           "card 4111 1111 1111 1111 or 4111111111111112", "call +1 (942) 555-3625 or +49 30 123456", "é@x.de ü 1@a.b",
           "nothing here", "", None, "key dafbac99949115180e7593de87b4492bcef9890b", "+1 2", "4111-1111-1111-1111+1"]


def test_fixed_patterns(spark):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def fits(kind, found):
        digits = [int(c) for c in found if c in "0123456789"]
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            check = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits[::-1]))
            return 16 <= len(digits) <= 19 and check % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    docs = frame(spark, list(enumerate(PRIVATE)) + [(0, PRIVATE[0])])
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    for i, t in enumerate(PRIVATE):
        spans = [(k, m.start(), m.end()) for k, p in kinds.items() for m in re.finditer(p, t or "") if fits(k, m.group())]
        assert [got[i][f"n_{k}"] for k in kinds] == [sum(s[0] == k for s in spans) for k in kinds]
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[i].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert {x for x in listed.split(",")} <= {x for x in got[i].spans.split(",")}
    assert pii.find(docs.limit(0)).count() == 0


def test_only_windows_with_a_whole_core_are_run():
    """Windows with a few digits alone are left out; what is found in all windows is found in the others too."""
    rng, text = random.Random(6), ""
    for found, _ in pii._examples(400, 5):
        text += found + " " * rng.randint(0, 3) + rng.choice(["12 ", "in 2019, ", "@ ", "1.2.3 ", "no number "]) * rng.randint(0, 4)
    text += " 2020 was the year, p. 17 " * 200
    every = [c * pii.STEP for c in range((len(text) - 1) // pii.STEP + 1)]
    some, chosen = pii._windows(text), pii.learnt_spans(pii.trained(), [text])
    assert set(some) < set(every) and max(some) < len(text) - 26 * 200 + pii.WINDOW
    original, pii._windows = pii._windows, lambda t: every
    try:
        assert pii.learnt_spans(pii.trained(), [text]) == chosen and len(chosen[0]) > 100
    finally:
        pii._windows = original


def test_tagger_learns_and_adds_only_personal_data():
    x, y = pii._labelled(400, 99, pii.TRAIN_LENGTH)
    path = pii.trained().decode(x.T).T
    found = [(set(pii._runs(a)), set(pii._runs(b))) for a, b in zip(y, path)]
    hits = sum(len(a & b) for a, b in found)
    assert hits / sum(len(a) for a, _ in found) > 0.9 and hits / sum(len(b) for _, b in found) > 0.9
    texts = ["x " * 200 + "ring (942) 555-3625 now" + " y" * 100, "on 2023-10-11 at 12:30 version 1.2.3", "plain words"]
    spans = [more for _, more in pii.all_spans(pii.trained(), pa.array(texts))]
    assert [texts[0][a:b] for _, a, b in spans[0]] == ["(942) 555-3625"] and spans[1:] == [[], []]


def test_tagger_gradients():
    x, y = pii._labelled(3, 1, 20)
    t = Tagger(9, hidden=4)
    _, grads = t._gradients(x.T, y.T)
    for name, w in t.weights.items():
        i = np.unravel_index(np.argmax(abs(grads[name])), w.shape)
        before, losses = w[i], []
        for step in (1e-2, -1e-2):
            w[i] = before + step
            losses.append(t._gradients(x.T, y.T)[0])
        w[i] = before
        assert abs((losses[0] - losses[1]) / 2e-2 - grads[name][i]) < 0.02 * abs(grads[name][i]) + 1e-2


def test_mask(spark):
    docs = frame(spark, [(1, "to a@b.co now"), (2, None), (3, "clean"), (1, "to a@b.co now")])
    got = pii.mask(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [(1, "to [EMAIL] now"), (1, "to [EMAIL] now"), (2, None), (3, "clean")]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body class="ad">
<nav><ul><li><a href="/x">Home</a></ul></nav><!-- x --><div class="cookie-notice">We use cookies</div>
<article><header><h1>The   title</h1></header><p>First &amp; <b>bold</b>,<br>same block</p><p>Of.<div class="share">Share</div>
<form><p>Your mail</p></form><aside>More of it</aside><p>Last &eacute; 1 &lt; 2</article>
<section id="comments"><p>A reader says that this is the best of all the things that were ever in the world.</p></section>
<footer>&copy; me</footer></body></html>"""
PLAIN = """<div><h2>Head</h2><p>It was the best of times and it was the worst of times, as the man had said to all of us there.</p>
<p>Short one.</p><p>And it is the end of the story that he had to tell us on the day that they were here.</p>
<p><a href=1>one</a> <a href=2>two</a> <a href=3>three</a></p></div>"""


def test_main_text(spark):
    assert maintext.main_text(PAGE) == "The title\nFirst & bold, same block\nOf.\nLast é 1 < 2"
    text = maintext.main_text(PLAIN).split("\n")
    assert text[0] == "Head" and "Short one." in text and len(text) == 4
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (4, "u", "<article><p>cut off <b"), (5, "u", "<article>a<script>x"),
            (1, "u", PAGE), (6, "u", "<p>" * 5000), (7, "u", "<article><p>&lt;b&gt;")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = {r.page_id: (r.text, r.n_chars) for r in maintext.extract(pages).collect()}
    assert got[2] == got[3] == got[6] == ("", 0) and got[4] == ("cut off", 7) and got[5] == ("a", 1) and got[7] == ("<b>", 3)
    assert maintext.extract(pages).count() == 8 and maintext.extract(pages.limit(0)).count() == 0


def test_quality_votes_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in neighbours.score(docs, neighbours.fit(docs, labels, "quality")).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 and
               r.predicted == (r.score >= 0.3) for i, r in got.items())
    marks = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(a == b for a, b in marks) >= 0.95 * len(marks)


def test_quality_votes_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(4, 1), (9, 0), (13, 0), (14, None), (None, 1), (99, 1)], "doc_id long, quality int")
    scored = neighbours.score(edge_docs, neighbours.fit(edge_docs, labels, "quality")).collect()
    assert len(scored) == edge_docs.count() and all(0 <= r.score <= 1 for r in scored)
    nothing = neighbours.fit(no_docs, labels.limit(0), "quality")
    assert nothing.share == 0.5 and neighbours.score(no_docs, nothing).count() == 0
    assert {r.score for r in neighbours.score(edge_docs, nothing).collect()} == {0.5}
