"""Extra columns with names that the operators use inside, and texts that once took the square of their length."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from wayfare.llm import decontam, maintext, neighbours, pii


@pytest.fixture(scope="module")
def clashing(spark):
    rng = random.Random(6)
    rows = [(i, " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(40)), 1, "x", 2, "y", "z") for i in range(60)]
    return spark.createDataFrame(rows, "doc_id long, text string, _id int, _label string, id int, _lower string, LOWER string")


def test_votes_do_not_read_other_columns(spark, clashing):
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    plain = clashing.select("doc_id", "text")
    scores = [sorted(map(tuple, neighbours.score(d, neighbours.fit(d, labels, "quality")).collect())) for d in (clashing, plain)]
    assert scores[0] == scores[1] and len(scores[0]) == 60


def test_leaks_keep_all_columns(spark, clashing):
    item = clashing.where("doc_id = 7").select(F.lit(1).alias("item_id"), "text")
    out = decontam.remove_leaks(spark, clashing, item)
    assert out.columns == clashing.columns
    assert {r["doc_id"] for r in out.collect()} == set(range(60)) - {7}
    assert {(r[5], r[6]) for r in out.collect()} == {("y", "z")}


@pytest.mark.parametrize("text", ["a" * 1_000_000, "1" * 1_000_000, "1.2." * 250_000, "a@" * 500_000, "a1-" * 300_000, "+1" * 400_000])
def test_patterns_take_time_in_proportion(text):
    start = time.time()
    pii.base_spans(text)
    assert time.time() - start < 5


def test_patterns_equal_a_plain_search():
    rng = random.Random(1)
    for _ in range(5000):
        text = "".join(rng.choices("ab1.2@-_+ 3%()", k=rng.randint(0, 40)))
        assert pii.base_spans(text) == [(k, m.start(), m.end()) for k in pii.KINDS for m in re.finditer(pii.PATTERNS[k], text)
                                        if pii.valid(k, m.group())], text


def test_spans_apart():
    def plain(found, taken):
        out = []
        for span in sorted(found, key=lambda x: (x[1] - x[2], x[1], x[0])):
            if all(span[2] <= s or e <= span[1] for _, s, e in [*taken, *out]):
                out.append(span)
        return out

    rng = random.Random(2)
    some = lambda k: [("ip", s, s + rng.randint(1, 9)) for s in rng.choices(range(60), k=k)]
    for _ in range(800):
        found, taken = some(rng.randint(0, 8)), some(rng.randint(0, 5))
        assert pii._apart(found, taken) == plain(found, taken)
    start = time.time()
    assert len(pii._apart([("ip", 3 * i, 3 * i + 2) for i in range(100_000)], [])) == 100_000
    assert time.time() - start < 8


def test_deep_nesting():
    start = time.time()
    page = "<div>x</b></section></li>" * 100_000 + "<article><p>" + "the text of it all " * 20 + "</p></article>"
    assert maintext.main_text(page).startswith("the text")
    assert time.time() - start < 20


def test_an_article_stays_whole():
    long = "Some words of it are in a sentence that is long enough to be the text of an article here."
    page = (f"<h1>Title</h1><article><p>Copyright law protects the author of a work.</p><p><a href=x>A sentence that is a link.</a></p>"
            f"<p>{long} <label>More</label> of it.</p><ul><li><a href=1>one</a></li><li><a href=2>two</a></li></ul></article>"
            f"<p>© someone</p>")
    assert maintext.main_text(page).split("\n") == [
        "Title", "Copyright law protects the author of a work.", "A sentence that is a link.", f"{long} More of it."]
