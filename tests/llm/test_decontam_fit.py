"""The axes of the leak search come from the passages of all documents, not of some."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wayfare.llm import decontam
from wayfare.llm.words import Words, slices

from .conftest import frame


def counts_of(block, texts):
    """Counts of the words of every passage of the texts, from the words themselves."""
    place = {h: i for i, h in enumerate(block.vocabulary.tolist())}
    rows = []
    for words in decontam._words(texts):
        room = max(len(words) - decontam.PASSAGE, 0)
        starts = [*range(0, room, decontam.STEP), room] if len(words) else []
        for a in starts:
            rows.append(np.zeros(len(place)))
            for h in words[a:a + decontam.PASSAGE].tolist():
                if h in place:
                    rows[-1][place[h]] += 1
    return np.array(rows).reshape(-1, len(place))


@pytest.mark.parametrize("wide", [decontam.WIDE, 0])
def test_products_over_every_passage(wide):
    rng = np.random.default_rng(2)
    block = decontam.read_block([(0, " ".join(f"w{i}" for i in range(20)))])
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 30, n)) for n in (0, 1, 5, 31, 32, 33, 39, 40, 41, 64, 257, 0, 90)]
    q = rng.standard_normal((20, 6)).astype(np.float32)
    products = decontam.Products(q, wide)
    for _, buf, offsets in slices(pa.array(texts), 700):
        words = Words(buf, offsets, decontam.WORDY)
        products.add(words, block.table().find(words.hashes()))
    a = counts_of(block, texts)
    assert np.allclose(products.sums(), a.T @ (a @ q), rtol=1e-4, atol=1e-3)


def test_axes_hold_what_any_part_of_the_documents_holds(spark):
    """A hash of the id once chose half of 4200 documents for the fit; here the other half has a theme of its own."""
    ids = spark.range(4200).select("id", (F.pmod(F.xxhash64("id"), F.lit(2)) == 0).alias("chosen")).collect()
    rng = np.random.default_rng(4)
    items = [(i, " ".join(f"w{j}" for j in range(8 * i, 8 * i + 8))) for i in range(5)]
    rows = [(r.id, " ".join(["w1 w2 w3" if r.chosen else "w30 w31", *(f"w{j}" for j in rng.integers(0, 40, 6))])) for r in ids]
    docs = frame(spark, rows)
    block = next(decontam.fitted_blocks(spark, decontam._texts(docs, "doc_id", "text"),
                                        spark.createDataFrame(items, "item_id long, text string"), "item_id", "text"))
    a, own = counts_of(block, [t for _, t in rows]), decontam._own_passages(block).astype(float)
    df = (a > 0).sum(axis=0)  # one passage a document
    assert np.allclose(block.idf, np.log(4201 / (1 + df)) + 1e-3)
    g = (a.T @ a + own.T @ own * (len(a) / len(own))) * np.outer(block.idf, block.idf)
    want = np.linalg.eigh(g)[1][:, ::-1][:, :3]
    assert np.allclose(np.abs((want * block.axes[:, :3]).sum(axis=0)), 1, atol=1e-3)


def test_recall_does_not_hang_on_the_size_of_the_vocabulary(spark, monkeypatch):
    """Pairs of words in a table and passages one by one lead to the same rows."""
    rng = np.random.default_rng(6)
    items = [(i, " ".join(f"w{j}" for j in rng.integers(0, 900, 25))) for i in range(60)]
    rows = [(i, " ".join([*(f"w{j}" for j in rng.integers(0, 2000, 80)), items[i % 60][1]])) for i in range(120)]
    got = []
    for wide in (decontam.WIDE, 0):
        monkeypatch.setattr(decontam, "WIDE", wide)
        out = decontam.find(spark, frame(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
        got.append(sorted((r.doc_id, r.item_id) for r in out.collect()))
    assert got[0] == got[1] == [(i, i % 60) for i in range(120)]
