"""Quality scores by voting of the nearest labelled texts in a latent semantic space.

Terms are byte trigrams, hashed to `TERMS` columns, and the shapes of words (length, case, first and last
kind of character, equal to the word before), `SHAPES` columns. Their document frequencies are counted over
all texts; each of the two blocks of a text's TF-IDF row is scaled to the same length.
The model is fitted on a bounded sample: the `SAMPLE` labelled rows outside the held-out fold with the
smallest hash of their id. A randomised SVD of the sample's TF-IDF rows gives the `RANK` latent axes, and
the sample's own latent vectors with their labels (SAMPLE x RANK floats) go to every task. Each text is
projected, its cosine with every labelled vector is computed in blocks, and the labels of the `VOTERS`
nearest are averaged with the cosines to the power `SHARPNESS` as weights.

Inputs of a score are the text alone; label, language, source and id are not.

Edge cases: a null or empty text, or one without similarity to any labelled text, gets the share of label 1
in the sample; without any labelled row that share counts as one half; null labels are left out; a text
shorter than three bytes has no terms; repeated rows give repeated rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.words import Words, slices

TERMS = 1 << 13
SHAPES = 1 << 8
COLUMNS = TERMS + SHAPES
SAMPLE = 4096
RANK = 64
VOTERS = 15
SHARPNESS = 4
FOLDS = 5
THRESHOLD = 0.3
BLOCK_ROWS = 512


def held_out(id_column: str) -> Column:
    """crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


_KIND = np.full(256, 3, np.uint8)  # lower case, upper case, digit, punctuation
_KIND[97:123] = _KIND[0x80:] = 0
_KIND[65:91] = 1
_KIND[48:58] = 2


def shape_counts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Dense counts (texts, SHAPES) of the shapes of the words of each text."""
    words = Words(buf, offsets)
    owners, h, n = words.owners(), words.hashes(), len(offsets) - 1
    size = words.ends - words.starts
    same = np.zeros(len(h), np.int64)
    same[1:] = (h[1:] == h[:-1]) & (owners[1:] == owners[:-1])
    length = np.minimum(np.log2(np.maximum(size, 1)).astype(np.int64), 3)
    shape = ((_KIND[buf[words.starts]] * 4 + _KIND[buf[words.ends - 1]]) * 4 + length) * 2 + same
    return np.bincount(owners * SHAPES + shape, minlength=n * SHAPES).astype(np.float32).reshape(n, SHAPES)


def term_counts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Dense counts (texts, COLUMNS) of the byte trigrams and word shapes of each text."""
    return np.concatenate([_trigram_counts(buf, offsets), shape_counts(buf, offsets)], axis=1)


def _trigram_counts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    if len(buf) < 3:
        return np.zeros((n, TERMS), np.float32)
    a = buf.astype(np.uint32)
    term = (a[:-2] << 16 | a[1:-1] << 8 | a[2:]) * np.uint32(2654435761) >> np.uint32(32 - 13)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    whole = owner[:-2] == owner[2:]
    cells = owner[:-2][whole] * TERMS + term[whole]
    return np.bincount(cells, minlength=n * TERMS).astype(np.float32).reshape(n, TERMS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows from counts, in place; both blocks of a row have length 1 (or 0)."""
    np.log1p(counts, out=counts)
    counts *= idf
    for part in (counts[:, :TERMS], counts[:, TERMS:]):
        size = np.sqrt(np.einsum("ij,ij->i", part, part))
        part /= np.where(size > 0, size, 1)[:, None]
    return counts


def latent_axes(rows: np.ndarray, rank: int, rounds: int = 3, seed: int = 5) -> np.ndarray:
    """The leading right singular vectors (columns, rank) of `rows`, by randomised subspace iteration."""
    rank = min(rank, *rows.shape)
    wide = min(rank + 16, min(rows.shape))
    q = np.random.Generator(np.random.PCG64(seed)).standard_normal((rows.shape[1], wide)).astype(np.float32)
    for _ in range(rounds):
        q = np.linalg.qr(rows.T @ (rows @ q))[0]
    _, _, turn = np.linalg.svd(rows @ q, full_matrices=False)
    return (q @ turn.T)[:, :rank].astype(np.float32)


@dataclass
class Voters:
    """The fitted model: what every task gets."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    share: float

    def latent(self, rows: np.ndarray) -> np.ndarray:
        """Unit latent vectors of weighted rows (0 for a row without terms)."""
        z = rows @ self.axes
        size = np.sqrt((z * z).sum(axis=1))
        return z / np.where(size > 1e-6, size, 1)[:, None] * (size > 1e-6)[:, None]

    def score(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.share)
        if not len(self.labels):
            return out
        cosine = self.latent(weighted(counts, self.idf)) @ self.vectors.T
        k = min(VOTERS, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64) ** SHARPNESS
        total = weight.sum(axis=1)
        some = total > 1e-9
        out[some] = (weight * self.labels[near]).sum(axis=1)[some] / total[some]
        return np.clip(out, 0, 1)


def document_frequencies(docs: DataFrame, text_column: str) -> tuple[np.ndarray, int]:
    """Number of texts that hold each term, and number of texts; every task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(COLUMNS, np.int64), 0
        for batch in batches:
            for _, buf, offsets in slices(batch.column(0), rows=BLOCK_ROWS):
                df += (term_counts(buf, offsets) > 0).sum(axis=0)
                n += len(offsets) - 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, COLUMNS, dtype=np.int32)), pa.array(np.append(n, df))],
                                         names=["term", "n"])

    rows = docs.select(F.col(text_column).cast("string")).mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n"))
    df, total = np.zeros(COLUMNS, np.int64), 0
    for term, n in rows.collect():  # COLUMNS + 1 rows
        if term < 0:
            total = n
        else:
            df[term] = n
    return df, total


def fit(docs: DataFrame, labels: DataFrame, label_column: str, id_column: str = "doc_id", text_column: str = "text",
        sample: int = SAMPLE) -> Voters:
    df, total = document_frequencies(docs, text_column)
    idf = np.log((1 + total) / (1 + df)).astype(np.float32) + 1
    chosen = labels.where(~held_out(id_column)).where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull()) \
        .select(F.col(id_column).alias("_id"), F.col(label_column).cast("double").alias("_label")) \
        .orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")) \
        .join(F.broadcast(chosen), F.col("id") == F.col("_id")).select("_id", "_label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, buf, offsets in slices(batch.column(2), rows=BLOCK_ROWS):
                counts = term_counts(buf, offsets)
                cells = [np.flatnonzero(c).astype(np.uint16) for c in counts]
                part = batch.slice(row, len(cells))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([c.tobytes() for c in cells], pa.binary()),
                     pa.array([counts[i, c].tobytes() for i, c in enumerate(cells)], pa.binary())],
                    names=["id", "label", "terms", "counts"])

    kind = docs.schema[id_column].dataType.simpleString()
    found = sorted(texts.mapInArrow(run, f"id {kind}, label double, terms binary, counts binary").collect(), key=lambda r: tuple(r))
    rows = np.zeros((len(found), COLUMNS), np.float32)
    for i, r in enumerate(found):
        rows[i, np.frombuffer(r.terms, np.uint16)] = np.frombuffer(r.counts, np.float32)
    marks = np.array([r.label for r in found])
    share = float(marks.mean()) if len(marks) else 0.5
    model = Voters(idf, np.zeros((COLUMNS, 1), np.float32), np.zeros((0, 1), np.float32), marks, share)
    if len(found):
        rows = weighted(rows, idf)
        model.axes = latent_axes(rows, RANK)
        model.vectors = model.latent(rows)
    return model


def score(docs: DataFrame, model: Voters, id_column: str = "doc_id", text_column: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """id, held_out, score and predicted of every row; no shuffle. The model's size is fixed by its parameters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = shared.value
        for batch in batches:
            parts = [voters.score(term_counts(buf, offsets)) for _, buf, offsets in slices(batch.column(2), rows=BLOCK_ROWS)]
            value = np.concatenate([*parts, np.zeros(0)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(value), pa.array((value >= threshold).astype(np.int32))],
                names=[id_column, "held_out", "score", "predicted"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column), held_out(id_column).alias("held_out"), F.col(text_column).cast("string")) \
        .mapInArrow(run, f"`{id_column}` {kind}, held_out boolean, score double, predicted int")
