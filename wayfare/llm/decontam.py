"""Passages of a benchmark in documents, found by latent semantic retrieval.

Words are runs of letters and digits in lower case, compared by 64-bit hashes. The vocabulary
is the benchmark's; passages are `PASSAGE` words long and begin every `STEP` words. A passage is a TF-IDF
row (count times idf); a word outside the vocabulary counts only in the row's length, with the median idf.
That length takes every occurrence of a word by itself, so repetition can only raise a cosine; a word that
only repeats the one before it counts nowhere.

1. One pass over all documents counts the document frequencies of the vocabulary and multiplies the passages of
   every document with a start that the benchmark's passages give; vocabulary ranges add up the products of the
   tasks. The start needs no idf, so the idf that the same pass finds is put in afterwards.
2. These products make a randomised SVD (Nystrom form) of the TF-IDF passages of the benchmark and of all
   documents, both parts of the same weight, which gives the latent axes.
3. Every passage of every document is compared with all items by two cosines: of the TF-IDF rows as they are, and
   with the item on the axes. The greater counts, so an item that lies outside the axes is found by its words.
   An item of more than two passages is compared as a whole and by the passages side by side that cover it; the
   nearest counts, so its length does not lower the cosine of a copy.
   Passages whose share of squared length in the vocabulary is below `COSINE` squared are left out: without
   repeated words that share bounds both cosines.
4. Pairs with a cosine of `COSINE` or more are checked on the words around the passage: the longest common
   subsequence must hold `SAME` of the item's words and of its idf, and `ANSWER` of the words of its last
   sentence, which carries the answer.

Items are taken in blocks of at most `ITEMS` items and `VECTORS` search vectors (or one item), so that vocabulary,
axes and item vectors sent to the tasks have a bound of their own: a larger benchmark means more blocks, not
larger ones.

Edge cases: null or empty texts on either side match nothing; an empty benchmark gives no rows; repeated
documents give repeated rows; items with equal texts are all reported; a document without an id is reported
with a null id; other columns are not read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from wayfare.llm.words import IS_WORD, U64, KeyTable, Words, ragged, slices

PASSAGE, STEP = 32, 8
RANK, SPARE, ROUNDS = 256, 16, 2
SAMPLE = None  # no sample is taken: every document enters the fit; the name stays for callers that set it
ITEMS, VECTORS = 512, 512
COSINE, SAME, ANSWER = 0.35, 0.7, 0.6
RANGE = 64
WIDE = 6144  # vocabularies up to this size count pairs of words in a table
TASKS = 32  # tasks that send products, or three for each core if that is more
WORDY = IS_WORD.copy()
WORDY[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80), *range(0x00, 0x09), *range(0x0E, 0x20)]] = False


def _words(texts: list[str]) -> list[np.ndarray]:
    out = []
    for _, buf, offsets in slices(pa.array(texts, pa.string())):
        w = Words(buf, offsets, WORDY)
        out += np.split(w.hashes(), w.bounds[1:-1])
    return out


@dataclass
class Block:
    """Items of the benchmark and all that a task needs to find them."""

    ids: list
    words: list[np.ndarray]  # vocabulary numbers of each item
    answers: list[int]  # words of the last sentence
    vocabulary: np.ndarray
    idf: np.ndarray
    strange: float = 0.0  # weight of a word outside
    axes: np.ndarray | None = None
    vectors: np.ndarray | None = None  # search vectors on the axes
    plain: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None  # cells of the search vectors as they are
    first: np.ndarray | None = None  # first search vector of each item

    def scores(self) -> np.ndarray:
        """What each word adds to the products with all search vectors, first plain, then on the axes; a last
        row of zeros stands for words outside the vocabulary."""
        plain = _dense(*self.plain, len(self.vectors), len(self.vocabulary)).T
        rows = np.concatenate([plain, self.axes @ self.vectors.T], axis=1) * self.idf[:, None].astype(np.float32)
        return np.concatenate([rows, np.zeros((1, rows.shape[1]), np.float32)])

    def table(self) -> KeyTable:
        t = KeyTable(max(8, int(np.ceil(np.log2(4 * len(self.vocabulary) + 1)))))
        t.add(self.vocabulary, np.arange(len(self.vocabulary)))
        return t


def read_block(rows: list) -> Block | None:
    """A block of (id, text) rows; None without any word."""
    hashes = _words([text for _, text in rows])
    kept = [i for i, h in enumerate(hashes) if len(h)]
    if not kept:
        return None
    vocabulary, number = np.unique(np.concatenate([hashes[i] for i in kept]), return_inverse=True)
    words = np.split(number, np.cumsum([len(hashes[i]) for i in kept])[:-1])
    last = _words([next((s for s in reversed(re.split(r"[.!?\n]+", rows[i][1])) if s.strip()), "") for i in kept])
    return Block([rows[i][0] for i in kept], words, [len(x) for x in last], vocabulary, np.zeros(len(vocabulary)))


def passages(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word within the text, words) of every passage, for texts with these numbers of words."""
    room = np.maximum(counts - PASSAGE, 0)
    per = np.where(counts > 0, -(-room // STEP) + 1, 0)
    text = np.repeat(np.arange(len(counts)), per)
    start = np.minimum(ragged(np.zeros(len(per), np.int64), per) * STEP, room[text])
    return text, start, np.minimum(counts, PASSAGE)[text]


def cells(number: np.ndarray, start: np.ndarray, length: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, vocabulary number, weight) of the known words of passages; number is -1 for others."""
    word = number[ragged(start, length)]
    row = np.repeat(np.arange(len(start)), length)
    known = word >= 0
    key, count = np.unique(row[known] * len(idf) + word[known], return_counts=True)
    row, word = key // len(idf), key % len(idf)
    return row, word, (count * idf[word]).astype(np.float32)


def _dense(row: np.ndarray, word: np.ndarray, weight: np.ndarray, rows: int, columns: int) -> np.ndarray:
    out = np.zeros((rows, columns), np.float32)
    out[row, word] = weight
    return out


def _added(key: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and the sum of the rows of each; keys come in order."""
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[head], np.add.reduceat(rows, head, axis=0)


def _times(row: np.ndarray, word: np.ndarray, value: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that have cells, and their products with q."""
    return _added(row, q[word] * value[:, None])


def _begun(at: np.ndarray, room: np.ndarray) -> np.ndarray:
    """How many passages of a text begin at word `at` or before, if `room` words follow its first passage."""
    return np.where(at >= 0, np.minimum(at // STEP + 1, -(-room // STEP)) + (at >= room), 0)


def word_pairs(words: Words, number: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(first * size + second, passages that hold both) of the pairs of known words, the first before the second or
    the same occurrence, in portions."""
    known = np.flatnonzero(number >= 0)
    owner = words.owners()[known]
    room, at = np.maximum(words.counts - PASSAGE, 0)[owner], known - words.bounds[owner]
    n, apart = number[known].astype(np.int64), owner << 32  # no pair across texts
    begun, over = _begun(at, room) + apart, _begun(at - PASSAGE, room) + apart
    for k in range(min(PASSAGE, len(known))):
        both = begun[:len(n) - k] - over[k:]
        some = np.flatnonzero(both > 0)
        if not len(some):
            break
        yield n[some] * size + n[some + k], both[some]


class Products:
    """A'(A q) over passages A given as counts of words.

    For a vocabulary of up to `wide` words A'A is counted in a table, pair by pair; for a larger one every
    passage is multiplied."""

    def __init__(self, q: np.ndarray, wide: int):
        self.q, self.size, self.total = q, len(q), np.zeros(q.shape)
        self.counted = self.size <= wide
        self.table = np.zeros(self.size * self.size if self.counted else 0, np.int32)
        self.mass = 0  # no cell of the table holds more

    def add(self, words: Words, number: np.ndarray) -> None:
        if not self.counted:
            self._multiply(words, number)
            return
        for same, (key, times) in zip(itertools.chain([True], itertools.repeat(False)), word_pairs(words, number, self.size)):
            if same:
                self.total += np.bincount(key // self.size, times, self.size)[:, None] * self.q
                continue
            mass = int(times.sum())
            if self.mass + mass >= 1 << 30:
                self._empty()
            self.mass += mass
            np.add.at(self.table, key, times.astype(np.int32))

    def _empty(self) -> None:
        cells = self.table.reshape(self.size, -1)
        for a in range(0, self.size, 512):
            both = cells[a:a + 512] + cells[:, a:a + 512].T
            self.total[a:a + 512] += both.astype(np.float32) @ self.q
        self.table[:] = 0
        self.mass = 0

    def _multiply(self, words: Words, number: np.ndarray) -> None:
        text, start, length = passages(words.counts)
        start, one = start + words.bounds[text], np.ones(self.size)
        for a in range(0, len(start), 1024):
            row, word, value = cells(number, start[a:a + 1024], length[a:a + 1024], one)
            if len(row):
                rows, y = _times(row, word, value, self.q)
                order = np.argsort(word, kind="stable")
                place = np.searchsorted(rows, row[order])
                used, more = _added(word[order], y[place] * value[order][:, None])
                self.total[used] += more

    def sums(self) -> np.ndarray:
        if self.mass:
            self._empty()
        return self.total


def _count(docs: DataFrame, block: Block, q: np.ndarray) -> tuple[int, np.ndarray, int, np.ndarray]:
    """Over all documents: their number, those that hold each word of the vocabulary, the number of passages, and
    A'(A q) over the passages A as counts of words."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((block, q))
    ranges, wide = -(-len(q) // RANGE), WIDE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, q = shared.value
        table, size = block.table(), len(q)
        df, products, texts, seen = np.zeros(size, np.int64), Products(q, wide), 0, 0
        for batch in batches:
            for _, buf, offsets in slices(batch.column(0)):
                words = Words(buf, offsets, WORDY)
                number = table.find(words.hashes())
                known = number >= 0
                pair = np.unique(words.owners()[known] * size + number[known])
                df += np.bincount(pair % size, minlength=size)
                texts += len(offsets) - 1
                seen += len(passages(words.counts)[0])
                products.add(words, number)
        if texts:
            sums = products.sums().astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(-1, ranges, dtype=np.int32)),
                 pa.array([np.append([texts, seen], df).astype(np.float64).tobytes(),
                           *(sums[r * RANGE:(r + 1) * RANGE].tobytes() for r in range(ranges))])],
                names=["part", "sums"])

    def add(table: pa.Table) -> pa.Table:
        kind = np.float64 if table.column("part")[0].as_py() < 0 else np.float32
        total = 0
        for sums in table.column("sums"):
            total = total + np.frombuffer(sums.as_buffer(), kind).astype(np.float64)
        return pa.table({"part": table.column("part").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    few = docs.select("text").coalesce(max(TASKS, 3 * context.defaultParallelism))  # what is sent follows the cores
    got = dict(tuple(r) for r in few.mapInArrow(run, "part int, sums binary").groupBy("part")
               .applyInArrow(add, "part int, sums binary").collect())  # vocabulary x axes of one block
    shared.unpersist()
    if not got:
        return 0, np.zeros(len(q)), 0, np.zeros(q.shape)
    head = np.frombuffer(got.pop(-1), np.float64)
    return int(head[0]), head[2:], int(head[1]), np.concatenate([np.frombuffer(got[r], np.float64) for r in sorted(got)]).reshape(q.shape)


def search_parts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(item, first word within the item, words) of every search vector, item by item: the whole item, and for one
    of more than two passages also the passages side by side that cover it."""
    per = 1 + np.where(counts > 2 * PASSAGE, -(-counts // PASSAGE), 0)
    item = np.repeat(np.arange(len(counts)), per)
    k = ragged(np.zeros(len(per), np.int64), per) - 1
    start = np.where(k < 0, 0, np.minimum(k * PASSAGE, counts[item] - PASSAGE))
    return item, start, np.where(k < 0, counts[item], PASSAGE)


def _own_passages(block: Block) -> np.ndarray:
    """Counts of the words of the items and of their passages."""
    number = np.concatenate(block.words)
    counts = np.array([len(w) for w in block.words])
    first = np.cumsum(counts) - counts
    text, start, length = passages(counts)
    start, length = np.append(start + first[text], first), np.append(length, counts)
    return _dense(*cells(number, start, length, np.ones(len(block.idf))), len(start), len(block.idf))


def leading(product: np.ndarray, start: np.ndarray, rank: int) -> np.ndarray:
    """The leading eigenvectors of a positive matrix G, from G start and start (Nystrom approximation; exact if the
    start spans everything)."""
    inner = start.T @ product
    value, turn = np.linalg.eigh((inner + inner.T) / 2)
    good = value > 1e-9 * max(value[-1], 1e-300)
    return np.linalg.svd(product @ (turn[:, good] / np.sqrt(value[good])), full_matrices=False)[0][:, :rank]


def fit(docs: DataFrame, block: Block) -> Block:
    """The block with idf, latent axes and item vectors."""
    own = _own_passages(block)
    wide = min(RANK + SPARE, own.shape[1])
    q = np.linalg.qr(np.random.Generator(np.random.PCG64(3)).standard_normal((own.shape[1], wide)))[0].astype(np.float32)
    for _ in range(ROUNDS):
        q = np.linalg.qr(q + own.T @ (own @ q))[0].astype(np.float32)
    total, df, n, product = _count(docs, block, q)
    block.idf = np.log((1 + total) / (1 + df)) + 1e-3
    block.strange = float(np.median(block.idf))
    product += own.T @ (own @ q) * max(1.0, n / len(own))
    # A holds counts, B = A idf: B'B (q / idf) = idf A'A q
    block.axes = leading(product * block.idf[:, None], q / block.idf[:, None], RANK).astype(np.float32)
    counts = np.array([len(w) for w in block.words])
    item, start, length = search_parts(counts)
    row, word, weight = cells(np.concatenate(block.words), start + (np.cumsum(counts) - counts)[item], length, block.idf)
    weight /= np.sqrt(np.bincount(row, weight * weight, len(item)))[row]
    block.plain = row, word, weight
    block.first = np.searchsorted(item, np.arange(len(counts)))
    block.vectors = _dense(*block.plain, len(item), len(block.idf)) @ block.axes
    return block


def common_subsequence(a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> float:
    """Largest total weight of a common subsequence of a and b; `weight` holds that of each element of a."""
    best = np.zeros(len(b) + 1)
    for x, w in zip(a, weight):
        step = np.where(b == x, best[:-1] + w, 0)
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], step))
    return float(best[-1])


def in_common(a: np.ndarray, b: np.ndarray) -> int:
    """Words of a that b holds as well, each as often as in both: no common subsequence is longer."""
    word, count = np.unique(a, return_counts=True)
    held = np.sort(b)
    return int(np.minimum(count, np.searchsorted(held, word, "right") - np.searchsorted(held, word)).sum())


def confirmed(block: Block, item: int, around: np.ndarray) -> float:
    """Share of the item's words in the longest common subsequence with the words around a passage, or 0
    where that share, its idf or the answer falls short."""
    words = block.words[item]
    share = common_subsequence(words, around, np.ones(len(words))) / len(words)
    if share < SAME:
        return 0.0
    idf = block.idf[words]
    if common_subsequence(words, around, idf) < SAME * idf.sum():
        return 0.0
    answer = words[len(words) - block.answers[item]:]
    if len(answer) and np.isin(answer, around).mean() < ANSWER:
        return 0.0
    return share


def _stride_sums(scores: np.ndarray, number: np.ndarray, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Sum of the scores of the words of each stride; words outside the vocabulary add nothing."""
    padded = np.append(number, -1)
    out = scores[padded[head]]
    for k in range(1, STEP):
        out += scores[np.where(head + k < tail, padded[np.minimum(head + k, len(number))], -1)]
    return out


def find_in_slice(block: Block, table: KeyTable, scores: np.ndarray, buf: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, float, float]]:
    """(text, item, cosine, share of the item) of every item that a text holds."""
    words = Words(buf, offsets, WORDY)
    number = table.find(words.hashes())
    again = np.flatnonzero(number[1:] == number[:-1]) + 1
    weight = np.where(number >= 0, block.idf[number], block.strange) ** 2
    weight[again[number[again] >= 0]] = 0
    number[again] = -1
    whole, known = (np.concatenate([[0.0], np.cumsum(x)]) for x in (weight, weight * (number >= 0)))
    # the scores of the words of a stride of STEP words are summed, passages are sums of neighbouring strides
    per = -(-words.counts // STEP)
    owner = np.repeat(np.arange(len(per)), per)
    head = words.bounds[owner] + ragged(np.zeros(len(per), np.int64), per) * STEP
    tail = np.minimum(head + STEP, words.bounds[owner + 1])
    stop = np.cumsum(per)[owner]
    many = PASSAGE // STEP
    at = np.arange(len(head))
    first = np.flatnonzero((at + many <= stop) | (at == stop - per[owner]))
    last = np.minimum(first + many, stop[first]) - 1
    text, start, end = owner[first], head[first], tail[last]
    size = whole[end] - whole[start]
    near = np.flatnonzero((size > 0) & (known[end] - known[start] >= COSINE * COSINE * size * (1 - 1e-9)))
    best: dict[tuple[int, int], tuple[float, float]] = {}
    for a in range(0, len(near), 1024):
        part = near[a:a + 1024]
        stride = np.minimum(first[part, None] + np.arange(many), last[part, None])
        used, place = np.unique(stride, return_inverse=True)
        place = place.reshape(stride.shape)
        sums = _stride_sums(scores, number, head[used], tail[used])
        z = sums[place[:, 0]]
        for k in range(1, many):
            z += sums[place[:, k]] * (first[part] + k <= last[part])[:, None]
        cosine = np.maximum(*np.split(z, 2, axis=1)) / np.sqrt(size[part])[:, None]
        cosine = np.maximum.reduceat(cosine, block.first, axis=1)  # of an item's search vectors the nearest
        for i, item in zip(*np.nonzero(cosine >= COSINE)):
            p = part[i]
            key, c = (int(text[p]), int(item)), float(cosine[i, item])
            old = best.get(key)
            if old and old[1] >= 1:
                best[key] = max(c, old[0]), old[1]
                continue
            reach = len(block.words[item])
            lo, hi = words.bounds[text[p]], words.bounds[text[p] + 1]
            around = number[max(lo, start[p] - reach):min(hi, end[p] + reach)]
            if in_common(block.words[item], around) < max(SAME, old[1] if old else 0.0) * reach - 1e-9:
                continue
            share = confirmed(block, int(item), around)
            if share and (old is None or share >= old[1]):
                best[key] = max(c, old[0] if old else 0.0), share
    return [(t, i, c, s) for (t, i), (c, s) in sorted(best.items())]


def _texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).alias("id"),
                       F.lower(F.coalesce(F.col(text_column).cast("string"), F.lit(""))).alias("text"))


def fitted_blocks(spark: SparkSession, texts: DataFrame, benchmark: DataFrame, item_column: str,
                  item_text_column: str) -> Iterator[Block]:
    """The benchmark in fitted blocks of at most `ITEMS` items and `VECTORS` search vectors (or of one item)."""
    items = benchmark.select(F.col(item_column), F.lower(F.col(item_text_column).cast("string")).alias("text")) \
        .where("text is not null").toLocalIterator()
    rows: list = []
    vectors = 0
    for row in itertools.chain(map(tuple, items), [None]):
        more = 0 if row is None else len(search_parts(np.array([len(_words([row[1]])[0])]))[0])
        if rows and (row is None or len(rows) == ITEMS or vectors + more > VECTORS):
            block = read_block(rows)
            if block is not None:
                yield fit(texts, block)
            rows, vectors = [], 0
        rows.append(row)
        vectors += more


def find(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
         item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """id, item, cosine and share of the item's words, for every item that a document holds; no shuffle."""
    schema = f"`{id_column}` {docs.schema[id_column].dataType.simpleString()}, " \
             f"`{item_column}` {benchmark.schema[item_column].dataType.simpleString()}, cosine double, share double"
    texts = _texts(docs, id_column, text_column)
    item_type = to_arrow_type(benchmark.schema[item_column].dataType)
    out = spark.createDataFrame([], schema)
    for block in fitted_blocks(spark, texts, benchmark, item_column, item_text_column):
        out = out.unionByName(texts.mapInArrow(_search(spark.sparkContext.broadcast(block), item_type, id_column, item_column), schema))
    return out


def _search(shared: Broadcast, item_type: pa.DataType, id_column: str, item_column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        table, scores = block.table(), block.scores()
        for batch in batches:
            for row, buf, offsets in slices(batch.column(1)):
                found = find_in_slice(block, table, scores, buf, offsets)
                if found:
                    text, item, cosine, share = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(np.array(text) + row)),
                         pa.array([block.ids[i] for i in item], item_type), pa.array(cosine), pa.array(share)],
                        names=[id_column, item_column, "cosine", "share"])
    return run


def remove_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """The rows of `docs` that hold no item, with all their columns; no shuffle."""
    lower = "lower"
    while lower.casefold() in map(str.casefold, docs.columns):
        lower += "_"
    out = docs.withColumn(lower, F.lower(F.coalesce(F.col(text_column).cast("string"), F.lit(""))))
    at = len(docs.columns)

    def without(shared: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            table, scores = block.table(), block.scores()
            for batch in batches:
                for row, buf, offsets in slices(batch.column(at)):
                    clean = np.ones(len(offsets) - 1, bool)
                    clean[[found[0] for found in find_in_slice(block, table, scores, buf, offsets)]] = False
                    yield batch.slice(row, len(clean)).take(pa.array(np.flatnonzero(clean)))
        return run

    for block in fitted_blocks(spark, _texts(docs, id_column, text_column), benchmark, item_column, item_text_column):
        out = out.mapInArrow(without(spark.sparkContext.broadcast(block)), out.schema)
    return out.drop(lower)
