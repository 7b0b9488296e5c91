"""Periodic runs of words: suffix classes united by decreasing LCP, over ordered position sets.

A run is a stretch of consecutive words with smallest period q (words q apart are equal) whose length is at
least `least` and `times` * q and which no neighbouring word extends.

The texts of a slice are worked on together, as numbers of their words:

1. Suffixes are ranked by prefix doubling. A suffix that shares its prefix with no other one of its text leaves,
   so the rounds follow the longest repeat and a text without repeats costs two or three sorts.
2. Neighbours in the order of the ranks get their LCP from the ranks of all rounds. Pairs below the least LCP
   that a run can have are left out.
3. The pairs are taken by decreasing LCP (Kruskal); each unites two suffix classes, kept as ordered lists of
   positions, the smaller into the larger. Positions i < j that become neighbours agree in exactly LCP words.
   If j - i is at most the LCP this is a seed: a stretch from i of j - i + LCP words with period j - i.
   Neighbours in their class have no smaller period between them, and a seed that a word before i would extend is
   found again from there, so seeds that start leftmost are the runs, each once.

Texts never meet, so the work needs no shuffle, and a hot source or a group of copies is just so many rows.

Edge cases: a null or empty text has no words and no run; a null id counts as an empty text where ids decide
something (`planted_tail`); repeated rows give equal rows; a very long text is a slice of its own; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.words import U64, Words, ragged, slices

LEAST, TIMES = 6, 4
Rewrite = Callable[[pa.Array, np.ndarray], np.ndarray]


def dense(values: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Number of the first place of each (owner, value) in their order, so that groups leave gaps of their size."""
    order = np.lexsort((values, owners))
    new = np.ones(len(order), bool)
    new[1:] = (values[order][1:] != values[order][:-1]) | (owners[order][1:] != owners[order][:-1])
    rank = np.empty(len(order), np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return rank


def suffix_ranks(words: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, until no two of a text are equal.

    Equal ranks mean equal words (all of them there); `words` are numbers or hashes, `bounds` the texts' ends.
    """
    n = len(words)
    owners = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    end = bounds[1:][owners]
    ranks = [dense(words, owners)]
    reach = 1
    while True:
        rank = ranks[-1]
        size = np.bincount(rank, minlength=n)
        busy = np.flatnonzero(size[rank] > 1)
        if not len(busy):
            return ranks
        then = busy + reach
        second = np.where(then < end[busy], rank[np.minimum(then, n - 1)], -1)
        order = np.lexsort((second, rank[busy]))
        first, second = rank[busy][order], second[order]
        group = np.ones(len(order), bool)
        group[1:] = first[1:] != first[:-1]
        new = group.copy()
        new[1:] |= second[1:] != second[:-1]
        # a text's end is shorter than the rest and equal to no other suffix
        new |= second < 0
        at = np.arange(len(order))
        start = np.maximum.accumulate(np.where(group, at, 0))
        place = np.maximum.accumulate(np.where(new, at, 0))
        rank = rank.copy()
        rank[busy[order]] = first + place - start
        ranks.append(rank)
        reach *= 2


def neighbour_lcp(ranks: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, LCP) of neighbours in suffix order that share at least `least` words."""
    level = min(len(ranks) - 1, max(least, 1).bit_length() - 1)
    size = np.bincount(ranks[level], minlength=len(ranks[level]))
    busy = np.flatnonzero(size[ranks[level]] > 1)
    order = busy[np.argsort(ranks[-1][busy], kind="stable")]
    a, b = order[:-1], order[1:]
    same = ranks[level][a] == ranks[level][b]
    a, b = a[same], b[same]
    lcp = np.zeros(len(a), np.int64)
    n = len(ranks[0])
    for k in range(len(ranks) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        inside = (x < n) & (y < n)
        equal = np.zeros(len(a), bool)
        equal[inside] = ranks[k][x[inside]] == ranks[k][y[inside]]
        lcp[equal] += 1 << k
    long = lcp >= least
    return a[long], b[long], lcp[long]


def seeds(a: np.ndarray, b: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """(i, period, LCP) of positions that become neighbours when classes are united by decreasing LCP."""
    order = np.argsort(-lcp, kind="stable")
    nodes, pair = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = pair[:len(a)][order].tolist(), pair[len(a):][order].tolist()
    places = nodes.tolist()
    root = list(range(len(places)))
    held: list[list[int] | None] = [[p] for p in places]
    out: list[tuple[int, int, int]] = []
    for x, y, l in zip(left, right, lcp[order].tolist()):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x == y:
            continue
        big, small = held[x], held[y]
        if len(big) < len(small):
            x, y, big, small = y, x, small, big
        root[y], held[y] = x, None
        at = []
        for p in small:
            k = bisect_left(big, p)
            big.insert(k, p)
            at.append(k)
        # a later insert below moves nothing: `small` is ascending
        come = set(small) if len(small) > 1 else small
        for k in at:
            p = big[k]
            if k and p - big[k - 1] <= l and big[k - 1] not in come:
                out.append((big[k - 1], p - big[k - 1], l))
            if k + 1 < len(big) and big[k + 1] - p <= l and big[k + 1] not in come:
                out.append((p, big[k + 1] - p, l))
    return np.array(out, np.int64).reshape(-1, 3)


def runs_of(words: np.ndarray, bounds: np.ndarray, least: int = LEAST, times: int = TIMES) -> tuple[np.ndarray, ...]:
    """(text, start, length, period) of every run, by text, start and period."""
    none = np.zeros(0, np.int64)
    if not len(words):
        return none, none, none, none
    if times < 2:
        raise ValueError("a run has two periods at least")
    shortest = min(max(least, times * q) - q for q in range(1, least + 1))
    a, b, lcp = neighbour_lcp(suffix_ranks(words, bounds), shortest)
    if not len(a):
        return none, none, none, none
    i, q, l = seeds(a, b, lcp).T
    text = np.searchsorted(bounds, i, side="right") - 1
    leftmost = (i == bounds[text]) | (words[i - 1] != words[i - 1 + q])
    ok = leftmost & (q + l >= np.maximum(least, times * q))
    i, q, l, text = i[ok], q[ok], l[ok], text[ok]
    order = np.lexsort((q, i))
    i, q, l, text = i[order], q[order], l[order], text[order]
    return text, i - bounds[text], q + l, q


def planted_tail(ids: pa.Array, counts: np.ndarray) -> np.ndarray:
    """Which word of its text stands at each place, once some texts chosen by their id have got a periodic tail.

    With h the CRC-32 of the decimal id and g = h // 10, texts with h % 10 = 0 repeat the p words from word a on,
    where a = g % n and p = 1 + (n - a) // (3 + g % 8).
    """
    h = np.array([zlib.crc32(b"" if i is None else str(i).encode()) for i in ids.to_pylist()], np.int64)
    g, n = h // 10, counts.astype(np.int64)
    hit = (h % 10 == 0) & (n > 0)
    a = np.where(hit, g % np.maximum(n, 1), n)
    p = 1 + (n - a) // (3 + g % 8)
    within = ragged(np.zeros(len(n), np.int64), n)
    a, p = np.repeat(a, n), np.repeat(p, n)
    return np.where(within >= a, a + (within - a) % p, within)


class _Slice:
    """The words of the texts of a slice, after `rewrite`, and their runs."""

    def __init__(self, ids: pa.Array, buf: np.ndarray, offsets: np.ndarray, rewrite: Rewrite | None):
        words = Words(buf, offsets)
        self.buf, self.bounds, self.counts = buf, words.bounds, words.counts
        hashes, self.starts, self.ends = words.hashes(), words.starts, words.ends
        if rewrite is not None:
            at = rewrite(ids, words.counts) + np.repeat(words.bounds[:-1], words.counts)
            hashes, self.starts, self.ends = hashes[at], self.starts[at], self.ends[at]
        self.text, self.start, self.length, self.period = runs_of(hashes, self.bounds)
        self.edges = np.searchsorted(self.text, np.arange(len(self.counts) + 1))

    def kept(self) -> np.ndarray:
        """Whether a word stays: no run contains it after its first period."""
        change = np.zeros(len(self.starts) + 1, np.int64)
        first = self.bounds[self.text] + self.start
        np.add.at(change, first + self.period, 1)
        np.add.at(change, first + self.length, -1)
        return np.cumsum(change[:-1]) == 0

    def collapsed(self) -> list[bytes]:
        """The words that stay, joined by single spaces."""
        kept = np.flatnonzero(self.kept())
        width = self.ends[kept] - self.starts[kept] + 1
        total = np.concatenate([[0], np.cumsum(width)])
        raw = np.append(self.buf, np.uint8(0x20))[ragged(self.starts[kept], width)]
        raw[total[1:] - 1] = 0x20
        raw, edge = raw.tobytes(), total[np.searchsorted(kept, self.bounds)].tolist()
        return [raw[x:max(x, y - 1)] for x, y in zip(edge[:-1], edge[1:])]


def _run_columns(s: _Slice) -> list[pa.Array]:
    edges = pa.array(s.edges.astype(np.int32))
    return [pa.ListArray.from_arrays(edges, pa.array(x)) for x in (s.start, s.length, s.period)]


def _digests(s: _Slice) -> list[pa.Array]:
    n = len(s.counts)
    ratio = s.length / s.period
    best = np.full(n, -1)
    order = np.lexsort((s.period, s.start, -ratio, s.text))
    head = order[s.edges[:-1][s.edges[1:] > s.edges[:-1]]]  # the sort keeps each text's runs at their places
    best[s.text[head]] = head
    none = best < 0
    lines = [b"%d,%d,%d\n" % r for r in zip(s.start.tolist(), s.length.tolist(), s.period.tolist())]
    edges = s.edges.tolist()
    return [pa.array(np.diff(s.edges).astype(np.int64))] + \
        [pa.array(np.zeros(n, np.int64) if none.all() else x[np.maximum(best, 0)], mask=none)
         for x in (s.start, s.length, s.period, 1000 * s.length // np.maximum(s.period, 1))] + \
        [pa.array([hashlib.sha256(b"".join(lines[x:y])).hexdigest() for x, y in zip(edges[:-1], edges[1:])]),
         pa.array([hashlib.sha256(t).hexdigest() for t in s.collapsed()])]


def _per_text(docs: DataFrame, id_column: str, text_column: str, fields: str, columns: Callable[[_Slice], list[pa.Array]],
              rewrite: Rewrite | None) -> DataFrame:
    kind = docs.schema[id_column].dataType.simpleString()
    names = [id_column, *(f.split()[0] for f in fields.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, buf, offsets in slices(batch.column(1)):
                ids = batch.column(0).slice(row, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays([ids, *columns(_Slice(ids, buf, offsets, rewrite))], names=names)

    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, f"`{id_column}` {kind}, {fields}")


def find_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """id, start, length and period (in words) of every run of every text."""
    lists = _per_text(docs, id_column, text_column, "start array<long>, length array<long>, period array<long>", _run_columns, rewrite)
    return lists.select(F.col(id_column), F.inline(F.arrays_zip("start", "length", "period")))


def collapse(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """id and text: the words that no run contains after its first period, joined by single spaces."""
    return _per_text(docs, id_column, text_column, "collapsed string",
                     lambda s: [pa.array([t.decode("utf-8") for t in s.collapsed()], pa.string())], rewrite) \
        .withColumnRenamed("collapsed", text_column)


def digest_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rewrite: Rewrite | None = None) -> DataFrame:
    """Per text: the number of runs, the one of most periods (nulls without one), and the digests of all runs and
    of the collapsed text."""
    return _per_text(docs, id_column, text_column, "n_runs long, start long, length long, period long, "
                     "exponent_milli long, runs_sha256 string, collapsed_sha256 string", _digests, rewrite)
