"""Removal of repeated word runs by exact hashes of all windows of every text against all others.

A run of `length` words that also starts anywhere else is a repeat, and every word of it goes. The index
holds reference blocks: among the (length + 1) // 2-word grams inside each window of `length` words, the
gram with the smallest hash names the block that the window belongs to, so equal windows always name the
same block. The steps are:

1. Each text lists the names of its blocks; names that no other block has are dropped.
2. Texts send their remaining blocks (consecutive windows under one name, as 64-bit hashes) to the name.
   There the windows of all blocks of that name are sorted by hash; a window seen twice is a repeat, and its
   reference is the next equal window. A factor is a run in which the next window continues in the same
   reference. There is no greedy parse: equal windows alone decide what goes.
3. Factors come back to their text, cover `length` - 1 more words than they have windows, and are cut out.

Equal names within a batch, and equal blocks, are settled there; one of them travels on. So a name that a
third of all rows hold sends one row per batch. Windows are compared by 64-bit hashes among blocks of
equal 64-bit names.

Edge cases: a null or empty text has no words; texts shorter than `length` words keep all; repeated rows
are copies of each other; rows are told apart by a hash of id and text, so null or repeated ids do no harm;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.words import U64, Words, mix, ragged, slices, windows


def _over(best: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """`best` (np.minimum or np.maximum) of each run of `width` neighbouring values."""
    have, out = 1, values
    while have * 2 <= width:
        out = best(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = best(out[:len(out) - (width - have)], out[width - have:])
    return out


class Blocks:
    """Blocks of the texts of a slice: owner, first window, number of windows and name of each."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, length: int):
        words = Words(buf, offsets)
        owners, h = words.owners(), words.hashes()
        gram = (length + 1) // 2
        self.at, self.window = windows(h, owners, length)
        self.owner = owners[self.at]
        if not len(self.at):
            self.name = self.first = self.count = np.zeros(0, np.int64)
            self.block_owner, self.loops = self.owner, np.zeros(0, bool)
            return
        at, key = windows(h, owners, gram)
        full = np.full(len(h), np.iinfo(np.uint64).max, U64)
        full[at] = key
        width = length - gram + 1
        least = _over(np.minimum, full, width)[self.at]
        new = np.ones(len(self.at), bool)
        new[1:] = (least[1:] != least[:-1]) | (self.owner[1:] != self.owner[:-1])
        self.first = np.flatnonzero(new)
        self.count = np.diff(np.append(self.first, len(self.at)))
        self.name = least[self.first].view(np.int64)
        self.block_owner = self.owner[self.first]
        # a block can repeat itself if its naming gram stands at two places in it
        padded = np.zeros(len(h) + width - 1, U64)
        padded[self.at + width - 1] = least
        chosen = np.flatnonzero((_over(np.maximum, padded, width) == full) & (full != np.iinfo(np.uint64).max))
        again = np.flatnonzero((full[chosen][1:] == full[chosen][:-1]) & (owners[chosen][1:] == owners[chosen][:-1]))
        again = chosen[again]
        self.loops = np.isin(_pair(self.name.view(U64), self.block_owner), _pair(full[again], owners[again]))


def _pair(name: np.ndarray, owner: np.ndarray) -> np.ndarray:
    return mix(name) ^ mix(owner.astype(U64))


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """key (a hash of id and text), id and text."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(F.xxhash64(F.col(id_column), text).alias("key"), F.col(id_column).alias("id"), text.alias("text"))


def _names(docs: DataFrame, length: int) -> DataFrame:
    """deal, name, key and known: a name of each text, whether the batch has shown it to be repeated.

    `deal` is what rows are dealt out by: the name, or the key where nothing is left to find out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            names, owners, loops = [], [], []
            for row, buf, offsets in slices(batch.column(1)):
                b = Blocks(buf, offsets, length)
                names.append(b.name)
                owners.append(b.block_owner + row)
                loops.append(b.loops)
            name, owner = (np.concatenate(x or [np.zeros(0, np.int64)]) for x in (names, owners))
            order = np.argsort(name, kind="stable")
            name, owner = name[order], owner[order]
            known = np.concatenate(loops or [np.zeros(0, bool)])[order]
            same = name[1:] == name[:-1]
            known[1:] |= same
            known[:-1] |= same
            first = np.ones(len(name), bool)
            first[1:] = ~same
            key = keys[owner]
            yield pa.RecordBatch.from_arrays([pa.array(np.where(first, name, key)), pa.array(name), pa.array(key),
                                              pa.array(known), pa.array(first)],
                                             names=["deal", "name", "key", "known", "first"])

    return docs.select("key", "text").mapInArrow(
        run, "deal long, name long, key long, known boolean, first boolean")


def _table(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    got = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(got) if got else None


def _repeated_names(names: DataFrame) -> DataFrame:
    """key and name of the blocks whose name occurs twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(batches)
        if table is None:
            return
        name, key, known, first = (table.column(c).to_numpy() for c in ("name", "key", "known", "first"))
        asked = np.flatnonzero(first)
        asked = asked[np.argsort(name[asked], kind="stable")]
        same = name[asked][1:] == name[asked][:-1]
        known = known.copy()
        known[asked[1:][same]] = True
        known[asked[:-1][same]] = True
        yield pa.RecordBatch.from_arrays([pa.array(key[known]), pa.array(name[known])], names=["key", "name"])

    return names.repartition("deal").mapInArrow(run, "key long, name long")


def _sent_blocks(docs: DataFrame, length: int) -> DataFrame:
    """Blocks with a repeated name: deal, name, key, start word, windows; and where a block of the batch is
    the same, that one's key and start as ref_key and ref_start."""
    fields = "deal long, name long, key long, start int, n int, windows binary, ref_key long, ref_start int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lists = batch.column(0).to_numpy(), batch.column(2)
            rows, flat = np.asarray(lists.offsets), lists.values.to_numpy(zero_copy_only=False)
            parts = []
            for row, buf, offsets in slices(batch.column(1)):
                b = Blocks(buf, offsets, length)
                if not len(b.first):
                    continue
                n = len(offsets) - 1
                held = flat[rows[row]:rows[row + n]]
                holder = np.repeat(np.arange(n), np.diff(rows[row:row + n + 1]))
                at = np.flatnonzero(np.isin(_pair(b.name.view(U64), b.block_owner), _pair(held.view(U64), holder)))
                start = b.at[b.first[at]] - _first_word(b, at)
                cells = ragged(b.first[at], b.count[at])
                parts.append((b.name[at], keys[b.block_owner[at] + row], start, b.count[at], b.window[cells]))
            if not parts:
                continue
            name, key, start, count = (np.concatenate([p[i] for p in parts]) for i in range(4))
            window = np.concatenate([p[4] for p in parts])
            begin = np.cumsum(count) - count
            digest = mix(window + U64(1))
            digest = np.add.reduceat(digest * (ragged(np.zeros_like(count), count).astype(U64) * U64(2) + U64(1)), begin)
            order = np.lexsort((digest, name))
            first = np.ones(len(order), bool)
            first[1:] = (name[order][1:] != name[order][:-1]) | (digest[order][1:] != digest[order][:-1])
            leader = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
            ref = np.empty(len(order), np.int64)
            ref[order] = leader
            own = ref == np.arange(len(ref))
            # the leader of equal blocks has an equal one too
            last = np.empty(len(order), np.int64)
            group = np.cumsum(first) - 1
            ends = np.append(np.flatnonzero(first)[1:], len(order)) - 1
            last[order] = order[ends[group]]
            settled = np.where(own, last, ref)
            alone = settled == np.arange(len(ref))
            raw = window.tobytes()
            packed = [raw[8 * a:8 * (a + c)] if o else None for a, c, o in zip(begin.tolist(), count.tolist(), own.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.where(own, name, key)), pa.array(name), pa.array(key), pa.array(start.astype(np.int32)),
                 pa.array(count.astype(np.int32)), pa.array(packed, pa.binary()),
                 pa.array(key[settled], mask=alone), pa.array(start[settled].astype(np.int32), mask=alone)],
                names=[f.split()[0] for f in fields.split(", ")])

    return docs.mapInArrow(run, fields)


def _first_word(b: Blocks, at: np.ndarray) -> np.ndarray:
    """Index in the slice of the first word of the text that each block belongs to."""
    owners = b.block_owner[at]
    # the first window of a text starts at its first word
    return b.at[np.searchsorted(b.owner, owners)]


def _factors(blocks: DataFrame) -> DataFrame:
    """key, start, n, ref_key, ref_start: n windows from a word that continue in the reference."""
    fields = "key long, start int, n int, ref_key long, ref_start int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(batches)
        if table is None:
            return
        settled = table.filter(table.column("ref_key").is_valid())
        yield from settled.select(["key", "start", "n", "ref_key", "ref_start"]).combine_chunks().to_batches()
        table = table.filter(table.column("windows").is_valid()).combine_chunks()
        if not table.num_rows:
            return
        name, key, start, n = (table.column(c).to_numpy() for c in ("name", "key", "start", "n"))
        window = np.frombuffer(b"".join(table.column("windows").to_pylist()), U64)
        block = np.repeat(np.arange(len(n)), n)
        place = ragged(np.zeros(len(n), np.int64), n.astype(np.int64))
        order = np.lexsort((block, window, name[block]))
        w, o = window[order], name[block][order]
        same = (w[1:] == w[:-1]) & (o[1:] == o[:-1])
        # the reference of a window is the next equal one, that of the last is the first
        head = np.ones(len(order), bool)
        head[1:] = ~same
        first = np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))
        following = np.arange(1, len(order) + 1)
        tail = np.append(head[1:], True)
        following[tail] = first[tail]
        shared = ~(head & tail)
        ref = np.full(len(order), -1)
        ref[order[shared]] = order[following[shared]]
        cell = np.flatnonzero(ref >= 0)
        if not len(cell):
            return
        to = ref[cell]
        new = np.ones(len(cell), bool)
        new[1:] = (np.diff(cell) != 1) | (block[cell][1:] != block[cell][:-1]) | (np.diff(to) != 1) | \
                  (block[to][1:] != block[to][:-1])
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(cell)))
        a, b = cell[head], to[head]
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[block[a]]), pa.array((start[block[a]] + place[a]).astype(np.int32)),
             pa.array(count.astype(np.int32)), pa.array(key[block[b]]),
             pa.array((start[block[b]] + place[b]).astype(np.int32))], names=[f.split()[0] for f in fields.split(", ")])

    return blocks.repartition("deal").mapInArrow(run, fields)


def factors(docs: DataFrame, length: int = 35, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """key, start, n, ref_key, ref_start: from word `start` of text `key`, n + length - 1 words also stand
    from word `ref_start` of text `ref_key`. `key` is xxhash64(id, text)."""
    keyed = _keyed(docs, id_column, text_column)
    repeated = _repeated_names(_names(keyed, length)).groupBy("key").agg(F.collect_set("name").alias("names"))
    joined = keyed.join(repeated.hint("shuffle_hash"), "key").select("key", "text", "names")
    return _factors(_sent_blocks(joined, length))


def remove_repeats(docs: DataFrame, length: int = 35, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_words, n_removed and the kept words joined by single spaces, of every row."""
    return _cut(docs, length, id_column, text_column, False)


def digest_repeats(docs: DataFrame, length: int = 35, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """As `remove_repeats`, with the SHA-256 of the kept text as kept_sha256 in its place."""
    return _cut(docs, length, id_column, text_column, True)


def _cut(docs: DataFrame, length: int, id_column: str, text_column: str, digest: bool) -> DataFrame:
    found = factors(docs, length, id_column, text_column)
    spans = found.groupBy("key").agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("counts"))
    keyed = _keyed(docs, id_column, text_column)
    joined = keyed.join(spans.hint("shuffle_hash"), "key", "left").select("id", "text", "starts", "counts")
    last = "kept_sha256" if digest else text_column

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, buf, offsets in slices(batch.column(1)):
                part = batch.slice(row, len(offsets) - 1)
                words = Words(buf, offsets)
                starts, counts = part.column(2), part.column(3)
                flat = starts.flatten().to_numpy(zero_copy_only=False)
                size = np.nan_to_num(np.asarray(starts.value_lengths().fill_null(0))).astype(np.int64)
                begin = flat + np.repeat(words.bounds[:-1], size)
                change = np.zeros(len(words.starts) + 1, np.int64)
                np.add.at(change, begin, 1)
                np.add.at(change, begin + counts.flatten().to_numpy(zero_copy_only=False) + length - 1, -1)
                gone = np.cumsum(change[:-1]) > 0
                kept = np.flatnonzero(~gone)
                removed = np.zeros(len(words.starts) + 1, np.int64)
                np.cumsum(gone, out=removed[1:])
                n_removed = removed[words.bounds[1:]] - removed[words.bounds[:-1]]
                width = words.ends[kept] - words.starts[kept] + 1
                out = np.append(buf, np.uint8(0x20))[ragged(words.starts[kept], width)]
                total = np.concatenate([[0], np.cumsum(width)])
                out[total[1:] - 1] = 0x20
                edge = total[np.searchsorted(kept, words.bounds)].tolist()
                texts = [out[a:max(a, b - 1)] for a, b in zip(edge[:-1], edge[1:])]
                shown = [hashlib.sha256(t).hexdigest() if digest else t.tobytes().decode("utf-8") for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words.counts.astype(np.int64)),
                                                  pa.array(n_removed), pa.array(shown, pa.string())],
                                                 names=[id_column, "n_words", "n_removed", last])

    kind = docs.schema[id_column].dataType.simpleString()
    return joined.mapInArrow(run, f"`{id_column}` {kind}, n_words long, n_removed long, `{last}` string")
