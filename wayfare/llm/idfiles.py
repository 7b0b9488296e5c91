"""Token-id files: every text's ids with an end id, in ascending order of the text's id.

The file format is a folder of Parquet part files, so that any store and lost tasks are Spark's concern. A
row is one block of whole documents: `part` and `block` (its place in the order), `n_ids`, `docs` (the
documents' ids), `sizes` (their numbers of token ids, little-endian 32-bit, zlib) and `data`, the token ids
packed by `coder`, which resets its model for each block and checks a CRC-32.

Texts are dealt out by ranges of their id and sorted there, so `part` orders the blocks. Words between
white space are encoded once and then looked up by a 64-bit hash in a table that each Python worker keeps; the
vocabulary's own rules never look across white space, which `IdWords` checks. New words of plain Latin characters
are merged together by `merges` (`LatinWords`); all others go to the tokenizers library.

Edge cases: a null or empty text has only its end id; equal ids are ordered by text; a null id comes first;
an empty table gives files without blocks; other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfare.llm import coder
from wayfare.llm.merges import PairTable, merge
from wayfare.llm.tokens import byte_symbols
from wayfare.llm.words import KeyTable, Words, ragged, slices

CACHE_BITS = 21
MARK = 0x01
BLOCK_IDS = 1 << 22


#: The rules that `LatinWords` follows.
LATIN_RULES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN_NORMAL = ["NFC", "Replace", "Lowercase"]


class LatinWords:
    """Ids of words of ASCII and of the letters from U+00C0 to U+00FF, by merging all of them together.

    Such words have no other form under the normal form of the file; an apostrophe or a less-than sign, which may
    open a suffix or a special string, makes a word none of these. A word is cut between letters, single digits
    and runs of other characters; the bytes of a cut are the first symbols, the last one with the mark of a word's end.
    """

    def __init__(self, spec: dict):
        vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        pairs = [m if isinstance(m, list) else m.split(" ", 1) for m in spec["model"]["merges"]]
        self.pairs = PairTable(np.array([vocab[a] for a, _ in pairs]), np.array([vocab[b] for _, b in pairs]),
                               np.arange(len(pairs)), np.array([vocab[a + b] for a, b in pairs]))
        self.inner, self.last = np.zeros(256, np.int32), np.zeros(256, np.int32)
        for char, byte in byte_symbols().items():
            self.inner[byte], self.last[byte] = vocab[char], vocab[char + suffix]
        self.kind = np.full(256, 2, np.uint8)  # letters 0, digits 1, others 2
        self.kind[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = 0
        self.kind[48:58] = 1
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.plain = np.zeros(256, bool)
        self.plain[0x21:0x7F] = True
        self.plain[[0x27, 0x3C]] = False

    @staticmethod
    def fits(spec: dict) -> bool:
        model, steps, normal = spec["model"], spec["pre_tokenizer"].get("pretokenizers", []), spec["normalizer"] or {}
        return (model["type"] == "BPE" and bool(model["end_of_word_suffix"]) and len(steps) == 2 and steps[1]["type"] == "ByteLevel"
                and not steps[1]["add_prefix_space"] and not steps[1]["use_regex"] and not model["ignore_merges"]
                and steps[0].get("pattern", {}).get("Regex") == LATIN_RULES
                and [n["type"] for n in normal.get("normalizers", [])] == LATIN_NORMAL)

    def holds(self, words: Words, where: np.ndarray) -> np.ndarray:
        """Which of the words are made of these characters alone."""
        buf = words.buf
        after = np.zeros(len(buf), bool)
        after[1:] = buf[:-1] == 0xC3
        good = self.plain[buf] | (buf == 0xC3) | (after & (buf >= 0x80) & (buf < 0xC0) & (buf != 0x97) & (buf != 0xB7))
        bad = np.zeros(len(buf) + 1, np.int64)
        np.cumsum(~good, out=bad[1:])
        return bad[words.ends[where]] == bad[words.starts[where]]

    def encode(self, words: Words, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these words end to end, and the number of each."""
        size = words.ends[where] - words.starts[where]
        raw = words.buf[ragged(words.starts[where], size)]
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(len(where), np.int64)
        second = np.zeros(len(raw), bool)
        second[1:] = raw[:-1] == 0xC3
        text = np.where(second & (raw >= 0x80) & (raw < 0x9F), raw + np.uint8(0x20), self.lower[raw])
        kind = self.kind[text]
        begin = np.ones(len(text), bool)
        begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 1)
        first = np.cumsum(size) - size
        begin[first] = True
        at = np.flatnonzero(begin)
        end = np.append(at[1:], len(text)) - 1
        symbols = self.inner[text]
        symbols[end] = self.last[text[end]]
        ids, n = merge(symbols, end + 1 - at, self.pairs)
        total = np.concatenate([[0], np.cumsum(n)])
        edge = np.append(np.searchsorted(at, first), len(at))
        return ids, total[edge[1:]] - total[edge[:-1]]


class IdWords:
    """A vocabulary file of the tokenizers library that drops white space, and the words seen so far."""

    def __init__(self, path: str):
        self.tokenizer = tokenizers.Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        if not any(s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"] for s in steps):
            raise ValueError("only vocabularies that drop the white space between words are read")
        self.symbols = self.tokenizer.get_vocab_size(with_added_tokens=True)
        mark = self.tokenizer.encode(chr(MARK), add_special_tokens=False).ids
        if len(mark) != 1:
            raise ValueError("the vocabulary has no id for the mark between words")
        self.mark = mark[0]
        self.latin = LatinWords(spec) if LatinWords.fits(spec) else None
        self.table = KeyTable(CACHE_BITS)
        self.clear()

    def clear(self) -> None:
        self.table.clear()
        self.ids = np.zeros(1 << 20, np.int32)
        self.used, self.number = 0, 0
        self.at, self.size = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int32)

    def _encode(self, words: Words, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some words end to end, and the number of each."""
        if self.latin is None:
            return self._by_library(words, where)
        fast = self.latin.holds(words, where)
        n, parts = np.zeros(len(where), np.int64), []
        for chosen, encode in ((np.flatnonzero(fast), self.latin.encode), (np.flatnonzero(~fast), self._by_library)):
            ids, n[chosen] = encode(words, where[chosen])
            parts.append((chosen, ids))
        out, first = np.empty(int(n.sum()), np.int32), np.cumsum(n) - n
        for chosen, ids in parts:
            out[ragged(first[chosen], n[chosen])] = ids
        return out, n

    def _by_library(self, words: Words, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """They go to the library as one text, with a control character as a word of its own between them; words
        that hold it go one by one."""
        if not len(where):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        size = words.ends[where] - words.starts[where]
        marked = np.zeros(len(words.buf) + 1, np.int64)
        np.cumsum(words.buf == MARK, out=marked[1:])
        odd = marked[words.ends[where]] > marked[words.starts[where]]
        where_odd, plain = where[odd], np.flatnonzero(~odd)
        at = np.cumsum(size[plain] + 3) - size[plain] - 3
        joined = np.full(int((size[plain] + 3).sum()), 0x20, np.uint8)
        joined[ragged(at, size[plain])] = words.buf[ragged(words.starts[where[plain]], size[plain])]
        joined[at + size[plain] + 1] = MARK
        found = np.array(self.tokenizer.encode_batch_fast([joined.tobytes().decode("utf-8")], add_special_tokens=False)[0].ids, np.int32)
        ends = np.flatnonzero(found == self.mark)
        n = np.zeros(len(where), np.int64)
        n[plain] = np.diff(ends, prepend=-1) - 1
        found = found[found != self.mark]
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(
            [words.buf[a:b].tobytes().decode("utf-8") for a, b in zip(words.starts[where_odd], words.ends[where_odd])],
            add_special_tokens=False)]
        n[odd] = [len(x) for x in lists]
        out = np.empty(int(n.sum()), np.int32)
        first = np.cumsum(n) - n
        out[ragged(first[plain], n[plain])] = found
        out[ragged(first[odd], n[odd])] = [i for x in lists for i in x]
        return out, n

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of a slice end to end, and the number of ids of each."""
        words = Words(buf, offsets)
        keys = words.hashes()
        number = self.table.find(keys)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new, where = np.unique(keys[missing], return_index=True)
            where = missing[where]
            if len(new) > self.table.room:
                self.clear()
                new, where = np.unique(keys, return_index=True)
                missing = np.arange(len(keys))
                if len(new) > self.table.room:  # one slice with more words than the table holds
                    ids, size = self._encode(words, np.arange(len(keys)))
                    return ids, self._per_text(size, words)
            ids, size = self._encode(words, where)
            need = self.number + len(new)
            while need > len(self.at):
                self.at, self.size = (np.append(x, np.zeros(len(x), np.int32)) for x in (self.at, self.size))
            while self.used + len(ids) > len(self.ids):
                self.ids = np.append(self.ids, np.zeros(len(self.ids), np.int32))
            self.ids[self.used:self.used + len(ids)] = ids
            self.at[self.number:need] = self.used + np.cumsum(size) - size
            self.size[self.number:need] = size
            self.table.add(new, self.number + np.arange(len(new)))
            self.used, self.number = self.used + len(ids), need
            number[missing] = self.table.find(keys[missing])
        size = self.size[number].astype(np.int64)
        return self.ids[ragged(self.at[number].astype(np.int64), size)], self._per_text(size, words)

    @staticmethod
    def _per_text(size: np.ndarray, words: Words) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(size)])
        return total[words.bounds[1:]] - total[words.bounds[:-1]]


_loaded: dict[str, IdWords] = {}


def id_words(path: str) -> IdWords:
    """The vocabulary at `path`, read once by each Python worker."""
    if path not in _loaded:
        _loaded[path] = IdWords(path)
    return _loaded[path]


def with_end(ids: np.ndarray, size: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """ids with the end id after each text, and the sizes with it."""
    out = np.full(len(ids) + len(size), end_id, np.int32)
    place = np.ones(len(out), bool)
    place[np.cumsum(size + 1) - 1] = False
    out[place] = ids
    return out, size + 1


def write_ids(docs: DataFrame, path: str, vocabulary: str, end_id: int = 1, id_column: str = "doc_id",
              text_column: str = "text", parts: int | None = None) -> None:
    """Encode every text and write the files."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = id_words(vocabulary)
        part, block = TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        n = 0

        def flush() -> pa.RecordBatch:
            docs = pa.concat_arrays([d for d, _, _ in held])
            sizes = np.concatenate([s for _, s, _ in held])
            ids = np.concatenate([i for _, _, i in held])
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs),
                 pa.array([zlib.compress(sizes.astype("<u4").tobytes())], pa.binary()),
                 pa.array([coder.pack(ids, words.symbols)], pa.binary())],
                names=["part", "block", "n_ids", "docs", "sizes", "data"])

        for batch in batches:
            for row, buf, offsets in slices(batch.column(1)):
                ids, size = with_end(*words.encode(buf, offsets), end_id)
                held.append((batch.column(0).slice(row, len(size)), size, ids))
                n += len(ids)
                if n >= BLOCK_IDS:
                    yield flush()
                    held, n, block = [], 0, block + 1
        if held:
            yield flush()

    ordered = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")) \
        .repartitionByRange(parts, "id").sortWithinPartitions("id", "text")
    ordered.mapInArrow(run, f"part int, block int, n_ids long, docs array<{kind}>, sizes binary, data binary").write.parquet(path)


def read_ids(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """id, start (ids of all documents before it), n_tokens and ids of every document of the files."""
    return _read(spark, path, id_column, "ids array<int>", lambda ids, edge: pa.ListArray.from_arrays(
        pa.array(edge.astype(np.int32)), pa.array(ids.astype(np.int32))))


def digest_ids(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """id, start, n_tokens and the CRC-32 of the ids as little-endian 32-bit numbers, from the files."""

    def digest(ids: np.ndarray, edge: np.ndarray) -> pa.Array:
        raw = memoryview(ids.astype("<u4").tobytes())
        return pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())], pa.int64())

    return _read(spark, path, id_column, "ids_crc32 long", digest)


def _read(spark: SparkSession, path: str, id_column: str, last: str, column) -> DataFrame:
    blocks = spark.read.parquet(path)
    kind = blocks.schema["docs"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                one = batch.slice(r, 1)
                docs = one.column(2).flatten()
                size = np.frombuffer(zlib.decompress(one.column(3)[0].as_py()), "<u4").astype(np.int64)
                ids = coder.unpack(one.column(4)[0].as_py())
                edge = np.concatenate([[0], np.cumsum(size)])
                if len(size) != len(docs) or edge[-1] != len(ids):
                    raise ValueError("damaged block: sizes of documents")
                for a in range(0, len(docs), 2000):
                    b = min(a + 2000, len(docs))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(b - a, one.column(0)[0].as_py(), np.int32)),
                         pa.array(np.full(b - a, one.column(1)[0].as_py(), np.int32)), docs.slice(a, b - a),
                         pa.array(edge[a:b]), pa.array(size[a:b]), column(ids[edge[a]:edge[b]], edge[a:b + 1] - edge[a])],
                        names=["part", "block", id_column, "within", "n_tokens", last.split()[0]])

    rows = blocks.select("part", "block", "docs", "sizes", "data").mapInArrow(
        run, f"part int, block int, `{id_column}` {kind}, within long, n_tokens long, {last}")
    # only the blocks' heads are ordered here, a row for each part and then for each block of a part
    heads = blocks.select("part", "block", "n_ids")
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = heads.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", before.alias("part_start"))
    inner = F.coalesce(F.sum("n_ids").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = heads.select("part", "block", inner.alias("block_start")).join(parts, "part") \
        .select("part", "block", (F.col("part_start") + F.col("block_start")).alias("base"))
    return rows.join(starts, ["part", "block"]).select(
        F.col(id_column), (F.col("base") + F.col("within")).alias("start"), "n_tokens", last.split()[0])
