"""Token counts of a byte-level BPE vocabulary, without a list of tokens per text.

Texts are cut into pre-tokens by array operations on their code points. Pre-tokens are looked up by a
64-bit hash in a table of counts that each Python worker keeps; those not in it yet are merged together by
`merges.merge`, and the symbols that survive are counted.

Edge cases: a null or empty text has 0 bytes and 0 tokens; repeated rows give repeated rows; a text equal
to a special string counts one token for it, as the library does; columns of the input other than the id
and the text are not read, so their names cannot clash.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.merges import PairTable, merge
from wayfare.llm.words import KeyTable, ragged, slices, span_hashes, sums

CACHE_BITS = 20
#: White space of the pattern, and the suffixes that split from a word after an apostrophe.
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
SUFFIXES = ["s", "t", "re", "ve", "m", "ll", "d"]
SPACE, LETTER, NUMBER, OTHER = range(4)


def char_classes() -> np.ndarray:
    """Class of every code point: white space, letter, number or other."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[WHITE] = SPACE
    return out


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Vocabulary and merges of a byte-level BPE file, and the counts of pre-tokens seen so far."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        merges = [m if isinstance(m, list) else m.split(" ", 1) for m in merges]
        left, right, made = (np.array([vocab[x] for x in part]) for part in
                             ([a for a, _ in merges], [b for _, b in merges], [a + b for a, b in merges]))
        self.pairs = PairTable(left, right, np.arange(len(merges)), made)
        self.start = np.zeros(256, np.int32)
        for char, byte in byte_symbols().items():
            self.start[byte] = vocab[char]
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        self.classes = char_classes()
        self.table = KeyTable(CACHE_BITS)
        self.counts = np.zeros(0, np.int32)

    def starts(self, points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """True where a pre-token begins; `firsts` is True at the first character of each text."""
        n = len(points)
        kind = self.classes[points]
        begin = firsts.copy()
        begin[1:] |= kind[1:] != kind[:-1]
        last_white = np.zeros(n, bool)
        last_white[:-1] = (kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~firsts[1:]
        begin |= last_white
        begin[np.flatnonzero(last_white & (points == 0x20)) + 1] = False
        quote = np.flatnonzero(begin & (points == ord("'")))
        quote = quote[quote + 1 < n]
        quote = quote[~firsts[quote + 1]]
        for suffix in SUFFIXES:
            k = len(suffix)
            at = quote[quote + k < n]
            fits = np.ones(len(at), bool)
            for i, char in enumerate(suffix):
                fits &= (points[at + 1 + i] == ord(char)) & ~firsts[at + 1 + i]
            at = at[fits]
            begin[at + 1] = False
            after = at + 1 + k
            after = after[after < n]
            begin[after[kind[after] == LETTER]] = True
        return begin

    def tally(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text of a slice that holds no special string."""
        n_texts = len(offsets) - 1
        if not len(buf):
            return np.zeros(n_texts, np.int64)
        points = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
        heads = np.flatnonzero((buf & 0xC0) != 0x80)
        bounds = np.searchsorted(heads, offsets)
        firsts = np.zeros(len(points), bool)
        firsts[bounds[:-1][bounds[:-1] < len(points)]] = True
        at = np.flatnonzero(self.starts(points, firsts))
        begin = heads[at]
        end = np.append(begin[1:], len(buf))
        counts = self.lookup(buf, begin, end)
        return sums(counts, np.searchsorted(begin, offsets))

    def lookup(self, buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        keys = span_hashes(buf, begin, end)
        number = self.table.find(keys)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new, where = np.unique(keys[missing], return_index=True)
            where = missing[where]
            if len(new) > self.table.room:
                self.table.clear()
                self.counts = np.zeros(0, np.int32)
                new, where = np.unique(keys, return_index=True)
                if len(new) > self.table.room:  # one slice with more pre-tokens than the table holds
                    return self.merged(buf, begin, end)
                missing = np.arange(len(keys))
            self.table.add(new, len(self.counts) + np.arange(len(new)))
            self.counts = np.append(self.counts, self.merged(buf, begin[where], end[where]))
            number[missing] = self.table.find(keys[missing])
        return self.counts[number]

    def merged(self, buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        lengths = end - begin
        return merge(self.start[buf[ragged(begin, lengths)]], lengths, self.pairs)[1].astype(np.int32)

    def count(self, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text of a slice."""
        raw = buf.tobytes()
        cuts = sorted((i, i + len(s)) for s in (x.encode() for x in self.special) for i in _places(raw, s))
        if not cuts:
            return self.tally(buf, offsets)
        # the parts between special strings are texts of their own
        out = np.zeros(len(offsets) - 1, np.int64)
        for row in range(len(offsets) - 1):
            text = raw[offsets[row]:offsets[row + 1]]
            parts, special = [text], 0
            for s in (x.encode() for x in self.special):
                split = [p.split(s) for p in parts]
                special += sum(len(p) - 1 for p in split)
                parts = [x for p in split for x in p]
            sizes = np.cumsum([0, *map(len, parts)])
            out[row] = special + self.tally(np.frombuffer(b"".join(parts), np.uint8), sizes).sum()
        return out


def _places(raw: bytes, s: bytes) -> Iterator[int]:
    i = raw.find(s)
    while i >= 0:
        yield i
        i = raw.find(s, i + len(s))


_loaded: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    """The vocabulary at `path`, read once by each Python worker."""
    if path not in _loaded:
        _loaded[path] = ByteBpe(path)
    return _loaded[path]


def count_tokens(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text",
                 limit: int = 1024) -> DataFrame:
    """id, n_bytes, n_tokens and over_limit (more than `limit` tokens) of every row; no shuffle.

    `vocabulary` is the path of a byte-level BPE file on every machine.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary)
        for batch in batches:
            tokens, sizes = [], []
            for _, buf, offsets in slices(batch.column(1)):
                tokens.append(bpe.count(buf, offsets))
                sizes.append(np.diff(offsets))
            n = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(n), pa.array(n > limit)],
                                             names=[id_column, "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column), F.col(text_column).cast("string")).mapInArrow(
        run, f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
