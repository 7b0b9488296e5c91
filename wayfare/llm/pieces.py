"""SentencePiece BPE: encoding with the original byte span of every piece, and decoding.

Normalisation walks a text through the model's compiled character map, always taking the longest prefix
that the map knows, and records for each normalised byte the source byte that it comes from. The
normalised text is cut where no piece can cross (before a run of spaces, around characters that are in no
longer piece); these chunks are looked up by a 64-bit hash in a table that each Python worker keeps, and
new ones are merged together by `merges.merge`. As the pieces of a text lie end to end, cumulated piece
lengths give their spans in normalised bytes, and the alignment projects them to source bytes.

Edge cases: a null or empty text has no ids and decodes to an empty text; characters outside the
vocabulary become byte pieces (or the unknown id, if the model has no byte pieces); repeated rows give
repeated rows; columns other than id and text are not read, so their names cannot clash. Models with
user-defined pieces, another algorithm than BPE or a denormaliser are refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from wayfare.llm.merges import PairTable, merge
from wayfare.llm.words import KeyTable, ragged, slices, span_hashes

CACHE_BITS = 20
SPACE = 0x2581
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6


def character_map(blob: bytes) -> dict[bytes, bytes]:
    """All rules of a compiled character map: a double-array trie of keys, then zero-ended replacements."""
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
    texts = blob[4 + size:]

    def base(unit: int) -> int:
        return unit >> 10 << ((unit & 1 << 9) >> 6)

    rules, todo = {}, [(base(units[0]), b"")]
    while todo:
        node, key = todo.pop()
        for byte in range(1, 256):
            child = node ^ byte
            if child >= len(units) or units[child] & (1 << 31 | 0xFF) != byte:
                continue
            unit = units[child]
            if unit >> 8 & 1:
                at = units[child ^ base(unit)] & (1 << 31) - 1
                rules[key + bytes([byte])] = texts[at:texts.index(b"\0", at)]
            todo.append((child ^ base(unit), key + bytes([byte])))
    return rules


class Pieces:
    """A SentencePiece BPE model."""

    def __init__(self, path: str):
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        kinds = [p.type for p in model.pieces]
        if model.trainer_spec.model_type != 2 or USER in kinds or model.denormalizer_spec.precompiled_charsmap:
            raise ValueError("only BPE models without user-defined pieces and denormaliser are read")
        spec = model.normalizer_spec
        if not spec.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models that write spaces as a prefix of pieces are read")
        self.rules = character_map(spec.precompiled_charsmap)
        self.longest = max(map(len, self.rules), default=0)
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.n = len(model.pieces)
        names = [p.piece for p in model.pieces]
        ids = {name: i for i, (name, kind) in enumerate(zip(names, kinds)) if kind == NORMAL}
        self.byte_id = np.full(256, kinds.index(UNKNOWN), np.int32)
        for i, kind in enumerate(kinds):
            if kind == BYTE:
                self.byte_id[int(names[i][3:-1], 16)] = i
        self.has_bytes = BYTE in kinds
        self.unknown = kinds.index(UNKNOWN)
        self.char_symbol = np.arange(0x110000, dtype=np.int32) + self.n  # a character that is no piece
        for name, i in ids.items():
            if len(name) == 1:
                self.char_symbol[ord(name)] = i
        self.joins = np.zeros(0x110000, bool)  # characters of longer pieces
        self.joins[[ord(c) for c in {c for name in ids if len(name) > 1 for c in name}]] = True
        self.inner_space = np.zeros(0, np.int64)

        def symbol(part: str) -> int | None:
            return int(self.char_symbol[ord(part)]) if len(part) == 1 else ids.get(part)

        rows = []
        for name, i in ids.items():
            if SPACE in map(ord, name.lstrip(chr(SPACE))):
                raise ValueError("a piece crosses a space")
            for k in range(1, len(name)):
                left, right = symbol(name[:k]), symbol(name[k:])
                if left is not None and right is not None:
                    rows.append((left, right, model.pieces[i].score, i))
        order = sorted({r[2] for r in rows}, reverse=True)
        rank = {score: k for k, score in enumerate(order)}
        left, right, score, made = zip(*rows)
        self.pairs = PairTable(np.array(left), np.array(right), np.array([rank[s] for s in score]), np.array(made))
        shown = [bytes([int(x[3:-1], 16)]) if kind == BYTE else b"" if kind == CONTROL else
                 " ⁇ ".encode() if kind == UNKNOWN else x.replace(chr(SPACE), " ").encode()
                 for x, kind in zip(names, kinds)]
        self.shown, self.shown_at, self.shown_size = _pack(shown)
        self.digits, self.digits_at, self.digits_size = _pack([f"{i},".encode() for i in range(self.n)])
        # normalised bytes that a piece stands for
        self.width = np.array([1 if kind == BYTE else len(x.encode()) for x, kind in zip(names, kinds)])
        self.is_byte = np.array([kind == BYTE for kind in kinds])
        self.starts_blank = np.array([x.startswith(chr(SPACE)) for x in names])
        self.table = KeyTable(CACHE_BITS)
        self.clear()

    def clear(self) -> None:
        self.table.clear()
        self.ids = np.zeros(1 << 20, np.int32)
        self.used = 0
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int32)

    # -- normalisation ---------------------------------------------------------------------------------

    def normalise(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Normalised bytes of a slice, their offsets by text, and the source byte of each normalised byte.

        The alignment has one more entry, the end of the slice.
        """
        if self.rules or self.squeeze:
            return self._normalise_by_map(buf, offsets)
        space = np.frombuffer(chr(SPACE).encode(), np.uint8)
        sizes = np.diff(offsets)
        full = sizes > 0
        wide = buf == 0x20
        width = np.where(wide, 3, 1)
        begin = np.zeros(len(buf) + 1, np.int64)
        np.cumsum(width, out=begin[1:])
        lead = np.cumsum(full) * 3 if self.prefix else np.zeros(len(full), np.int64)  # prefixes up to and with each text
        owner = np.repeat(np.arange(len(sizes)), sizes)
        place = begin[:-1] + lead[owner]
        out_offsets = np.zeros(len(offsets), np.int64)
        out_offsets[1:] = begin[offsets[1:]] + lead
        out = np.empty(int(out_offsets[-1]), np.uint8)
        source = np.empty(len(out) + 1, np.int64)
        source[-1] = len(buf)
        out[place] = buf
        source[place] = np.arange(len(buf))
        at = np.flatnonzero(wide)
        for i in range(3):
            out[place[at] + i] = space[i]
            source[place[at] + i] = at
        if self.prefix:
            first = out_offsets[:-1][full]
            for i in range(3):
                out[first + i] = space[i]
                source[first + i] = offsets[:-1][full]
        return out, out_offsets, source

    def _normalise_by_map(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        raw, out, source, bounds = buf.tobytes(), bytearray(), [], [0]
        blank = chr(SPACE).encode()
        for row in range(len(offsets) - 1):
            i, end = int(offsets[row]), int(offsets[row + 1])
            parts: list[tuple[bytes, int]] = []
            while i < end:
                for k in range(min(self.longest, end - i), 0, -1):
                    if (to := self.rules.get(raw[i:i + k])) is not None:
                        break
                else:
                    k = 1
                    while i + k < end and raw[i + k] & 0xC0 == 0x80:
                        k += 1
                    to = raw[i:i + k]
                parts.append((to, i))
                i += k
            if self.squeeze:
                parts = _squeezed(parts)
            if parts and self.prefix:
                parts.insert(0, (b" ", parts[0][1]))
            for to, at in parts:
                for byte in to:
                    piece = blank if byte == 0x20 else bytes([byte])
                    out += piece
                    source += [at] * len(piece)
            bounds.append(len(out))
        return np.frombuffer(bytes(out), np.uint8), np.array(bounds), np.array([*source, len(buf)])

    # -- encoding --------------------------------------------------------------------------------------

    def encode(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of normalised texts end to end, and the bounds of each text's ids."""
        if not len(buf):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        points = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
        heads = np.flatnonzero((buf & 0xC0) != 0x80)
        bounds = np.searchsorted(heads, offsets)
        blank = points == SPACE
        cut = np.zeros(len(points) + 1, bool)
        cut[1:-1] = blank[1:] & ~blank[:-1]
        alone = np.flatnonzero(~self.joins[points])
        cut[alone] = True
        cut[alone + 1] = True
        cut[bounds] = True
        first = np.flatnonzero(cut[:-1])
        begin = heads[first]
        end = np.append(begin[1:], len(buf))
        keys = span_hashes(buf, begin, end)
        number = self.table.find(keys)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new, where = np.unique(keys[missing], return_index=True)
            where = missing[where]
            if len(new) > self.table.room:
                self.clear()
                new, where = np.unique(keys, return_index=True)
                missing = np.arange(len(keys))
                if len(new) > self.table.room:  # one slice with more chunks than the table holds
                    ids, sizes = self._merged(points, first, np.append(first[1:], len(points)))
                    total = np.concatenate([[0], np.cumsum(sizes)])
                    return ids, total[np.searchsorted(begin, offsets)]
            last = np.append(first[1:], len(points))
            ids, sizes = self._merged(points, first[where], last[where])
            self.table.add(new, len(self.at) + np.arange(len(new)))
            self.at = np.append(self.at, self.used + np.cumsum(sizes) - sizes)
            self.size = np.append(self.size, sizes.astype(np.int32))
            while self.used + len(ids) > len(self.ids):
                self.ids = np.append(self.ids, np.zeros(len(self.ids), np.int32))
            self.ids[self.used:self.used + len(ids)] = ids
            self.used += len(ids)
            number[missing] = self.table.find(keys[missing])
        size = self.size[number].astype(np.int64)
        total = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        return self.ids[ragged(self.at[number], size)], total[np.searchsorted(begin, offsets)]

    def _merged(self, points: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = last - first
        symbols, sizes = merge(self.char_symbol[points[ragged(first, sizes)]], sizes, self.pairs)
        strange = np.flatnonzero(symbols >= self.n)
        if not len(strange):
            return symbols, sizes
        if not self.has_bytes:
            symbols[strange] = self.unknown
            return symbols, sizes
        spelled = [self.byte_id[list(chr(c).encode())] for c in (symbols[strange] - self.n).tolist()]
        width = np.ones(len(symbols), np.int64)
        width[strange] = [len(x) for x in spelled]
        out = np.repeat(symbols, width)
        out[out >= self.n] = np.concatenate(spelled)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        return out, np.bincount(owner, weights=width, minlength=len(sizes)).astype(np.int64)

    def spans(self, ids: np.ndarray, bounds: np.ndarray, offsets: np.ndarray, source: np.ndarray,
              buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Source byte span of every id, within its text; `offsets` are those of the source texts."""
        width = self.width[ids]
        if not self.has_bytes:  # an unknown id stands for one normalised character
            strange = np.flatnonzero(ids == self.unknown)
            for i in strange:  # widths before it are right by then
                head = int(width[:i].sum())
                width[i] = len(buf[head:head + 4].tobytes().decode("utf-8", "ignore")[:1].encode())
        end = np.cumsum(width)
        start = end - width
        base = np.repeat(offsets[:-1], np.diff(bounds))
        stop = np.repeat(offsets[1:], np.diff(bounds))
        return source[start] - base, np.minimum(_next_source(source)[end - 1], stop) - base

    # -- decoding --------------------------------------------------------------------------------------

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the decoded texts end to end, and their bounds."""
        skip = np.zeros(len(ids), np.int64)
        if self.prefix:
            first, last = bounds[:-1][np.diff(bounds) > 0], bounds[1:][np.diff(bounds) > 0]
            while len(hidden := np.flatnonzero(self.shown_size[ids[first]] == 0)):  # control pieces show nothing
                first[hidden] += 1
                first, last = first[first < last], last[first < last]
            skip[first] = self.starts_blank[ids[first]]
        size = self.shown_size[ids] - skip
        total = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        out = self.shown[ragged(self.shown_at[ids] + skip, size)]
        where = total[bounds]
        if self.is_byte[ids].any():
            try:
                out.tobytes().decode("utf-8")
            except UnicodeDecodeError:  # byte pieces that form no character: each becomes U+FFFD
                texts = [_repaired(out[a:b].tobytes()) for a, b in zip(where[:-1], where[1:])]
                return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        return out, where


def _next_source(source: np.ndarray) -> np.ndarray:
    """For each normalised byte the source byte where the next different source byte begins."""
    out = np.empty(len(source) - 1, np.int64)
    change = np.flatnonzero(np.diff(source)) + 1
    ends = source[change]
    out[:] = source[-1]
    if len(change):
        owner = np.searchsorted(change, np.arange(len(out)), side="right")
        known = owner < len(ends)
        out[known] = ends[owner[known]]
    return out


def _repaired(raw: bytes) -> bytes:
    out, i = [], 0
    while i < len(raw):
        for k in (1, 2, 3, 4):
            try:
                out.append(raw[i:i + k].decode("utf-8"))
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            k = 1
        i += k
    return "".join(out).encode()


def _squeezed(parts: list[tuple[bytes, int]]) -> list[tuple[bytes, int]]:
    """Without leading and trailing spaces, and one space of each run."""
    out: list[tuple[bytes, int]] = []
    for to, at in parts:
        for byte in to:
            if byte == 0x20 and (not out or out[-1][0] == b" "):
                continue
            out.append((bytes([byte]), at))
    while out and out[-1][0] == b" ":
        out.pop()
    return out


def _pack(items: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = np.array([len(x) for x in items], np.int64)
    return np.frombuffer(b"".join(items), np.uint8), np.cumsum(size) - size, size


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The model at `path`, read once by each Python worker."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def _by_batch(docs: DataFrame, id_column: str, text_column: str, schema: str, rows) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, buf, offsets in slices(batch.column(1)):
                ids = batch.column(0).slice(row, len(offsets) - 1)
                yield pa.RecordBatch.from_arrays([ids, *rows(buf, offsets)],
                                                 names=[id_column, *(x.split()[0] for x in schema.split(", "))])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(F.col(id_column), F.col(text_column).cast("string")).mapInArrow(
        run, f"`{id_column}` {kind}, {schema}")


def _aligned(m: Pieces, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids of all texts end to end, their bounds, and the source byte span of every id."""
    normal, at, source = m.normalise(buf, offsets)
    ids, bounds = m.encode(normal, at)
    return ids, bounds, *m.spans(ids, bounds, offsets, source, normal)


def encode(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, ids, starts and ends of every row: the pieces and their byte spans in the original text."""

    def rows(buf: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        ids, bounds, start, end = _aligned(pieces(model), buf, offsets)
        by = pa.array(bounds.astype(np.int32))
        return [pa.ListArray.from_arrays(by, pa.array(x.astype(np.int32))) for x in (ids, start, end)]

    return _by_batch(docs, id_column, text_column, "ids array<int>, starts array<int>, ends array<int>", rows)


def decode(frame: DataFrame, model: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """id and decoded text of every row of ids; null or empty ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = pieces(model)
        for batch in batches:
            lists = batch.column(1).to_pylist()
            bounds = np.cumsum([0, *(len(x or ()) for x in lists)])
            ids = np.array([i for x in lists for i in x or ()], np.int32)
            out, where = m.decode(ids, bounds)
            texts = [out[a:b].tobytes().decode("utf-8") for a, b in zip(where[:-1], where[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[id_column, "text"])

    kind = frame.schema[id_column].dataType.simpleString()
    return frame.select(id_column, ids_column).mapInArrow(run, f"`{id_column}` {kind}, text string")


def round_trip(docs: DataFrame, model: str, id_column: str = "doc_id", text_column: str = "text",
               spans: bool = False) -> DataFrame:
    """id, n_tokens, ids_sha256 and decoded_sha256 of every row: encoded, decoded and digested; no shuffle. With
    `spans` also spans_sha256, of the source byte spans as pairs of 32-bit numbers (start, end)."""
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", spans_sha256 string" * spans

    def rows(buf: np.ndarray, offsets: np.ndarray) -> list[pa.Array]:
        m = pieces(model)
        if spans:
            ids, bounds, start, end = _aligned(m, buf, offsets)
        else:
            ids, bounds = m.encode(*m.normalise(buf, offsets)[:2])
        text, where = m.decode(ids, bounds)
        size = m.digits_size[ids]
        listed = m.digits[ragged(m.digits_at[ids], size)]
        total = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        ends = total[bounds]
        sha = hashlib.sha256
        by_ids = [sha(listed[a:max(a, b - 1)]).hexdigest() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        by_text = [sha(text[a:b]).hexdigest() for a, b in zip(where[:-1].tolist(), where[1:].tolist())]
        out = [pa.array(np.diff(bounds)), pa.array(by_ids, pa.string()), pa.array(by_text, pa.string())]
        if spans:
            pair = np.stack([start, end], axis=1).astype("<i4")
            by_span = [sha(pair[a:b].tobytes()).hexdigest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            out.append(pa.array(by_span, pa.string()))
        return out

    return _by_batch(docs, id_column, text_column, schema, rows)
