"""Blocks of token ids, packed by an adaptive context-mixing range coder.

A block is cut into equal lanes that are coded side by side, one id of every lane per step, with one range
coder per lane and one model for the block. The model starts empty in every block:

* order 2 and order 1: the id last seen after the two ids, and after the one id, before; with a confidence
  that grows when it comes true and falls when not;
* the mix: for each pair of confidences (and whether both predict the same id) the counts of "order 2 was
  right", "order 1 was right" and "neither" give the probabilities of these three events;
* order 0: ids that neither predicts are coded by their frequencies so far, retabulated now and then.

A block is bytes: magic, number of ids, lanes, CRC-32 of the ids as little-endian 32-bit numbers, bytes per
lane, then the lanes. `unpack` checks the sum and raises on a damaged block.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"WFI1"
HEAD = struct.Struct("<4sIIIII")
LANES = 8192
LEAST_STEPS = 64
EVENT_BITS, SYMBOL_BITS = 12, 22
PAIR_BITS = 18
TOP, BOTTOM = np.uint64(1 << 48), np.uint64(1 << 32)
U64 = np.uint64
U16 = U64(16)


class _Model:
    """Predictions for all lanes; the same calls in packing and unpacking keep both sides equal.

    An entry of the order-1 and order-2 tables is 8 * id + confidence.
    """

    def __init__(self, symbols: int, lanes: int):
        self.symbols = symbols
        self.one = np.full(symbols, symbols * 8, np.int32)  # no id yet
        self.two = np.full(1 << PAIR_BITS, symbols * 8, np.int32)
        self.events = np.tile(np.array([1, 1, 2], np.int64), (128, 1))
        self.edges = np.zeros((128, 4), U64)
        self.edges[:, 3] = 1 << EVENT_BITS
        self.counts = np.ones(symbols, np.int64)
        self.fresh: list[np.ndarray] = []
        self.step, self.next = 0, 1
        self.last = self.before = np.zeros(lanes, np.int32)
        self.tabulate()

    def tabulate(self) -> None:
        """Order-0 table from the counts so far; every id keeps a share."""
        if self.fresh:
            self.counts += 32 * np.bincount(np.concatenate(self.fresh), minlength=self.symbols)
            self.fresh = []
        total = (1 << SYMBOL_BITS) - self.symbols
        size = 1 + self.counts * total // self.counts.sum()
        size[0] += (1 << SYMBOL_BITS) - size.sum()
        self.cumulated = np.zeros(self.symbols + 1, U64)
        np.cumsum(size, out=self.cumulated[1:], dtype=U64)
        self.sizes = size.astype(U64)
        # the id of every 64th place, where a search starts
        self.guide = (np.searchsorted(self.cumulated, np.arange(0, 1 << SYMBOL_BITS, 64, dtype=U64), side="right") - 1).astype(np.int32)

    def find(self, place: np.ndarray) -> np.ndarray:
        """The id whose order-0 interval holds each place."""
        at = self.guide[place >> U64(6)]
        later = np.flatnonzero(self.cumulated[at + 1] <= place)
        at[later] += 1
        later = later[self.cumulated[at[later] + 1] <= place[later]]
        at[later] = np.searchsorted(self.cumulated, place[later], side="right") - 1
        return at

    def predict(self) -> None:
        """Sets the order-2 and order-1 ids of every lane, and `cell`, which tells how sure they are."""
        mixed = self.before.astype(np.uint32) * np.uint32(49177) + self.last.astype(np.uint32)
        self.pair = mixed * np.uint32(2654435761) >> np.uint32(32 - PAIR_BITS)
        self.entry2, self.entry1 = self.two[self.pair], self.one[self.last]
        self.guess2, self.guess1 = self.entry2 >> 3, self.entry1 >> 3
        self.cell = ((self.entry2 & 7) << 3 | self.entry1 & 7) << 1 | (self.guess1 == self.guess2)
        total = self.events.sum(axis=1, keepdims=True)
        self.edges[:, 1:3] = np.cumsum(self.events[:, :2] * ((1 << EVENT_BITS) - 3) // total + 1, axis=1)

    def learn(self, ids: np.ndarray, event: np.ndarray) -> None:
        self.events += np.bincount(self.cell * 3 + event, minlength=384).reshape(128, 3)
        if self.step % 64 == 63:
            self.events = self.events // 2 + 1
        fresh = ids << 3
        for guess, entry, table, key in ((self.guess2, self.entry2, self.two, self.pair),
                                         (self.guess1, self.entry1, self.one, self.last)):
            sure = entry & 7
            wrong = np.where(sure > 1, entry - (sure + 1 >> 1), fresh)
            table[key] = np.where(guess == ids, entry + (sure < 7), wrong)
        self.fresh.append(ids)
        self.before, self.last = self.last, ids
        self.step += 1
        if self.step == self.next:
            self.tabulate()
            self.next += max(1, min(self.step, 48))


def _shift(low: np.ndarray, size: np.ndarray, emit) -> None:
    """Bring every lane's range back above `BOTTOM`; `emit(lanes)` moves 16 settled bits out or in."""
    todo = np.flatnonzero(((low ^ (low + size)) < TOP) | (size < BOTTOM))
    while len(todo):
        l, s = low[todo], size[todo]
        forced = (l ^ (l + s)) >= TOP
        if forced.any():
            s = np.where(forced, (~l + U64(1)) & (BOTTOM - U64(1)), s)
        emit(todo, l)
        l, s = l << U16, s << U16
        low[todo], size[todo] = l, s
        todo = todo[((l ^ (l + s)) < TOP) | (s < BOTTOM)]


def pack(ids: np.ndarray, symbols: int) -> bytes:
    """The block of these ids, all below `symbols`."""
    n = len(ids)
    check = zlib.crc32(np.ascontiguousarray(ids, "<u4"))
    lanes = max(1, min(LANES, n // LEAST_STEPS))
    steps = -(-n // lanes)
    grid = np.zeros(lanes * steps, np.int32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    low, size = np.zeros(lanes, U64), np.full(lanes, np.iinfo(np.uint64).max, U64)
    wide = steps * 3 + 8
    out = np.zeros(lanes * wide, np.uint16)
    first = np.arange(lanes) * wide
    at = first.copy()
    model = _Model(symbols, lanes)

    def emit(lane: np.ndarray, value: np.ndarray) -> None:
        place = at[lane]
        out[place] = value >> U64(48)
        at[lane] = place + 1

    for row in grid:
        model.predict()
        event = np.where(row == model.guess2, 0, 2 - (row == model.guess1))
        key = (model.cell << 2) + event
        edges = model.edges.ravel()
        start = edges[key]
        size >>= U64(EVENT_BITS)
        low += start * size
        size *= edges[key + 1] - start
        _shift(low, size, emit)
        rare = np.flatnonzero(event == 2)
        if len(rare):
            s = row[rare]
            unit = size[rare] >> U64(SYMBOL_BITS)
            low[rare] += model.cumulated[s] * unit
            size[rare] = model.sizes[s] * unit
            _shift(low, size, emit)
        model.learn(row, event)
    every = np.arange(lanes)
    for _ in range(4):
        emit(every, low)
        low <<= U16
    used = at - first
    body = out.reshape(lanes, wide)[np.arange(wide)[None, :] < used[:, None]].astype("<u2").tobytes()
    return HEAD.pack(MAGIC, n, lanes, check, symbols, len(body)) + used.astype("<u4").tobytes() + body


def unpack(block: bytes) -> np.ndarray:
    """The ids of a block."""
    try:
        magic, n, lanes, check, symbols, length = HEAD.unpack_from(block)
    except struct.error as e:
        raise ValueError("damaged block: too short") from e
    if magic != MAGIC or len(block) != HEAD.size + 4 * lanes + length:
        raise ValueError("damaged block: wrong head or length")
    used = np.frombuffer(block, "<u4", lanes, HEAD.size).astype(np.int64)
    body = np.frombuffer(block, "<u2", length // 2, HEAD.size + 4 * lanes)
    if used.sum() != len(body):
        raise ValueError("damaged block: lane sizes")
    body = np.append(body, np.zeros(8, "<u2")).astype(U64)
    at = np.cumsum(used) - used
    limit = len(body) - 1
    code = np.zeros(lanes, U64)
    for _ in range(4):
        code = code << U16 | body[np.minimum(at, limit)]
        at += 1
    steps = -(-n // lanes)
    low, size = np.zeros(lanes, U64), np.full(lanes, np.iinfo(np.uint64).max, U64)
    grid = np.empty((steps, lanes), np.int32)
    model = _Model(symbols, lanes)

    def emit(lane: np.ndarray, _: np.ndarray) -> None:
        place = at[lane]
        code[lane] = code[lane] << U16 | body[np.minimum(place, limit)]
        at[lane] = place + 1

    for t in range(steps):
        model.predict()
        edges = model.edges.ravel()
        key = model.cell << 2
        size >>= U64(EVENT_BITS)
        place = np.minimum((code - low) // size, U64((1 << EVENT_BITS) - 1))
        event = (place >= edges[key + 1]).astype(np.int32) + (place >= edges[key + 2])
        key += event
        start = edges[key]
        low += start * size
        size *= edges[key + 1] - start
        _shift(low, size, emit)
        row = np.where(event == 0, model.guess2, model.guess1)
        rare = np.flatnonzero(event == 2)
        if len(rare):
            base, unit = low[rare], size[rare] >> U64(SYMBOL_BITS)
            s = model.find(np.minimum((code[rare] - base) // unit, U64((1 << SYMBOL_BITS) - 1)))
            low[rare] = base + model.cumulated[s] * unit
            size[rare] = model.sizes[s] * unit
            _shift(low, size, emit)
            row[rare] = s
        if row.max() >= symbols:
            raise ValueError("damaged block: impossible event")
        grid[t] = row
        model.learn(row, event)
    ids = grid.T.reshape(-1)[:n]
    if zlib.crc32(np.ascontiguousarray(ids, "<u4")) != check:
        raise ValueError("damaged block: checksum")
    return ids
