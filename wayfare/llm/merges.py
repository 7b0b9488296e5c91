"""Byte-pair merging of many sequences at once.

All sequences lie in one flat array of symbols. In each round every sequence merges its lowest-ranked
adjacent pair, at all places (of overlapping ones, from the left); sequences without a known pair leave.
"""

from __future__ import annotations

import numpy as np

from wayfare.llm.words import U64, KeyTable, ragged

NEVER = np.iinfo(np.int32).max


class PairTable:
    """rank and merged symbol of each symbol pair."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, made: np.ndarray):
        bits = max(8, int(np.ceil(np.log2(len(left) * 4 + 1))))
        self.table = KeyTable(bits)
        self.table.add(self._keys(left, right), np.arange(len(left)))
        self.rank = np.append(rank.astype(np.int32), np.int32(NEVER))  # the absent pair is number -1
        self.made = np.append(made.astype(np.int32), np.int32(-1))

    @staticmethod
    def _keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 32 | right.astype(np.int64)).astype(U64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.table.find(self._keys(left, right))


def merge(symbols: np.ndarray, lengths: np.ndarray, pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and lengths of the sequences after all merges; lengths are 1 at least."""
    done_symbols, done_lengths, done_ids = [], [], []
    ids = np.arange(len(lengths))
    symbols, lengths = symbols.astype(np.int32), lengths.astype(np.int64)
    number = None
    while len(ids):
        n = len(symbols)
        starts = np.cumsum(lengths) - lengths
        if number is None:
            number = np.full(n, -1, np.int32)
            if n > 1:
                number[:-1] = pairs.find(symbols[:-1], symbols[1:])
            number[starts + lengths - 1] = -1
        rank = pairs.rank[number]
        least = np.minimum.reduceat(rank, starts)
        open_ = least < NEVER
        if not open_.all():
            shut = np.flatnonzero(~open_)
            done_ids.append(ids[shut])
            done_lengths.append(lengths[shut])
            done_symbols.append(symbols[ragged(starts[shut], lengths[shut])])
            left = np.flatnonzero(open_)
            keep = ragged(starts[left], lengths[left])
            symbols, rank, number, ids, lengths, least = symbols[keep], rank[keep], number[keep], ids[left], lengths[left], least[left]
            starts = np.cumsum(lengths) - lengths
            n = len(symbols)
            if not len(ids):
                break
        hit = rank == np.repeat(least, lengths)
        at = np.flatnonzero(hit)
        # in a run of neighbouring places every second one is left out
        new_run = np.ones(len(at), bool)
        new_run[1:] = np.diff(at) != 1
        first = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - first) % 2 == 0]
        symbols[at] = pairs.made[number[at]]
        gone = np.zeros(n, bool)
        gone[at + 1] = True
        owner = np.searchsorted(starts, at, side="right") - 1
        lengths = lengths - np.bincount(owner, minlength=len(lengths))
        keep = np.flatnonzero(~gone)
        place = np.cumsum(~gone) - 1
        symbols, number = symbols[keep], number[keep]
        # only pairs that touch a new symbol change
        merged = place[at]
        last = np.zeros(len(symbols), bool)
        last[np.cumsum(lengths) - 1] = True
        touched = np.concatenate([merged, merged[merged > 0] - 1])
        inner = touched[~last[touched]]
        number[inner] = pairs.find(symbols[inner], symbols[inner + 1])
        number[touched[last[touched]]] = -1
    order = np.concatenate(done_ids) if done_ids else np.zeros(0, np.int64)
    all_lengths = np.concatenate(done_lengths) if done_lengths else np.zeros(0, np.int64)
    all_symbols = np.concatenate(done_symbols) if done_symbols else np.zeros(0, np.int32)
    back = np.argsort(order, kind="stable")
    starts = np.cumsum(all_lengths) - all_lengths
    return all_symbols[ragged(starts[back], all_lengths[back])], all_lengths[back]
