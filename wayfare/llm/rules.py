"""Quality rules as a short-circuit cascade.

Each rule reads a few counts of a text and rejects it or not. The order of the rules comes from a sample:
cost is the measured time to get the counts that a rule needs, selectivity the share of rows it rejects;
rules run by rejections per cost, and a text that one rule rejects is not looked at by the next one. The
verdict is the same for every order, as a text is kept only if no rule rejects it.

Counts of a text, from words `[^\\x20\\x09-\\x0D]+`: n_words; word_chars, code points in words; n_symbols,
characters of `[#*$%&|<>]`; n_lines, \\n-split lines with a word; n_dup_lines, those equal to an earlier
line; n_repeat_words, words in 3-word windows that occur twice or more in the text, first included;
n_upper and n_lower, ASCII letters; n_digits, ASCII digits. Texts are compared by 64-bit hashes.

Edge cases: a null or empty text has zero counts and fails `few_words`; repeated rows give repeated rows;
other columns of the input pass through `filter_documents` untouched and are not read by the counts.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.words import IS_WORD, U64, Words, mix, ragged, slices, span_hashes, sums, windows

SAMPLE_ROWS = 512
SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _class_table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_SYMBOL = _class_table(SYMBOLS)
_UPPER = _class_table("".join(map(chr, range(65, 91))))
_LOWER = _class_table("".join(map(chr, range(97, 123))))
_DIGIT = _class_table("0123456789")


class Texts:
    """The texts of a slice; counts are made when first asked for."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray):
        self.buf, self.offsets, self.made = buf, offsets, {}
        self._words: Words | None = None

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @property
    def words(self) -> Words:
        if self._words is None:
            self._words = Words(self.buf, self.offsets)
        return self._words

    def __getitem__(self, name: str) -> np.ndarray:
        if name not in self.made:
            getattr(self, f"_count_{name}")()
        return self.made[name]

    def take(self, rows: np.ndarray) -> Texts:
        """The texts at these rows, with the counts made so far."""
        size = np.diff(self.offsets)[rows]
        out = Texts(self.buf[ragged(self.offsets[:-1][rows], size)], np.concatenate([[0], np.cumsum(size)]))
        out.made = {name: values[rows] for name, values in self.made.items()}
        return out

    def _bytes_in(self, table: np.ndarray) -> np.ndarray:
        return sums(table[self.buf], self.offsets)

    def _count_n_words(self) -> None:
        self.made["n_words"] = self.words.counts

    def _count_word_chars(self) -> None:
        self.made["word_chars"] = sums(IS_WORD[self.buf] & ((self.buf & 0xC0) != 0x80), self.offsets)

    def _count_n_symbols(self) -> None:
        self.made["n_symbols"] = self._bytes_in(_SYMBOL)

    def _count_n_upper(self) -> None:
        self.made["n_upper"] = self._bytes_in(_UPPER)

    def _count_n_lower(self) -> None:
        self.made["n_lower"] = self._bytes_in(_LOWER)

    def _count_n_digits(self) -> None:
        self.made["n_digits"] = self._bytes_in(_DIGIT)

    def _count_n_lines(self) -> None:
        """Lines with a word, and how many of them equal an earlier line of the text."""
        ends = np.union1d(np.flatnonzero(self.buf == 0x0A), self.offsets[1:])
        starts = np.concatenate([[0], ends[:-1]])
        starts += (starts < len(self.buf)) & (np.isin(starts, np.flatnonzero(self.buf == 0x0A)))
        starts = np.minimum(starts, ends)
        worded = np.zeros(len(self.buf) + 1, np.int64)
        np.cumsum(IS_WORD[self.buf], out=worded[1:])
        some = worded[ends] > worded[starts]
        starts, ends = starts[some], ends[some]
        owner = np.searchsorted(self.offsets, starts, side="right") - 1
        key = np.unique(span_hashes(self.buf, starts, ends) ^ mix(owner.astype(U64)), return_index=True)[1]
        self.made["n_lines"] = np.bincount(owner, minlength=len(self))
        self.made["n_dup_lines"] = self.made["n_lines"] - np.bincount(owner[key], minlength=len(self))

    _count_n_dup_lines = _count_n_lines

    def _count_n_repeat_words(self) -> None:
        owners = self.words.owners()
        at, key = windows(self.words.hashes(), owners, 3)
        key = key ^ mix(owners[at].astype(U64))
        order = np.argsort(key)
        ordered = key[order]
        same = np.zeros(len(key), bool)
        same[1:] = ordered[1:] == ordered[:-1]
        same[:-1] |= same[1:]
        change = np.zeros(len(owners) + 4, np.int32)
        np.add.at(change, at[order[same]], 1)
        np.add.at(change, at[order[same]] + 3, -1)
        self.made["n_repeat_words"] = sums(np.cumsum(change)[:len(owners)] > 0, self.words.bounds)


@dataclass(frozen=True)
class Rule:
    name: str
    needs: tuple[str, ...]
    rejects: Callable[[Texts], np.ndarray]


#: Thresholds are whole numbers, so that SQL and numpy agree on every row.
BASE_RULES = (
    Rule("few_words", ("n_words",), lambda t: t["n_words"] < 50),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda t: 100 * t["n_repeat_words"] > 50 * t["n_words"]),
)
METHOD_RULES = (
    Rule("symbols", ("n_symbols", "n_words"), lambda t: 100 * t["n_symbols"] > 10 * t["n_words"]),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda t: 100 * t["n_dup_lines"] > 60 * t["n_lines"]),
    Rule("word_length", ("word_chars", "n_words"),
         lambda t: (t["word_chars"] < 3 * t["n_words"]) | (t["word_chars"] > 12 * t["n_words"])),
    Rule("shouting", ("n_upper", "n_lower"), lambda t: 100 * t["n_upper"] > 40 * (t["n_upper"] + t["n_lower"])),
    Rule("digits", ("n_digits", "word_chars"), lambda t: 100 * t["n_digits"] > 20 * t["word_chars"]),
)
RULES = BASE_RULES + METHOD_RULES


def measure(texts: Texts, rules: tuple[Rule, ...] = RULES) -> dict[str, tuple[float, int]]:
    """Seconds and rejections of each rule over all given texts, each rule starting without any counts."""
    out = {}
    for rule in rules:
        fresh = Texts(texts.buf, texts.offsets)
        began = time.perf_counter()
        rejected = int(rule.rejects(fresh).sum())
        out[rule.name] = time.perf_counter() - began, rejected
    return out


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_column: str = "text",
                sample_rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """Rules by rejections per cost, estimated on the first `sample_rows` rows at most.

    The sample decides the order of the work only, never a verdict.
    """
    sample = [r[0] or "" for r in docs.select(F.col(text_column).cast("string")).limit(sample_rows).collect()]
    cost = dict.fromkeys((r.name for r in rules), 0.0)
    rejected = dict.fromkeys(cost, 0)
    for _, buf, offsets in slices(pa.array(sample, pa.string())):
        for name, (seconds, n) in measure(Texts(buf, offsets), rules).items():
            cost[name] += seconds
            rejected[name] += n
    return tuple(sorted(rules, key=lambda r: -(rejected[r.name] + 0.5) / (cost[r.name] + 1e-6)))


def cascade(texts: Texts, rules: tuple[Rule, ...]) -> np.ndarray:
    """For each text the place in `rules` of the rule that stopped it, or -1."""
    stopped = np.full(len(texts), -1)
    rows, left = np.arange(len(texts)), texts
    for i, rule in enumerate(rules):
        rejected = rule.rejects(left)
        stopped[rows[rejected]] = i
        if rejected.any():
            kept = np.flatnonzero(~rejected)
            rows, left = rows[kept], left.take(kept)
        if not len(rows):
            break
    return stopped


def _run(docs: DataFrame, columns: list[str], schema: str, per_slice) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, buf, offsets in slices(batch.column(len(columns) - 1)):
                part = batch.slice(row, len(offsets) - 1)
                yield per_slice(part, Texts(buf, offsets))

    return docs.select(*columns).mapInArrow(run, schema)


def count_and_judge(docs: DataFrame, rules: tuple[Rule, ...], id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """id, the five counts, base_failed, and kept: the base passed and none of `rules` rejects; no shuffle.

    `rules` come in the order in which they run, on the texts that passed the base.
    """

    def judge(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        counts = [texts[name].astype(np.int64) for name in COUNTS]
        failed = np.zeros(len(texts), bool)
        for rule in BASE_RULES:
            failed |= rule.rejects(texts)
        kept = ~failed
        passed = np.flatnonzero(kept)
        if len(passed):
            kept[passed] = cascade(texts.take(passed), rules) < 0
        return pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, (*counts, failed, kept))],
                                          names=[id_column, *COUNTS, "base_failed", "kept"])

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, {', '.join(f'{c} long' for c in COUNTS)}, base_failed boolean, kept boolean"
    frame = docs.select(F.col(id_column), F.col(text_column).cast("string").alias(text_column))
    return _run(frame, [id_column, text_column], schema, judge)


def filter_documents(docs: DataFrame, rules: tuple[Rule, ...], text_column: str = "text") -> DataFrame:
    """The rows that no rule rejects, with all their columns; rules run in the given order; no shuffle."""
    columns = [c for c in docs.columns if c != text_column] + [text_column]
    frame = docs.select(*(F.col(f"`{c}`") for c in columns))

    def judge(part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
        return part.take(pa.array(np.flatnonzero(cascade(texts, rules) < 0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, buf, offsets in slices(batch.column(len(columns) - 1)):
                yield judge(batch.slice(row, len(offsets) - 1), Texts(buf, offsets))

    return frame.mapInArrow(run, frame.schema).select(*(F.col(f"`{c}`") for c in docs.columns))
