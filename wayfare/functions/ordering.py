"""Order statistics without a global sort.

A plain ``percentile`` or an unpartitioned window gathers a whole column in one task. Here
ranks are found by counting, so neither a value shared by a third of all rows nor a huge column
ever meets in one task:

* Doubles are mapped to 64-bit numbers of the same order, whose digits of at most 13 bits are
  counted from the left: five passes whatever the values, for all columns and strata together
  (`radix_ranks`). From the second pass on only rows that share a wanted prefix are read.
* Whole numbers, such as hashes: the range that holds a wanted rank is cut into cells, the cells
  are counted, and the search goes on inside the one cell that holds the rank, until a single
  value is left.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

CELLS = 1024
DIGITS = (13, 13, 13, 13, 12)  # bits of each pass


def small_values(df: DataFrame, col: str, limit: int = 1000) -> list:
    """Distinct non-null values of a column that must be a small domain; checked, not assumed."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"'{col}' has more than {limit} distinct values")
    return sorted(r[0] for r in rows)


@dataclass(frozen=True)
class Ranked:
    """The value `v` at 1-based rank `k` of the `n` rows of a stratum."""

    stratum: object
    n: int
    k: int
    v: object


def order_statistics(df: DataFrame, value: Column, ranks: Callable[[int], Sequence[int]],
                     stratum: Column | None = None, strata: Sequence | None = None,
                     span: tuple | None = None) -> list[Ranked]:
    """Exact values at the 1-based `ranks(n)` of each stratum; ranks outside 1..n are left out.

    `strata` lists the allowed strata. What the driver sees per pass is bounded by
    strata x ranks x CELLS counts, and what is broadcast by strata x ranks ranges. A known
    `span` of the values saves the pass that looks for their extremes.
    """
    kind = df.select(value.alias("v")).schema["v"].dataType
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        found = radix_ranks(df, {"v": value}, ranks, stratum, strata)
        return [Ranked(r.stratum[1], r.n, r.k, r.v) for r in found]
    rows = df.select((F.lit(0) if stratum is None else stratum).alias("s"), value.alias("v"))
    rows = rows.where(F.col("v").isNotNull())
    if stratum is not None:
        rows = rows.where(F.col("s").isin(list(strata)))
    # (stratum, rank) -> (low, high, rows below low): the range known to hold the rank
    if span is None:
        ends = rows.groupBy("s").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        size = {r["s"]: r["n"] for r in ends}
        found = {(r["s"], k): (r["lo"], r["hi"], 0) for r in ends for k in set(ranks(r["n"])) if 1 <= k <= r["n"]}
    else:
        first = _count_cells(_inside(rows, [(s, *span) for s in (strata if strata is not None else [0])]))
        size = {s: sum(w for w, _, _ in cells) for (s, _, _), cells in first.items()}
        found = {(s, k): _locate(cells, k, 0) for (s, _, _), cells in first.items()
                 for k in set(ranks(size[s])) if 1 <= k <= size[s]}
    kept, passes = None, 0
    try:
        while ranges := sorted({(s, lo, hi) for (s, _), (lo, hi, _) in found.items() if lo != hi}, key=str):
            inside = _inside(rows if kept is None else kept, ranges)
            if kept is None and (span is not None or passes):  # later passes read only the chosen cells
                kept = inside.select("s", "v").persist(StorageLevel.DISK_ONLY)
                inside = _inside(kept, ranges)
            cells = _count_cells(inside)
            found = {(s, k): (lo, hi, below) if lo == hi else _locate(cells[(s, lo, hi)], k, below)
                     for (s, k), (lo, hi, below) in found.items()}
            passes += 1
    finally:
        if kept is not None:
            kept.unpersist()
    return [Ranked(s, size[s], k, lo) for (s, k), (lo, _, _) in found.items()]


def _inside(rows: DataFrame, ranges: list[tuple]) -> DataFrame:
    """Rows inside the given (stratum, lo, hi) ranges, which never overlap."""
    kind = rows.schema["v"].dataType.simpleString()
    label = rows.schema["s"].dataType.simpleString()
    table = rows.sparkSession.createDataFrame(ranges, f"s {label}, lo {kind}, hi {kind}")
    return rows.join(F.broadcast(table), "s").where((F.col("v") >= F.col("lo")) & (F.col("v") <= F.col("hi")))


def _cell() -> Column:
    """The cell of a row. The ends of a range always fall into different cells, so every pass shrinks it."""
    v, lo, hi = (F.col(c) for c in ("v", "lo", "hi"))
    return F.least(F.floor((v - lo).cast("double") / (hi - lo).cast("double") * CELLS), F.lit(CELLS - 1))


def _count_cells(inside: DataFrame) -> dict:
    """{range: [(rows, least, greatest), ...] in cell order}."""
    counts = inside.groupBy("s", "lo", "hi", _cell().alias("c")).agg(
        F.count("*").alias("w"), F.min("v").alias("least"), F.max("v").alias("greatest"))
    out: dict = {}
    for r in sorted(counts.collect(), key=lambda r: r["c"]):
        out.setdefault((r["s"], r["lo"], r["hi"]), []).append((r["w"], r["least"], r["greatest"]))
    return out


def _locate(cells: list[tuple], k: int, below: int) -> tuple:
    """The extremes of the cell that holds rank k, and the rows below it."""
    for w, least, greatest in cells:
        if k <= below + w:
            return least, greatest, below
        below += w
    raise AssertionError("rank beyond the counted rows")


# ---- doubles ------------------------------------------------------------------------------

def ordered_bits(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the doubles; minus zero is zero."""
    bits = (np.asarray(values, np.float64) + 0.0).view(np.int64)
    return np.where(bits < 0, ~bits, bits ^ np.int64(-(1 << 63))).view(np.uint64)


def double_of(bits: int) -> float:
    raw = bits - (1 << 63) if bits >> 63 else ~bits
    return float(np.array([raw], np.int64).view(np.float64)[0])


class _Wanted:
    """Slots (column, stratum, prefix), looked up by whole arrays."""

    def __init__(self, slots: Sequence[tuple[int, int, int]], strata: int, left: int):
        self.left, self.columns = left, {}  # `left`: bits not known yet
        for i in {c for c, _, _ in slots}:
            known = sorted({p for c, _, p in slots if c == i})
            grid = np.full((len(known) + 1, strata), -1)
            for slot, (c, s, p) in enumerate(slots):
                if c == i:
                    grid[known.index(p), s] = slot
            self.columns[i] = (np.array(known, np.uint64), grid)

    def slot(self, column: int, bits: np.ndarray, stratum: np.ndarray) -> np.ndarray:
        if column not in self.columns:
            return np.full(len(bits), -1)
        known, grid = self.columns[column]
        prefix = np.zeros(len(bits), np.uint64) if self.left >= 64 else bits >> np.uint64(self.left)
        at = np.searchsorted(known, prefix)
        at = np.where((at < len(known)) & (known[np.minimum(at, len(known) - 1)] == prefix), at, len(known))
        return grid[at, stratum]


def radix_ranks(df: DataFrame, values: dict[str, Column], ranks: Callable[[int], Sequence[int]],
                stratum: Column | None = None, strata: Sequence | None = None) -> list[Ranked]:
    """Exact values at the 1-based `ranks(n)` of every (column, stratum); nulls and NaN are left out.

    The `stratum` of a result is (column name, stratum). What the driver sees is a few numbers per rank and pass.
    """
    names, strata = list(values), [0] if stratum is None else list(strata)
    place = F.lit(0) if stratum is None else F.array_position(F.array(*[F.lit(s) for s in strata]), stratum).cast("int") - 1
    clean = [F.when(~F.isnan(c.cast("double")), c.cast("double")).alias(f"v{i}") for i, c in enumerate(values.values())]
    rows = df.select(place.alias("s"), *clean).where("s >= 0")
    size = {(i, r["s"]): r[f"n{i}"] for r in rows.groupBy("s").agg(
        *[F.count(f"v{i}").alias(f"n{i}") for i in range(len(names))]).collect() for i in range(len(names))}
    found = {(i, s, k): (0, 0) for (i, s), n in size.items() for k in set(ranks(n)) if 1 <= k <= n}  # -> (prefix, rows below)
    left, kept = 64, None

    def wide(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for batch in batches:
            s = batch.column(0).to_numpy()
            for i in range(len(names)):
                v = batch.column(i + 1)
                there = v.is_valid().to_numpy(zero_copy_only=False)
                yield i, ordered_bits(v.to_numpy(zero_copy_only=False)[there]), s[there]

    def long(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for batch in batches:
            c, s, b = (batch.column(k).to_numpy() for k in range(3))
            for i in np.unique(c).tolist():
                yield i, b[c == i].view(np.uint64), s[c == i]

    try:
        for number, width in enumerate(DIGITS):
            slots = sorted({(i, s, p) for (i, s, _), (p, _) in found.items()})
            if not slots:
                break
            wanted, cells = _Wanted(slots, len(strata), left), 1 << width
            if number == 1:
                kept = rows.mapInArrow(_keeper(wanted, wide), "c int, s int, b long").persist(StorageLevel.DISK_ONLY)
            source, read = (rows, wide) if kept is None else (kept, long)
            counts = source.mapInArrow(_counter(wanted, read, len(slots), cells, left - width), "slot int, digit int, n long") \
                .groupBy("slot", "digit").agg(F.sum("n").alias("n"))
            asked = {m: [(k, found[i, s, k][1]) for (j, t, k), (q, _) in found.items() if (j, t, q) == (i, s, p)]
                     for m, (i, s, p) in enumerate(slots)}
            got = counts.groupBy("slot").applyInArrow(_locator(asked), "slot int, k long, digit int, below long").collect()
            found = {(*slots[r["slot"]][:2], r["k"]): (slots[r["slot"]][2] << width | r["digit"], r["below"]) for r in got}
            left -= width
    finally:
        if kept is not None:
            kept.unpersist()
    return [Ranked((names[i], strata[s]), size[i, s], k, double_of(p)) for (i, s, k), (p, _) in found.items()]


def _keeper(wanted: _Wanted, read: Callable) -> Callable:
    """(column, stratum, bits) of the rows in a wanted slot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, bits, s in read(batches):
            hit = wanted.slot(i, bits, s) >= 0
            yield pa.RecordBatch.from_arrays([pa.array(np.full(int(hit.sum()), i, np.int32)), pa.array(s[hit].astype(np.int32)),
                                              pa.array(bits[hit].view(np.int64))], names=["c", "s", "b"])
    return run


def _counter(wanted: _Wanted, read: Callable, slots: int, cells: int, shift: int) -> Callable:
    """Rows per (slot, next digit), added up in the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for i, bits, s in read(batches):
            slot = wanted.slot(i, bits, s)
            hit = slot >= 0
            digit = (bits[hit] >> np.uint64(shift)).astype(np.int64) & (cells - 1)
            new, n = np.unique(slot[hit] * cells + digit, return_counts=True)
            keys, back = np.unique(np.concatenate([keys, new]), return_inverse=True)
            sizes = np.bincount(back, np.concatenate([sizes, n]), len(keys)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array((keys // cells).astype(np.int32)), pa.array((keys % cells).astype(np.int32)), pa.array(sizes)],
                                         names=["slot", "digit", "n"])
    return run


def _locator(asked: dict[int, list[tuple[int, int]]]) -> Callable:
    """The digit that holds each asked rank of a slot, and the rows below it."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("digit")
        slot, digit, n = table.column("slot")[0].as_py(), table.column("digit").to_numpy(), table.column("n").to_numpy()
        upto = np.cumsum(n)
        k, below = (np.array(x, np.int64) for x in zip(*asked[slot]))
        at = np.searchsorted(upto, k - below)
        return pa.table({"slot": pa.array(np.full(len(k), slot, np.int32)), "k": k, "digit": pa.array(digit[at].astype(np.int32)),
                         "below": below + (upto - n)[at]})
    return run


def _interpolated(found: list[Ranked], probs: Sequence[float]) -> list[tuple]:
    at = {(f.stratum, f.k): f.v for f in found}
    out = []
    for s, n in sorted({(f.stratum, f.n) for f in found}, key=str):
        for p in probs:
            low, high, part = _spots(n, p)
            a, b = at[s, low], at[s, high]
            out.append((s, p, a if a == b or not part else a * (1 - part) + b * part if abs(b - a) == float("inf")
                        else a + (b - a) * part))
    return out


def _spots(n: int, p: float) -> tuple[int, int, float]:
    pos = (n - 1) * p
    low = int(pos)
    return low + 1, min(low + 2, n), pos - low


def column_quantiles(df: DataFrame, values: dict[str, Column], probs: Sequence[float]) -> list[tuple]:
    """Exact, linearly interpolated quantiles of several columns in the same passes: [(column, p, value), ...]."""
    found = radix_ranks(df, values, lambda n: [k for p in probs for k in _spots(n, p)[:2]])
    return [(s[0], p, v) for s, p, v in _interpolated(found, probs)]


def quantiles(df: DataFrame, value: Column, probs: Sequence[float], stratum: Column | None = None,
              strata: Sequence | None = None) -> list[tuple]:
    """Exact, linearly interpolated quantiles: [(stratum, p, value), ...]."""
    found = radix_ranks(df, {"v": value}, lambda n: [k for p in probs for k in _spots(n, p)[:2]], stratum, strata)
    return [(s[1], p, v) for s, p, v in _interpolated(found, probs)]


def running_counts(df: DataFrame, value: Column, weights: dict[str, Column], pieces: int = 256) -> DataFrame:
    """Per distinct value: its weights and the running totals of the weights below it.

    The values are split at `pieces` bounds taken from a hash-ordered sample of the distinct
    values, which is the same in every run; the running sum is done inside each piece, and the
    piece totals (at most `pieces` rows) are added up in a second, bounded window.
    """
    grouped = (df.select(value.alias("v"), *[c.alias(k) for k, c in weights.items()])
               .where(F.col("v").isNotNull())
               .groupBy("v").agg(*[F.sum(k).alias(k) for k in weights]))
    bounds = (grouped.select("v").orderBy(F.xxhash64("v"), "v").limit(pieces)
              .agg(F.array_sort(F.collect_list("v")).alias("b")))  # at most `pieces` values
    cut_up = (grouped.withColumn("_b", bounds.scalar())
              .withColumn("piece", F.size(F.filter("_b", lambda b: b < F.col("v")))).drop("_b"))
    totals = cut_up.groupBy("piece").agg(*[F.sum(k).alias(f"_{k}") for k in weights])
    upto = W.orderBy("piece").rowsBetween(W.unboundedPreceding, -1)  # at most `pieces` + 1 rows
    offsets = totals.select("piece", *[F.coalesce(F.sum(f"_{k}").over(upto), F.lit(0)).alias(f"_off_{k}")
                                       for k in weights])
    inner = W.partitionBy("piece").orderBy("v").rowsBetween(W.unboundedPreceding, -1)
    return (cut_up.join(F.broadcast(offsets), "piece")
            .select("v", *weights,
                    *[(F.coalesce(F.sum(k).over(inner), F.lit(0)) + F.col(f"_off_{k}")).alias(f"{k}_below")
                      for k in weights]))
