"""Seeded samples, splits and folds.

A split is a cut of the rows by a seeded hash of their key. The exact cut points are order
statistics of the hash, found by two aggregate passes; the rows themselves are then only
compared with literals, so no split shuffles or sorts the data.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from wayfare.functions.columns import HASH_SPAN, hash_order
from wayfare.functions.ordering import order_statistics, small_values

HEAVY_PARTS = 100


def _cuts(df: DataFrame, order: Column, ranks: Callable[[int], Sequence[int]], stratum: Column | None = None,
          strata: Sequence | None = None) -> dict:
    """{stratum: [cut, ...]} in rank order. A rank of 0, an empty part, has no row and no cut."""
    cuts: dict = {}
    for found in sorted(order_statistics(df, order, ranks, stratum, strata, HASH_SPAN), key=lambda f: f.k):
        cuts.setdefault(found.stratum, []).append(found.v)
    return cuts


def _part(size: int, share: float) -> int:
    """ceil(share x size), without the binary error of the product (0.2 x 15 is 3, not 4)."""
    return math.ceil(round(size * share, 9))


def sample_rows(df: DataFrame, keys: Sequence[Column], n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows without replacement (all rows if there are fewer): the n smallest hashes."""
    order = hash_order(*keys, seed=seed)
    cut = _cuts(df, order, lambda size: [min(n, size)])
    return df.where(order <= cut[0][0]) if cut else df


def split_random(df: DataFrame, keys: Sequence[Column], test: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds `is_test`: the ceil(test x n) rows of the smallest hashes."""
    order = hash_order(*keys, seed=seed)
    cut = _cuts(df, order, lambda size: [_part(size, test)])
    return df.withColumn("is_test", (order <= cut[0][0]) if cut else F.lit(False))


def split_stratified(df: DataFrame, label: str, keys: Sequence[Column], test: float = 0.2,
                     seed: int = 42, labels: Sequence | None = None) -> DataFrame:
    """Adds `is_test`: round(test x n) rows of every label. Known `labels` save a pass."""
    order = hash_order(*keys, seed=seed)
    strata = small_values(df, label) if labels is None else list(labels)
    cuts = _cuts(df, order, lambda size: [int(size * test + 0.5)], F.col(label), strata)
    return df.withColumn("is_test", _by_label(label, {s: (order <= c[0]) for s, c in cuts.items()}, F.lit(False)))


def split_grouped(df: DataFrame, group: str, test: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds `is_test`: all rows of ceil(test x groups) whole groups."""
    order = hash_order(F.col(f"`{group}`"), seed=seed)
    groups = df.select(f"`{group}`").distinct()
    cut = _cuts(groups, order, lambda size: [_part(size, test)])
    return df.withColumn("is_test", (order <= cut[0][0]) if cut else F.lit(False))


def unseen_groups(train: DataFrame, test: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Groups of the test rows that the training rows lack."""
    return test.select(*groups).distinct().join(train.select(*groups).distinct(), list(groups), "left_anti")


def _by_label(label: str, cases: dict, default: Column) -> Column:
    out = F.when(F.lit(False), default)
    for value, expr in cases.items():
        out = out.when(F.col(label) == F.lit(value), expr)
    return out.otherwise(default)


def fold_stratified(df: DataFrame, label: str, keys: Sequence[Column], k: int = 5, seed: int = 42,
                    col: str = "fold", labels: Sequence | None = None) -> DataFrame:
    """Folds 0..k-1 whose sizes differ by at most one row within every label. Known `labels`
    save a pass."""
    order = hash_order(*keys, seed=seed)
    strata = small_values(df, label) if labels is None else list(labels)

    def ends(size: int) -> list[int]:  # last rank of the folds 0..k-2
        return [size * i // k for i in range(1, k)]

    cuts = _cuts(df, order, ends, F.col(label), strata)
    fold = {s: sum(((order > c).cast("int") for c in cs), F.lit(0)) for s, cs in cuts.items()}
    return df.withColumn(col, _by_label(label, fold, F.lit(0)))


def fold_repeated(df: DataFrame, label: str, keys: Sequence[Column], k: int = 5,
                  seeds: Sequence[int] = (42, 43), labels: Sequence | None = None) -> DataFrame:
    """One row per (row, repeat), each repeat folded with its own seed."""
    wide = df
    labels = small_values(df, label) if labels is None else labels
    for seed in seeds:
        wide = fold_stratified(wide, label, keys, k, seed, f"_fold_{seed}", labels)
    repeats = F.array(*[F.struct(F.lit(i).alias("repeat"), F.col(f"_fold_{s}").alias("fold"))
                        for i, s in enumerate(seeds)])
    return wide.select(*df.columns, F.explode(repeats).alias("_r")).select(*df.columns, "_r.*")


def fold_group(df: DataFrame, group: str, k: int = 5, seed: int = 42, col: str = "fold") -> DataFrame:
    """Every group lies in exactly one fold, and the folds are of near equal size.

    Groups above 1 % of a fold are few by definition, at most 100 k of them: they are dealt,
    largest first, to the emptiest fold. The many light groups fill the folds up to the common
    level in hash order by cut points of their running size. A group that holds a third of all
    rows therefore gets a fold nearly to itself.
    """
    sizes = df.groupBy(F.col(f"`{group}`").alias("g")).agg(F.count("*").alias("n"))
    order = hash_order(F.col("g"), seed=seed)
    total = sizes.agg(F.sum("n")).collect()[0][0] or 0
    limit = max(1, total // (k * HEAVY_PARTS))
    heavy = sizes.where(F.col("n") > limit).collect()  # fewer than k * HEAVY_PARTS rows
    load, dealt = [0] * k, {}
    for row in sorted(heavy, key=lambda r: (-r["n"], str(r["g"]))):
        fold = min(range(k), key=lambda f: (load[f], f))
        load[fold] += row["n"]
        dealt.setdefault(fold, []).append(row["g"])
    rest = total - sum(load)
    room = _fill(load, rest)
    light = sizes.where(F.col("n") <= limit).withColumn("h", order)
    upper = _size_cuts(light, room)
    fold = sum(((hash_order(F.col(f"`{group}`"), seed=seed) > cut).cast("int") for cut in upper), F.lit(0))
    for f, names in dealt.items():
        fold = F.when(F.col(f"`{group}`").isin(names), F.lit(f)).otherwise(fold)
    return df.withColumn(col, fold)


def _fill(load: list[int], rest: int) -> list[int]:
    """How much of `rest` each fold takes so that the loads level out."""
    order = sorted(range(len(load)), key=lambda f: load[f])
    room, left = [0] * len(load), rest
    for i in range(len(order)):
        step = (load[order[i + 1]] - load[order[i]]) if i + 1 < len(order) else left
        add = min(left, step * (i + 1)) if i + 1 < len(order) else left
        for f in order[:i + 1]:
            room[f] += add / (i + 1)
        left -= add
    return room


def _size_cuts(light: DataFrame, room: list[float]) -> list[int]:
    """Hash bounds that hand the light groups to the folds in proportion to `room`.

    Sizes are summed over 4096 equal hash ranges, which the driver adds up.
    """
    bits = 48
    cells = {r["c"]: r["n"] for r in light.groupBy(F.shiftright("h", bits).alias("c"))
             .agg(F.sum("n").alias("n")).collect()}
    goals, goal = [], 0.0
    for r in room[:-1]:
        goal += r
        goals.append(goal)
    cuts, run, cell = [], 0, 0
    for goal in goals:
        while cell < 4096 and run + cells.get(cell, 0) / 2 < goal:
            run += cells.get(cell, 0)
            cell += 1
        cuts.append((cell << bits) - 1)
    return cuts


def shuffled_labels(df: DataFrame, key: Column, label: str, seed: int) -> DataFrame:
    """The labels handed out anew, their counts unchanged: rows in one hash order take the label
    of the same rank in another. For a binary label that is a cut at the number of positives."""
    order = hash_order(key, seed=seed)
    positives = df.where(F.col(label) == 1).count()
    if positives == 0:
        return df
    cut = _cuts(df, order, lambda size: [positives])
    return df.withColumn(label, (order <= cut[0][0]).cast(df.schema[label].dataType))
