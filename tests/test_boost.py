"""Boosting, trees and forests against a plain recursive search for splits."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.operators import boost
from wayfare.operators.boost import Job, TreeSpec


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(8)
    out = []
    for i in range(420):
        c, d, x, z = rnd.choice("abcde"), rnd.choice("pq"), round(rnd.gauss(0, 3), 2), rnd.randint(0, 6)
        y = {"a": 5, "b": -3}.get(c, 1) * (x > 0.5) + z * (d == "p") + rnd.gauss(0, 0.3)
        out.append((i, c, d, x, float(z), y, int(y > 1.5), i % 3))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id long, c string, d string, x double, z double, y double, label int, fold int").persist()


@pytest.fixture(scope="module")
def bins(df):
    return boost.fit_bins(df, ["c", "d"], ["x", "z"])


def brute_tree(codes, is_cat, sizes, g, h, spec):
    """Nested (feature, cut, left, right) or (value,), grown best first from all possible splits."""
    def score(at):
        return g[at].sum() ** 2 / h[at].sum()

    def best(at, depth):
        found = (0.0, None)
        if spec.depth is not None and depth >= spec.depth:
            return found
        for f in range(len(sizes)):
            for cut in range(sizes[f] - 1):
                left = codes[f][at] == cut if is_cat[f] else codes[f][at] <= cut
                a, b = at[left], at[~left]
                if min(len(a), len(b)) < spec.min_leaf or min(h[a].sum(), h[b].sum()) < 1e-3:
                    continue
                gain = score(a) + score(b) - score(at)
                if gain > 1e-12 * (score(a) + score(b)) and gain > found[0] * (1 + 1e-9) + 1e-12:
                    found = (gain, (f, cut, a, b))
        return found

    leaves = [{"at": np.arange(len(g)), "depth": 0}]
    root, n = leaves[0], 1
    for leaf in leaves:
        leaf["best"] = best(leaf["at"], 0)
    while leaves and (spec.leaves is None or n < spec.leaves):
        leaf = max(leaves, key=lambda v: v["best"][0])
        leaves = [v for v in leaves if v is not leaf]
        if leaf["best"][0] <= 0:
            break
        f, cut, a, b = leaf["best"][1]
        leaf["split"] = (f, cut)
        leaf["kids"] = [{"at": x, "depth": leaf["depth"] + 1} for x in (a, b)]
        for kid in leaf["kids"]:
            kid["best"] = best(kid["at"], kid["depth"])
        leaves += leaf["kids"]
        n += 1

    def shape(v):
        return (*v["split"], *map(shape, v["kids"])) if "kids" in v else (len(v["at"]), -g[v["at"]].sum() / h[v["at"]].sum())

    return shape(root), root


def grown_tree(nodes, i, counts):
    if nodes.left[i] < 0:
        return (counts[i], nodes.value[i])
    return (nodes.feature[i], nodes.cut[i], grown_tree(nodes, nodes.left[i], counts), grown_tree(nodes, nodes.right[i], counts))


def same(a, b, rate):
    if len(a) == 2:
        return len(b) == 2 and a[0] == b[0] and abs(a[1] * rate - b[1]) < 1e-6
    return len(b) == 4 and a[:2] == b[:2] and same(a[2], b[2], rate) and same(a[3], b[3], rate)


@pytest.mark.parametrize("spec", [TreeSpec("squared", 3, 0.1, 6, None, 5), TreeSpec("squared", 2, 0.3, 31, 3, 20),
                                  TreeSpec("log", 3, 0.2, 7, None, 10), TreeSpec("log", 2, 1.0, None, 4, 1)])
def test_splits_equal_brute_force(spark, df, bins, rows, spec):
    target = "y" if spec.loss == "squared" else "label"
    blocks = boost.make_blocks(df.coalesce(1), bins, F.col(target))
    model = boost.fit(blocks, bins, spec)
    block = boost.Block(*[blocks.first()[c] for c in ("block", "n", "codes", "y", "fold", "factor", "truth")], 4)
    score, codes = np.full(block.n, model.base), block.codes
    for r in range(spec.rounds):
        p = 1 / (1 + np.exp(-score))
        g, h = (score - block.y, np.ones(block.n)) if spec.loss == "squared" else (p - block.y, p * (1 - p))
        want, _ = brute_tree(codes, bins.is_cat, bins.sizes, g, h, spec)
        leaf = model.nodes.leaves_of(codes, bins.is_cat, np.full(block.n, r))
        counts = np.bincount(leaf, minlength=len(model.nodes.tree))
        assert same(want, grown_tree(model.nodes, r, counts), spec.rate)
        score += model.nodes.value[leaf]
    assert np.allclose(model.raw(codes), score)


@pytest.mark.parametrize("spec,stops", [(TreeSpec("squared", 12, 0.2, 9, None, 5), (5, 12)), (TreeSpec("log", 4, 0.3, 6, None, 5), (4,)),
                                        (TreeSpec("mean", 1, min_leaf=3), (1,)), (TreeSpec("mean", 1, depth=2, min_leaf=3), (1,))])
def test_many_blocks_equal_one(spark, df, bins, spec, stops):
    """The job per pass over small blocks finds what one task finds; held rows are those of the fold."""
    target = F.col("label" if spec.loss == "log" else "y")
    jobs = [Job(spec, f, stops) for f in range(2)]
    got = []
    for size in (None, 97):
        blocks = boost.make_blocks(df, bins, target, F.col("fold"), block=size)
        assert (blocks.count() > 1) == (size is not None)
        assert blocks.agg(F.sum("n")).first()[0] == 420
        pred = boost.predict_folds(blocks, bins, jobs).collect()
        got.append(sorted((r["job"], r["stop"], r["label"], round(r["prediction"], 6), round(r["p1"], 6)) for r in pred))
    assert len(got[0]) == 2 * 140 * len(stops) and got[0] == got[1]


def test_rounds_are_prefixes(spark, df, bins):
    blocks = boost.make_blocks(df, bins, F.col("y"), F.col("fold"))
    spec = TreeSpec("squared", 8, 0.1, 15, None, 5)
    both = boost.predict_folds(blocks, bins, [Job(spec, 1, (3, 8))])
    alone = boost.predict_folds(blocks, bins, [Job(TreeSpec("squared", 3, 0.1, 15, None, 5), 1, (3,))])
    pick = lambda d: sorted((r["label"], r["prediction"]) for r in d.where("stop = 3").collect())
    assert pick(both) == pick(alone)


def test_a_chain_of_splits_has_no_depth_limit(spark):
    """y = 2.45^x: every split takes the largest value off; Spark's own trees end at 30 levels."""
    df = spark.createDataFrame([(float(i), 2.45 ** i) for i in range(35)], "x double, y double")
    bins = boost.fit_bins(df, [], ["x"])
    model = boost.fit(boost.make_blocks(df, bins, F.col("y")), bins, TreeSpec("mean", 1, min_leaf=1))
    depth = {0: 0}
    for i in range(len(model.nodes.tree)):
        for child in (model.nodes.left[i], model.nodes.right[i]):
            if child >= 0:
                depth[child] = depth[i] + 1
    assert max(depth.values()) == 34
    limited = boost.fit(boost.make_blocks(df, bins, F.col("y")), bins, TreeSpec("mean", 1, depth=4, min_leaf=1))
    assert len(limited.nodes.tree) <= 31


def test_forest_learns_and_is_repeatable(spark, df, bins):
    blocks = boost.make_blocks(df, bins, F.col("label"), F.col("fold"))
    spec = TreeSpec("mean", 60, min_leaf=2, columns=3, draws=True)
    jobs = [Job(spec, f, (20, 60)) for f in range(3)]
    pred = boost.predict_folds(blocks, bins, jobs)
    rows = pred.groupBy("stop").agg(F.avg(((F.col("p1") > 0.5) == (F.col("label") == 1)).cast("int")).alias("hit"),
                                    F.count("*").alias("n"), F.min("p1").alias("low"), F.max("p1").alias("high")).collect()
    assert {r["stop"] for r in rows} == {20, 60} and all(r["n"] == 420 and r["hit"] > 0.85 and 0 <= r["low"] and r["high"] <= 1 for r in rows)
    again = boost.predict_folds(blocks, bins, jobs)
    assert pred.exceptAll(again).isEmpty()


def test_missing_and_unseen_values(spark, bins, df, tmp_path):
    model = boost.fit(boost.make_blocks(df, bins, F.col("y")), bins, TreeSpec("squared", 5, 0.3, 8, None, 5))
    odd = spark.createDataFrame([("new", None, None, float("nan")), (None, "p", 1.0, 2.0)], "c string, d string, x double, z double")
    assert all(np.isfinite(r["prediction"]) for r in model.transform(odd).collect())
    model.save(spark, str(tmp_path / "m"))
    other = boost.Ensemble.load(str(tmp_path / "m"), spark)
    want, got = ([r["prediction"] for r in m.transform(df.orderBy("id")).collect()] for m in (model, other))
    assert got == want


def test_constant_target_and_no_rows(spark, bins, df):
    flat = boost.fit(boost.make_blocks(df.withColumn("y", F.lit(2.0)), bins, F.col("y")), bins, TreeSpec("squared", 3, 0.1, 8, None, 5))
    assert {round(r["prediction"], 9) for r in flat.transform(df).collect()} == {2.0}
    empty = boost.fit(boost.make_blocks(df.where("id < 0"), bins, F.col("y")), bins, TreeSpec("squared", 3, 0.1, 8, None, 5))
    assert {r["prediction"] for r in empty.transform(df).collect()} == {0.0}


@pytest.mark.parametrize("spec", [TreeSpec("squared", 6, 0.2, 9, None, 5), TreeSpec("log", 4, 0.3, 6, None, 5), TreeSpec("mean", 1, min_leaf=3)])
def test_repeated_rows_over_many_blocks_are_merged_and_grown_in_a_task(spark, df, bins, spec, monkeypatch):
    """Six copies of every row: the entries are those of one copy, and the trees those of all rows."""
    target, jobs = F.col("label" if spec.loss == "log" else "y"), [Job(spec, 1, (spec.rounds,))]
    many = df.crossJoin(spark.range(6).toDF("copy")).repartition(5)
    pick = lambda b: sorted((r["label"], round(r["prediction"], 6), round(r["p1"], 6)) for r in boost.predict_folds(b, bins, jobs).collect())
    want = pick(boost.make_blocks(many, bins, target, F.col("fold")))
    monkeypatch.setattr(boost, "BLOCK", 400)
    monkeypatch.setattr(boost, "PIECE", 50)
    blocks = boost.make_blocks(many, bins, target, F.col("fold"))
    assert blocks.count() > 1 and blocks.agg(F.sum("n")).first()[0] <= 420
    assert len(want) == 6 * 140 and pick(blocks) == want
    monkeypatch.setattr(boost, "_in_step", None)  # nothing is grown by a job per pass
    model = boost.fit(blocks, bins, spec)
    monkeypatch.undo()
    monkeypatch.setattr(boost, "WHOLE", 1)  # more entries than a task may hold: weights count in the job per pass as well
    assert pick(blocks) == want
    assert len({r["prediction"] for r in model.transform(df).collect()}) > 2
