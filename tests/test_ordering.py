import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wayfare.functions import ordering
from wayfare.operators import folds, metrics
from wayfare.operators.explore import histogram


def frame(spark, seed, n=600):
    rnd = random.Random(seed)
    # a third of the rows share one value, and the tail is long
    values = [7.0 if rnd.random() < 0.34 else rnd.lognormvariate(0, 3) * rnd.choice([-1, 1]) for _ in range(n)]
    return values, spark.createDataFrame([(i, v, "a" if i % 3 else "b") for i, v in enumerate(values)],
                                         "id long, v double, g string")


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles_match_numpy(spark, seed):
    values, df = frame(spark, seed)
    probs = [0.0, 0.025, 0.25, 0.5, 0.75, 0.975, 1.0]
    got = {p: v for _, p, v in ordering.quantiles(df, F.col("v"), probs)}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(values, p), rel=1e-12)
    for s, p, v in ordering.quantiles(df, F.col("v"), [0.5], F.col("g"), ["a", "b"]):
        part = [x for i, x in enumerate(values) if ("a" if i % 3 else "b") == s]
        assert v == pytest.approx(np.median(part), rel=1e-12)


def test_order_statistics_of_every_rank(spark):
    values, df = frame(spark, 5, 50)
    got = ordering.order_statistics(df, F.col("v"), lambda n: range(1, n + 1))
    assert [r.v for r in sorted(got, key=lambda r: r.k)] == sorted(values)


@pytest.mark.parametrize("values", [[1.0, 2.0, math.inf], [-math.inf, math.inf], [-math.inf, 1.0, 1.0, 5.0, math.inf, math.inf],
                                    [-1e308, 0.0, 1e308, 5.0, 1e-308], [math.inf] * 3, [5e-324, 0.0, -5e-324]])
def test_ranks_of_endless_and_huge_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = ordering.order_statistics(df, F.col("v"), lambda n: range(1, n + 1))
    assert [r.v for r in sorted(got, key=lambda r: r.k)] == sorted(values)


def test_columns_and_strata_in_the_same_passes(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice("pq"), rnd.choice([0.0, -0.0, 1.5, rnd.gauss(0, 1e-300), rnd.gauss(0, 1e9)]), rnd.choice([None, math.nan, rnd.random()]))
            for _ in range(700)]
    df = spark.createDataFrame(rows, "g string, a double, b double").repartition(3)
    got = ordering.column_quantiles(df, {"a": F.col("a"), "b": F.col("b"), "none": F.lit(None).cast("double")}, [0.0, 0.3, 0.5, 1.0])
    clean = {"a": [r[1] for r in rows], "b": [r[2] for r in rows if r[2] is not None and r[2] == r[2]]}
    assert len(got) == 8
    for c, p, v in got:
        assert v == pytest.approx(np.quantile(clean[c], p), rel=1e-12)
    ranks = ordering.radix_ranks(df, {"a": F.col("a"), "b": F.col("b")}, lambda n: range(1, n + 1, 7), F.col("g"), ["p", "q", "absent"])
    for r in ranks:
        part = sorted(x for g, a, b in rows for x in [a if r.stratum[0] == "a" else b] if g == r.stratum[1] and x is not None and x == x)
        assert r.v == part[r.k - 1] and r.n == len(part)


def test_passes_do_not_depend_on_the_values(spark, monkeypatch):
    """Five counting passes, one count of rows."""
    jobs = []
    locate = ordering._locator
    monkeypatch.setattr(ordering, "_locator", lambda asked: jobs.append(len(asked)) or locate(asked))
    df = spark.createDataFrame([(float(f"{m}e{e}"),) for m in (1, -3) for e in range(-300, 300, 37)], "v double")
    ordering.column_quantiles(df, {"v": F.col("v")}, [0.1, 0.5, 0.9])
    assert len(jobs) == 5


@pytest.mark.parametrize("n, p", [(7, 0.3), (100, 0.5), (101, 0.5), (5000, 0.02), (50, 0.0), (50, 1.0), (0, 0.5)])
def test_binomial_draws_invert_the_distribution(n, p):
    u = np.linspace(0.0005, 0.9995, 1000)
    below = np.cumsum([math.comb(n, k) * p ** k * (1 - p) ** (n - k) if n < 1000 else math.exp(
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
        for k in range(n + 1)])
    want = np.minimum(np.searchsorted(below, u * (1 - 1e-12)), n)
    assert (metrics.binomial_draws(n, p, u) == want).mean() > 0.998


def test_empty_bins_are_rows(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,)], "v double")
    got = [(r["bin"], r["n"]) for r in histogram(df, "v", 5).orderBy("bin").collect()]
    assert got == [(0, 2), (1, 0), (2, 0), (3, 0), (4, 1)]


def test_small_values_refuses_a_large_domain(spark):
    with pytest.raises(ValueError):
        ordering.small_values(spark.range(50), "id", limit=10)


def test_running_counts(spark):
    values, df = frame(spark, 3)
    run = ordering.running_counts(df, F.col("v"), {"n": F.lit(1)}, pieces=16).collect()
    assert len(run) == len(set(values))
    for r in run:
        assert r["n_below"] == sum(v < r["v"] for v in values)
        assert r["n"] == values.count(r["v"])


def brute_auc(labels, scores):
    pairs = [(p > n) + 0.5 * (p == n) for p, y in zip(scores, labels) if y for n, z in zip(scores, labels) if not z]
    return sum(pairs) / len(pairs)


def test_auc_matches_all_pairs(spark):
    rnd = random.Random(4)
    rows = [(int(rnd.random() < 0.4), round(rnd.random(), 1)) for _ in range(300)]
    df = spark.createDataFrame(rows, "label int, score double")
    want = brute_auc([y for y, _ in rows], [s for _, s in rows])
    assert metrics.auc(df.withColumn("n", F.lit(1))).first()[0] == pytest.approx(want, abs=1e-12)
    scored = metrics.score_classification(df.withColumn("prediction", (F.col("score") > 0.5).cast("int"))).first()
    tp = sum(y and s > 0.5 for y, s in rows)
    assert scored["f1"] == pytest.approx(2 * tp / (sum(y for y, _ in rows) + sum(s > 0.5 for _, s in rows)), abs=1e-4)


def test_interval_matches_the_published_folds(spark):
    folds_ = [0.89, 0.949, 0.9362, 0.956, 0.9506]
    df = spark.createDataFrame([("m", s) for s in folds_], "model string, score double")
    row = metrics.interval(df, ["model"], chance=0.5).first()
    assert (row["mean"], row["std"], row["n_folds"]) == (0.9364, 0.0269, 5)
    assert not row["includes_chance"] and row["over_chance"] == 0.4364


def test_permutation_p(spark):
    df = spark.createDataFrame([(0.5 + i / 1000,) for i in range(100)], "score double")
    row = metrics.permutation_p(df, 0.9).first()
    assert row["p_value"] == 0.0099 and row["significant_at_0_05"]


def test_bootstrap_small_and_large(spark):
    df = spark.createDataFrame([("a", 0.8584, 1285), ("b", 0.5, 40)], "s string, p double, n long")
    got = {r["s"]: r for r in metrics.bootstrap_interval(df, "s", "p", "n", 400).collect()}
    assert 0.83 < got["a"]["ci_low"] < 0.8584 < got["a"]["ci_high"] < 0.89
    assert 0.2 < got["b"]["ci_low"] < 0.5 < got["b"]["ci_high"] < 0.8
    again = {r["s"]: r for r in metrics.bootstrap_interval(df, "s", "p", "n", 400).collect()}
    assert got == again


@pytest.fixture
def people(spark):
    rnd = random.Random(9)
    rows = [(i, int(rnd.random() < 0.3), "hot" if rnd.random() < 0.34 else f"g{rnd.randint(0, 40)}") for i in range(500)]
    return spark.createDataFrame(rows, "id long, label int, grp string")


def test_exact_sample(people):
    got = folds.sample_rows(people, [F.col("id")], 77)
    assert got.count() == 77 and got.distinct().count() == 77
    assert folds.sample_rows(people, [F.col("id")], 9999).count() == 500


def test_splits(people):
    cut = folds.split_random(people, [F.col("id")], 0.2)
    assert cut.where("is_test").count() == 100
    strat = folds.split_stratified(people, "label", [F.col("id")], 0.25)
    for r in strat.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect():
        assert r["t"] == int(r["n"] * 0.25 + 0.5)
    group = folds.split_grouped(people, "grp", 0.2)
    per = group.groupBy("grp").agg(F.countDistinct("is_test").alias("k"), F.max("is_test").alias("t")).collect()
    assert all(r["k"] == 1 for r in per)
    assert sum(r["t"] for r in per) == -(-len(per) // 5)
    train, test = group.where(~F.col("is_test")), group.where("is_test")
    assert folds.unseen_groups(train, test, ["grp"]).count() == sum(r["t"] for r in per)


def test_folds(people):
    df = folds.fold_stratified(people, "label", [F.col("id")], 5)
    for label in (0, 1):
        sizes = [r["n"] for r in df.where(F.col("label") == label).groupBy("fold").agg(F.count("*").alias("n")).collect()]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    rep = folds.fold_repeated(people, "label", [F.col("id")], 5, (1, 2, 3))
    assert rep.count() == 1500 and rep.select("repeat").distinct().count() == 3


def test_group_folds_with_a_hot_group(people):
    df = folds.fold_group(people, "grp", 5)
    assert df.groupBy("grp").agg(F.countDistinct("fold").alias("k")).where("k <> 1").count() == 0
    sizes = sorted(r["n"] for r in df.groupBy("fold").agg(F.count("*").alias("n")).collect())
    hot = people.where("grp = 'hot'").count()
    assert len(sizes) == 5 and sizes[-1] <= hot + 15  # the hot group has a fold nearly to itself


def test_group_folds_of_many_light_groups(spark):
    df = folds.fold_group(spark.range(6000).withColumn("g", F.floor(F.col("id") / 2)), "g", 4)
    sizes = [r["n"] for r in df.groupBy("fold").agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 4 and max(sizes) < 1.1 * min(sizes)
