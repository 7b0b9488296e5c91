"""Shared passes against one fit each: ridge by folds, logistic Newton steps, AUC of many groups."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_ordering import brute_auc
from wayfare.operators import linear, metrics, tune
from wayfare.operators.linear import LogisticJob
from wayfare.operators.models import LabelInputs


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(12)
    out = []
    for i in range(300):
        c, x, z = rnd.choice("abc"), rnd.gauss(2000, 3), rnd.choice([None, 1.0, 5.0, 9.0])
        out.append((i, c, x, z, 3 * (c == "a") + 0.5 * (x - 2000) + (z or 0) + rnd.gauss(0, 1), int(rnd.random() < 0.3 + 0.4 * (c == "b")), i % 4))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "id long, c string, x double, z double, y double, label int, fold int").repartition(3).persist()


def plain(columns, rows):
    x = np.array([[float(r[1] == v) for v in "abc"] + [r[2] - columns.shift[0], (columns.fill[1] if r[3] is None else r[3]) - columns.shift[1]] for r in rows])
    return x, np.array([r[4] for r in rows]), np.array([r[5] for r in rows], float), np.array([r[6] for r in rows])


def test_ridge_of_all_folds_from_one_scan(df, rows):
    columns = linear.fit_onehot(df, ["c"], ["x", "z"])
    got = {(a, f): (r2, rmse) for a, f, r2, rmse in linear.ridge_scores(linear.fold_products(df, columns, F.col("y"), F.col("fold")), [0.01, 1.0, 50.0])}
    x, y, _, fold = plain(columns, rows)
    for (alpha, f), (r2, rmse) in got.items():
        t, h = fold != f, fold == f
        xc, yc = x[t] - x[t].mean(0), y[t] - y[t].mean()
        w = np.linalg.solve(xc.T @ xc + alpha * np.eye(5), xc.T @ yc)
        e = y[h] - (y[t].mean() + (x[h] - x[t].mean(0)) @ w)
        assert rmse == pytest.approx(np.sqrt((e ** 2).mean()), rel=1e-8)
        assert r2 == pytest.approx(1 - (e ** 2).mean() / y[h].var(), rel=1e-8)
    assert len(got) == 12


def test_predictions_are_plain_columns(df):
    model = linear.fit_ridge(df, ["c"], ["x", "z"], F.col("y"))
    out = model.columns.transform(model.transform(df)).select("prediction", "features").collect()
    w = model.coefficients.toArray()
    assert all(r["prediction"] == pytest.approx(model.intercept + r["features"].toArray() @ w) for r in out)
    assert "Python" not in model.transform(df).select("prediction")._jdf.queryExecution().executedPlan().toString()


def brute_logistic(z, y, C):
    """Gradient steps of a safe length, until nothing moves."""
    z = np.column_stack([np.ones(len(z)), z])
    w, reg = np.zeros(z.shape[1]), np.r_[0, np.ones(z.shape[1] - 1)] / C
    for _ in range(200):
        p = 1 / (1 + np.exp(-z @ w))
        w = w - np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(reg), z.T @ (p - y) + reg * w)
    assert np.abs(z.T @ (p - y) + reg * w).max() < 1e-7
    return w


def test_newton_steps_of_all_models_together(df, rows):
    columns = linear.fit_onehot(df, ["c"], ["x", "z"], True)
    kept = linear.FoldedRows(df, columns, [F.col("label"), 1 - F.col("label")], F.col("fold"))
    jobs = [LogisticJob(f, r, C) for f in (-1, 0, 3) for r in (0, 1) for C in (0.1, 10.0)]
    got = linear.fit_logistic_jobs(kept, jobs)
    x, _, label, fold = plain(columns, rows)
    for job, w in zip(jobs, got):
        t = fold != job.held
        num = (x[:, 3:] - x[t][:, 3:].mean(0)) / x[t][:, 3:].std(0)
        z = np.column_stack([x[:, :3], num])
        y = label if job.response == 0 else 1 - label
        want = brute_logistic(z[t], y[t], job.C)
        assert np.allclose(w, want, atol=1e-6)
    pred = linear.held_scores(kept, jobs, got).groupBy("job").count().collect()
    assert {r["job"]: r["count"] for r in pred} == {m: 75 for m, j in enumerate(jobs) if j.held >= 0}
    kept.close()


def test_permutations_share_their_passes(spark, df):
    p = tune.permutation_test(df, "behaviour_logistic", LabelInputs(["c"], ["x", "z"]), F.col("id"), n=8, k=3).first()
    assert p["score"] > p["permutation_mean"] and 1 / 9 - 1e-4 <= p["p_value"] <= 1


def test_auc_of_groups(spark):
    rnd = random.Random(3)
    data = [(g, rnd.randint(0, 1), rnd.choice([0.5, round(rnd.random(), 2), rnd.random() / 1e9])) for g in "xyz" for _ in range(400)]
    data += [("one", 1, 0.3), ("one", 1, 0.4)]
    got = {r["g"]: r["roc_auc"] for r in metrics.auc_by(spark.createDataFrame(data, "g string, label int, p double"), ["g"], score="p", pieces=16).collect()}
    for g in "xyz":
        part = [r for r in data if r[0] == g]
        assert got[g] == pytest.approx(brute_auc([r[1] for r in part], [r[2] for r in part]), rel=1e-12)
    assert got["one"] is None
