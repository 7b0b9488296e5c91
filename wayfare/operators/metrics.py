"""Scores, intervals and tests over row-level prediction tables. All plain aggregates."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from wayfare.functions.columns import hash_order, half_up, ratio, unpivot
from wayfare.functions.ordering import running_counts
from wayfare.operators.explore import histogram

Z95 = 1.96


def regression_aggs(label: str = "label", prediction: str = "prediction") -> list[Column]:
    """MSE, RMSE, MAE, R2 and MAPE %. MAPE leaves out zero labels, whose ratio is undefined."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    mse = F.avg((y - p) * (y - p))
    return [F.count("*").alias("n"), mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.avg(F.abs(y - p)).alias("mae"),
            (1 - F.try_divide(mse, F.var_pop(y))).alias("r2"),
            (F.avg(F.abs(F.try_divide(y - p, y))) * 100).alias("mape_pct")]


def score_regression(pred: DataFrame, by: Sequence[str] = (), label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """Metrics, rounded as reported."""
    digits = {"mse": 2, "rmse": 4, "mae": 4, "r2": 6, "mape_pct": 4}
    raw = pred.groupBy(*by).agg(*regression_aggs(label, prediction))
    return raw.withColumns({c: half_up(F.col(c), d) for c, d in digits.items()})


def majority(df: DataFrame, label: str = "label") -> DataFrame:
    """The most frequent binary label and the accuracy of always predicting it."""
    y = F.col(label).cast("int")
    return df.agg(F.mode(y, True).alias("label"), half_up(F.avg(y), 4).alias("base_rate"),
                  half_up(F.greatest(F.avg(y), 1 - F.avg(y)), 4).alias("majority_accuracy"))


def score_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                 score: str = "score") -> DataFrame:
    """Rows per (score, label, prediction): all that the classification metrics need."""
    return pred.groupBy(F.col(score).alias("score"), F.col(label).cast("int").alias("label"),
                        F.col(prediction).cast("int").alias("prediction")).agg(F.count("*").alias("n"))


def auc(counts: DataFrame) -> DataFrame:
    """Exact area under the ROC curve: the share of (positive, negative) pairs in the right
    order, ties counting half. Rows are counted per distinct score first, and the negatives below
    each score come from running counts, so nothing is sorted in one task."""
    n, y = F.col("n"), F.col("label")
    run = running_counts(counts, F.col("score"), {"pos": n * y, "neg": n * (1 - y)})
    won = F.sum(F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / F.lit(2.0)))
    return run.agg(F.try_divide(won, F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))


def auc_by(pred: DataFrame, keys: Sequence[str], label: str = "label", score: str = "score", pieces: int = 256) -> DataFrame:
    """AUC of every group, all in one go: (keys, roc_auc).

    Rows are counted per group and score; the scores of a group are cut at percentiles of its own, running counts
    are done inside a piece, and the piece totals (at most `pieces` a group) are added up beside it.
    """
    y, keys = F.col(label).cast("int"), list(keys)
    counts = pred.where(F.col(score).isNotNull()).groupBy(*keys, F.col(score).alias("v")).agg(
        F.sum(y).cast("double").alias("pos"), F.sum(1 - y).cast("double").alias("neg"))
    probs = F.array(*[F.lit(i / pieces) for i in range(1, pieces)])
    cuts = counts.groupBy(*keys).agg(F.percentile_approx("v", probs).alias("cuts"))
    placed = counts.join(cuts, keys).withColumn("piece", F.size(F.filter("cuts", lambda c: c < F.col("v")))).drop("cuts")
    upto = W.partitionBy(*keys).orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    before = placed.groupBy(*keys, "piece").agg(F.sum("neg").alias("n")).select(
        *keys, "piece", F.coalesce(F.sum("n").over(upto), F.lit(0.0)).alias("before"))
    inner = W.partitionBy(*keys, "piece").orderBy("v").rowsBetween(W.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(inner), F.lit(0.0)) + F.col("before")
    won = placed.join(before, [*keys, "piece"]).withColumn("won", F.col("pos") * (below + F.col("neg") / 2))
    return won.groupBy(*keys).agg(F.try_divide(F.sum("won"), F.sum("pos") * F.sum("neg")).alias("roc_auc"))


def score_classification(pred: DataFrame, label: str = "label", prediction: str = "prediction",
                         score: str = "score") -> DataFrame:
    """Accuracy, F1 of the positive class, AUC, and the lift over the majority label.

    The predictions are read once, into counts that are kept until the one result row is known.
    """
    counts = score_counts(pred, label, prediction, score).persist(StorageLevel.MEMORY_AND_DISK)
    y, p = F.col("label"), F.col("prediction")
    rows = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    n = F.sum("n")
    wide = counts.agg(n.alias("n"), ratio(rows(y == 1), n).alias("base_rate"),
                      ratio(rows(y == p), n).alias("accuracy"),
                      F.coalesce(ratio(2 * rows((y == 1) & (p == 1)), rows(y == 1) + rows(p == 1)),
                                 F.lit(0.0)).alias("f1"))
    base = F.greatest(F.col("base_rate"), 1 - F.col("base_rate"))
    out = wide.select(
        "n", half_up(F.col("base_rate"), 4).alias("base_rate"), half_up(base, 4).alias("majority_accuracy"),
        half_up(F.col("accuracy"), 4).alias("accuracy"), half_up(F.col("f1"), 4).alias("f1"),
        half_up(auc(counts).scalar(), 4).alias("roc_auc"), half_up(F.col("accuracy") - base, 4).alias("lift"))
    return settle(out, counts)


def settle(df: DataFrame, *kept: DataFrame) -> DataFrame:
    """A metric table, a few rows per model and fold, taken to the driver so that the frames kept
    for it can be released."""
    try:
        rows = df.collect()
    finally:
        for frame in kept:
            frame.unpersist()
    return df.sparkSession.createDataFrame(rows, df.schema)


def interval(scores: DataFrame, by: Sequence[str], score: str = "score", chance: float | None = None) -> DataFrame:
    """Mean, sample std and normal 95 % interval of fold scores; optionally against chance."""
    out = scores.groupBy(*by).agg(F.avg(score).alias("m"), F.stddev_samp(score).alias("s"),
                                  F.count("*").alias("n_folds"), (F.max(score) - F.min(score)).alias("spread"))
    half = F.lit(Z95) * F.col("s") / F.sqrt("n_folds")
    out = out.withColumns({"ci_low": F.col("m") - half, "ci_high": F.col("m") + half})
    cols = [half_up(F.col("m"), 4).alias("mean"), half_up(F.col("s"), 4).alias("std"),
            half_up(F.col("ci_low"), 4).alias("ci_low"), half_up(F.col("ci_high"), 4).alias("ci_high"),
            half_up(F.col("spread"), 4).alias("spread"), "n_folds"]
    if chance is not None:
        cols += [F.lit(chance).between(F.col("ci_low"), F.col("ci_high")).alias("includes_chance"),
                 half_up(F.col("m") - chance, 4).alias("over_chance")]
    return out.select(*by, *cols)


def fold_r2(pred: DataFrame, by: Sequence[str], label: str = "label", prediction: str = "prediction") -> DataFrame:
    return pred.groupBy(*by).agg(*[c for c in regression_aggs(label, prediction)]).select(
        *by, "n", F.col("r2").alias("score"))


def best_variant(intervals: DataFrame, family: str, variant: str) -> DataFrame:
    """Per family the variant of the highest mean, with its interval."""
    best = F.max(F.struct("mean", "ci_low", "ci_high", variant))
    return intervals.groupBy(family).agg(best.alias("b")).select(family, "b.*")


def permutation_p(scores: DataFrame, actual: Column | float) -> DataFrame:
    """p = (1 + shuffles scoring at least as high) / (1 + shuffles)."""
    a = F.lit(actual) if isinstance(actual, float) else actual
    return scores.agg(F.avg("score").alias("permutation_mean"),
                      ratio(1 + F.count_if(F.col("score") >= a), 1 + F.count("*")).alias("p_value")).select(
        half_up(a, 4).alias("score"), half_up(F.col("permutation_mean"), 4).alias("permutation_mean"),
        half_up(F.col("p_value"), 4).alias("p_value"), (F.col("p_value") < 0.05).alias("significant_at_0_05"))


def binomial_draws(n: int, p: float, u: np.ndarray) -> np.ndarray:
    """The smallest k with P(X <= k) >= u, for X from Binomial(n, p): exact draws by inversion.

    Probabilities are taken within ten deviations of the mode; what lies beyond has less weight than the
    last bit of a double. They follow from each other by ratio, so the work grows with the square root of n.
    """
    if n <= 0 or p <= 0 or p >= 1:
        return np.full(len(u), n if n > 0 and p >= 1 else 0)
    reach = int(10 * math.sqrt(n * p * (1 - p))) + 30
    mode = min(n, int((n + 1) * p))
    k = np.arange(max(0, mode - reach), min(n, mode + reach) + 1, dtype=np.float64)
    logs = np.concatenate([[0.0], np.cumsum(np.log((n - k[:-1]) / (k[:-1] + 1)) + math.log(p) - math.log1p(-p))])
    below = np.cumsum(np.exp(logs - logs.max()))
    return (k[0] + np.minimum(np.searchsorted(below, u * below[-1]), len(k) - 1)).astype(np.int64)


def bootstrap_interval(rates: DataFrame, key: str, rate: str, n: str, n_boot: int, seed: int = 42) -> DataFrame:
    """Percentile interval of a hit rate from `n_boot` parametric draws of Binomial(n, rate).

    The uniform numbers come from a seeded hash, so a lost task redraws the same ones. A strategy is one
    task of `n_boot` rows, whatever n is.
    """
    draws = rates.select(key, F.col(rate).cast("double").alias("p"), F.col(n).cast("long").alias("n"),
                         F.explode(F.sequence(F.lit(1), F.lit(n_boot))).alias("draw"))
    u = (hash_order(F.col(key), F.col("draw"), seed=seed).cast("double") + 0.5) / float(1 << 60)

    def drawn(rows: pd.DataFrame) -> pd.DataFrame:
        size, p = int(rows["n"].iloc[0]), float(rows["p"].iloc[0])
        return rows.assign(hits=binomial_draws(size, p, rows["u"].to_numpy()))

    key_type = rates.schema[key].dataType.simpleString()
    hits = draws.withColumn("u", u).groupBy(key).applyInPandas(drawn, f"`{key}` {key_type}, p double, n long, draw int, u double, hits long")
    # n_boot draws per strategy: a bounded group, so the plain percentile is fine here
    return hits.withColumn("r", ratio(F.col("hits"), F.col("n"))).groupBy(key).agg(
        half_up(F.max("p"), 4).alias("hit_rate"), half_up(F.percentile("r", 0.025), 4).alias("ci_low"),
        half_up(F.percentile("r", 0.975), 4).alias("ci_high"), F.max("n").alias("n_users"))


def residual_stats(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    r = F.col(label) - F.col(prediction)
    return pred.agg(F.count("*").alias("n"), F.avg(r).alias("mean"), F.stddev_pop(r).alias("sd"),
                    F.min(r).alias("min"), F.max(r).alias("max"))


def residual_histogram(pred: DataFrame, bins: int = 60, label: str = "label",
                       prediction: str = "prediction") -> DataFrame:
    return histogram(pred.select((F.col(label) - F.col(prediction)).alias("residual")), "residual", bins)


def metric_table(results: DataFrame, metric: str, variants: Sequence[str], key: str = "model",
                 col: str = "split") -> DataFrame:
    """Model x split table of one metric."""
    return results.groupBy(key).agg(*[F.max(F.when(F.col(col) == v, F.col(metric))).alias(v) for v in variants])


def metric_long(table: DataFrame, metric: str, variants: Sequence[str], key: str = "model",
                col: str = "split") -> DataFrame:
    return unpivot(table, [key], col, {v: {metric: F.col(v)} for v in variants})
