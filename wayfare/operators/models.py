"""Model families: price regression, label classification, hotel attachment.

Every family is a function (train frame) -> Model; predictions are columns. Trees, forests and boosting are grown by
`boost`, ridge by `linear`; the logistic models of one fit are Spark ML jobs over the encoded frame.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from wayfare import schemas as S
from wayfare.functions.columns import half_up, ratio
from wayfare.operators import boost, folds, linear, metrics
from wayfare.operators.encode import Encoder, fit_encoder, load_encoder, save_encoder

ROWS_PER_TASK = 10_000
PARALLEL = 4
LEAVES, MIN_LEAF = 31, 20  # of boosted trees, unless given


@dataclass
class Model:
    """A fitted encoder and estimator. `transform` adds `prediction`, and `p1` for a classifier."""

    name: str
    encoder: Encoder | boost.Bins | linear.OneHot | None
    fitted: object
    per_unit: str | None = None  # column the prediction is multiplied with
    constant: tuple[float, float] | None = None  # (prediction, p1) of the majority baseline

    def transform(self, df: DataFrame) -> DataFrame:
        if self.constant is not None:
            return df.withColumns({"prediction": F.lit(self.constant[0]), "p1": F.lit(self.constant[1])})
        direct = isinstance(self.fitted, (boost.Ensemble, linear.Linear))
        out = self.fitted.transform(df if direct else self.encoder.transform(df))
        if "probability" in out.columns:
            out = out.withColumn("p1", vector_to_array("probability")[1])
        if self.per_unit:
            out = out.withColumn("prediction", F.col("prediction") * F.col(self.per_unit))
        return out if direct else out.drop("features", "rawPrediction", "probability")


Fit = Callable[[DataFrame], Model]


def save_model(spark: SparkSession, model: Model, path: str) -> str:
    """Write a fitted model with its encoder; `load_model` in another session scores alike."""
    kind = None if model.fitted is None else type(model.fitted).__name__
    own = isinstance(model.encoder, Encoder)
    plain = {"name": model.name, "kind": kind, "per_unit": model.per_unit, "constant": model.constant, "encoder": own,
             "linear": asdict(model.fitted) if kind == "Linear" else None}
    spark.createDataFrame([(json.dumps(plain),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/model")
    if own:
        save_encoder(spark, model.encoder, f"{path}/encoder")
    if kind == "Ensemble":
        model.fitted.save(spark, f"{path}/fitted")
    elif kind == "LogisticRegressionModel":
        model.fitted.write().overwrite().save(f"{path}/fitted")
    return path


def load_model(spark: SparkSession, path: str) -> Model:
    plain = json.loads(spark.read.text(f"{path}/model").first()[0])
    encoder = load_encoder(spark, f"{path}/encoder") if plain["encoder"] else None
    fitted = None
    if plain["kind"] == "Ensemble":
        fitted = boost.Ensemble.load(f"{path}/fitted", spark)
        encoder = fitted.bins
    elif plain["kind"] == "Linear":
        fitted = linear.Linear(**plain["linear"] | {"columns": linear.OneHot(**plain["linear"]["columns"])})
        encoder = fitted.columns
    elif plain["kind"]:
        fitted = LogisticRegressionModel.load(f"{path}/fitted")
    constant = tuple(plain["constant"]) if plain["constant"] else None
    return Model(plain["name"], encoder, fitted, plain["per_unit"], constant)


@contextmanager
def encoded(encoder: Encoder, df: DataFrame, label: str = "label") -> Iterator[tuple[DataFrame, int]]:
    """(frame, rows): the two columns an estimator needs, kept while it iterates.

    An iterative fit runs one job per step, so a small frame is put into few tasks; a large one
    keeps its partitions (coalesce never adds or shuffles any).
    """
    kept = (encoder.transform(df).select("features", F.col(label).cast("double").alias("label"))
            .persist(StorageLevel.MEMORY_AND_DISK))
    try:
        n = kept.count()
        yield kept.coalesce(tasks_for(n)), n
    finally:
        kept.unpersist()


def side_by_side(jobs: Sequence[Callable]) -> list:
    """Run a few driver-side loops of Spark jobs at the same time; results keep their order."""
    with ThreadPoolExecutor(PARALLEL) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def tasks_for(rows: int) -> int:
    return max(1, math.ceil(rows / ROWS_PER_TASK))


def price_spec(kind: str, **p) -> boost.TreeSpec:
    """The trees of a price model; `max_depth` None or `leaves` None means no limit."""
    if kind == "decision_tree":
        return boost.TreeSpec("mean", 1, depth=p.get("max_depth", 12), min_leaf=p.get("min_leaf", MIN_LEAF))
    return boost.TreeSpec("squared", p.get("rounds", 300), p.get("rate", 0.1), p.get("leaves", LEAVES), p.get("max_depth"),
                          p.get("min_leaf", MIN_LEAF))


def label_spec(kind: str, bins: boost.Bins, **p) -> boost.TreeSpec:
    """The trees of a label model. A node of a forest tries the square root of the number of columns."""
    if kind == "behaviour_rf":
        columns = max(1, math.isqrt(sum(map(len, bins.values)) + len(bins.num)))
        return boost.TreeSpec("mean", p.get("trees", 300), depth=p.get("max_depth"), min_leaf=p.get("min_leaf", 5),
                              columns=columns, draws=True)
    return boost.TreeSpec("log", p.get("rounds", 200), p.get("rate", 0.1), p.get("leaves", LEAVES), p.get("max_depth"),
                          p.get("min_leaf", MIN_LEAF))


PRICE_MODELS = ("ridge", "decision_tree", "gbt", "gbt_rate_per_km")


def fit_price(kind: str, train: DataFrame, **params) -> Model:
    """`gbt_rate_per_km` learns price per distance and multiplies back; zero distances cannot be
    learnt from and are left out of its training rows."""
    per_unit = "distance" if kind.endswith("rate_per_km") else None
    label = ratio(F.col("price"), F.col("distance")) if per_unit else F.col("price")
    rows = train.withColumn("label", label).where(F.col("label").isNotNull())
    family = kind.removesuffix("_rate_per_km")
    if family == "ridge":
        fitted = linear.fit_ridge(rows, S.PRICE_CAT, S.PRICE_NUM, F.col("label"), params.get("alpha", 1.0))
        return Model(kind, fitted.columns, fitted, per_unit)
    bins = boost.fit_bins(rows, S.PRICE_CAT, S.PRICE_NUM, median=False)
    fitted = boost.fit(boost.make_blocks(rows, bins, F.col("label")), bins, price_spec(family, **params))
    return Model(kind, bins, fitted, per_unit)


def ridge_coefficients(model: Model, k: int = 8) -> list[tuple[str, float]]:
    """The k lowest and k highest coefficients by name."""
    pairs = sorted(zip(model.encoder.names, (float(c) for c in model.fitted.coefficients)), key=lambda p: p[1])
    return pairs if len(pairs) <= 2 * k else pairs[:k] + pairs[-k:]


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def predictions(fitted: Model, test: DataFrame, label: str, /, **tags) -> DataFrame:
    out = fitted.transform(test)
    p1 = F.col("p1") if "p1" in out.columns else F.lit(None).cast("double")
    return out.select(*[F.lit(v).alias(k) for k, v in tags.items()], F.col(label).cast("double").alias("label"),
                      F.col("prediction").cast("double").alias("prediction"), p1.alias("p1"))


def evaluate_price(legs: DataFrame, keys: Sequence, models: dict[str, dict] | None = None,
                   seed: int = 42) -> DataFrame:
    """Every model on a random and on a grouped split: one row of metrics per (split, model),
    with the best grouped RMSE marked as selected."""
    models = models or {m: {} for m in PRICE_MODELS}
    cuts = {"random": folds.split_random(legs, keys, 0.2, seed),
            "grouped": folds.split_grouped(legs, "route", 0.2, seed)}

    def held_out(how: str, name: str) -> DataFrame:
        fitted = fit_price(name, cuts[how].where(~F.col("is_test")), **models[name])
        return predictions(fitted, cuts[how].where("is_test"), "price", split=how, model=name)

    parts = side_by_side([lambda h=h, m=m: held_out(h, m) for h in cuts for m in models])
    scored = metrics.score_regression(union(parts), ["split", "model"])
    scored = metrics.settle(scored)
    best = scored.where("split = 'grouped'").agg(F.min(F.struct("rmse", "model"))["model"]).scalar()
    return scored.withColumn("selected", F.col("model") == best)


def select_price(legs: DataFrame, keys: Sequence, models: dict[str, dict] | None = None,
                 seed: int = 42) -> tuple[DataFrame, Model]:
    """The comparison of all models, and the selected one fitted again on all legs."""
    scored = evaluate_price(legs, keys, models, seed)
    best = scored.where("selected").agg(F.min("model")).first()[0]
    return scored, fit_price(best, legs, **(models or {}).get(best, {}))


# ---- classification ----------------------------------------------------------------------

@dataclass(frozen=True)
class LabelInputs:
    """Columns a label classifier may use: categories, numerics and one text."""

    cat: Sequence[str]
    num: Sequence[str]
    text: str | None = None


LABEL_MODELS = ("baseline_majority", "behaviour_logistic", "behaviour_rf", "behaviour_gbt", "name_logistic",
                "name_plus_behaviour")


TREE_LABELS = ("behaviour_rf", "behaviour_gbt", "attach_gbt")


def label_encoder(kind: str, train: DataFrame, inputs: LabelInputs, **p) -> Encoder:
    text = {"grams": p.get("grams", (2, 4)), "min_df": p.get("min_df", 2)}
    if kind == "name_logistic":
        return fit_encoder(train, text=inputs.text, **text)
    if kind == "name_plus_behaviour":
        return fit_encoder(train, inputs.cat, inputs.num, text=inputs.text, **text)
    return fit_encoder(train, inputs.cat, inputs.num)


def label_estimator(kind: str, n: int, **p):
    # The penalty |w|^2 / 2 against C times the summed loss is 1 / (C n) against the mean loss.
    # The solver stops at its tolerance; thousands of rare n-grams converge slowly, so these models get
    # the higher limit.
    limit = 2000 if kind.startswith("name") else 1000
    return LogisticRegression(regParam=1.0 / (p.get("C", 1.0) * max(n, 1)), elasticNetParam=0.0,
                              standardization=False, maxIter=p.get("max_iter", limit))


def fit_majority(train: DataFrame, label: str = "label") -> Model:
    row = metrics.majority(train, label).first()
    return Model("baseline_majority", None, None, constant=(float(row["label"]), float(row["label"])))


def fit_label(kind: str, train: DataFrame, inputs: LabelInputs, label: str = "label", **params) -> Model:
    if kind == "baseline_majority":
        return fit_majority(train, label)
    if kind in TREE_LABELS:
        bins = boost.fit_bins(train, inputs.cat, inputs.num)
        blocks = boost.make_blocks(train, bins, F.col(label), merge=kind != "behaviour_rf")
        return Model(kind, bins, boost.fit(blocks, bins, label_spec(kind, bins, **params), classifies=True))
    encoder = label_encoder(kind, train, inputs, **params)
    with encoded(encoder, train, label) as (data, n):
        fitted = label_estimator(kind, n, **params).fit(data)
    return Model(kind, encoder, fitted)


def evaluate_labels(df: DataFrame, inputs: LabelInputs, key, label: str = "label",
                    models: dict[str, dict] | None = None, test: float = 0.25, seed: int = 42) -> DataFrame:
    """Accuracy, F1, AUC and lift of every model on one stratified held-out part."""
    models = models or {m: {} for m in LABEL_MODELS}
    cut = folds.split_stratified(df, label, [key], test, seed)
    train, held = cut.where(~F.col("is_test")), cut.where("is_test")
    parts = []
    for name, params in models.items():
        pred = predictions(fit_label(name, train, inputs, label, **params), held, label)
        parts.append(metrics.score_classification(pred, score="p1").select(F.lit(name).alias("model"), "*"))
    return union(parts)


def impute_labels(model: Model, unlabelled: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    """Predicted label and the probability of that label for rows without one."""
    out = model.transform(unlabelled)
    return out.select(key, F.when(F.col("prediction") == 1, names[1]).otherwise(names[0]).alias("predicted"),
                      half_up(F.greatest(F.col("p1"), 1 - F.col("p1")), 4).alias("confidence"))


def write_imputed(model: Model, unlabelled: DataFrame, key: str, names: tuple[str, str], path: str) -> str:
    """Write the imputed labels as a table of their own; known labels are never overwritten."""
    impute_labels(model, unlabelled, key, names).write.mode("overwrite").parquet(path)
    return path


def fit_attach(train: DataFrame, **params) -> Model:
    """Will a trip book a hotel: boosted trees on four categories and four numerics."""
    rows = train.withColumn("label", F.col("has_hotel").cast("int"))
    return fit_label("attach_gbt", rows, LabelInputs(S.ATTACH_CAT, S.ATTACH_NUM), **params)


def evaluate_attach(trips: DataFrame, seed: int = 42, **params) -> DataFrame:
    df = trips.withColumn("label", F.col("has_hotel").cast("int"))
    cut = folds.split_stratified(df, "label", [F.col("travelCode")], 0.2, seed)
    model = fit_attach(cut.where(~F.col("is_test")), **params)
    return metrics.score_classification(predictions(model, cut.where("is_test"), "label"), score="p1")
