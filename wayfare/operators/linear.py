"""Linear models of many folds, penalties and label vectors from shared passes.

Ridge: one pass sums the products of all columns per fold. Leaving a fold out is a subtraction, every penalty a
Cholesky solve of columns x columns numbers on the driver, and the held-out error follows from the held fold's
products. Logistic: all (fold, label vector, penalty) models take their Newton steps together; a pass adds up loss,
gradient and Hessian of every model that is not done yet. What reaches the driver is models x columns^2 numbers,
whatever the rows.

Edge cases: a null numeric takes the fill value; a null or unseen category is all zeros; rows without a target are
left out; a constant column has no influence; a fold without rows scores nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, functions as F

from wayfare.operators.encode import fit_numeric

STEPS, TOLERANCE = 60, 1e-9
MOST_VALUES = 10_000


@dataclass
class OneHot:
    """One column per value of a category, then the numerics: (x - shift) / scale, nulls filled before."""

    cat: list[str]
    num: list[str]
    values: list[list[str]]
    fill: list[float]
    shift: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)

    @property
    def names(self) -> list[str]:
        return [f"{c}={v}" for c, vs in zip(self.cat, self.values) for v in vs] + self.num

    @property
    def width(self) -> int:
        return sum(map(len, self.values)) + len(self.num)

    def inputs(self) -> list[Column]:
        return [F.col(f"`{c}`").cast("string") for c in self.cat] + [F.col(f"`{c}`").cast("double") for c in self.num]

    def _numerics(self) -> list[Column]:
        return [(F.coalesce(c, F.lit(f)) - F.lit(m)) / F.lit(s)
                for c, f, m, s in zip(self.inputs()[len(self.cat):], self.fill, self.shift, self.scale)]

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds `features`; only asked for by name, predictions do without."""
        hot = [(c.eqNullSafe(v)).cast("double") for c, vs in zip(self.inputs(), self.values) for v in vs]
        return df.withColumn("features", array_to_vector(F.array(*hot, *self._numerics())))

    def predictor(self, weights: Sequence[float], intercept: float) -> Column:
        """The linear predictor as a plain expression."""
        total, at = F.lit(float(intercept)), 0
        for c, vs in zip(self.inputs(), self.values):
            if vs:
                pairs = [F.lit(x) for v, w in zip(vs, weights[at:at + len(vs)]) for x in (v, float(w))]
                total = total + F.coalesce(F.try_element_at(F.create_map(*pairs), c), F.lit(0.0))
            at += len(vs)
        for c, w in zip(self._numerics(), weights[at:]):
            total = total + c * F.lit(float(w))
        return total

    def matrix(self, columns: Sequence[pa.Array]) -> np.ndarray:
        """(rows, width) of a batch of `inputs`, for sums inside a task."""
        n = len(columns[0])
        out, at = np.zeros((n, self.width)), 0
        for col, vs in zip(columns, self.values):
            code = pc.fill_null(pc.index_in(col, pa.array(vs, pa.string())), -1).to_numpy(zero_copy_only=False)
            hit = np.flatnonzero(code >= 0)
            out[hit, at + code[hit]] = 1.0
            at += len(vs)
        for i, col in enumerate(columns[len(self.cat):]):
            x = col.to_numpy(zero_copy_only=False).astype(float)
            out[:, at + i] = (np.where(np.isnan(x), self.fill[i], x) - self.shift[i]) / self.scale[i]
        return out


def fit_onehot(df: DataFrame, cat: Sequence[str], num: Sequence[str], median: bool = False) -> OneHot:
    """The values that occur, and the numerics' fill values: their medians, or zero. Numerics are only shifted."""
    cols = [F.col(f"`{c}`").cast("string") for c in cat]
    row = df.agg(*[F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(cols)],
                 *[F.avg(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None))).alias(f"m{i}") for i, c in enumerate(num)]).first()
    if any(row[f"n{i}"] > MOST_VALUES for i in range(len(cat))):
        raise ValueError("a category has too many values for one column each")
    sets = df.agg(*[F.array_sort(F.collect_set(c)).alias(f"v{i}") for i, c in enumerate(cols)]).first() if cat else {}
    fill = [s[0] for s in fit_numeric(df, num, False).values()] if median and num else [0.0] * len(num)
    return OneHot(list(cat), list(num), [list(sets[f"v{i}"]) for i in range(len(cat))], fill,
                  [row[f"m{i}"] or 0.0 for i in range(len(num))], [1.0] * len(num))


@dataclass
class Linear:
    """A fitted linear or logistic model over `OneHot` columns."""

    columns: OneHot
    weights: list[float]
    intercept: float
    logistic: bool = False

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(self.weights)

    def transform(self, df: DataFrame) -> DataFrame:
        raw = self.columns.predictor(self.weights, self.intercept)
        if not self.logistic:
            return df.withColumn("prediction", raw)
        return df.withColumn("p1", 1 / (1 + F.exp(-raw))).withColumn("prediction", (F.col("p1") > 0.5).cast("double"))


# ---- ridge ------------------------------------------------------------------------------------

def fold_products(df: DataFrame, columns: OneHot, target: Column, fold: Column | None = None) -> dict[int, np.ndarray]:
    """Per fold the sums of products of all pairs of (1, columns, target)."""
    rows = df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns.inputs())], target.cast("double").alias("y"),
                     (F.lit(0) if fold is None else fold).cast("int").alias("fold")).where("y is not null and not isnan(y)")
    k, size = len(columns.cat) + len(columns.num), columns.width + 2
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            folds = batch.column(k + 1).to_numpy()
            z = np.column_stack([np.ones(batch.num_rows), columns.matrix(batch.columns[:k]), batch.column(k).to_numpy()])
            for f in np.unique(folds).tolist():
                part = z[folds == f]
                sums[f] = sums.get(f, 0.0) + part.T @ part
        for f, total in sums.items():
            values = total[upper]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), f, np.int32)), pa.array(np.arange(len(values), dtype=np.int32)),
                                              pa.array(values)], names=["fold", "cell", "value"])

    out: dict[int, np.ndarray] = {}
    for r in rows.mapInArrow(run, "fold int, cell int, value double").groupBy("fold", "cell").agg(F.sum("value").alias("value")).collect():
        total = out.setdefault(r["fold"], np.zeros((size, size)))
        i, j = upper[0][r["cell"]], upper[1][r["cell"]]
        total[i, j] = total[j, i] = r["value"]
    return out


def solve_ridge(products: np.ndarray, alpha: float) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the squared error plus alpha * |weights|^2."""
    n = products[0, 0]
    mean = products[0, 1:] / n
    centred = products[1:, 1:] - n * np.outer(mean, mean)
    a = centred[:-1, :-1] + alpha * np.eye(len(centred) - 1)
    try:
        low = np.linalg.cholesky(a)
        w = np.linalg.solve(low.T, np.linalg.solve(low, centred[:-1, -1]))
    except np.linalg.LinAlgError:
        w = np.linalg.lstsq(a, centred[:-1, -1], rcond=None)[0]
    return w, float(mean[-1] - w @ mean[:-1])


def ridge_scores(products: dict[int, np.ndarray], alphas: Sequence[float]) -> list[tuple[float, int, float | None, float]]:
    """(alpha, fold, R2, RMSE) of every fold under the fit of all others."""
    total, out = sum(products.values()), []
    for f, held in sorted(products.items()):
        for alpha in alphas:
            w, b = solve_ridge(total - held, alpha)
            v = np.concatenate([[-b], -w, [1.0]])
            n, error = held[0, 0], max(float(v @ held @ v), 0.0)
            spread = held[-1, -1] - held[0, -1] ** 2 / n
            out.append((alpha, f, float(1 - error / spread) if spread > 0 else None, float(np.sqrt(error / n))))
    return out


def fit_ridge(df: DataFrame, cat: Sequence[str], num: Sequence[str], target: Column, alpha: float = 1.0) -> Linear:
    columns = fit_onehot(df, cat, num)
    products = fold_products(df, columns, target)
    w, b = solve_ridge(products[0], alpha) if products else (np.zeros(columns.width), 0.0)
    return Linear(columns, w.tolist(), b)


# ---- logistic ---------------------------------------------------------------------------------

@dataclass(frozen=True)
class LogisticJob:
    """Trained on all folds but `held`, for label vector `response`, with penalty |w|^2 / 2 against C times the loss."""

    held: int
    response: int = 0
    C: float = 1.0


class FoldedRows:
    """The rows of a search, kept until `close`: inputs, fold and label vectors, and the numerics' scale without each fold."""

    def __init__(self, df: DataFrame, columns: OneHot, responses: Sequence[Column], fold: Column):
        self.columns, self.k, self.responses = columns, len(columns.cat) + len(columns.num), len(responses)
        self.rows = df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns.inputs())], fold.cast("int").alias("fold"),
                              F.array(*[r.cast("byte") for r in responses]).alias("y")).persist(StorageLevel.MEMORY_AND_DISK)
        at = sum(map(len, columns.values))
        total = {f: p[[0, *range(1 + at, 1 + columns.width)]][:, [0, *range(1 + at, 1 + columns.width)]]
                 for f, p in fold_products(self.rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns.cat + columns.num)],
                                                            "fold"), columns, F.lit(0.0), F.col("fold")).items()}
        every = sum(total.values()) if total else np.zeros((1 + len(columns.num),) * 2)
        self.folds = sorted(total)
        self.scale = {}
        for f in [-1, *self.folds]:
            m = every - total.get(f, 0.0)
            n = max(m[0, 0], 1.0)
            mean = m[0, 1:] / n
            spread = np.sqrt(np.maximum(np.diag(m)[1:] / n - mean ** 2, 0.0))
            self.scale[f] = (mean, np.where(spread > 1e-9 * (1 + np.abs(mean)), spread, 1.0))

    def close(self) -> None:
        self.rows.unpersist()

    def scaled(self, x: np.ndarray, held: int) -> np.ndarray:
        """(1, columns) with the numerics centred and scaled by the training rows of a fold."""
        mean, spread = self.scale[held]
        at = x.shape[1] - len(mean)
        return np.column_stack([np.ones(len(x)), x[:, :at], (x[:, at:] - mean) / spread])


def _batches(rows: FoldedRows, batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        if batch.num_rows:
            y = batch.column(rows.k + 1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(float)
            yield rows.columns.matrix(batch.columns[:rows.k]), batch.column(rows.k).to_numpy(), y


def fit_logistic_jobs(rows: FoldedRows, jobs: Sequence[LogisticJob]) -> np.ndarray:
    """(jobs, 1 + columns): intercept and weights of every job, by Newton steps in step."""
    size = rows.columns.width + 1
    upper = np.triu_indices(size)
    weights, last = np.zeros((len(jobs), size)), np.zeros((len(jobs), size))
    best = np.full(len(jobs), np.inf)
    live = list(range(len(jobs)))
    ridge = np.ones(size)
    ridge[0] = 0.0
    light = FoldedRows.__new__(FoldedRows)
    light.__dict__.update({k: v for k, v in vars(rows).items() if k != "rows"})
    for _ in range(STEPS):
        if not live:
            break
        shared = rows.rows.sparkSession.sparkContext.broadcast((light, [jobs[m] for m in live], weights[live]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            view, now, w = shared.value
            sums = np.zeros((len(now), 1 + size + len(upper[0])))
            for x, folds, y in _batches(view, batches):
                for held in sorted({j.held for j in now}):
                    at = [m for m, j in enumerate(now) if j.held == held]
                    train = folds != held
                    z, labels = view.scaled(x[train], held), y[train][:, [now[m].response for m in at]]
                    eta = z @ w[at].T
                    p = 1 / (1 + np.exp(-np.clip(eta, -700, 700)))
                    sums[at, 0] += (np.logaddexp(0.0, eta) - labels * eta).sum(axis=0)
                    sums[at, 1:1 + size] += (p - labels).T @ z
                    bend = p * (1 - p)
                    for i, m in enumerate(at):
                        sums[m, 1 + size:] += (z.T @ (z * bend[:, [i]]))[upper]
            n, width = sums.shape
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(n, dtype=np.int32), width)),
                                              pa.array(np.tile(np.arange(width, dtype=np.int32), n)), pa.array(sums.ravel())],
                                             names=["model", "cell", "value"])

        got = rows.rows.mapInArrow(run, "model int, cell int, value double").groupBy("model", "cell").agg(F.sum("value")).toPandas()
        shared.destroy()
        sums = np.zeros((len(live), 1 + size + len(upper[0])))
        sums[got["model"], got["cell"]] = got["sum(value)"]
        going = []
        for i, m in enumerate(live):
            penalty = ridge / jobs[m].C
            loss = sums[i, 0] + 0.5 * float(penalty @ weights[m] ** 2)
            if loss > best[m] * (1 + 1e-12):  # too far: half the step
                weights[m] = (weights[m] + last[m]) / 2
                going.append(m)
                continue
            grad = sums[i, 1:1 + size] + penalty * weights[m]
            bend = np.zeros((size, size))
            bend[upper] = sums[i, 1 + size:]
            bend = bend + np.triu(bend, 1).T + np.diag(penalty)
            step = np.linalg.lstsq(bend, grad, rcond=None)[0]
            best[m], last[m] = loss, weights[m].copy()
            weights[m] = weights[m] - step
            if np.abs(step).max() > TOLERANCE * (1 + np.abs(weights[m]).max()):
                going.append(m)
        live = going
    return weights


def held_scores(rows: FoldedRows, jobs: Sequence[LogisticJob], weights: np.ndarray) -> DataFrame:
    """job, label and p1 of every held row under every job."""
    light = FoldedRows.__new__(FoldedRows)
    light.__dict__.update({k: v for k, v in vars(rows).items() if k != "rows"})
    shared = rows.rows.sparkSession.sparkContext.broadcast((light, list(jobs), weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        view, jobs, w = shared.value
        for x, folds, y in _batches(view, batches):
            for held in sorted({j.held for j in jobs}):
                part = folds == held
                if not part.any():
                    continue
                z = view.scaled(x[part], held)
                for m, job in enumerate(jobs):
                    if job.held == held:
                        p = 1 / (1 + np.exp(-np.clip(z @ w[m], -700, 700)))
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), m, np.int32)), pa.array(y[part, job.response]), pa.array(p)],
                                                         names=["job", "label", "p1"])

    return rows.rows.mapInArrow(run, "job int, label double, p1 double")


def held_hits(rows: FoldedRows, jobs: Sequence[LogisticJob], weights: np.ndarray) -> list[tuple[int, int]]:
    """(right, rows) of the held rows of every job: two numbers a job."""
    scored = held_scores(rows, jobs, weights)
    hit = F.count_if((F.col("p1") > 0.5) == (F.col("label") > 0.5))
    found = {r["job"]: (r["hit"], r["n"]) for r in scored.groupBy("job").agg(hit.alias("hit"), F.count("*").alias("n")).collect()}
    return [found.get(m, (0, 0)) for m in range(len(jobs))]
