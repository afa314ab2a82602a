"""Linear models of every symbol from Gram matrices, in one pass over the rows.

One aggregation gives, per (symbol, fold), the count, the sums and the sums of
products of features and label.  Everything a linear fit needs is a sum of
those: the train set is the sum of its folds, a cross-validation train set that
sum without one fold, and a fold's squared error a quadratic form of its own
matrix.  So all symbols, folds and penalties come from one job, whose second
part holds a few thousand numbers per symbol.

* Linear Regression: least squares, of smallest norm where features depend on each other.
* Ridge: ``|y - xw - b|^2 + alpha * |w|^2``.
* Lasso: ``|y - xw - b|^2 / 2n + alpha * |w|_1`` by coordinate descent, from the
  largest penalty down, each started from the one before.

Labels are shifted by their symbol's mean before products are taken, so large
prices lose no digits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.joins import checked_broadcast
from ..session import cut_lineage

RIDGE_GRID = [0.01, 0.1, 1, 10, 100]
LASSO_GRID = [0.01, 0.1, 1, 10]
MAX_SWEEPS = 20_000
POLISH_SWEEPS = 25          # sweeps after which the linear system on the features left in is tried
GAP = 1e-10                 # of the largest product with the label: how well it must meet the optimality conditions
TOLERANCE = 1e-12           # of a sweep's largest step, relative to the label's deviation
FIT_SCHEMA = """symbol string, model string, alpha double, n_train long, intercept double, coefficients array<double>,
 fold_mse array<double>, cv_mse double, chosen boolean, gap double"""


def gram_parts(rows: DataFrame) -> DataFrame:
    """(symbol, fold, pos, v): count, sums and products of (x, y - y0), added up per task, then by key and position.

    ``rows`` has symbol, fold, x (array), y and y0.  Any one symbol may hold most
    rows: each task sends one small row per (symbol, fold) it has seen.
    """
    def run(batches):
        held: dict[tuple, np.ndarray] = {}
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            z = np.column_stack([np.ones(n), x, b.column("y").to_numpy(zero_copy_only=False) - b.column("y0").to_numpy(zero_copy_only=False)])
            keys = pd.MultiIndex.from_arrays([b.column("symbol").to_pylist(), b.column("fold").to_pylist()])
            codes, names = pd.factorize(keys)
            for k, name in enumerate(names):
                part = z[codes == k]
                g = part.T @ part                       # its first row: count and sums
                held[name] = held[name] + g if name in held else g
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in held], pa.string()), pa.array([f for _, f in held], pa.int32()),
                                              pa.array([g.ravel() for g in held.values()], pa.list_(pa.float64()))], names=["symbol", "fold", "g"])

    parts = rows.select("symbol", "fold", "x", "y", "y0").mapInArrow(run, "symbol string, fold int, g array<double>")
    return parts.select("symbol", "fold", F.posexplode("g").alias("pos", "v")).groupBy("symbol", "fold", "pos").agg(F.sum("v").alias("v"))


def centred(g: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray, float]:
    """(n, means, centred products of features, of features and label, of the label) of a matrix of (1, x, y)."""
    n, s = g[0, 0], g[0, 1:]
    c = g[1:, 1:] - np.outer(s, s) / n
    return n, s / n, c[:-1, :-1], c[:-1, -1], float(c[-1, -1])


def least_squares(xx: np.ndarray, xy: np.ndarray, l2: float = 0.0) -> np.ndarray:
    """Weights of smallest norm; directions that are rounding of 0 take no part unless a penalty holds them."""
    e, u = np.linalg.eigh(xx)
    least = max(e.max(initial=0.0), 0.0) * len(e) * np.finfo("f8").eps
    inverse = np.array([1 / (max(v, 0.0) + l2) if l2 or v > least else 0.0 for v in e])
    return u @ (inverse * (u.T @ xy))


def lasso(xx: np.ndarray, xy: np.ndarray, l1: float, w: np.ndarray) -> np.ndarray:
    """Coordinate descent on ``w'xx w / 2 - xy'w + l1 * |w|_1`` from ``w`` until the features it leaves in give the exact optimum."""
    w, d = w.copy(), np.diag(xx)
    use = [int(j) for j in np.flatnonzero(d > 1e-12 * max(d.max(initial=0.0), 1e-300))]
    gradient = xy - xx @ w
    unit = np.sqrt(max(float(np.max(np.abs(xy), initial=0.0)), 1e-300) / max(float(d.max(initial=0.0)), 1e-300))
    for sweep in range(MAX_SWEEPS):
        step = 0.0
        for j in use:
            old = w[j]
            rho = gradient[j] + d[j] * old
            new = (rho - l1 if rho > l1 else rho + l1 if rho < -l1 else 0.0) / d[j]
            if new != old:
                gradient -= xx[:, j] * (new - old)
                w[j] = new
                step = max(step, abs(new - old))
        done = step <= TOLERANCE * unit
        if done or sweep % POLISH_SWEEPS == POLISH_SWEEPS - 1:
            exact = _on_support(xx, xy, l1, w)
            if _lasso_gap(xx, xy, l1, exact) <= GAP * float(np.max(np.abs(xy), initial=0.0)):
                return exact
        if done:
            break
    exact = _on_support(xx, xy, l1, w)
    return exact if _lasso_gap(xx, xy, l1, exact) <= _lasso_gap(xx, xy, l1, w) else w


def _on_support(xx: np.ndarray, xy: np.ndarray, l1: float, w: np.ndarray) -> np.ndarray:
    """The solution of the linear system that the optimum solves if it has the support and signs of ``w``; else ``w``."""
    held = np.flatnonzero(w)
    exact = np.zeros_like(w)
    if len(held):
        exact[held] = least_squares(xx[np.ix_(held, held)], xy[held] - l1 * np.sign(w[held]))
    return exact if np.array_equal(np.sign(exact), np.sign(w)) else w


def _lasso_gap(xx: np.ndarray, xy: np.ndarray, l1: float, w: np.ndarray) -> float:
    """Largest distance from the subgradient conditions: x'r = l1 * sign(w) where w is not 0, else |x'r| <= l1."""
    r = xy - xx @ w
    return float(np.max(np.where(w != 0, np.abs(r - l1 * np.sign(w)), np.maximum(np.abs(r) - l1, 0.0)), initial=0.0))


def squared_error(g: np.ndarray, w: np.ndarray, b: float) -> float:
    """Mean squared error of ``xw + b`` over the rows behind a matrix."""
    v = np.concatenate([[-b], -w, [1.0]])
    return float(v @ g @ v / g[0, 0])


def fits_of(folds: list[np.ndarray], y0: float) -> list[tuple]:
    """Every fit of one symbol from the matrices of its folds: the columns of ``FIT_SCHEMA`` but symbol."""
    total = sum(folds)
    grids = {"Linear Regression": [0.0], "Ridge": RIDGE_GRID, "Lasso": LASSO_GRID}

    def weights(model: str, g: np.ndarray) -> dict[float, tuple[np.ndarray, float]]:
        n, m, xx, xy, _ = centred(g)
        out, w = {}, np.zeros(len(xy))
        for alpha in sorted(grids[model], reverse=True):
            w = lasso(xx, xy, n * alpha, w) if model == "Lasso" else least_squares(xx, xy, alpha)
            out[alpha] = (w, float(m[-1] - m[:-1] @ w))
        return out

    rows = []
    n, _, xx, xy, yy = centred(total)
    for model, grid in grids.items():
        best = weights(model, total)
        tried = [weights(model, total - f) if f[0, 0] and f[0, 0] < total[0, 0] else None for f in folds]
        errors = {a: [squared_error(f, *t[a]) for f, t in zip(folds, tried) if t is not None] for a in grid}
        mean = {a: float(np.mean(e)) if e else None for a, e in errors.items()}
        pick = min(grid, key=lambda a: (mean[a] if mean[a] is not None else 0.0))        # ties: the first of the grid
        for a in grid:
            w, b = best[a]
            rr = max(yy - 2 * xy @ w + w @ xx @ w, 0.0)
            r = xy - xx @ w
            gap = _lasso_gap(xx, xy, n * a, w) if model == "Lasso" else float(np.max(np.abs(r - a * w), initial=0.0))
            scale = np.sqrt(max(np.diag(xx).max(initial=0.0) * max(rr, 0.0), 1e-24))
            rows.append((model, float(a), int(round(n)), b + y0, w.tolist(), errors[a], mean[a], a == pick, gap / scale))
    return rows


def linear_fits(data: DataFrame, k: int = 3) -> DataFrame:
    """Fits of Linear Regression, Ridge and Lasso for every symbol and penalty, with fold errors and the chosen penalty.

    ``data`` is the model input (symbol, split, timestamp, y, features).
    """
    from .ml import with_time_folds
    train = with_time_folds(data.where(F.col("split") == "train"), k)
    y0 = cut_lineage(train.groupBy("symbol").agg(F.avg("y").alias("y0")))
    rows = train.join(checked_broadcast(y0), "symbol").select("symbol", F.col("fold").cast("int").alias("fold"), vector_to_array("features").alias("x"), "y", "y0")
    grams = gram_parts(rows).join(checked_broadcast(y0), "symbol")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        size = int(round(np.sqrt(pdf["pos"].max() + 1)))
        folds = [f.sort_values("pos")["v"].to_numpy().reshape(size, size) for _, f in pdf.groupby("fold")]
        out = pd.DataFrame(fits_of(folds, float(pdf["y0"].iloc[0])), columns=["model", "alpha", "n_train", "intercept", "coefficients", "fold_mse", "cv_mse", "chosen", "gap"])
        out.insert(0, "symbol", pdf["symbol"].iloc[0])
        return out

    return cut_lineage(grams.groupBy("symbol").applyInPandas(solve, FIT_SCHEMA))


def configured(fits: DataFrame) -> DataFrame:
    """The fits behind the two configurations: penalty 1 as default (0 for least squares), the chosen one as tuned."""
    default = fits.where((F.col("model") == "Linear Regression") | (F.col("alpha") == 1.0)).withColumn("config", F.lit("default"))
    return default.unionByName(fits.where("chosen").withColumn("config", F.lit("tuned")))


def predictions(data: DataFrame, fits: DataFrame) -> DataFrame:
    """(symbol, model, config, timestamp, y, prediction) of every row and configured fit of its symbol, in one pass."""
    f = checked_broadcast(configured(fits).select("symbol", "model", "config", "intercept", "coefficients"))
    x = data.select("symbol", "timestamp", "y", vector_to_array("features").alias("x")).join(f, "symbol")
    dot = F.aggregate(F.zip_with("x", "coefficients", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return x.select("symbol", "model", "config", "timestamp", "y", (F.col("intercept") + dot).alias("prediction"))


def ols_by_feature(data: DataFrame, cols: list[str]) -> DataFrame:
    """Least squares of the label on each single feature, from the same matrices: slope, intercept and r2 per (symbol, feature)."""
    y0 = cut_lineage(data.groupBy("symbol").agg(F.avg("y").alias("y0")))
    rows = data.join(checked_broadcast(y0), "symbol").select("symbol", F.lit(0).alias("fold"), vector_to_array("features").alias("x"), "y", "y0")
    grams = gram_parts(rows).join(checked_broadcast(y0), "symbol")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        size = int(round(np.sqrt(pdf["pos"].max() + 1)))
        n, m, xx, xy, yy = centred(pdf.sort_values("pos")["v"].to_numpy().reshape(size, size))
        out = []
        for j, c in enumerate(cols):
            flat = xx[j, j] <= 1e-9 * n
            slope = None if flat else xy[j] / xx[j, j]
            out.append((pdf["symbol"].iloc[0], c, int(round(n)), slope, None if flat else m[-1] + pdf["y0"].iloc[0] - slope * m[j],
                        None if flat or yy <= 0 else xy[j] ** 2 / (xx[j, j] * yy)))
        return pd.DataFrame(out, columns=["symbol", "feature", "n", "slope", "intercept", "r2"])

    return grams.groupBy("symbol").applyInPandas(solve, "symbol string, feature string, n long, slope double, intercept double, r2 double")
