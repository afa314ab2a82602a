"""MLlib parity: ridge with regParam = alpha * sd(y) / n equals closed-form ridge."""

import threading

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from barlake.operators import features as FT
from barlake.operators import forest as RF
from barlake.operators import gram as GR
from barlake.operators import ml as ML
from barlake.operators import training as TR
from barlake.session import cut_lineage
from barlake.catalog.base import core
from conftest import SF01


@pytest.mark.parametrize("alpha", [1.0, 10.0])
def test_ridge_matches_closed_form(spark, alpha):
    data = cut_lineage(ML.model_input(FT.next_close_target(FT.feature_frame(core(spark, SF01)))))
    d = data.where((F.col("symbol") == "BTCUSDT") & (F.col("split") == "train"))
    pdf = d.select("features", "y").toPandas()
    X = np.stack(pdf["features"].map(lambda v: v.toArray()).to_numpy())
    y = pdf["y"].to_numpy()
    m = ML.ridge(alpha, len(y), y.std(ddof=1)).fit(d)
    Xc, yc = X - X.mean(0), y - y.mean()
    beta = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(X.shape[1]), Xc.T @ yc)
    assert np.max(np.abs(m.coefficients.toArray() - beta)) <= 1e-4 * max(1.0, np.max(np.abs(beta)))
    assert abs(m.intercept - (y.mean() - X.mean(0) @ beta)) < 1e-6


def test_regression_metrics_formulas(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (4.0, 4.0)], "y double, prediction double")
    r = ML.regression_metrics(df, []).first()
    e = np.array([-0.5, 1.0, 0.0]); yv = np.array([1.0, 2.0, 4.0])
    assert r["mae"] == pytest.approx(np.mean(np.abs(e)))
    assert r["rmse"] == pytest.approx(np.sqrt(np.mean(e ** 2)))
    assert r["r2"] == pytest.approx(1 - np.sum(e ** 2) / np.sum((yv - yv.mean()) ** 2))
    assert r["mape"] == pytest.approx(np.mean(np.abs(e) / yv) * 100)


def _lasso_cd(X, y, alpha, iters=20000, tol=1e-12):
    """Reference coordinate descent for (1/2n)||y - Xw - b||^2 + alpha * ||w||_1."""
    n, p = X.shape
    xm, ym = X.mean(0), y.mean()
    Xc, yc = X - xm, y - ym
    w, r, sq = np.zeros(p), yc.copy(), (Xc ** 2).sum(0)
    for _ in range(iters):
        step = 0.0
        for j in range(p):
            if sq[j] == 0:
                continue
            old = w[j]
            rho = Xc[:, j] @ r + sq[j] * old
            new = np.sign(rho) * max(abs(rho) - n * alpha, 0.0) / sq[j]
            if new != old:
                r -= Xc[:, j] * (new - old)
                w[j], step = new, max(step, abs(new - old))
        if step < tol:
            break
    return w, ym - xm @ w


def test_lasso_matches_coordinate_descent(spark):
    data = cut_lineage(ML.model_input(FT.next_close_target(FT.feature_frame(core(spark, SF01)))))
    d = data.where((F.col("symbol") == "BTCUSDT") & (F.col("split") == "train"))
    pdf = d.select("features", "y").toPandas()
    X = np.stack(pdf["features"].map(lambda v: v.toArray()).to_numpy())
    y = pdf["y"].to_numpy()
    m = ML.lasso(1.0).fit(d)
    w, b = _lasso_cd(X, y, 1.0)
    got = m.coefficients.toArray()
    assert np.max(np.abs(got - w)) <= 1e-4 * max(1.0, np.max(np.abs(w)))
    assert set(np.flatnonzero(np.abs(got) > 1e-9)) == set(np.flatnonzero(np.abs(w) > 1e-9))
    assert abs(m.intercept - b) < 1e-6


# Gram matrices, forests scored from one, and the table of results

@pytest.fixture(scope="module")
def data(spark):
    return cut_lineage(ML.model_input(FT.next_close_target(FT.feature_frame(core(spark, SF01)))))


@pytest.fixture(scope="module")
def fits(data):
    return GR.linear_fits(data)


def _arrays(rows):
    pdf = rows.select("timestamp", "features", "y").toPandas().sort_values("timestamp")
    return np.stack(pdf["features"].map(lambda v: v.toArray()).to_numpy()), pdf["y"].to_numpy()


def _fit(name, alpha, X, y):
    Xc, yc = X - X.mean(0), y - y.mean()
    if name == "Lasso":
        return _lasso_cd(X, y, alpha)
    w = np.linalg.lstsq(Xc, yc, rcond=1e-8)[0] if name == "Linear Regression" else np.linalg.solve(Xc.T @ Xc + alpha * np.eye(X.shape[1]), Xc.T @ yc)
    return w, y.mean() - X.mean(0) @ w


def test_fits_of_all_symbols_equal_separate_ones(data, fits):
    """Predictions of every penalty, and the mean error over three time folds, against NumPy on the rows."""
    rows = {(r.symbol, r.model, r.alpha): r for r in fits.collect()}
    assert len(rows) == 3 * (1 + len(GR.RIDGE_GRID) + len(GR.LASSO_GRID))
    X, y = _arrays(data.where("symbol = 'ETHUSDT' AND split = 'train'"))
    folds = np.minimum(np.arange(len(y)) * 3 // len(y), 2)
    for (symbol, model, alpha), r in rows.items():
        assert r.gap < 1e-6, r
        if symbol != "ETHUSDT" or (model, alpha) == ("Lasso", 0.01):
            continue
        w, b = _fit(model, alpha, X, y)
        scale = y.std()
        assert np.max(np.abs(X @ np.array(r.coefficients) + r.intercept - X @ w - b)) < 1e-5 * scale, (model, alpha)
        if model != "Lasso":
            for k in range(3):
                w, b = _fit(model, alpha, X[folds != k], y[folds != k])
                mse = np.mean((y[folds == k] - X[folds == k] @ w - b) ** 2)
                assert abs(r.fold_mse[k] - mse) < 1e-3 * mse + 1e-8 * scale ** 2, (model, alpha, k)
        assert r.n_train == len(y) and abs(r.cv_mse - np.mean(r.fold_mse)) < 1e-9 * r.cv_mse
    for symbol in {k[0] for k in rows}:
        for model in ("Ridge", "Lasso"):
            mine = [r for k, r in rows.items() if k[:2] == (symbol, model)]
            assert [r.alpha for r in mine if r.chosen] == [min(mine, key=lambda r: r.cv_mse).alpha]


def test_lasso_meets_its_conditions_on_features_that_depend_on_each_other():
    rnd = np.random.default_rng(1)
    X = rnd.normal(size=(200, 6))
    X = np.column_stack([X, X[:, 0], X[:, 1] + 1e-6 * rnd.normal(size=200), np.zeros(200)])
    y = X @ np.array([3, -2, 0, 0, 1, 0, 0, 0, 0]) + rnd.normal(size=200)
    Xc, yc = X - X.mean(0), y - y.mean()
    xx, xy, w = Xc.T @ Xc, Xc.T @ yc, np.zeros(9)
    for alpha in (2.0, 0.5, 0.1, 0.001):
        w = GR.lasso(xx, xy, 200 * alpha, w)
        assert GR._lasso_gap(xx, xy, 200 * alpha, w) < 1e-6 * np.abs(xy).max()


def test_metrics_of_linear_models_equal_numpy(spark, data, tmp_path):
    table = TR.Results(data, ["BTCUSDT"], str(tmp_path / "r")).table(["Linear Regression", "Ridge"], ["default"]).collect()
    X, y = _arrays(data.where("symbol = 'BTCUSDT' AND split = 'train'"))
    Xt, yt = _arrays(data.where("symbol = 'BTCUSDT' AND split = 'test'"))
    assert {(r.symbol, r.model) for r in table} == {("BTCUSDT", "Linear Regression"), ("BTCUSDT", "Ridge")}
    for r in table:
        w, b = _fit(r.model, 1.0, X, y)
        e = yt - Xt @ w - b
        assert (r.n_train, r.n_test) == (len(y), len(yt))
        assert r.rmse == pytest.approx(np.sqrt(np.mean(e ** 2)), rel=1e-4) and r.mae == pytest.approx(np.mean(np.abs(e)), rel=1e-4)
        assert r.r2 == pytest.approx(1 - np.sum(e ** 2) / np.sum((yt - yt.mean()) ** 2), rel=1e-4, abs=1e-6)


def test_cut_trees_equal_trees_fitted_small(spark, tmp_path):
    """Depth: a fit limited in depth, same seed and tree count.  Prefix: the first trees' mean.  Split size: nodes with fewer rows are leaves."""
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(250, 4))
    y = x[:, 0] * 3 + x[:, 1] ** 2 + rnd.normal(size=250) / 9
    rows = spark.createDataFrame([(Vectors.dense(a), float(b), "s", i, Vectors.dense(a)) for i, (a, b) in enumerate(zip(x, y))],
                                 ["features", "y", "symbol", "timestamp", "copy"]).coalesce(1).cache()
    deep = ML.random_forest(7).fit(rows)
    deep.write().save(str(tmp_path / "deep"))
    forest = RF.read_forest(spark, str(tmp_path / "deep"))
    for depth in (1, 3, 6, None):
        small = ML.random_forest(7, depth).fit(rows)
        want = np.array([r[0] for r in small.transform(rows).select("prediction").collect()])
        assert np.allclose(forest.scores(x, [(7, depth, 2)])[:, 0], want, atol=1e-9), depth
    trees = np.array([[t.predict(Vectors.dense(a)) for t in deep.trees[:3]] for a in x[:20]])
    assert np.allclose(forest.scores(x[:20], [(3, None, 2)])[:, 0], trees.mean(1), atol=1e-9)
    got = forest.scores(x, [(7, None, 2), (7, None, 40), (7, 2, 40), (2, 2, 2)])

    def walk(tree, a, least, limit):
        at, d = forest.roots[tree], 0
        while forest.feature[at] >= 0 and forest.rows[at] >= least and d < limit:
            at, d = (forest.left if a[forest.feature[at]] <= forest.threshold[at] else forest.right)[at], d + 1
        return forest.prediction[at]

    for k, (trees_, depth, least) in enumerate([(7, 99, 2), (7, 99, 40), (7, 2, 40), (2, 2, 2)]):
        assert np.allclose(got[:, k], [np.mean([walk(t, a, least, depth) for t in range(trees_)]) for a in x])
    table = RF.grid_predictions(rows, forest, [(7, 3, 2), (2, 2, 2)]).toPandas()
    assert len(table) == 500 and set(table["setting"]) == {"trees=7,depth=3,min_split=2", "trees=2,depth=2,min_split=2"}


def test_results_resume_and_follow_code_and_input(spark, data, tmp_path, monkeypatch):
    """Small forests and boosting: every piece is written once, a second run fits nothing, and the digest names code and content."""
    monkeypatch.setattr(RF, "RF_TREES", [2, 4])
    monkeypatch.setattr(RF, "GRID", [(t, d, m) for t in (2, 4) for d in (3, None) for m in (2, 5)])
    monkeypatch.setattr(RF, "DEFAULT_RF", (2, None, 2))
    monkeypatch.setattr(ML, "gradient_boosting", lambda tuned=False: GBTRegressor(labelCol="y", maxIter=6 if tuned else 3, maxDepth=3, seed=1))
    results = TR.Results(data, ["BTCUSDT", "nowhere"], str(tmp_path / "r"))
    first = sorted(map(str, results.table().collect()))
    assert len(first) == len(ML.MODEL_NAMES) * 2
    scores = results.scores().collect()
    assert len([s for s in scores if s.model == "Random Forest"]) == 8 and all(len(s.fold_mse) == 3 for s in scores)
    for model in ("Ridge", "Lasso", "Random Forest"):
        (chosen,) = [s for s in scores if s.model == model and s.chosen]
        assert chosen.cv_mse == min(s.cv_mse for s in scores if s.model == model)
        assert any(f"model='{model}'" in r and "config='tuned'" in r and f"setting='{chosen.setting}'" in r for r in first)
    rounds = [r.train_mse for r in sorted(results.boosting_rounds().collect(), key=lambda r: r.round)]
    assert len(rounds) == 6 and all(a > b for a, b in zip(rounds, rounds[1:]))

    def no_fit(*a, **k):
        raise AssertionError("fitted again")
    monkeypatch.setattr(ML, "random_forest", no_fit)
    monkeypatch.setattr(ML, "gradient_boosting", no_fit)
    monkeypatch.setattr(GR, "linear_fits", no_fit)
    again = TR.Results(data, ["BTCUSDT"], str(tmp_path / "r"))
    assert sorted(map(str, again.table().collect())) == first
    assert TR.digest("1") != TR.digest("2")
    before = TR.digest("1")
    monkeypatch.setattr(TR.inspect, "getsource", lambda m: "other code")
    assert TR.digest("1") != before


def test_stored_forest_is_scored_on_executors(spark, tmp_path, monkeypatch):
    """Blocks of rows and packs of trees give the forest's own scores, copies and null times kept; no node goes through the driver."""
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(120, 3))
    y = x[:, 0] + x[:, 1] ** 2
    rows = [(Vectors.dense(a), float(b), "s", i if i % 40 else None) for i, (a, b) in enumerate(zip(x, y))]
    rows = spark.createDataFrame(rows + rows[:5], ["features", "y", "symbol", "timestamp"])
    ML.random_forest(7, 6).fit(rows.coalesce(1)).write().save(str(tmp_path / "f"))
    grid = [(7, None, 2), (7, 6, 2), (5, 3, 2), (2, None, 9), (1, 1, 2)]
    forest = RF.read_forest(spark, str(tmp_path / "f"))
    z = np.vstack([x, x[:5]])
    want = forest.scores(z, grid)
    monkeypatch.setattr(RF, "TREES_AT_A_TIME", 3)
    monkeypatch.setattr(RF, "ROWS_PER_BLOCK", 50)
    monkeypatch.setattr(type(rows), "toPandas", lambda self: (_ for _ in ()).throw(AssertionError("rows through the driver")))
    got = RF.stored_predictions(rows, RF.read_nodes(spark, str(tmp_path / "f")), grid).collect()
    assert len(got) == 125 and sum(r.timestamp is None for r in got) == 4
    for r in got:
        near = np.abs(want - np.array(r.predictions)).max(axis=1)
        assert near.min() < 1e-12 and r.predictions[0] == r.predictions[1]
    assert np.allclose(sorted(r.predictions[2] for r in got), np.sort(want[:, 2]), atol=1e-12)


def test_fold_scores_and_metrics_of_a_forest_collect_no_nodes(spark, data, tmp_path, monkeypatch):
    """One symbol of three: the grid names it alone, each family has one choice, and no table of nodes reaches the driver."""
    monkeypatch.setattr(RF, "RF_TREES", [2, 4])
    monkeypatch.setattr(RF, "GRID", [(t, d, 2) for t in (2, 4) for d in (25, None)])
    monkeypatch.setattr(RF, "DEFAULT_RF", (2, None, 2))
    results = TR.Results(data, ["ETHUSDT"], str(tmp_path / "r"))
    monkeypatch.setattr(RF, "read_forest", lambda *a: (_ for _ in ()).throw(AssertionError("nodes through the driver")))
    scores = results.scores().collect()
    assert {s.symbol for s in scores} == {"ETHUSDT"}
    assert sorted(s.model for s in scores if s.chosen) == ["Lasso", "Random Forest", "Ridge"]
    table = results.table(["Random Forest"]).collect()
    assert sorted(r.config for r in table) == ["default", "tuned"]
    by = {s.setting: s for s in scores if s.model == "Random Forest"}
    held = results.folds().where("symbol = 'ETHUSDT' AND fold = 0")
    X, y = _arrays(held)
    monkeypatch.undo()
    forest = RF.read_forest(spark, str(tmp_path / "r" / "trees-ETHUSDT-0"))
    for t in (2, 4):
        mse = np.mean((y - forest.scores(X, [(t, None, 2)])[:, 0]) ** 2)
        assert by[RF.name_of((t, None, 2))].fold_mse[0] == pytest.approx(mse, rel=1e-9)
        if forest.depth <= 25:
            assert by[RF.name_of((t, None, 2))].fold_mse[0] == by[RF.name_of((t, 25, 2))].fold_mse[0]


def test_forest_rows_keep_their_node_and_trees_stay_the_same(spark, tmp_path):
    """Tasks are not sent the trees grown so far; nodes equal those of a fit that sends them, of one group of nodes or many, copies kept."""
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(300, 4))
    y = x[:, 0] * 2 + x[:, 1] ** 2 + rnd.normal(size=300) / 9
    rows = [(Vectors.dense(a), float(b)) for a, b in zip(x, y)]
    rows = spark.createDataFrame(rows + rows[:9], ["features", "y"]).coalesce(1).cache()
    mine = ML.random_forest(6)
    assert mine.getCacheNodeIds() and mine.getMaxMemoryInMB() < 1024
    nodes = []
    for name, est in (("mine", mine), ("sent", ML.random_forest(6).setCacheNodeIds(False).setMaxMemoryInMB(1024)), ("small", ML.random_forest(6).setMaxMemoryInMB(1))):
        est.fit(rows).write().save(str(tmp_path / name))
        nodes.append(RF.read_nodes(spark, str(tmp_path / name)).orderBy("tree", "id").toPandas())
    assert len(nodes[0]) > 1000 and nodes[0].equals(nodes[1]) and nodes[0].equals(nodes[2])


def test_forests_run_beside_boosting(spark, data, tmp_path, monkeypatch):
    """Chains of boosting leave three quarters of the cores to forests, and the results come in the order of the jobs."""
    cores = spark.sparkContext.defaultParallelism
    together = max(cores, 6 + 3 * cores // 4)
    met = threading.Barrier(together)

    def job(k):
        met.wait(30)
        return k
    results = TR.Results(data, ["BTCUSDT"], str(tmp_path / "r"))
    assert results._together([lambda k=k: job(k) for k in range(together)], 6) == list(range(together))
    seen = []
    monkeypatch.setattr(TR.Results, "_together", lambda self, jobs, light=0: seen.append((len(jobs), light)) or [spark.createDataFrame([], TR.RESULT)])
    results.table()
    assert seen[0] == (2 + 1 + 3 + 1, 2)
