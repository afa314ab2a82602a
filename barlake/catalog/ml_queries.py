"""Catalog: model training, evaluation and result tables (section 2.12, 2.4, 2.5, 2.8).

SQL cannot fit the models, but it can say what a right fit must give: row
counts per split, label variance, and that the optimality conditions hold,
which the Spark side checks on the data; single-feature least squares it can
compute itself.  The queries of metrics, scores and coefficients, and the
tables made of them, are rows-only and are tested against NumPy.
Model input is written once per content of the source; results are kept in the
table of ``operators.training``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import CORE_SYMBOLS
from ..operators import features as FT
from ..operators import forest as RF
from ..operators import gram as GR
from ..operators import ml as ML
from ..operators import training as TR
from ..session import scratch_path, table
from ..sources import files as FS
from ..streaming.jobs import table_exists
from .base import core, r, round_doubles
from .feature_queries import TARGET_SQL
from .registry import query


def _content(spark, sf) -> str:
    """Name of the source's content, whatever its path."""
    ev = table(spark, sf, "events")
    n, h = ev.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*ev.columns).cast("decimal(38,0)"))).first()
    return f"{n}-{h}"


def _data(spark, sf):
    """Model input, written once per content and code: iterative fits must not recompute the feature lineage."""
    path = scratch_path(spark, f"tables/model-input-{TR.digest(_content(spark, sf))}")
    if not table_exists(spark, path + "/_SUCCESS"):
        ML.model_input(FT.next_close_target(FT.feature_frame(core(spark, sf)))).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _results(spark, sf) -> TR.Results:
    return TR.results(_data(spark, sf), CORE_SYMBOLS, _content(spark, sf))


def _facts_sql(model: str) -> str:
    return f"""{TARGET_SQL} SELECT symbol, '{model}' AS model, count(*) FILTER (WHERE split = 'train') AS n_train,
  count(*) FILTER (WHERE split = 'test') AS n_test, true AS holds FROM tgt GROUP BY symbol"""


#: Largest gap of the optimality conditions, relative to the data's scale.
CONDITION_GAP = 1e-3


def _conditions(spark, sf, rows):
    """``rows`` of results with ``holds``: what the theory of a model demands of its fit, and metrics that agree with each other.

    Linear fits meet their optimality conditions.  A forest averages labels it
    has seen; forests and boosting explain half of the train label's variance at least.
    """
    data = _data(spark, sf)
    y = data.groupBy("symbol").agg(
        *[f(F.when(F.col("split") == s, F.col("y"))).alias(f"{n}_{s}") for s in ("train", "test") for n, f in (("vy", F.var_pop), ("lo", F.min), ("hi", F.max))])
    x = rows.join(y, "symbol")
    mse = F.col("rmse") * F.col("rmse")
    agree = (F.abs((1 - F.col("r2")) * F.col("vy_test") - mse) <= 1e-6 * F.greatest(mse, F.lit(1e-9))) & (F.col("mae") <= F.col("rmse") * (1 + 1e-9))
    tree = (F.col("train_mse") < 0.5 * F.col("vy_train")) & ((F.col("model") != "Random Forest") | (F.col("low") >= F.col("lo_train")) & (F.col("high") <= F.col("hi_train")))
    gaps = GR.configured(_results(spark, sf).fits()).select("symbol", "model", "config", "gap")
    x = x.join(gaps, ["symbol", "model", "config"], "left")
    return x.withColumn("consistent", agree).withColumn("holds", agree & F.coalesce(F.col("gap") < CONDITION_GAP, tree))


def _one_model(name):
    """Per symbol: rows of both splits and whether the default fit meets its conditions."""
    def fn(spark, sf):
        rows = _results(spark, sf).table([name], ["default"])
        return _conditions(spark, sf, rows).select("symbol", "model", "n_train", "n_test", "holds")
    return fn


for _key, _name in [("linear_regression", "Linear Regression"), ("ridge", "Ridge"), ("lasso", "Lasso"),
                    ("random_forest", "Random Forest"), ("gradient_boosting", "Gradient Boosting")]:
    query(_key, _facts_sql(_name))(_one_model(_name))


def _ols_sql() -> str:
    stats = ", ".join(f"avg({c}) AS {c}__mu, stddev_pop({c}) AS {c}__sd" for c in FT.FEATURE_COLS)
    scaled = ", ".join(f"({c} - {c}__mu) / CASE WHEN {c}__sd = 0 THEN 1 ELSE {c}__sd END" for c in FT.FEATURE_COLS)
    fit = lambda f, name: f"CASE WHEN var_pop(x) > 1e-9 THEN {r(f + '(y, x)', name, 6).rpartition(' AS ')[0]} END AS {name}"
    return f"""{TARGET_SQL}, tr AS (SELECT * FROM tgt WHERE split = 'train'), st AS (SELECT symbol, {stats} FROM tr GROUP BY symbol),
  lng AS (SELECT symbol, y, unnest([{", ".join(f"'{c}'" for c in FT.FEATURE_COLS)}]) AS feature, unnest([{scaled}]) AS x FROM tr JOIN st USING (symbol))
  SELECT symbol, feature, count(*) AS n, {fit('regr_slope', 'slope')}, {fit('regr_intercept', 'intercept')}, {fit('regr_r2', 'r2')}
  FROM lng GROUP BY symbol, feature"""


@query("ols_by_feature", _ols_sql())
def q_ols_by_feature(spark, sf):
    """Least squares of the next close on each scaled feature alone, from the Gram matrices of all symbols."""
    return round_doubles(GR.ols_by_feature(_data(spark, sf).where("split = 'train'"), FT.FEATURE_COLS), 6)


GRID_FAMILIES = {"Ridge": len(GR.RIDGE_GRID), "Lasso": len(GR.LASSO_GRID), "Random Forest": len(RF.GRID)}


@query("grid_search_cv3", f"""{TARGET_SQL}, fam(model, candidates) AS (VALUES {", ".join(f"('{k}', {v})" for k, v in GRID_FAMILIES.items())})
  SELECT symbol, model, candidates::BIGINT AS candidates, 3::BIGINT AS folds, count(*) AS n_train, true AS chosen_is_best
  FROM tgt, fam WHERE split = 'train' GROUP BY 1, 2, 3""")
def q_grid(spark, sf):
    """Per symbol and family: size of the grid, folds behind each mean error, train rows, and whether the choice has the lowest mean."""
    s = _results(spark, sf).scores()
    by = s.groupBy("symbol", "model").agg(F.count(F.lit(1)).alias("candidates"), F.min(F.size("fold_mse")).cast("long").alias("folds"),
                                          (F.min("cv_mse") == F.max(F.when(F.col("chosen"), F.col("cv_mse")))).alias("chosen_is_best"))
    n = _data(spark, sf).where("split = 'train'").groupBy("symbol").agg(F.count(F.lit(1)).alias("n_train"))
    return by.join(n, "symbol").select("symbol", "model", "candidates", "folds", "n_train", "chosen_is_best")


@query("grid_search_scores")
def q_grid_scores(spark, sf):
    """Every candidate: its three fold errors, their mean, and whether it is the choice."""
    s = _results(spark, sf).scores().select("symbol", "model", "setting", *[F.get("fold_mse", i).alias(f"mse_fold_{i}") for i in range(3)], "cv_mse", "chosen")
    return round_doubles(s)


@query("linear_coefficients")
def q_coefficients(spark, sf):
    """Weights of the default and tuned linear fits on scaled features; the intercept as a feature of its own."""
    f = GR.configured(_results(spark, sf).fits())
    names = F.array(*[F.lit(c) for c in [*FT.FEATURE_COLS, "(intercept)"]])
    x = f.select("symbol", "model", "config", "alpha", F.explode(F.arrays_zip(names.alias("feature"), F.concat("coefficients", F.array("intercept")).alias("weight"))).alias("w"))
    return round_doubles(x.select("symbol", "model", "config", "alpha", F.col("w.feature").alias("feature"), F.col("w.weight").alias("weight")))


@query("boosting_rounds")
def q_boosting_rounds(spark, sf):
    """Train error after each of the tuned boosting's rounds."""
    return round_doubles(_results(spark, sf).boosting_rounds("tuned"))


@query("model_metrics")
def q_model_metrics(spark, sf):
    """Test metrics of every model, symbol and configuration, with the setting behind them."""
    return round_doubles(_results(spark, sf).table().select("symbol", "model", "config", "setting", "n_train", "n_test", "mae", "rmse", "r2", "mape"))


@query("train_per_symbol", f"""{TARGET_SQL}, m(model) AS (VALUES {", ".join(f"('{x}')" for x in ML.MODEL_NAMES)}),
  te AS (SELECT symbol, count(*) AS n_test, avg(y) AS my, var_pop(y) AS vy FROM tgt WHERE split = 'test' GROUP BY symbol)
  SELECT symbol, model, 'default' AS config, n_test, {r('vy', 'y_variance', 6)}, true AS consistent FROM te, m""")
def q_train(spark, sf):
    """Every default model per symbol: test rows, label variance, and metrics that agree with each other and with it."""
    res = _conditions(spark, sf, _results(spark, sf).table(configs=["default"]))
    return res.select("symbol", "model", "config", "n_test", (F.round("vy_test", 6) + 0.0).alias("y_variance"), "consistent")


@query("save_load_model", f"""{TARGET_SQL} SELECT symbol, timestamp, true AS same FROM tgt WHERE split = 'test'""")
def q_save_load(spark, sf):
    """Each symbol's model is saved once, then found and loaded; both predict the same."""
    from functools import reduce
    d, out, base = _data(spark, sf), [], FS.new_table_path(spark, "models")
    for sym in CORE_SYMBOLS:
        train, test = (d.where((F.col("symbol") == sym) & (F.col("split") == s)) for s in ("train", "test"))
        path = f"{base}/{sym}/lasso"
        fresh = ML.pipeline(ML.lasso(1.0)).fit(train)
        fresh.write().save(path)
        back = ML.fit_or_load(ML.lasso(100.0), train, path)                 # present: not fitted again
        a = fresh.transform(test).select("symbol", "timestamp", F.col("prediction").alias("p1"))
        b = back.transform(test).select("timestamp", F.col("prediction").alias("p2"))
        out.append(a.join(b, "timestamp").select("symbol", "timestamp", (F.abs(F.col("p1") - F.col("p2")) < 1e-12).alias("same")))
    return reduce(lambda x, y: x.unionByName(y), out)


NAIVE_SQL = f"""{TARGET_SQL}, pr AS (SELECT symbol, split, timestamp, y, close AS prediction FROM tgt WHERE split = 'test')"""


@query("naive_forecast_metrics", f"""{NAIVE_SQL}, my AS (SELECT symbol, avg(y) AS m FROM pr GROUP BY symbol)
  SELECT symbol, {r('avg(abs(y - prediction))', 'mae')}, {r('sqrt(avg((y - prediction) * (y - prediction)))', 'rmse')},
    {r('1 - sum((y - prediction) * (y - prediction)) / sum((y - m) * (y - m))', 'r2')},
    {r('avg(abs(y - prediction) / greatest(abs(y), 2.220446049250313e-16)) * 100', 'mape')}
  FROM pr JOIN my USING (symbol) GROUP BY symbol""")
def q_naive(spark, sf):
    t = FT.next_close_target(FT.feature_frame(core(spark, sf))).where(F.col("split") == "test")
    return round_doubles(ML.regression_metrics(ML.naive_forecast(t), ["symbol"]))


@query("regression_metrics", f"""{NAIVE_SQL}, my AS (SELECT avg(y) AS m FROM pr)
  SELECT {r('avg(abs(y - prediction))', 'mae')}, {r('sqrt(avg((y - prediction) * (y - prediction)))', 'rmse')},
    {r('1 - sum((y - prediction) * (y - prediction)) / sum((y - m) * (y - m))', 'r2')},
    {r('avg(abs(y - prediction) / greatest(abs(y), 2.220446049250313e-16)) * 100', 'mape')} FROM pr, my""")
def q_metrics(spark, sf):
    t = FT.next_close_target(FT.feature_frame(core(spark, sf))).where(F.col("split") == "test")
    return round_doubles(ML.regression_metrics(ML.naive_forecast(t), []))


@query("prediction_errors", f"""{NAIVE_SQL} SELECT symbol, timestamp, {r('y - prediction', 'error')},
  CASE WHEN y - prediction > 0 THEN 'under' WHEN y - prediction < 0 THEN 'over' ELSE 'exact' END AS direction FROM pr""")
def q_pred_err(spark, sf):
    t = FT.next_close_target(FT.feature_frame(core(spark, sf))).where(F.col("split") == "test")
    return round_doubles(ML.prediction_errors(ML.naive_forecast(t)).select("symbol", "timestamp", "error", "direction"))


def _recap(spark, sf):
    """One row per (crypto, model): metrics of both configurations."""
    t = _results(spark, sf).table().select("symbol", "model", "config", "r2", "mae", "rmse")
    pick = lambda c, m: F.max(F.when(F.col("config") == c, F.col(m))).alias(f"{m}_{c}")  # noqa: E731  one row each
    return (t.groupBy("symbol", "model").agg(*[pick(c, m) for m in ("r2", "mae", "rmse") for c in TR.CONFIGS])
            .withColumn("crypto", F.replace("symbol", F.lit("USDT"), F.lit("")))
            .withColumn("delta_r2", F.col("r2_tuned") - F.col("r2_default")))


@query("compare_default_tuned")
def q_compare(spark, sf):
    return round_doubles(_recap(spark, sf).select("crypto", "model", "r2_default", "r2_tuned", "delta_r2", "rmse_default", "rmse_tuned"))


@query("results_pivot")
def q_pivot(spark, sf):
    return round_doubles(_recap(spark, sf).groupBy("model").pivot("crypto", ["BTC", "ETH", "SOL"]).agg(F.first("r2_tuned")))


@query("tuning_gain")
def q_gain(spark, sf):
    return round_doubles(_recap(spark, sf).agg((F.avg("delta_r2") * 100).alias("mean_delta_r2_pct"), F.count(F.lit(1)).alias("pairs")))


@query("rank_models")
def q_rank(spark, sf):
    from pyspark.sql import Window
    w = Window.partitionBy("crypto").orderBy(F.col("r2_tuned").desc(), F.col("model"))
    x = _recap(spark, sf).withColumn("rank", F.row_number().over(w))
    return round_doubles(x.select("crypto", "model", "r2_tuned", "rank"))


@query("results_csv")
def q_results_csv(spark, sf):
    path = FS.new_table_path(spark, "results_summary_all_models")
    FS.write_single_csv(_recap(spark, sf).select("crypto", "model", "r2_default", "r2_tuned", "mae_tuned", "rmse_tuned"),
                        path)
    return spark.read.option("header", True).option("inferSchema", True).csv(path)
