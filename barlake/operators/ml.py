"""Next-bar regressors with MLlib: per-symbol fits, temporal CV, metrics.

Model set (fixed to the reference's configurations):
* Linear Regression - OLS;
* Ridge (alpha 1; grid 0.01..100) - squared-L2 with ``regParam = alpha * sd(y) / n``, solved in closed form
  (MLlib scales the label internally; this makes it equal to closed-form ridge);
* Lasso (alpha 1; grid 0.01..10) - ``elasticNetParam = 1, regParam = alpha``;
* Random Forest - 100 trees, unlimited depth (MLlib max 30), all features; its grid
  (trees {100, 200} x depth {10, 20, none} x min split {2, 5}) is scored in ``forest``;
* Gradient boosting - one ``GBTRegressor`` stands in for the three external
  boosted-tree libraries (100 rounds default; 200 rounds, depth 7, step 0.1,
  subsample 0.8, feature fraction 0.8 tuned).  Numbers differ by design.
Linear models of all symbols, their grids and folds come from one pass in ``gram``;
``training`` keeps every model's results.  Cross-validation uses 3 contiguous time folds, MSE.
Metrics are plain aggregates (MAE, RMSE, R2, MAPE %), so they run where the
predictions are.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.chunked import global_row_index
from ..plans.joins import checked_broadcast
from .features import FEATURE_COLS, standard_scale

MAX_TREE_DEPTH = 30
SEED = 42
TREE_MEMORY_MB = 128        # statistics of the nodes split together: the memory of a task, and how long it keeps its core
MODEL_NAMES = ["Linear Regression", "Ridge", "Lasso", "Random Forest", "Gradient Boosting"]
# Iterative learners run one job per iteration / tree level: size training
# partitions by rows so big symbols stay parallel and small ones skip task overhead.
ROWS_PER_TRAIN_PARTITION = 500_000


def model_input(target_frame: DataFrame, cols: list[str] = FEATURE_COLS) -> DataFrame:
    """Scaled feature vector + label ``y`` (scaler fitted on train rows only)."""
    scaled = standard_scale(target_frame, cols)
    return VectorAssembler(inputCols=cols, outputCol="features").transform(scaled).select(
        "symbol", "split", "timestamp", "close", "y", "features")


def ridge_penalty(alpha: float, n: int, y_sd: float) -> float:
    """MLlib's regParam of a ridge ``alpha``: the normal solver divides by the population deviation of the label."""
    return alpha * y_sd * ((n - 1) / n) ** 0.5 / n


def ridge(alpha: float, n: int, y_sd: float) -> LinearRegression:
    return LinearRegression(labelCol="y", regParam=ridge_penalty(alpha, n, y_sd), elasticNetParam=0.0, standardization=False,
                            solver="normal")


def lasso(alpha: float) -> LinearRegression:
    return LinearRegression(labelCol="y", regParam=alpha, elasticNetParam=1.0, standardization=False,
                            maxIter=1000, tol=1e-10)


def random_forest(trees: int = 100, depth: int | None = None) -> RandomForestRegressor:
    """Each row keeps the node it is in, so that tasks are not sent the trees grown so far, which get large without a limit of depth."""
    return RandomForestRegressor(labelCol="y", numTrees=trees, maxDepth=depth or MAX_TREE_DEPTH, featureSubsetStrategy="all",
                                 seed=SEED, maxMemoryInMB=TREE_MEMORY_MB, cacheNodeIds=True)


def gradient_boosting(tuned: bool = False) -> GBTRegressor:
    if tuned:
        return GBTRegressor(labelCol="y", maxIter=200, maxDepth=7, stepSize=0.1, subsamplingRate=0.8,
                            featureSubsetStrategy="0.8", seed=SEED)
    return GBTRegressor(labelCol="y", maxIter=100, maxDepth=6, stepSize=0.1, seed=SEED)


def with_time_folds(train: DataFrame, k: int = 3) -> DataFrame:
    """``fold`` = contiguous block of the train rows in time (no shuffling)."""
    x = global_row_index(train, ["symbol"], "timestamp", "__i", with_count="__n")
    return x.withColumn("fold", F.least(F.floor(F.col("__i") * k / F.col("__n")), F.lit(k - 1)).cast("int")).drop("__i", "__n")


def regression_metrics(pred: DataFrame, keys: list[str], y: str = "y", yhat: str = "prediction") -> DataFrame:
    """MAE, RMSE, R2 and MAPE % per group (one pass for sums, one for the mean of y)."""
    e = F.col(y) - F.col(yhat)
    keys = list(keys) or []
    k = keys or ["__all"]
    p = pred if keys else pred.withColumn("__all", F.lit(1))
    mean_y = p.groupBy(*k).agg(F.avg(y).alias("__my"))
    x = p.join(checked_broadcast(mean_y), k)
    return x.groupBy(*k).agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"),
        (1 - F.sum(e * e) / F.sum((F.col(y) - F.col("__my")) ** 2)).alias("r2"),
        (F.avg(F.abs(e) / F.greatest(F.abs(F.col(y)), F.lit(2.220446049250313e-16))) * 100).alias("mape")).drop("__all")


def prediction_errors(pred: DataFrame, y: str = "y", yhat: str = "prediction") -> DataFrame:
    e = F.col(y) - F.col(yhat)
    return pred.withColumn("error", e).withColumn(
        "direction", F.when(e > 0, F.lit("under")).when(e < 0, F.lit("over")).otherwise(F.lit("exact")))


def naive_forecast(target_frame: DataFrame) -> DataFrame:
    """Persistence baseline: predict close(t+1) = close(t)."""
    return target_frame.withColumn("prediction", F.col("close"))


def save_and_reload(model: PipelineModel | object, path: str):
    """Persist a fitted model/pipeline and load it back."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path) if isinstance(model, PipelineModel) else type(model).load(path)


def fit_or_load(est, train: DataFrame, path: str) -> PipelineModel:
    """The model saved at ``path`` if there is one, else a new fit saved there."""
    spark = train.sparkSession
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):
        pipeline(est).fit(train).write().save(path)
    return PipelineModel.load(path)


def linear_conditions(model, train: DataFrame, l2: float = 0.0, l1: float = 0.0) -> float:
    """How far a linear fit is from its optimality conditions, relative to the data's scale (0: exact).

    With residuals r and weights w: x'r = l2 * w for ridge (0 for OLS), and
    |x'r| / n <= l1, with equality in the sign of w where w is not 0, for lasso.
    """
    from pyspark.ml.functions import vector_to_array
    r = F.col("y") - F.col("prediction")
    p = model.transform(train).select(r.alias("r"), F.posexplode(vector_to_array("features")).alias("j", "x"))
    g = p.groupBy("j").agg(F.sum(F.col("r") * F.col("x")).alias("g"), F.sum(F.col("x") * F.col("x")).alias("xx"),
                           F.sum(F.col("r") * F.col("r")).alias("rr"), F.count(F.lit(1)).alias("n")).collect()
    worst = 0.0
    for row in g:                                        # one row per feature
        w = float(model.coefficients[row["j"]])
        scale = max((row["xx"] * row["rr"]) ** 0.5, 1e-12)
        if l1:
            gap = abs(row["g"] - row["n"] * l1 * (1 if w > 0 else -1)) if w else max(0.0, abs(row["g"]) - row["n"] * l1)
        else:
            gap = abs(row["g"] - l2 * w)
        worst = max(worst, gap / scale)
    return worst


def pipeline(est) -> Pipeline:
    return Pipeline(stages=[est])
