"""Results of all models, kept in a table that grows piece by piece.

The table lives in a folder named by a digest of the code that fits, its
parameters and the input's content.  Each piece (linear models of all symbols;
a forest fold, the forests or one boosting run of a symbol) is written once.
A run that stops resumes with the pieces that are missing, and changed code,
parameters or data never read old ones.
"""

from __future__ import annotations

import hashlib
import inspect
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import features, forest, gram, ml

CONFIGS = ["default", "tuned"]
RESULT = """symbol string, model string, config string, setting string, n_train long, n_test long, mae double, rmse double, r2 double, mape double,
 train_mse double, low double, high double"""
SCORE = "symbol string, model string, setting string, place int, fold int, mse double"


def digest(*parts) -> str:
    """Short name of the code that fits models and of ``parts`` (parameters, content of the input)."""
    code = [inspect.getsource(m) for m in (features, forest, gram, ml)] + [inspect.getsource(Results)]
    return hashlib.sha256("\0".join([*code, *map(str, parts)]).encode()).hexdigest()[:16]


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


class Results:
    """Pieces below ``path`` for the model input ``data`` (symbol, split, timestamp, close, y, features)."""

    def __init__(self, data: DataFrame, symbols: list[str], path: str):
        self.spark, self.path, self.data = data.sparkSession, path, data
        found = {r["symbol"] for r in data.where("split = 'train'").select("symbol").distinct().where(F.col("symbol").isin(symbols)).collect()}
        self.symbols = [s for s in symbols if s in found]

    def _piece(self, name: str, build) -> DataFrame:
        path = f"{self.path}/{name}"
        if not _exists(self.spark, f"{path}/_SUCCESS"):
            build().write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def _together(self, jobs: list, light: int = 0) -> list:
        """Chains of small jobs leave executors idle on their own; the first ``light`` jobs use little of a core, and three quarters of the cores go to others beside them."""
        cores = self.spark.sparkContext.defaultParallelism
        with ThreadPoolExecutor(max(1, min(len(jobs), max(cores, light + 3 * cores // 4)))) as pool:
            return list(pool.map(lambda job: job(), jobs))

    def folds(self) -> DataFrame:
        """Train rows with their time fold."""
        return self._piece("folds", lambda: ml.with_time_folds(self.data.where("split = 'train'")))

    def _train(self, symbol: str, without: int | None = None) -> DataFrame:
        rows = self.folds().where(F.col("symbol") == symbol)
        rows = rows if without is None else rows.where(F.col("fold") != without)
        return rows.coalesce(max(1, -(-rows.count() // ml.ROWS_PER_TRAIN_PARTITION)))

    def _metrics(self, test: DataFrame, train: DataFrame) -> DataFrame:
        """Columns of ``RESULT`` from predictions (symbol, model, config, setting, y, prediction) of test and train rows."""
        keys = ["symbol", "model", "config", "setting"]
        e = F.col("y") - F.col("prediction")
        fit = train.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_train"), F.avg(e * e).alias("train_mse"))
        seen = test.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_test"), F.min("prediction").alias("low"), F.max("prediction").alias("high"))
        return ml.regression_metrics(test, keys).join(seen, keys).join(fit, keys).select(*[c.split()[0] for c in RESULT.split(",")])

    # linear models: one pass for all symbols

    def fits(self) -> DataFrame:
        return self._piece("linear-fits", lambda: gram.linear_fits(self.data))

    def linear(self) -> DataFrame:
        def build() -> DataFrame:
            chosen = gram.configured(self.fits()).select("symbol", "model", "config", F.concat(F.lit("alpha="), F.col("alpha").cast("string")).alias("setting"))
            p = gram.predictions(self.data, self.fits()).join(chosen, ["symbol", "model", "config"])
            split = self.data.select("symbol", "timestamp", "split")
            p = p.join(split, ["symbol", "timestamp"])
            return self._metrics(p.where("split = 'test'"), p.where("split = 'train'"))
        return self._piece("linear", build)

    # forests: one deep forest per fold, one on all train rows

    def _forest(self, symbol: str, without: int | None) -> DataFrame:
        """Nodes of the forest."""
        path = f"{self.path}/trees-{symbol}-{'all' if without is None else without}"
        if not _exists(self.spark, f"{path}/data/_SUCCESS"):
            ml.random_forest(max(forest.RF_TREES)).fit(self._train(symbol, without)).write().overwrite().save(path)
        return forest.read_nodes(self.spark, path)

    def _fold_scores(self, symbol: str, fold: int) -> DataFrame:
        def build() -> DataFrame:
            held_out = self.folds().where((F.col("symbol") == symbol) & (F.col("fold") == fold))
            p = forest.stored_predictions(held_out, self._forest(symbol, fold), forest.GRID)
            e = [F.col("y") - F.get("predictions", i) for i in range(len(forest.GRID))]
            by = p.groupBy("symbol").agg(*[F.avg(d * d).alias(f"mse_{i}") for i, d in enumerate(e)])        # one row: settings of like trees tie to the last digit
            each = F.explode(F.array(*[F.struct(F.lit(forest.name_of(g)).alias("setting"), F.lit(i).alias("place"), F.col(f"mse_{i}").alias("mse")) for i, g in enumerate(forest.GRID)]))
            return by.select("symbol", each.alias("s")).select("symbol", F.lit("Random Forest").alias("model"), "s.setting", "s.place", F.lit(fold).alias("fold"), "s.mse")
        return self._piece(f"forest-fold-{symbol}-{fold}", build)

    def forest_scores(self) -> DataFrame:
        self.folds()
        parts = self._together([lambda s=s, k=k: self._fold_scores(s, k) for s in self.symbols for k in range(3)])
        return reduce(DataFrame.unionByName, parts)

    def _forests(self, symbol: str, config: str) -> DataFrame:
        def build() -> DataFrame:
            pick = forest.DEFAULT_RF
            if config == "tuned":
                chosen = self.scores().where((F.col("symbol") == symbol) & (F.col("model") == "Random Forest") & F.col("chosen")).first()["setting"]
                pick = next(g for g in forest.GRID if forest.name_of(g) == chosen)
            trees = self._forest(symbol, None)
            rows = self.data.where(F.col("symbol") == symbol)
            p = [forest.stored_predictions(rows.where(F.col("split") == s), trees, [pick]).select(
                "symbol", F.lit("Random Forest").alias("model"), F.lit(config).alias("config"), F.lit(forest.name_of(pick)).alias("setting"), "y", F.get("predictions", 0).alias("prediction"))
                for s in ("test", "train")]
            return self._metrics(*p)
        return self._piece(f"forest-{symbol}-{config}", build)

    # boosting

    def _boosted(self, symbol: str, config: str) -> GBTRegressionModel:
        path = f"{self.path}/boosting-model-{symbol}-{config}"
        if not _exists(self.spark, f"{path}/data/_SUCCESS"):
            train = self._train(symbol).cache()
            ml.gradient_boosting(config == "tuned").fit(train).write().overwrite().save(path)
            train.unpersist()
        return GBTRegressionModel.load(path)

    def _boosting(self, symbol: str, config: str) -> DataFrame:
        def build() -> DataFrame:
            model = self._boosted(symbol, config)
            p = model.transform(self.data.where(F.col("symbol") == symbol)).withColumns(
                {"model": F.lit("Gradient Boosting"), "config": F.lit(config), "setting": F.lit(f"rounds={len(model.trees)}")})
            return self._metrics(p.where("split = 'test'"), p.where("split = 'train'"))
        return self._piece(f"boosting-{symbol}-{config}", build)

    def boosting_rounds(self, config: str = "tuned") -> DataFrame:
        """(symbol, config, round, train_mse): the error falls as rounds are added."""
        def one(symbol: str) -> DataFrame:
            def build() -> DataFrame:
                errors = self._boosted(symbol, config).evaluateEachIteration(self._train(symbol), "squared")
                return self.spark.createDataFrame([(symbol, config, i + 1, float(e)) for i, e in enumerate(errors)], "symbol string, config string, round int, train_mse double")
            return self._piece(f"boosting-rounds-{symbol}-{config}", build)
        self.folds()
        return reduce(DataFrame.unionByName, self._together([lambda s=s: one(s) for s in self.symbols]))

    # tables

    def scores(self, families: tuple[str, ...] = ("Ridge", "Lasso", "Random Forest")) -> DataFrame:
        """Grid search: fold errors and their mean for every (symbol, model, setting), and the choice (ties: first of the grid)."""
        from pyspark.sql import Window
        alphas = {"Ridge": gram.RIDGE_GRID, "Lasso": gram.LASSO_GRID}
        place = F.coalesce(*[F.when((F.col("model") == m) & (F.col("alpha") == a), F.lit(i)) for m, grid in alphas.items() for i, a in enumerate(grid)])
        lin = self.fits().where(F.col("model").isin(list(alphas)) & F.col("symbol").isin(self.symbols)).select(
            "symbol", "model", F.concat(F.lit("alpha="), F.col("alpha").cast("string")).alias("setting"), place.alias("place"), F.posexplode("fold_mse").alias("fold", "mse"))
        rows = lin.where(F.col("model").isin(list(families)))
        if "Random Forest" in families:
            rows = rows.unionByName(self.forest_scores())
        by = rows.groupBy("symbol", "model", "setting", "place").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("fold", "mse"))), lambda x: x["mse"]).alias("fold_mse"), F.avg("mse").alias("cv_mse"))
        first = F.row_number().over(Window.partitionBy("symbol", "model").orderBy("cv_mse", "place"))
        return by.withColumn("chosen", first == 1)

    def table(self, models: list[str] | None = None, configs: list[str] = CONFIGS) -> DataFrame:
        """Rows of ``RESULT`` for the models and configurations asked for; missing pieces are fitted at the same time."""
        models = models or ml.MODEL_NAMES
        self.folds()
        jobs = []
        if "Gradient Boosting" in models:                # the longest chains first
            jobs += [lambda s=s, c=c: self._boosting(s, c) for c in sorted(configs, reverse=True) for s in self.symbols]
        light = len(jobs)
        if "Random Forest" in models:                    # the forests of most rows first
            jobs += [lambda s=s: self._forests(s, "default") for s in self.symbols if "default" in configs]
            if "tuned" in configs:
                jobs += [lambda s=s, k=k: self._fold_scores(s, k).limit(0) for s in self.symbols for k in range(3)]
        if set(models) & {"Linear Regression", "Ridge", "Lasso"}:
            jobs.append(self.linear)
        parts = [p for p in self._together(jobs, light) if "n_test" in p.columns]
        if "Random Forest" in models and "tuned" in configs:
            parts += self._together([lambda s=s: self._forests(s, "tuned") for s in self.symbols])
        out = reduce(DataFrame.unionByName, parts)
        return out.where(F.col("model").isin(models) & F.col("config").isin(configs) & F.col("symbol").isin(self.symbols))


def results(data: DataFrame, symbols: list[str], content: str) -> Results:
    """The results table of a model input whose content is named by ``content``."""
    spark = data.sparkSession
    return Results(data, symbols, scratch_path(spark, f"tables/model-results-{digest(content, symbols, ml.SEED, forest.GRID)}"))
