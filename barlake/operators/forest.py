"""A grid of random forests scored from one deep forest.

With all features at every split and a fixed bag, a tree limited in depth, or
in the rows a node needs to be split, is the deeper tree cut short: its inner
nodes keep the prediction they would have as leaves.  The first trees of a
forest are a smaller forest.  So one fit of the most and deepest trees per fold
scores the whole grid of tree counts, depths and split sizes, and one fit on
all train rows gives the default and any chosen forest.

Trees are MLlib's; their nodes are a table.  Rows of a stored forest are scored
on executors: blocks of rows meet packs of trees, and the packs' sums are added
in tree order, so neither the nodes nor the predictions pass the driver.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RF_TREES, RF_DEPTHS, RF_MIN_SPLIT = [100, 200], [10, 20, None], [2, 5]
DEFAULT_RF = (100, None, 2)
GRID = list(product(RF_TREES, RF_DEPTHS, RF_MIN_SPLIT))
ROWS_AT_A_TIME = 2048       # rows times trees are walked down together
TREES_AT_A_TIME = 10        # trees of a pack: a task holds their nodes
ROWS_PER_BLOCK = 100_000    # rows a pack meets in one task


class Forest:
    """Nodes of all trees as arrays: feature (-1: leaf), threshold, children, prediction, rows behind the node."""

    def __init__(self, nodes: pd.DataFrame):
        nodes = nodes.sort_values(["tree", "id"], ignore_index=True)
        tree = nodes["tree"].to_numpy()
        self.roots = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]]) if len(nodes) else np.empty(0, "i8")
        base = self.roots[np.searchsorted(self.roots, np.arange(len(nodes)), side="right") - 1] if len(nodes) else self.roots
        inner = nodes["left"].to_numpy() >= 0
        self.feature = np.where(inner, nodes["feature"].to_numpy(), -1)
        self.threshold = nodes["threshold"].fillna(0.0).to_numpy()
        self.left = np.where(inner, base + nodes["left"].to_numpy(), np.arange(len(nodes)))
        self.right = np.where(inner, base + nodes["right"].to_numpy(), np.arange(len(nodes)))
        self.prediction, self.rows = nodes["prediction"].to_numpy(), nodes["rows"].to_numpy()
        self.depth = self._deepest()

    def _deepest(self) -> int:
        level, depth = self.roots, 0
        while True:
            inner = level[self.feature[level] >= 0]
            if not len(inner):
                return depth
            level, depth = np.concatenate([self.left[inner], self.right[inner]]), depth + 1

    def scores(self, x: np.ndarray, grid: list[tuple]) -> np.ndarray:
        """Predictions (rows x grid) of every (trees, depth, least rows of a split node)."""
        return self.sums(x, grid) / np.array([g[0] for g in grid], "f8")

    def sums(self, x: np.ndarray, grid: list[tuple]) -> np.ndarray:
        """Predictions of the first trees added up (rows x grid); no trees give 0."""
        out = np.empty((len(x), len(grid)))
        for a in range(0, len(x), ROWS_AT_A_TIME):
            part = x[a:a + ROWS_AT_A_TIME]
            for least in {g[2] for g in grid}:
                at = np.tile(self.roots, (len(part), 1))
                wanted = {self.depth if g[1] is None else min(g[1], self.depth) for g in grid if g[2] == least}
                means: dict[int, np.ndarray] = {}
                for depth in range(self.depth + 1):
                    if depth in wanted:
                        means[depth] = np.cumsum(self.prediction[at], axis=1)
                    f = self.feature[at]
                    split = (f >= 0) & (self.rows[at] >= least)
                    if not split.any():
                        break
                    low = np.take_along_axis(part, np.maximum(f, 0), axis=1) <= self.threshold[at]
                    at = np.where(split, np.where(low, self.left[at], self.right[at]), at)
                final = np.cumsum(self.prediction[at], axis=1)
                for k, (trees, depth, m) in enumerate(grid):
                    if m == least:
                        d = self.depth if depth is None else min(depth, self.depth)
                        out[a:a + len(part), k] = means.get(d, final)[:, trees - 1] if trees else 0.0
        return out


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of a saved random forest."""
    n = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("id"), n["prediction"].alias("prediction"), n["rawCount"].alias("rows"), n["leftChild"].alias("left"),
        n["rightChild"].alias("right"), n["split"]["featureIndex"].alias("feature"), F.get(n["split"]["leftCategoriesOrThreshold"], 0).alias("threshold"))


def read_forest(spark: SparkSession, path: str) -> Forest:
    """A saved random forest that fits the driver."""
    return Forest(read_nodes(spark, path).toPandas())


def name_of(setting: tuple) -> str:
    trees, depth, least = setting
    return f"trees={trees},depth={'none' if depth is None else depth},min_split={least}"


def grid_predictions(data: DataFrame, forest: Forest, grid: list[tuple]) -> DataFrame:
    """(symbol, timestamp, y, setting, prediction): every row under every setting, Arrow batch by batch."""
    names = [name_of(g) for g in grid]
    rows = data.select("symbol", "timestamp", "y", vector_to_array("features").alias("x"))

    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            p = forest.scores(np.stack(pdf["x"].to_numpy()), grid)
            for k, name in enumerate(names):
                yield pd.DataFrame({"symbol": pdf["symbol"], "timestamp": pdf["timestamp"], "y": pdf["y"], "setting": name, "prediction": p[:, k]})

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    return rows.mapInPandas(run, f"symbol string, timestamp {kinds['timestamp']}, y double, setting string, prediction double")


def stored_predictions(data: DataFrame, nodes: DataFrame, grid: list[tuple]) -> DataFrame:
    """(symbol, timestamp, y, predictions) of every row: one prediction per setting of ``grid``, from the node table ``nodes``.

    A task holds a block of rows and a pack of trees.
    """
    most = max(g[0] for g in grid)
    blocks = -(-data.count() // ROWS_PER_BLOCK) or 1
    packs = -(-most // TREES_AT_A_TIME)
    kinds = {f.name: f.dataType.simpleString() for f in data.schema.fields}
    rows = data.select(F.monotonically_increasing_id().alias("row"), "symbol", "timestamp", "y", vector_to_array("features").alias("x"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1))))
    trees = nodes.where(F.col("tree") < most).withColumns({
        "pack": F.floor(F.col("tree") / TREES_AT_A_TIME).cast("int"), "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})

    def run(part: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(part):
            return part[["row", "symbol", "timestamp", "y", "pack"]].assign(sums=[])
        first = int(part["pack"].iloc[0]) * TREES_AT_A_TIME
        mine = [(min(max(t - first, 0), TREES_AT_A_TIME), depth, least) for t, depth, least in grid]
        sums = Forest(held).sums(np.stack(part["x"].to_numpy()), mine)
        return part[["row", "symbol", "timestamp", "y", "pack"]].assign(sums=list(sums))

    keys = ["block", "pack"]
    parts = rows.groupBy(*keys).cogroup(trees.groupBy(*keys)).applyInPandas(
        run, f"row long, symbol string, timestamp {kinds['timestamp']}, y double, pack int, sums array<double>")
    by = parts.groupBy("row", "symbol", "timestamp", "y").agg(F.array_sort(F.collect_list(F.struct("pack", "sums"))).alias("parts"))
    total = lambda k, t: F.aggregate("parts", F.lit(0.0), lambda s, v: s + F.get(v["sums"], k)) / F.lit(float(t))
    return by.select("symbol", "timestamp", "y", F.array(*[total(k, g[0]) for k, g in enumerate(grid)]).alias("predictions"))
