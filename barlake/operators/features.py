"""Leak-free feature building for next-bar regression.

Order of operations (per symbol): calendar features -> temporal 70/30 split
by row position -> lag / rolling / diff / spread features computed *inside
each split* (windows partitioned by (symbol, split), so no value crosses the
cut) -> drop rows with any NULL -> target = next row's close inside the split
(last row dropped) -> standard scaling fitted on the train split only
(population sigma; zero sigma scales by 1).

All per-series windows run through the chunked plans; the target uses a
row-index self join instead of ``lead`` so it stays chunk-parallel too.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import full_window, rows, series_window
from ..plans.chunked import chunked_window, global_row_index
from ..plans.joins import checked_broadcast

BASE_COLS = ["timestamp", "symbol", "open", "high", "low", "close", "volume", "trades", "sma_20", "ema_50", "rsi_14",
             "macd", "macd_signal", "bb_upper", "bb_middle", "bb_lower"]
CALENDAR_COLS = ["hour", "day_of_week", "day_of_month", "month", "hour_sin", "hour_cos", "day_sin", "day_cos"]
LAG_COLS = [f"close_lag_{i}" for i in range(1, 13)] + [f"volume_lag_{i}" for i in range(1, 4)]
ROLLING_COLS = ["close_rolling_mean_5", "close_rolling_mean_20", "close_rolling_std_20"]
DIFF_COLS = ["price_change", "price_change_pct", "volume_change"]
SPREAD_COLS = ["hl_spread", "hl_spread_pct"]
ENGINEERED = LAG_COLS + ROLLING_COLS + DIFF_COLS + SPREAD_COLS
FEATURE_COLS = [c for c in BASE_COLS if c not in ("timestamp", "symbol", "close")] + CALENDAR_COLS + ENGINEERED
FEATURE_LOOKBACK = 19
TRAIN_RATIO = 0.7


def calendar_features(df: DataFrame) -> DataFrame:
    t = F.col("timestamp")
    two_pi = 2 * math.pi
    x = (df.withColumn("hour", F.hour(t).cast("bigint"))
         .withColumn("day_of_week", F.weekday(t).cast("bigint"))
         .withColumn("day_of_month", F.dayofmonth(t).cast("bigint"))
         .withColumn("month", F.month(t).cast("bigint")))
    return (x.withColumn("hour_sin", F.sin(F.lit(two_pi) * F.col("hour") / 24))
            .withColumn("hour_cos", F.cos(F.lit(two_pi) * F.col("hour") / 24))
            .withColumn("day_sin", F.sin(F.lit(two_pi) * F.col("day_of_week") / 7))
            .withColumn("day_cos", F.cos(F.lit(two_pi) * F.col("day_of_week") / 7)))


def temporal_split(df: DataFrame, ratio: float = TRAIN_RATIO) -> DataFrame:
    """First ``int(n * ratio)`` rows of each symbol are ``train``, the rest ``test``."""
    x = global_row_index(df, ["symbol"], "timestamp", "__i", with_count="__n")
    cut = F.floor(F.col("__n") * F.lit(ratio))
    return x.withColumn("split", F.when(F.col("__i") < cut, F.lit("train")).otherwise(F.lit("test"))).drop("__i", "__n")


def lag_features(df: DataFrame, part: list[str]) -> DataFrame:
    w = series_window(part)
    for i in range(1, 13):
        df = df.withColumn(f"close_lag_{i}", F.lag("close", i).over(w))
    for i in range(1, 4):
        df = df.withColumn(f"volume_lag_{i}", F.lag("volume", i).over(w))
    return df


def rolling_features(df: DataFrame, part: list[str]) -> DataFrame:
    w = series_window(part)
    return (df.withColumn("close_rolling_mean_5", full_window(F.avg("close"), "close", w, 5))
            .withColumn("close_rolling_mean_20", full_window(F.avg("close"), "close", w, 20))
            .withColumn("close_rolling_std_20", full_window(F.stddev_samp("close"), "close", w, 20)))


def diff_features(df: DataFrame, part: list[str]) -> DataFrame:
    w = series_window(part)
    prev_c, prev_v = F.lag("close").over(w), F.lag("volume").over(w)
    return (df.withColumn("price_change", F.col("close") - prev_c)
            .withColumn("price_change_pct", (F.try_divide(F.col("close"), prev_c) - 1) * 100)
            .withColumn("volume_change", F.col("volume") - prev_v))


def spread_features(df: DataFrame) -> DataFrame:
    return (df.withColumn("hl_spread", F.col("high") - F.col("low"))
            .withColumn("hl_spread_pct", (F.col("high") - F.col("low")) / F.col("close") * 100))


def _engineered(df: DataFrame, part: list[str]) -> DataFrame:
    return spread_features(diff_features(rolling_features(lag_features(df, part), part), part))


def engineered_in_split(split_df: DataFrame) -> DataFrame:
    """Lag/rolling/diff/spread features per (symbol, split) — nothing crosses the cut."""
    return chunked_window(split_df, ["symbol", "split"], "timestamp", FEATURE_LOOKBACK, _engineered)


def feature_frame(unified: DataFrame, ratio: float = TRAIN_RATIO) -> DataFrame:
    """Unified rows -> split-tagged feature rows without NULLs."""
    x = calendar_features(unified.select(*BASE_COLS))
    x = engineered_in_split(temporal_split(x, ratio))
    return x.dropna(how="any", subset=[c for c in x.columns])


def next_close_target(frame: DataFrame) -> DataFrame:
    """y = close of the next row inside (symbol, split); the last row of each split is dropped.

    Chunks carry rows from before their start; on mirrored time the next row is
    the one before, so the target is a lag and the frame is not joined to itself.
    """
    def target(df: DataFrame, part: list[str]) -> DataFrame:
        w = series_window(part, "__mirror")
        return df.withColumn("y", F.lag("close").over(w)).withColumn("__next", F.lag("timestamp").over(w).isNotNull())

    mirrored = frame.withColumn("__mirror", F.timestamp_micros(-F.unix_micros(F.col("timestamp").cast("timestamp"))))
    out = chunked_window(mirrored, ["symbol", "split"], "__mirror", 1, target)
    return out.where("__next").drop("__mirror", "__next")


def fit_scaler(train: DataFrame, cols: list[str], keys=("symbol",)) -> DataFrame:
    """Per-key mean and population sigma of each column on the train split (sigma 0 -> 1)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mu"), F.stddev_pop(c).alias(f"{c}__sd")]
    return train.groupBy(*keys).agg(*aggs)


def apply_scaler(df: DataFrame, stats: DataFrame, cols: list[str], keys=("symbol",), suffix: str = "") -> DataFrame:
    x = df.join(checked_broadcast(stats), list(keys), "inner")
    for c in cols:
        sd = F.col(f"{c}__sd")
        x = x.withColumn(c + suffix, (F.col(c) - F.col(f"{c}__mu")) / F.when(sd == 0, F.lit(1.0)).otherwise(sd))
    return x.drop(*[f"{c}__{s}" for c in cols for s in ("mu", "sd")])


def fit_or_load_scaler(train: DataFrame, cols: list[str], path: str, keys=("symbol",)) -> DataFrame:
    """The scaler saved at ``path`` if there is one, else a new fit saved there: live rows are scaled as the model's train rows were."""
    from ..sources.files import overwrite_table, table_there
    if not table_there(train.sparkSession, path):
        overwrite_table(fit_scaler(train, cols, keys), path)
    return train.sparkSession.read.parquet(path)


def standard_scale(frame: DataFrame, cols: list[str] = FEATURE_COLS) -> DataFrame:
    stats = fit_scaler(frame.where(F.col("split") == "train"), cols)
    return apply_scaler(frame, stats, cols)


def sequences(frame: DataFrame, n_steps: int = 60) -> DataFrame:
    """For row i >= n_steps of each split: the previous n_steps scaled vectors and scaled close(i)."""
    seq_cols = [c for c in frame.columns if c not in ("timestamp", "symbol", "split")]
    seq_cols = ["close"] + [c for c in seq_cols if c != "close"]
    scaled = apply_scaler(frame, fit_scaler(frame.where(F.col("split") == "train"), seq_cols), seq_cols)

    def comp(d, part):
        w = series_window(part)
        return (d.withColumn("seq", F.collect_list(F.array(*[F.col(c) for c in seq_cols])).over(rows(w, n_steps, -1)))
                .withColumn("__cnt", F.count(F.lit(1)).over(rows(w, n_steps, -1))))
    out = chunked_window(scaled.select("symbol", "split", "timestamp", *seq_cols), ["symbol", "split"], "timestamp",
                         n_steps, comp)
    return out.where(F.col("__cnt") == n_steps).select("symbol", "split", "timestamp", "seq",
                                                       F.col("close").alias("y_scaled"))
