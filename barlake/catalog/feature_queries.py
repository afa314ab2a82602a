"""Catalog: ML feature building (section 2.7, model-input part)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import features as FT
from ..sources.files import new_table_path
from .base import WITH_CORE, core, r, round_doubles
from .registry import query

TWO_PI = f"CAST({2 * math.pi!r} AS DOUBLE)"
P = "PARTITION BY symbol, split ORDER BY timestamp"
BASE = ", ".join(FT.BASE_COLS)

_LAGS = ", ".join([f"lag(close, {i}) OVER ({P}) AS close_lag_{i}" for i in range(1, 13)]
                  + [f"lag(volume, {i}) OVER ({P}) AS volume_lag_{i}" for i in range(1, 4)])


def _full(agg: str, n: int) -> str:
    f = f"OVER ({P} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count(close) {f} = {n} THEN {agg}(close) {f} END"


FEATURE_SQL = f"""{WITH_CORE},
  cal AS (SELECT {BASE}, hour(timestamp) AS hour, isodow(timestamp) - 1 AS day_of_week,
    day(timestamp) AS day_of_month, month(timestamp) AS month FROM core),
  cal2 AS (SELECT *, sin({TWO_PI} * hour / 24) AS hour_sin, cos({TWO_PI} * hour / 24) AS hour_cos,
    sin({TWO_PI} * day_of_week / 7) AS day_sin, cos({TWO_PI} * day_of_week / 7) AS day_cos FROM cal),
  idx AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp) - 1 AS i,
    count(*) OVER (PARTITION BY symbol) AS n FROM cal2),
  spl AS (SELECT * EXCLUDE (i, n), CASE WHEN i < floor(n * CAST(0.7 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM idx),
  eng AS (SELECT *, {_LAGS},
    {_full('avg', 5)} AS close_rolling_mean_5, {_full('avg', 20)} AS close_rolling_mean_20,
    {_full('stddev_samp', 20)} AS close_rolling_std_20,
    close - lag(close) OVER ({P}) AS price_change, (close / lag(close) OVER ({P}) - 1) * 100 AS price_change_pct,
    volume - lag(volume) OVER ({P}) AS volume_change, high - low AS hl_spread, (high - low) / close * 100 AS hl_spread_pct
    FROM spl),
  frame AS (SELECT * FROM eng WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FT.BASE_COLS + FT.CALENDAR_COLS + FT.ENGINEERED)})"""

_INT_COLS = {"trades", "hour", "day_of_week", "day_of_month", "month"}


def _sel(cols):
    return ", ".join(c if c in _INT_COLS or c in ("symbol", "timestamp", "split") else r(c) for c in cols)


def _frame(spark, sf):
    return FT.feature_frame(core(spark, sf))


@query("calendar_features", f"{FEATURE_SQL} SELECT symbol, timestamp, {_sel(FT.CALENDAR_COLS)} FROM cal2")
def q_calendar(spark, sf):
    return round_doubles(FT.calendar_features(core(spark, sf)).select("symbol", "timestamp", *FT.CALENDAR_COLS))


@query("temporal_split_70_30", f"{FEATURE_SQL} SELECT symbol, timestamp, split FROM spl")
def q_split(spark, sf):
    return FT.temporal_split(core(spark, sf).select("symbol", "timestamp", "close")).select("symbol", "timestamp", "split")


def _eng(spark, sf):
    x = FT.calendar_features(core(spark, sf).select(*FT.BASE_COLS))
    return FT.engineered_in_split(FT.temporal_split(x))


for _key, _cols in [("lag_features", FT.LAG_COLS), ("rolling_features", FT.ROLLING_COLS),
                    ("diff_features", FT.DIFF_COLS), ("spread_features", FT.SPREAD_COLS)]:
    def _mk(cols=_cols):
        def fn(spark, sf):
            return round_doubles(_eng(spark, sf).select("symbol", "split", "timestamp", *cols))
        return fn
    query(_key, f"{FEATURE_SQL} SELECT symbol, split, timestamp, {_sel(_cols)} FROM eng")(_mk())

_FRAME_COLS = FT.BASE_COLS + FT.CALENDAR_COLS + ["split"] + FT.ENGINEERED


@query("feature_frame", f"{FEATURE_SQL} SELECT {_sel(_FRAME_COLS)} FROM frame")
def q_frame(spark, sf):
    return round_doubles(_frame(spark, sf).select(*_FRAME_COLS))


TARGET_SQL = f"""{FEATURE_SQL}, tgt AS (SELECT * FROM (SELECT *, lead(close) OVER ({P}) AS y FROM frame) WHERE y IS NOT NULL)"""


@query("next_close_target", f"{TARGET_SQL} SELECT symbol, split, timestamp, {r('close')}, {r('y')} FROM tgt")
def q_target(spark, sf):
    return round_doubles(FT.next_close_target(_frame(spark, sf)).select("symbol", "split", "timestamp", "close", "y"))


def _scale_sql(src: str, cols: list[str]) -> str:
    stats = ", ".join(f"avg({c}) AS {c}__mu, stddev_pop({c}) AS {c}__sd" for c in cols)
    scaled = ", ".join(r(f"({c} - {c}__mu) / CASE WHEN {c}__sd = 0 THEN 1 ELSE {c}__sd END", c) for c in cols)
    return (f"st AS (SELECT symbol, {stats} FROM {src} WHERE split = 'train' GROUP BY symbol), "
            f"scaled AS (SELECT {src}.symbol, split, timestamp, {scaled} FROM {src} JOIN st USING (symbol))")


@query("standard_scale", f"{TARGET_SQL}, {_scale_sql('tgt', FT.FEATURE_COLS)} SELECT * FROM scaled")
def q_scale(spark, sf):
    t = FT.next_close_target(_frame(spark, sf))
    return round_doubles(FT.standard_scale(t).select("symbol", "split", "timestamp", *FT.FEATURE_COLS))


@query("save_load_scaler", f"{TARGET_SQL}, {_scale_sql('tgt', FT.FEATURE_COLS)} SELECT * FROM scaled")
def q_saved_scaler(spark, sf):
    """The train split's scaler is saved once, then found, loaded and applied; another fit would differ."""
    t, path = FT.next_close_target(_frame(spark, sf)), new_table_path(spark, "scaler")
    FT.fit_or_load_scaler(t.where(F.col("split") == "train"), FT.FEATURE_COLS, path)
    back = FT.fit_or_load_scaler(t.where(F.col("split") == "test"), FT.FEATURE_COLS, path)      # present: not fitted again
    return round_doubles(FT.apply_scaler(t, back, FT.FEATURE_COLS).select("symbol", "split", "timestamp", *FT.FEATURE_COLS))


_SEQ_COLS = ["close"] + [c for c in _FRAME_COLS if c not in ("timestamp", "symbol", "split", "close")]
_SEQ_STATS = ", ".join(f"avg({c}) AS {c}__mu, stddev_pop({c}) AS {c}__sd" for c in _SEQ_COLS)
_SEQ_SCALED = ", ".join(f"({c} - {c}__mu) / CASE WHEN {c}__sd = 0 THEN 1 ELSE {c}__sd END AS {c}" for c in _SEQ_COLS)
SEQ_SQL = f"""{FEATURE_SQL},
  st AS (SELECT symbol, {_SEQ_STATS} FROM frame WHERE split = 'train' GROUP BY symbol),
  sc AS (SELECT frame.symbol, split, timestamp, {_SEQ_SCALED} FROM frame JOIN st USING (symbol)),
  sq AS (SELECT symbol, split, timestamp, close AS y_scaled,
    list([{', '.join(_SEQ_COLS)}]) OVER w AS seq, count(*) OVER w AS cnt FROM sc
    WINDOW w AS ({P} ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING))
  SELECT symbol, split, timestamp, {r('y_scaled')},
    list_transform(seq, lambda v: list_transform(v, lambda x: round(x, 8) + 0.0)) AS seq FROM sq WHERE cnt = 60"""


@query("sequences_60", SEQ_SQL)
def q_sequences(spark, sf):
    s = FT.sequences(_frame(spark, sf), 60)
    s = s.withColumn("seq", F.transform("seq", lambda v: F.transform(v, lambda x: F.round(x, 8))))
    return round_doubles(s)
