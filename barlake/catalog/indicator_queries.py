"""Catalog: batch indicator windows (each step alone and the whole pipeline)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import indicators as ind
from ..plans.chunked import chunked_window
from ..sources.adapters import event_candles
from .base import WITH_UNIFIED, r, round_doubles, unified
from .registry import query


def _steps(spark, sf_dir, lookback, steps, cols):
    c = ind.clean_batch(event_candles(spark, sf_dir))

    def compute(df, part):
        return reduce(lambda d, f: f(d, part), steps, df)

    out = chunked_window(c, ["symbol"], "timestamp", lookback, compute)
    return round_doubles(out.select("symbol", "timestamp", *cols))


def _sql(cte: str, cols: list[str]) -> str:
    return f"{WITH_UNIFIED} SELECT symbol, timestamp, {', '.join(r(c) for c in cols)} FROM {cte}"


def _ma(period, name):
    return lambda d, p: ind.moving_average(d, p, period, name)


@query("price_change", _sql("points", ["price_change"]))
def q_price_change(spark, sf_dir):
    return _steps(spark, sf_dir, 1, [ind.price_change], ["price_change"])


@query("gain_loss", _sql("points", ["gain", "loss"]))
def q_gain_loss(spark, sf_dir):
    return _steps(spark, sf_dir, 1, [ind.price_change, ind.gain_loss], ["gain", "loss"])


@query("avg_gain_loss_14", _sql("points", ["avg_gain", "avg_loss"]))
def q_avg_gain_loss(spark, sf_dir):
    return _steps(spark, sf_dir, 14, [ind.price_change, ind.gain_loss, ind.avg_gain_loss],
                  ["avg_gain", "avg_loss"])


@query("rsi_14", _sql("points", ["rsi_14"]))
def q_rsi(spark, sf_dir):
    return _steps(spark, sf_dir, 14, [ind.rsi_steps], ["rsi_14"])


@query("sma_20", _sql("points", ["sma_20"]))
def q_sma(spark, sf_dir):
    return _steps(spark, sf_dir, 19, [_ma(20, "sma_20")], ["sma_20"])


@query("ema_50", _sql("points", ["ema_50"]))
def q_ema50(spark, sf_dir):
    return _steps(spark, sf_dir, 49, [_ma(50, "ema_50")], ["ema_50"])


@query("ema_12_26", _sql("points", ["ema_12", "ema_26"]))
def q_ema_12_26(spark, sf_dir):
    return _steps(spark, sf_dir, 25, [_ma(12, "ema_12"), _ma(26, "ema_26")], ["ema_12", "ema_26"])


@query("bollinger", _sql("unified", ["bb_upper", "bb_middle", "bb_lower"]))
def q_bollinger(spark, sf_dir):
    return _steps(spark, sf_dir, 19, [ind.bollinger], ["bb_upper", "bb_middle", "bb_lower"])


@query("macd", _sql("points", ["macd"]))
def q_macd(spark, sf_dir):
    return _steps(spark, sf_dir, 25, [ind.macd], ["macd"])


@query("macd_signal", _sql("points", ["macd", "macd_signal"]))
def q_macd_signal(spark, sf_dir):
    return _steps(spark, sf_dir, 33, [ind.macd, ind.macd_signal], ["macd", "macd_signal"])


_UNIFIED_OUT = [c for c in ind.UNIFIED_COLS if c != "ingestion_timestamp"]
_DOUBLES = {"open", "high", "low", "close", "volume", *ind.INDICATOR_COLS}


@query("indicators_batch",
       f"{WITH_UNIFIED} SELECT " + ", ".join(r(c) if c in _DOUBLES else c for c in _UNIFIED_OUT) + " FROM unified")
def q_indicators_batch(spark, sf_dir):
    return round_doubles(unified(spark, sf_dir))
