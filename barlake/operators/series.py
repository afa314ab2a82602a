"""Per-series analytics on candle / unified rows (returns, risk, rolling stats).

Per-series windows go through the chunked plans (bounded frames with halo
rows, unbounded prefixes through chunk summaries) so one heavy symbol never
lands in a single task.  Rolling statistics follow pandas ``rolling(n)``:
NULL until the frame holds ``n`` valid values.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import (REGIME_Q_HIGH, REGIME_Q_LOW, REGIMES, RSI_OVERBOUGHT, RSI_OVERSOLD,
                               full_window, rows, series_window)
from ..plans.chunked import ChunkLayout, chunked_running, chunked_window, plan_chunks
from ..plans.joins import checked_broadcast
from ..plans.quantiles import exact_quantiles

KEYS = ["symbol"]
TS = "timestamp"


def _ret(value: str, part, scale: float | None):
    r = F.try_divide(F.col(value), F.lag(value).over(series_window(part, TS))) - F.lit(1.0)
    return r * F.lit(scale) if scale is not None else r


def with_returns(df: DataFrame, name: str = "ret_pct", value: str = "close", scale: float | None = 100.0,
                 layout: ChunkLayout | None = None) -> DataFrame:
    """``pct_change`` (x 100 by default) per symbol; first row NULL."""
    return chunked_window(df, KEYS, TS, 1, lambda d, p: d.withColumn(name, _ret(value, p, scale)), layout=layout)


def normalized_base100(df: DataFrame, layout: ChunkLayout | None = None) -> DataFrame:
    x = chunked_running(df, KEYS, TS, "close", "first", "__first", layout=layout)
    return x.withColumn("base100", F.col("close") / F.col("__first") * 100).drop("__first")


def cumulative_return(df: DataFrame, layout: ChunkLayout | None = None) -> DataFrame:
    """``cumprod(1 + r) - 1`` in % (telescopes to close / first close - 1)."""
    x = chunked_running(df, KEYS, TS, "close", "first", "__first", layout=layout)
    return x.withColumn("cum_return_pct", (F.col("close") / F.col("__first") - 1) * 100).drop("__first")


def drawdown(df: DataFrame, layout: ChunkLayout | None = None) -> DataFrame:
    """close / running max - 1, in %."""
    x = chunked_running(df, KEYS, TS, "close", "max", "cummax", layout=layout)
    return x.withColumn("drawdown_pct", (F.col("close") / F.col("cummax") - 1) * 100)


def rolling_volatility(df: DataFrame, n: int = 20, layout: ChunkLayout | None = None) -> DataFrame:
    """std of the last n returns (fraction) x sqrt(n) x 100."""
    def comp(d, p):
        w = series_window(p, TS)
        d = d.withColumn("ret", _ret("close", p, None))
        return d.withColumn("rolling_vol", full_window(F.stddev_samp("ret"), "ret", w, n) * math.sqrt(n) * 100)
    return chunked_window(df, KEYS, TS, n, comp, layout=layout)


def rolling_return_std(df: DataFrame, n: int = 20, layout: ChunkLayout | None = None) -> DataFrame:
    """Returns in % and their rolling std over n (regime input); rows without it dropped."""
    def comp(d, p):
        w = series_window(p, TS)
        d = d.withColumn("ret_pct", _ret("close", p, 100.0))
        return d.withColumn("rolling_vol", full_window(F.stddev_samp("ret_pct"), "ret_pct", w, n))
    return chunked_window(df, KEYS, TS, n, comp, layout=layout).where(F.col("rolling_vol").isNotNull())


def regime_thresholds(vol: DataFrame, group_rows_bound: int | None = None) -> DataFrame:
    return exact_quantiles(vol, KEYS, "rolling_vol", {"q33": REGIME_Q_LOW, "q66": REGIME_Q_HIGH},
                           group_rows_bound=group_rows_bound)


def volatility_regime(df: DataFrame, n: int = 20, layout: ChunkLayout | None = None) -> DataFrame:
    """Label each row Faible / Moyenne / Elevee by right-closed cuts at q33, q66."""
    layout = layout or plan_chunks(df, KEYS, TS)
    vol = rolling_return_std(df, n, layout)
    th = regime_thresholds(vol, group_rows_bound=layout.max_rows)
    v = F.col("rolling_vol")
    lab = (F.when(v <= F.col("q33"), F.lit(REGIMES[0])).when(v <= F.col("q66"), F.lit(REGIMES[1]))
           .otherwise(F.lit(REGIMES[2])))
    return vol.join(checked_broadcast(th), KEYS, "inner").withColumn("regime", lab)


def rolling_price_volume_corr(df: DataFrame, n: int = 30, threshold: float = -0.3,
                              layout: ChunkLayout | None = None) -> DataFrame:
    """Rolling Pearson of close and volume pct changes; divergence when < threshold."""
    def comp(d, p):
        w = series_window(p, TS)
        d = d.withColumn("price_change", _ret("close", p, None)).withColumn("volume_change", _ret("volume", p, None))
        both = F.col("price_change").isNotNull() & F.col("volume_change").isNotNull()
        x, y = F.when(both, F.col("price_change")), F.when(both, F.col("volume_change"))
        fw = rows(w, n - 1)
        c = F.try_divide(F.covar_pop(x, y).over(fw), F.stddev_pop(x).over(fw) * F.stddev_pop(y).over(fw))
        return d.withColumn("pv_corr", F.when(F.count(x).over(fw) == n, c))
    out = chunked_window(df, KEYS, TS, n, comp, layout=layout)
    return out.withColumn("divergence", F.coalesce(F.col("pv_corr") < threshold, F.lit(False)))


def rolling_beta(df: DataFrame, benchmark: str = "BTCUSDT", n: int = 50) -> DataFrame:
    """cov(asset, benchmark) / var(benchmark) over the last n aligned returns."""
    r = with_returns(df.select("symbol", TS, "close"), "ret", scale=None).where(F.col("ret").isNotNull())
    bench = r.where(F.col("symbol") == benchmark).select(TS, F.col("ret").alias("bench_ret"))
    assets = r.where(F.col("symbol") != benchmark)
    aligned = assets.join(bench, TS, "inner")

    def comp(d, p):
        fw = rows(series_window(p, TS), n - 1)
        b = F.try_divide(F.covar_samp("ret", "bench_ret").over(fw), F.var_samp("bench_ret").over(fw))
        return d.withColumn("beta", F.when(F.count(F.lit(1)).over(fw) == n, b))
    return chunked_window(aligned, KEYS, TS, n - 1, comp)


def bollinger_width(df: DataFrame) -> DataFrame:
    return df.withColumn("bb_width", (F.col("bb_upper") - F.col("bb_lower")) / F.col("bb_middle") * 100)


def bollinger_squeeze(df: DataFrame, q: float = 0.10) -> DataFrame:
    """Rows whose band width is below the symbol's q-quantile of widths."""
    x = bollinger_width(df)
    th = exact_quantiles(x, KEYS, "bb_width", {"q10": q})
    return x.join(checked_broadcast(th), KEYS, "inner").where(F.col("bb_width") < F.col("q10"))


def rolling_trade_size(df: DataFrame, n: int = 50, layout: ChunkLayout | None = None) -> DataFrame:
    def comp(d, p):
        w = series_window(p, TS)
        d = d.withColumn("avg_trade_size", F.try_divide(F.col("volume"), F.col("trades").cast("double")))
        return d.withColumn("rolling_trade_size", full_window(F.avg("avg_trade_size"), "avg_trade_size", w, n))
    return chunked_window(df, KEYS, TS, n - 1, comp, layout=layout)


def macd_bullish_cross(df: DataFrame, layout: ChunkLayout | None = None) -> DataFrame:
    def comp(d, p):
        w = series_window(p, TS)
        cross = (F.col("macd") > F.col("macd_signal")) & (F.lag("macd").over(w) <= F.lag("macd_signal").over(w))
        return d.withColumn("bullish_cross", F.coalesce(cross, F.lit(False)))
    return chunked_window(df, KEYS, TS, 1, comp, layout=layout)


def rsi_zone(rsi_col: str = "rsi_14"):
    r = F.col(rsi_col)
    return (F.when(r < RSI_OVERSOLD, F.lit("oversold")).when(r > RSI_OVERBOUGHT, F.lit("overbought"))
            .otherwise(F.lit("neutral")))


def macd_histogram(df: DataFrame) -> DataFrame:
    h = F.col("macd") - F.col("macd_signal")
    return df.withColumn("macd_hist", h).withColumn("hist_color", F.when(h > 0, F.lit("green")).otherwise(F.lit("red")))
