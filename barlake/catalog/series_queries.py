"""Catalog: per-series analytics of the exploration notebook (section 2.7 / 2.2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import series as S
from .base import WITH_CORE, core, r, round_doubles
from .registry import query

W = "PARTITION BY symbol ORDER BY timestamp"
RET = f"(close / lag(close) OVER ({W}) - 1)"


def _q(df, *cols):
    return round_doubles(df.select("symbol", "timestamp", *cols))


@query("returns_pct", f"{WITH_CORE} SELECT symbol, timestamp, {r(RET + ' * 100', 'ret_pct')} FROM core")
def q_returns_pct(spark, sf):
    return _q(S.with_returns(core(spark, sf)), "ret_pct")


@query("normalized_base100", f"""{WITH_CORE} SELECT symbol, timestamp,
  {r(f'close / first_value(close) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100', 'base100')}
  FROM core""")
def q_base100(spark, sf):
    return _q(S.normalized_base100(core(spark, sf)), "base100")


@query("cumulative_return", f"""{WITH_CORE} SELECT symbol, timestamp,
  {r(f'(close / first_value(close) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1) * 100', 'cum_return_pct')}
  FROM core""")
def q_cumret(spark, sf):
    return _q(S.cumulative_return(core(spark, sf)), "cum_return_pct")


@query("drawdown", f"""{WITH_CORE}, d AS (SELECT *, max(close) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cummax FROM core)
  SELECT symbol, timestamp, {r('cummax')}, {r('(close / cummax - 1) * 100', 'drawdown_pct')} FROM d""")
def q_drawdown(spark, sf):
    return _q(S.drawdown(core(spark, sf)), "cummax", "drawdown_pct")


_ROLL_VOL = f"""{WITH_CORE}, rt AS (SELECT *, {RET} AS ret FROM core)
  SELECT symbol, timestamp, {r('ret')}, {r(f'''CASE WHEN count(ret) OVER ({W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 20
     THEN stddev_samp(ret) OVER ({W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) END * sqrt(20) * 100''', 'rolling_vol')}
  FROM rt"""


@query("rolling_volatility_20", _ROLL_VOL)
def q_rolling_vol(spark, sf):
    return _q(S.rolling_volatility(core(spark, sf)), "ret", "rolling_vol")


VOL_CTE = f"""rt AS (SELECT *, {RET} * 100 AS ret_pct FROM core),
  vol AS (SELECT * FROM (SELECT *, CASE WHEN count(ret_pct) OVER ({W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) = 20
     THEN stddev_samp(ret_pct) OVER ({W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) END AS rolling_vol FROM rt)
     WHERE rolling_vol IS NOT NULL),
  th AS (SELECT symbol, quantile_cont(rolling_vol, 0.33) AS q33, quantile_cont(rolling_vol, 0.66) AS q66
         FROM vol GROUP BY symbol),
  reg AS (SELECT vol.*, q33, q66, CASE WHEN rolling_vol <= q33 THEN 'Faible' WHEN rolling_vol <= q66 THEN 'Moyenne'
          ELSE 'Elevee' END AS regime FROM vol JOIN th USING (symbol))"""


@query("volatility_regime", f"""{WITH_CORE}, {VOL_CTE}
  SELECT symbol, timestamp, {r('ret_pct')}, {r('rolling_vol')}, regime FROM reg""")
def q_vol_regime(spark, sf):
    return _q(S.volatility_regime(core(spark, sf)), "ret_pct", "rolling_vol", "regime")


_PV = f"""{WITH_CORE}, ch AS (SELECT *, close / lag(close) OVER ({W}) - 1 AS price_change,
      volume / lag(volume) OVER ({W}) - 1 AS volume_change FROM core),
  m AS (SELECT *, CASE WHEN price_change IS NOT NULL AND volume_change IS NOT NULL THEN price_change END AS x,
      CASE WHEN price_change IS NOT NULL AND volume_change IS NOT NULL THEN volume_change END AS y FROM ch),
  c AS (SELECT *, CASE WHEN count(x) OVER f = 30 THEN covar_pop(x, y) OVER f
      / nullif(stddev_pop(x) OVER f * stddev_pop(y) OVER f, 0) END AS pv_corr
      FROM m WINDOW f AS ({W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
  SELECT symbol, timestamp, {r('price_change')}, {r('volume_change')}, {r('pv_corr')},
    coalesce(pv_corr < -0.3, false) AS divergence FROM c"""


@query("rolling_price_volume_corr_30", _PV)
def q_pv_corr(spark, sf):
    return _q(S.rolling_price_volume_corr(core(spark, sf)), "price_change", "volume_change", "pv_corr", "divergence")


_BETA = f"""{WITH_CORE}, rt AS (SELECT symbol, timestamp, {RET} AS ret FROM core),
  b AS (SELECT timestamp, ret AS bench_ret FROM rt WHERE symbol = 'BTCUSDT' AND ret IS NOT NULL),
  a AS (SELECT rt.symbol, rt.timestamp, rt.ret, b.bench_ret FROM rt JOIN b USING (timestamp)
        WHERE rt.symbol <> 'BTCUSDT' AND rt.ret IS NOT NULL)
  SELECT symbol, timestamp, {r('ret')}, {r('bench_ret')}, {r('''CASE WHEN count(*) OVER f = 50 THEN
     covar_samp(ret, bench_ret) OVER f / nullif(var_samp(bench_ret) OVER f, 0) END''', 'beta')}
  FROM a WINDOW f AS ({W} ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)"""


@query("rolling_beta_50", _BETA)
def q_beta(spark, sf):
    return _q(S.rolling_beta(core(spark, sf)), "ret", "bench_ret", "beta")


BBW = "(bb_upper - bb_lower) / bb_middle * 100"


@query("bollinger_width", f"{WITH_CORE} SELECT symbol, timestamp, {r(BBW, 'bb_width')} FROM core")
def q_bb_width(spark, sf):
    return _q(S.bollinger_width(core(spark, sf)), "bb_width")


@query("bollinger_squeeze", f"""{WITH_CORE}, w AS (SELECT symbol, timestamp, {BBW} AS bb_width FROM core),
  q AS (SELECT symbol, quantile_cont(bb_width, 0.1) AS q10 FROM w GROUP BY symbol)
  SELECT symbol, timestamp, {r('bb_width')}, {r('q10')} FROM w JOIN q USING (symbol) WHERE bb_width < q10""")
def q_bb_squeeze(spark, sf):
    return _q(S.bollinger_squeeze(core(spark, sf)), "bb_width", "q10")


@query("rolling_trade_size_50", f"""{WITH_CORE}, t AS (SELECT *, volume / trades AS avg_trade_size FROM core)
  SELECT symbol, timestamp, {r('avg_trade_size')}, {r(f'''CASE WHEN count(avg_trade_size) OVER f = 50
     THEN avg(avg_trade_size) OVER f END''', 'rolling_trade_size')}
  FROM t WINDOW f AS ({W} ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)""")
def q_trade_size(spark, sf):
    return _q(S.rolling_trade_size(core(spark, sf)), "avg_trade_size", "rolling_trade_size")


@query("macd_bullish_cross", f"""{WITH_CORE} SELECT symbol, timestamp,
  coalesce(macd > macd_signal AND lag(macd) OVER ({W}) <= lag(macd_signal) OVER ({W}), false) AS bullish_cross FROM core""")
def q_macd_cross(spark, sf):
    return _q(S.macd_bullish_cross(core(spark, sf)), "bullish_cross")


@query("rsi_zones", f"""{WITH_CORE} SELECT symbol, timestamp, {r('rsi_14')},
  CASE WHEN rsi_14 < 30 THEN 'oversold' WHEN rsi_14 > 70 THEN 'overbought' ELSE 'neutral' END AS zone FROM core""")
def q_rsi_zones(spark, sf):
    return _q(core(spark, sf).withColumn("zone", S.rsi_zone()), "rsi_14", "zone")


@query("macd_histogram", f"""{WITH_CORE} SELECT symbol, timestamp, {r('macd - macd_signal', 'macd_hist')},
  CASE WHEN macd - macd_signal > 0 THEN 'green' ELSE 'red' END AS hist_color FROM core""")
def q_macd_hist(spark, sf):
    return _q(S.macd_histogram(core(spark, sf)), "macd_hist", "hist_color")


@query("intraday_volatility", f"""{WITH_CORE} SELECT symbol, timestamp,
  {r('(high - low) / open * 100', 'intraday_vol_pct')} FROM core""")
def q_intraday_vol(spark, sf):
    return _q(core(spark, sf).withColumn("intraday_vol_pct", (F.col("high") - F.col("low")) / F.col("open") * 100),
              "intraday_vol_pct")


@query("avg_trade_size", f"{WITH_CORE} SELECT symbol, timestamp, {r('volume / trades', 'avg_trade_size')} FROM core")
def q_avg_trade_size(spark, sf):
    return _q(core(spark, sf).withColumn("avg_trade_size", F.try_divide(F.col("volume"), F.col("trades").cast("double"))),
              "avg_trade_size")
