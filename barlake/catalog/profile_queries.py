"""Catalog: aggregations and data-quality profiles (section 2.5 / 2.8)."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from ..functions.exprs import CORE_SYMBOLS, WEEKDAYS_MONDAY_FIRST
from ..operators import profiles as P
from .base import WITH_CORE, WITH_UNIFIED, core, r, round_doubles, unified
from .registry import query
from .series_queries import RET, VOL_CTE, W

RETS = f"rt AS (SELECT *, {RET} * 100 AS ret_pct FROM core)"
ASSET = "replace(symbol, 'USDT', '') AS asset"


@query("count_by_symbol", f"{WITH_UNIFIED} SELECT symbol, count(*) AS n FROM unified GROUP BY symbol")
def q_count_by_symbol(spark, sf):
    return P.count_by_symbol(unified(spark, sf))


@query("dataset_overview", f"""{WITH_CORE} SELECT count(*) AS n_rows, count(DISTINCT symbol) AS n_symbols,
  min(timestamp) AS first_ts, max(timestamp) AS last_ts, date_sub('day', min(timestamp), max(timestamp)) AS span_days
  FROM core""")
def q_overview(spark, sf):
    return P.dataset_overview(core(spark, sf))


@query("symbol_overview", f"""{WITH_CORE} SELECT symbol, count(*) AS n_rows, min(timestamp) AS first_ts,
  max(timestamp) AS last_ts, date_sub('day', min(timestamp), max(timestamp)) AS span_days FROM core GROUP BY symbol""")
def q_symbol_overview(spark, sf):
    return P.symbol_overview(core(spark, sf))


_DESC_UNION = " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM core" for c in P.NUMERIC_COLS)


@query("describe_numeric", f"""{WITH_CORE}, l AS ({_DESC_UNION})
  SELECT column_name, count(value) AS count, {r('avg(value)', 'mean')}, {r('stddev_samp(value)', 'std')},
    {r('min(value)', 'min')}, {r('max(value)', 'max')}, {r('quantile_cont(value, 0.25)', 'p25')},
    {r('quantile_cont(value, 0.5)', 'p50')}, {r('quantile_cont(value, 0.75)', 'p75')}
  FROM l GROUP BY column_name""")
def q_describe(spark, sf):
    return round_doubles(P.describe_numeric(core(spark, sf)))


_UNI_COLS = ["timestamp", "date", "hour", "day_of_week", "symbol", "open", "high", "low", "close", "volume", "trades",
             "sma_20", "ema_50", "rsi_14", "macd", "macd_signal", "bb_upper", "bb_middle", "bb_lower", "source"]
_NULLS = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null, count(*) AS n FROM core"
                            for c in _UNI_COLS)


@query("null_profile", f"""{WITH_CORE}, l AS ({_NULLS})
  SELECT column_name, n_null, {r('n_null / n * 100', 'pct_null')} FROM l WHERE n_null > 0""")
def q_null_profile(spark, sf):
    return round_doubles(P.null_profile(core(spark, sf)))


@query("duplicate_full_rows", f"""{WITH_CORE} SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n_duplicates
  FROM (SELECT count(*) AS c FROM core GROUP BY ALL_COLS)""".replace("ALL_COLS", ", ".join(_UNI_COLS)))
def q_dup_rows(spark, sf):
    return P.duplicate_full_rows(core(spark, sf))


@query("duplicate_keys", f"""{WITH_CORE} SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n_duplicate_keys
  FROM (SELECT count(*) AS c FROM core GROUP BY timestamp, symbol)""")
def q_dup_keys(spark, sf):
    return P.duplicate_keys(core(spark, sf))


@query("ohlcv_consistency", f"""{WITH_CORE} SELECT count(*) FILTER (WHERE high < low) AS high_lt_low,
  count(*) FILTER (WHERE close < low OR close > high) AS close_outside_range,
  count(*) FILTER (WHERE volume < 0) AS negative_volume,
  count(*) FILTER (WHERE rsi_14 < 0 OR rsi_14 > 100) AS rsi_out_of_range FROM core""")
def q_ohlcv(spark, sf):
    return P.ohlcv_consistency(core(spark, sf))


@query("symbol_stats", f"""{WITH_CORE}, {RETS}
  SELECT symbol, count(*) AS n, {r('avg(close)', 'mean_close')}, {r('min(close)', 'min_close')},
    {r('max(close)', 'max_close')}, {r('stddev_samp(close)', 'std_close')}, {r('avg(volume)', 'mean_volume')},
    {r('avg(trades)', 'mean_trades')}, {r('avg(rsi_14)', 'mean_rsi')}, {r('avg(ret_pct)', 'mean_return_pct')},
    {r('(arg_max(close, timestamp) / arg_min(close, timestamp) - 1) * 100', 'total_return_pct')}, {ASSET}
  FROM rt GROUP BY symbol""")
def q_symbol_stats(spark, sf):
    return round_doubles(P.symbol_stats(core(spark, sf)))


@query("symbol_risk", f"""{WITH_CORE}, {RETS},
  x AS (SELECT *, coalesce(macd > macd_signal AND lag(macd) OVER ({W}) <= lag(macd_signal) OVER ({W}), false) AS bull,
        (close / max(close) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1) * 100 AS dd FROM rt)
  SELECT symbol, {r('CASE WHEN stddev_samp(ret_pct) > 0 THEN avg(ret_pct) / stddev_samp(ret_pct) ELSE 0 END', 'sharpe')},
    {r('min(dd)', 'max_drawdown_pct')}, count(*) FILTER (WHERE rsi_14 < 30) AS n_rsi_below_30,
    count(*) FILTER (WHERE rsi_14 > 70) AS n_rsi_above_70, count(*) FILTER (WHERE bull) AS n_macd_bullish,
    {r('avg((high - low) / open * 100)', 'mean_intraday_vol_pct')}, {ASSET}
  FROM x GROUP BY symbol""")
def q_symbol_risk(spark, sf):
    return round_doubles(P.symbol_risk(core(spark, sf)))


_HOURLY = f"""{WITH_CORE} SELECT hour, {r('avg(close)', 'mean_close')}, {r('avg(volume)', 'mean_volume')},
  {r('avg(trades)', 'mean_trades')}, {r('avg(rsi_14)', 'mean_rsi')} FROM core GROUP BY hour"""


@query("hourly_profile", _HOURLY)
def q_hourly(spark, sf):
    return round_doubles(P.hourly_profile(core(spark, sf)))


@query("top5_hours_by_volume", f"SELECT * FROM ({_HOURLY}) ORDER BY mean_volume DESC, hour LIMIT 5")
def q_top5(spark, sf):
    return round_doubles(P.top_hours_by_volume(core(spark, sf)))


_SPINE = "spine AS (SELECT * FROM (VALUES " + ", ".join(f"('{d}', {i})" for i, d in enumerate(WEEKDAYS_MONDAY_FIRST)) \
    + ") AS t(day_of_week, day_order))"


@query("weekday_profile", f"""{WITH_CORE}, {_SPINE},
  g AS (SELECT day_of_week, avg(close) AS mean_close, stddev_samp(close) AS std_close, avg(volume) AS mean_volume,
        avg(trades) AS mean_trades FROM core GROUP BY day_of_week)
  SELECT spine.day_of_week, day_order, {r('mean_close')}, {r('std_close')}, {r('mean_volume')}, {r('mean_trades')}
  FROM spine LEFT JOIN g USING (day_of_week)""")
def q_weekday(spark, sf):
    return round_doubles(P.weekday_profile(core(spark, sf)))


def _by_sym_hour(expr, name):
    return f"{WITH_CORE} SELECT symbol, hour, {r(f'avg({expr})', name)} FROM core GROUP BY symbol, hour"


@query("hourly_intraday_vol_by_symbol", _by_sym_hour("(high - low) / open * 100", "mean_intraday_vol_pct"))
def q_h_ivol(spark, sf):
    return round_doubles(P.by_symbol_hour(core(spark, sf), (F.col("high") - F.col("low")) / F.col("open") * 100,
                                          "mean_intraday_vol_pct"))


@query("hourly_volume_by_symbol", _by_sym_hour("volume", "mean_volume"))
def q_h_vol(spark, sf):
    return round_doubles(P.by_symbol_hour(core(spark, sf), F.col("volume"), "mean_volume"))


@query("hourly_trades_by_symbol", _by_sym_hour("trades", "mean_trades"))
def q_h_trades(spark, sf):
    return round_doubles(P.by_symbol_hour(core(spark, sf), F.col("trades"), "mean_trades"))


@query("weekday_price_by_symbol", f"""{WITH_CORE} SELECT symbol, """ + ", ".join(
    r(f"avg(close) FILTER (WHERE day_of_week = '{d}')", d) for d in WEEKDAYS_MONDAY_FIRST) + " FROM core GROUP BY symbol")
def q_wd_price(spark, sf):
    return round_doubles(P.weekday_price_by_symbol(core(spark, sf)))


def _daily_sql(how):
    agg = "avg(volume)" if how == "mean" else "sum(volume)"
    val = f"{how}_volume" if how == "mean" else "coalesce(sum_volume, 0)"
    return f"""{WITH_CORE}, d AS (SELECT symbol, CAST(timestamp AS DATE) AS date, volume FROM core),
  g AS (SELECT symbol, date, {agg} AS {how}_volume FROM d GROUP BY symbol, date),
  sp AS (SELECT symbol, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
         FROM d GROUP BY symbol)
  SELECT sp.symbol, sp.date, {r(val, f'{how}_volume')} FROM sp LEFT JOIN g USING (symbol, date)"""


@query("daily_mean_volume", _daily_sql("mean"))
def q_daily_mean(spark, sf):
    return round_doubles(P.daily_volume(core(spark, sf), "mean"))


@query("daily_sum_volume", _daily_sql("sum"))
def q_daily_sum(spark, sf):
    return round_doubles(P.daily_volume(core(spark, sf), "sum"))


@query("volume_total", f"""{WITH_CORE} SELECT symbol, {r('sum(volume)', 'total_volume')}, {ASSET}
  FROM core GROUP BY symbol ORDER BY total_volume DESC""")
def q_volume_total(spark, sf):
    return round_doubles(P.volume_total(core(spark, sf)))


@query("return_stats", f"""{WITH_CORE}, {RETS}
  SELECT symbol, {r('avg(ret_pct)', 'mean_ret')}, {r('quantile_cont(ret_pct, 0.5)', 'median_ret')},
    {r('stddev_samp(ret_pct)', 'std_ret')}, {r('min(ret_pct)', 'min_ret')}, {r('max(ret_pct)', 'max_ret')},
    {r('skewness(ret_pct)', 'skewness')}, {r('kurtosis(ret_pct)', 'kurtosis')},
    count(*) FILTER (WHERE ret_pct > 0) AS n_positive, count(*) FILTER (WHERE ret_pct < 0) AS n_negative, {ASSET}
  FROM rt GROUP BY symbol""")
def q_return_stats(spark, sf):
    return round_doubles(P.return_stats(core(spark, sf)))


def _corr_sql(src: str, cols: list[str], an: str, bn: str) -> str:
    parts = []
    for a, b in product(cols, cols):
        x = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
        y = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
        e = f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"
        parts.append(f"SELECT '{a}' AS {an}, '{b}' AS {bn}, {r(e, 'corr')} FROM {src}")
    return " UNION ALL ".join(parts)


@query("feature_corr_matrix", f"{WITH_CORE} " + _corr_sql("core", P.CORR_COLS, "col_a", "col_b"))
def q_feat_corr(spark, sf):
    return round_doubles(P.feature_corr_matrix(core(spark, sf)))


_PIVOT = "pv AS (SELECT timestamp, " + ", ".join(
    f"avg(close) FILTER (WHERE symbol = '{s}') AS {s}" for s in CORE_SYMBOLS) + " FROM core GROUP BY timestamp)"


@query("price_corr_matrix", f"{WITH_CORE}, {_PIVOT} " + _corr_sql("pv", CORE_SYMBOLS, "sym_a", "sym_b"))
def q_price_corr(spark, sf):
    return round_doubles(P.price_corr_matrix(core(spark, sf), CORE_SYMBOLS))


# independent formulation: forward fill on the pivot grid, pct_change, drop rows with any NULL
_FF = "ff AS (SELECT timestamp, " + ", ".join(
    f"last_value({s} IGNORE NULLS) OVER (ORDER BY timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {s}"
    for s in CORE_SYMBOLS) + " FROM pv)"
_PCT = "rpc AS (SELECT timestamp, " + ", ".join(
    f"{s} / lag({s}) OVER (ORDER BY timestamp) - 1 AS {s}" for s in CORE_SYMBOLS) + " FROM ff)"
_DROPNA = "dn AS (SELECT * FROM rpc WHERE " + " AND ".join(f"{s} IS NOT NULL" for s in CORE_SYMBOLS) + ")"


@query("return_corr_matrix", f"{WITH_CORE}, {_PIVOT}, {_FF}, {_PCT}, {_DROPNA} " + _corr_sql("dn", CORE_SYMBOLS, "sym_a", "sym_b"))
def q_ret_corr(spark, sf):
    return round_doubles(P.return_corr_matrix(core(spark, sf), CORE_SYMBOLS))


@query("regime_stats", f"""{WITH_CORE}, {VOL_CTE}
  SELECT symbol, regime, {r('avg(ret_pct)', 'mean_ret')}, {r('stddev_samp(ret_pct)', 'std_ret')},
    count(ret_pct) AS n_periods FROM reg GROUP BY symbol, regime""")
def q_regime_stats(spark, sf):
    return round_doubles(P.regime_stats(core(spark, sf)))


SESSION_SQL = """CASE WHEN hour >= 0 AND hour < 8 THEN 'Asie (00-08 UTC)' WHEN hour >= 8 AND hour < 16
  THEN 'Europe (08-16 UTC)' ELSE 'Amerique (16-00 UTC)' END"""


@query("session_stats", f"""{WITH_CORE}, {RETS}
  SELECT symbol, {SESSION_SQL} AS session, {r('avg(ret_pct)', 'mean_ret')}, {r('stddev_samp(ret_pct)', 'std_ret')},
    {r('avg(volume)', 'mean_volume')}, {r('avg(trades)', 'mean_trades')} FROM rt GROUP BY symbol, session""")
def q_session_stats(spark, sf):
    return round_doubles(P.session_stats(core(spark, sf)))


def _hist_sql(src_cte: str, value: str, n: int) -> str:
    return f"""{WITH_CORE}, {src_cte},
  x AS (SELECT symbol, CAST({value} AS DOUBLE) AS v FROM src WHERE {value} IS NOT NULL),
  mm AS (SELECT symbol, min(v) AS lo, max(v) AS hi FROM x GROUP BY symbol)
  SELECT symbol, CASE WHEN hi > lo THEN least(CAST(floor((v - lo) / (hi - lo) * {n}) AS BIGINT) + 1, {n}) END AS bin,
    count(*) AS n FROM x JOIN mm USING (symbol) GROUP BY symbol, bin"""


for _key, _val, _n, _src in [("histogram_close", "close", 50, "src AS (SELECT * FROM core)"),
                             ("histogram_returns", "ret_pct", 50, f"{RETS}, src AS (SELECT * FROM rt)"),
                             ("histogram_rsi", "rsi_14", 30, "src AS (SELECT * FROM core)"),
                             ("histogram_volume", "volume", 50, "src AS (SELECT * FROM core)")]:
    def _mk(val=_val, n=_n):
        def fn(spark, sf):
            from ..operators.series import with_returns
            c = core(spark, sf)
            if val == "ret_pct":
                c = with_returns(c.select("symbol", "timestamp", "close"))
            return P.histogram(c, val, n)
        fn.__name__ = f"q_hist_{val}"
        return fn
    query(_key, _hist_sql(_src, _val, _n))(_mk())


@query("boxplot_close", f"""{WITH_CORE}, q AS (SELECT symbol, quantile_cont(close, 0.25) AS q1, quantile_cont(close, 0.5) AS median,
    quantile_cont(close, 0.75) AS q3 FROM core GROUP BY symbol),
  qq AS (SELECT *, q3 - q1 AS iqr FROM q)
  SELECT symbol, {r('q1')}, {r('median')}, {r('q3')}, {r('iqr')},
    {r('min(close) FILTER (WHERE close >= q1 - 1.5 * iqr)', 'whisker_low')},
    {r('max(close) FILTER (WHERE close <= q3 + 1.5 * iqr)', 'whisker_high')},
    count(*) FILTER (WHERE close < q1 - 1.5 * iqr OR close > q3 + 1.5 * iqr) AS n_outliers
  FROM core JOIN qq USING (symbol) GROUP BY symbol, q1, median, q3, iqr""")
def q_boxplot(spark, sf):
    return round_doubles(P.boxplot_stats(core(spark, sf)))


@query("quantile_thresholds", f"""{WITH_CORE}, {VOL_CTE},
  bw AS (SELECT symbol, quantile_cont((bb_upper - bb_lower) / bb_middle * 100, 0.1) AS bb_width_q10 FROM core GROUP BY symbol)
  SELECT symbol, {r('q33')}, {r('q66')}, {r('bb_width_q10')} FROM th FULL JOIN bw USING (symbol)""")
def q_quant_thr(spark, sf):
    return round_doubles(P.quantile_thresholds(core(spark, sf)))
