"""Catalog: dimensions, joins, sorts/limits and set operations (2.3, 2.4, 2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import CORE_SYMBOLS, SESSIONS, trading_session
from ..operators import dims as D
from ..operators import indicators as ind
from ..operators import sets as ST
from ..sources.adapters import event_candles
from ..streaming.indicators import STREAM_COLS, stream_indicator_sql, stream_indicators
from .base import WITH_CANDLES, WITH_CORE, WITH_UNIFIED, core, r, round_doubles, unified
from .profile_queries import SESSION_SQL
from .registry import query

DIM_DATES_SQL = """dd AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM unified),
  dim_dates AS (SELECT date, year(date) AS year, month(date) AS month, monthname(date) AS month_name,
    day(date) AS day, dayofweek(date) + 1 AS day_of_week, dayname(date) AS day_of_week_name FROM dd)"""
_RUSH = " OR ".join(f"hours IN ({', '.join(str(h) for h in range(a, b))})" for a, b in D.RUSH)
HOURS_ATTR = f"""(hours + 11) % 12 + 1 AS hour_12, ['AM', 'PM'][hours // 12 + 1] AS am_pm,
    hours BETWEEN {D.WORK_START} AND {D.WORK_END} AS is_worked_hours, ({_RUSH}) AS is_rush_hour"""
DIM_HOURS_SQL = f"dim_hours AS (SELECT hours, {HOURS_ATTR} FROM range({D.HOURS}) AS t(hours))"
_LABELS = ", ".join(f"('{k}', '{v}')" for k, v in D.SYMBOL_LABELS.items())
DIM_SYMBOLS_SQL = f"""labels(symbol, label) AS (VALUES {_LABELS}),
  dim_symbols AS (SELECT symbol, coalesce(any_value(label), '{D.OTHER_LABEL}') AS symbole_libelle,
    '{D.QUOTE_CURRENCY}' AS devise_cotation, '{D.QUOTE_CURRENCY_NAME}' AS devise_cotation_nom
    FROM candles LEFT JOIN labels USING (symbol) GROUP BY symbol)"""


@query("dim_dates", f"{WITH_UNIFIED}, {DIM_DATES_SQL} SELECT * FROM dim_dates")
def q_dim_dates(spark, sf):
    return D.dim_dates(unified(spark, sf))


@query("dim_hours", f"{WITH_UNIFIED}, {DIM_HOURS_SQL} SELECT * FROM dim_hours")
def q_dim_hours(spark, sf):
    return D.dim_hours(unified(spark, sf))


@query("dim_symbols", f"{WITH_CANDLES}, {DIM_SYMBOLS_SQL} SELECT * FROM dim_symbols")
def q_dim_symbols(spark, sf):
    return D.dim_symbols(event_candles(spark, sf))


# target: an earlier load that only held the working hours; source: every generated hour
_MERGE_SQL = f"""{WITH_UNIFIED}, {DIM_HOURS_SQL},
  tgt AS (SELECT * FROM dim_hours WHERE is_worked_hours)
  SELECT * FROM tgt UNION ALL SELECT * FROM dim_hours WHERE hours NOT IN (SELECT hours FROM tgt)"""


@query("merge_insert_missing", _MERGE_SQL)
def q_merge(spark, sf):
    hours = D.dim_hours(unified(spark, sf))
    target = hours.where(F.col("is_worked_hours"))
    return D.merge_insert_missing(target, hours, "hours")


@query("unnest_lateral", f"""{WITH_UNIFIED} SELECT symbol, unnest(generate_series(min(hour), max(hour))) AS hours
  FROM unified GROUP BY symbol""")
def q_unnest(spark, sf):
    u = unified(spark, sf)
    return (u.groupBy("symbol").agg(F.min("hour").alias("h0"), F.max("hour").alias("h1"))
            .select("symbol", F.explode(F.sequence("h0", "h1")).alias("hours")))


@query("fact_dim_star", f"""{WITH_UNIFIED}, {DIM_DATES_SQL}, {DIM_HOURS_SQL}, {DIM_SYMBOLS_SQL}
  SELECT u.symbol, u.timestamp, {r('u.close', 'close')}, d.year, d.month_name, d.day_of_week_name, h.hour_12, h.am_pm,
    h.is_worked_hours, h.is_rush_hour, s.symbole_libelle, s.devise_cotation
  FROM unified u LEFT JOIN dim_dates d ON u.date = d.date LEFT JOIN dim_hours h ON u.hour = h.hours
  LEFT JOIN dim_symbols s ON u.symbol = s.symbol""")
def q_star(spark, sf):
    u = unified(spark, sf)
    star = D.fact_dim_star(u, D.dim_dates(u), D.dim_hours(u), D.dim_symbols(event_candles(spark, sf)))
    return round_doubles(star.select("symbol", "timestamp", "close", "year", "month_name", "day_of_week_name", "hour_12",
                                     "am_pm", "is_worked_hours", "is_rush_hour", "symbole_libelle", "devise_cotation"))


_RET = "close / lag(close) OVER (PARTITION BY symbol ORDER BY timestamp) - 1"


@query("align_returns_inner", f"""{WITH_CORE}, rt AS (SELECT symbol, timestamp, {_RET} AS ret FROM core),
  b AS (SELECT timestamp, ret AS bench_ret FROM rt WHERE symbol = 'BTCUSDT' AND ret IS NOT NULL)
  SELECT rt.symbol, rt.timestamp, {r('rt.ret', 'ret')}, {r('b.bench_ret', 'bench_ret')} FROM rt JOIN b USING (timestamp)
  WHERE rt.symbol <> 'BTCUSDT' AND rt.ret IS NOT NULL""")
def q_align(spark, sf):
    return round_doubles(ST.align_returns(core(spark, sf)))


@query("pivot_close_by_symbol", f"{WITH_CORE} SELECT timestamp, " + ", ".join(
    r(f"avg(close) FILTER (WHERE symbol = '{s}')", s) for s in CORE_SYMBOLS) + " FROM core GROUP BY timestamp")
def q_pivot(spark, sf):
    from ..operators.profiles import pivot_close
    return round_doubles(pivot_close(core(spark, sf), CORE_SYMBOLS))


_SESS_SPINE = "sp AS (SELECT * FROM (VALUES " + ", ".join(f"('{s}', {i})" for i, s in enumerate(SESSIONS)) \
    + ") AS t(session, session_order))"


@query("reindex_spine", f"""{WITH_CORE}, {_SESS_SPINE},
  g AS (SELECT symbol, {SESSION_SQL} AS session, avg(volume) AS mean_volume FROM core GROUP BY 1, 2)
  SELECT sy.symbol, sp.session, session_order, {r('mean_volume')} FROM (SELECT DISTINCT symbol FROM core) sy, sp
  LEFT JOIN g ON g.symbol = sy.symbol AND g.session = sp.session""")
def q_reindex(spark, sf):
    from ..operators.profiles import reindex_spine
    c = core(spark, sf)
    g = c.groupBy("symbol", trading_session("hour").alias("session")).agg(F.avg("volume").alias("mean_volume"))
    spine = spark.createDataFrame([(s, i) for i, s in enumerate(SESSIONS)], "session string, session_order int")
    return round_doubles(reindex_spine(g, spine, "session", "session_order", per=["symbol"]))


@query("order_by_time", f"{WITH_CORE} SELECT symbol, timestamp, {r('close')} FROM core ORDER BY timestamp DESC")
def q_order(spark, sf):
    return round_doubles(core(spark, sf).select("symbol", "timestamp", "close").orderBy(F.col("timestamp").desc()))


@query("head_10", f"""{WITH_CORE} SELECT symbol, timestamp, {r('close')} FROM core
  ORDER BY timestamp DESC, symbol LIMIT 10""")
def q_head(spark, sf):
    return round_doubles(core(spark, sf).select("symbol", "timestamp", "close")
                         .orderBy(F.col("timestamp").desc(), "symbol").limit(10))


_STREAM_OUT = ", ".join(r(c) for c in STREAM_COLS)
UNION_SQL = f"""{WITH_UNIFIED}, {stream_indicator_sql('cleaned')},
  both_src AS (SELECT symbol, timestamp, close, sma_20, rsi_14, 'historical' AS source FROM unified
               UNION ALL SELECT symbol, timestamp, close, sma_20, rsi_14, 'streaming' AS source FROM stream_ind)"""


def _both(spark, sf):
    c = ind.clean_batch(event_candles(spark, sf))
    hist = ind.indicators_batch(c).select("symbol", "timestamp", "close", "sma_20", "rsi_14", "source",
                                          "ingestion_timestamp")
    live = ind.with_lineage(stream_indicators(c), "streaming").select(
        "symbol", "timestamp", "close", "sma_20", "rsi_14", "source", "ingestion_timestamp")
    return ST.union_sources(hist, live)


@query("union_sources", f"{UNION_SQL} SELECT symbol, timestamp, source, {r('close')}, {r('sma_20')}, {r('rsi_14')} FROM both_src")
def q_union(spark, sf):
    return round_doubles(_both(spark, sf).drop("ingestion_timestamp"))


@query("dedupe_candles", f"""{UNION_SQL} SELECT symbol, timestamp, source, {r('close')}, {r('sma_20')}, {r('rsi_14')}
  FROM both_src WHERE source = 'historical'""")
def q_dedupe(spark, sf):
    return round_doubles(ST.dedupe_candles(_both(spark, sf)).drop("ingestion_timestamp"))


@query("indicators_stream_mode", f"""{WITH_UNIFIED}, {stream_indicator_sql('cleaned')}
  SELECT symbol, timestamp, {_STREAM_OUT} FROM stream_ind""")
def q_stream_mode(spark, sf):
    c = ind.clean_batch(event_candles(spark, sf))
    return round_doubles(stream_indicators(c).select("symbol", "timestamp", *STREAM_COLS))
