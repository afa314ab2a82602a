"""Catalog: parsing, validation, cleaning, projections (section 2.2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import CORE_SYMBOLS, base_asset, tcast, time_parts, trading_session
from ..operators import indicators as ind
from ..operators import parse as PZ
from ..session import table
from ..sources import messages as M
from ..sources.adapters import event_candles
from .base import WITH_CANDLES, WITH_CORE, WITH_UNIFIED, core, r, round_doubles, unified
from ..streaming.indicators import stream_indicator_sql, stream_indicators
from .profile_queries import SESSION_SQL
from .registry import query

SYM_CASE = """CASE event_type WHEN 'click' THEN 'BTCUSDT' WHEN 'view' THEN 'ETHUSDT' WHEN 'purchase' THEN 'SOLUSDT'
  WHEN 'signup' THEN 'ADAUSDT' WHEN 'error' THEN 'XRPUSDT' END"""
TICKS = f"""ticks AS (SELECT event_id, {SYM_CASE} AS symbol, ts AS timestamp, value AS open, value AS high,
  value AS low, value AS close, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume, CAST(1 AS BIGINT) AS trades
  FROM events)"""
TICKS_CHECKED = TICKS + """, checked AS (SELECT *, CASE WHEN volume IS NULL OR volume = 0 OR volume <= 0 THEN 'missing'
  END AS reject_reason FROM ticks)"""
ISO = "strftime(timestamp, '%Y-%m-%dT%H:%M:%S')"
ISO_END = "strftime(timestamp + INTERVAL 1 HOUR - INTERVAL 1 MILLISECOND, '%Y-%m-%dT%H:%M:%S.%f')"
OHLCV = ["open", "high", "low", "close", "volume"]


def _ticks(spark, sf):
    return PZ.validate_messages(M.tick_messages(table(spark, sf, "events")))


@query("parse_message_json", f"""{WITH_CANDLES} SELECT symbol, '1h' AS interval, {ISO} AS start_time,
  {ISO_END} AS close_time, {ISO_END} AS event_time, {", ".join(r(c) for c in OHLCV)}, trades FROM candles""")
def q_parse_json(spark, sf):
    msgs = M.stream_messages(event_candles(spark, sf))
    m, _ = PZ.parse_json_object(F.col("value"))
    x = msgs.select(m.alias("m")).select("m.*")
    return round_doubles(x.select("symbol", "interval", "start_time", "close_time", "event_time",
                                  *[tcast(F.col(c), "double").alias(c) for c in OHLCV],
                                  tcast("trades", "bigint").alias("trades")))


_KL = f"""{WITH_CANDLES}, kl AS (SELECT *, timestamp < max(timestamp) OVER (PARTITION BY symbol) AS is_closed FROM candles)"""
_KL_COLS = f"""{ISO_END} AS event_time, symbol, '1h' AS interval, {ISO} AS start_time, {ISO_END} AS close_time,
  {", ".join(r(c) for c in OHLCV)}, {r('volume * close', 'quote_volume')}, trades,
  {r('volume / 2', 'taker_buy_base')}, {r('volume * close / 2', 'taker_buy_quote')}"""


@query("flatten_kline_envelope", f"{_KL} SELECT {_KL_COLS} FROM kl")
def q_flatten(spark, sf):
    env = M.kline_envelopes(event_candles(spark, sf))
    return round_doubles(PZ.flatten_kline_envelope(env, closed_only=False))


@query("closed_candles_only", f"{_KL} SELECT {_KL_COLS} FROM kl WHERE is_closed")
def q_closed(spark, sf):
    env = M.kline_envelopes(event_candles(spark, sf))
    return round_doubles(PZ.flatten_kline_envelope(env, closed_only=True))


@query("kline_array_to_rows", f"""{WITH_CANDLES} SELECT symbol, timestamp AS open_time, {", ".join(r(c) for c in OHLCV)},
  {r('volume * close', 'quote_volume')}, trades, {r('volume / 2', 'taker_buy_base')},
  {r('volume * close / 2', 'taker_buy_quote')} FROM candles""")
def q_kline_rows(spark, sf):
    return round_doubles(PZ.kline_arrays_to_rows(M.kline_responses(event_candles(spark, sf))))


@query("clean_stream", f"""{WITH_CANDLES} SELECT timestamp, CAST(timestamp AS DATE) AS date, hour(timestamp) AS hour,
  dayname(timestamp) AS day_of_week, symbol, {", ".join(r(c) for c in OHLCV)}, trades FROM candles
  WHERE open <> 0 AND close <> 0 AND volume > 0""")
def q_clean_stream(spark, sf):
    v = PZ.validate_messages(M.stream_messages(event_candles(spark, sf)))
    good, _ = PZ.split_rejects(v)
    return round_doubles(PZ.cleaned_candles(good))


@query("clean_batch", f"""{WITH_CANDLES} SELECT symbol, timestamp, {", ".join(r(c) for c in OHLCV)}, trades FROM candles
  WHERE open IS NOT NULL AND close IS NOT NULL AND volume > 0""")
def q_clean_batch(spark, sf):
    return round_doubles(ind.clean_batch(event_candles(spark, sf)))


@query("event_time_coalesce", f"{WITH_CANDLES}, {TICKS} SELECT event_id, timestamp FROM ticks")
def q_event_time(spark, sf):
    return _ticks(spark, sf).select("event_id", "timestamp")


@query("parse_timestamp_formats", f"""{WITH_CANDLES}, {TICKS}
  SELECT event_id, timestamp AS ts_iso, date_trunc('second', timestamp) AS ts_plain FROM ticks""")
def q_ts_formats(spark, sf):
    t = _ticks(spark, sf)
    plain = PZ.parse_time(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    return t.select("event_id", F.col("timestamp").alias("ts_iso"), plain.alias("ts_plain"))


@query("typed_cast_reject", f"""{WITH_CANDLES}, {TICKS_CHECKED}
  SELECT event_id, symbol, timestamp, {", ".join(r(c) for c in OHLCV)}, trades, reject_reason FROM checked""")
def q_typed(spark, sf):
    return round_doubles(_ticks(spark, sf).select("event_id", "symbol", "timestamp", *OHLCV, "trades", "reject_reason"))


@query("quarantine_rejects", f"""{WITH_CANDLES}, {TICKS_CHECKED}
  SELECT reject_reason, symbol, count(*) AS n FROM checked WHERE reject_reason IS NOT NULL GROUP BY 1, 2""")
def q_quarantine(spark, sf):
    from ..streaming import jobs as J
    src = J.scratch(spark, "q_ticks")
    J.write_messages_in_order(M.tick_messages(table(spark, sf, "events")), src)
    good, bad = J.scratch(spark, "q_good"), J.scratch(spark, "q_dead_letter")
    J.split_to_sinks(J.message_stream(spark, src), good, bad, bad + "_ck")
    return spark.read.parquet(bad).groupBy("reject_reason", "symbol").agg(F.count(F.lit(1)).alias("n"))


_FULL = ["sma_20", "ema_50", "rsi_14", "macd", "macd_signal", "bb_middle"]
_FULL_SQL = " AND ".join(f"coalesce({c}, 0) <> 0" for c in _FULL)


@query("pipeline_counters", f"""{WITH_UNIFIED}, {TICKS_CHECKED},
  {stream_indicator_sql('cleaned')},
  t AS (SELECT count(*) AS received, count(*) FILTER (WHERE reject_reason = 'parse') AS parse_errors,
    count(*) FILTER (WHERE reject_reason IS NULL) AS cleaned,
    count(*) FILTER (WHERE reject_reason IS NOT NULL) AS rejected FROM checked),
  i AS (SELECT count(*) FILTER (WHERE {_FULL_SQL}) AS rows_full_indicators,
    count(*) FILTER (WHERE NOT ({_FULL_SQL})) AS rows_partial_indicators,
    {r(f'count(*) FILTER (WHERE {_FULL_SQL}) * 100.0 / count(*)', 'full_indicators_rate_pct')} FROM stream_ind)
  SELECT * FROM t, i""")
def q_counters(spark, sf):
    t = _ticks(spark, sf)
    counts = t.agg(F.count(F.lit(1)).alias("received"), F.count_if(F.col("reject_reason") == "parse").alias("parse_errors"),
                   F.count_if(F.col("reject_reason").isNull()).alias("cleaned"),
                   F.count_if(F.col("reject_reason").isNotNull()).alias("rejected"))
    si = stream_indicators(ind.clean_batch(event_candles(spark, sf)))
    full = None
    for c in _FULL:
        cond = F.coalesce(F.col(c), F.lit(0.0)) != 0
        full = cond if full is None else full & cond
    comp = si.agg(F.count_if(full).alias("rows_full_indicators"), F.count_if(~full).alias("rows_partial_indicators"),
                  (F.count_if(full) * 100.0 / F.count(F.lit(1))).alias("full_indicators_rate_pct"))
    one = counts.withColumn("__k", F.lit(1)).join(comp.withColumn("__k", F.lit(1)), "__k").drop("__k")
    return round_doubles(one)


@query("time_parts", f"""{WITH_CANDLES} SELECT symbol, timestamp, CAST(timestamp AS DATE) AS date,
  hour(timestamp) AS hour, dayname(timestamp) AS day_of_week FROM candles""")
def q_time_parts(spark, sf):
    return event_candles(spark, sf).select("symbol", "timestamp", *time_parts("timestamp"))


_REQ = ["timestamp", "date", "hour", "symbol", "open", "high", "low", "close", "volume", "source"]
_WH_COLS = [c for c in ind.UNIFIED_COLS if c != "ingestion_timestamp"]
_WH_DOUBLES = {"open", "high", "low", "close", "volume", *ind.INDICATOR_COLS}


@query("format_for_warehouse", f"{WITH_UNIFIED} SELECT " + ", ".join(
    r(c) if c in _WH_DOUBLES else c for c in _WH_COLS) + " FROM unified")
def q_format(spark, sf):
    u = ind.indicators_batch(event_candles(spark, sf))
    return round_doubles(PZ.format_for_warehouse(u, _REQ).drop("ingestion_timestamp"))


@query("symbol_in_filter", f"{WITH_CORE} SELECT symbol, timestamp FROM core")
def q_in_filter(spark, sf):
    return unified(spark, sf).where(F.col("symbol").isin(CORE_SYMBOLS)).select("symbol", "timestamp")


_DROP = ["source", "ingestion_timestamp", "date", "hour", "day_of_week"]


@query("drop_metadata_columns", f"{WITH_CORE} SELECT " + ", ".join(
    r(c) if c in _WH_DOUBLES else c for c in _WH_COLS if c not in _DROP) + " FROM core")
def q_drop_meta(spark, sf):
    return round_doubles(core(spark, sf).drop(*_DROP, "not_a_column"))


@query("literal_lineage", f"{WITH_UNIFIED} SELECT symbol, timestamp, source FROM unified")
def q_lineage(spark, sf):
    return ind.indicators_batch(event_candles(spark, sf)).select("symbol", "timestamp", "source")


@query("symbol_base_asset", f"{WITH_UNIFIED} SELECT DISTINCT symbol, replace(symbol, 'USDT', '') AS asset FROM unified")
def q_base_asset(spark, sf):
    return unified(spark, sf).select("symbol", base_asset("symbol").alias("asset")).distinct()


@query("trading_session", f"{WITH_CORE} SELECT symbol, timestamp, hour, {SESSION_SQL} AS session FROM core")
def q_session(spark, sf):
    return core(spark, sf).select("symbol", "timestamp", "hour", trading_session("hour").alias("session"))


@query("price_volume_rsi_points", f"""{WITH_CORE} SELECT timestamp, {r('volume')}, {r('close')}, {r('rsi_14')}
  FROM core WHERE symbol = 'BTCUSDT'""")
def q_pv_points(spark, sf):
    return round_doubles(core(spark, sf).where(F.col("symbol") == "BTCUSDT").select("timestamp", "volume", "close", "rsi_14"))
