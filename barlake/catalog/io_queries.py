"""Catalog: file scans and sinks (section 2.1); each writes then reads back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.exprs import CORE_SYMBOLS
from ..operators import dims as D
from ..operators import indicators as ind
from ..operators import parse as PZ
from ..session import table
from ..sources import files as FS
from ..sources import messages as M
from ..sources.adapters import event_candles
from .base import WITH_CANDLES, WITH_UNIFIED, r, round_doubles, unified
from .registry import query
from .parse_queries import TICKS_CHECKED
from .relational_queries import DIM_SYMBOLS_SQL

HIST_SQL = f"""{WITH_CANDLES}, hist AS (SELECT symbol, timestamp AS open_time, open, high, low, close, volume,
  volume * close AS quote_volume, trades, volume / 2 AS taker_buy_base, volume * close / 2 AS taker_buy_quote FROM candles)"""
HIST_DOUBLES = ["open", "high", "low", "close", "volume", "quote_volume", "taker_buy_base", "taker_buy_quote"]


def historical_rows(spark, sf):
    """Candles in the historical CSV shape (derived money columns as in the payload adapters)."""
    x = M.with_payload_fields(event_candles(spark, sf))
    return x.select("symbol", F.col("timestamp").alias("open_time"), "open", "high", "low", "close", "volume",
                    "quote_volume", "trades", "taker_buy_base", "taker_buy_quote")


def _written_history(spark, sf):
    path = FS.new_table_path(spark, "historical_csv")
    FS.write_csv_by_symbol_year(historical_rows(spark, sf), path)
    return path


@query("scan_historical_csv", f"{HIST_SQL} SELECT symbol, open_time, trades, " + ", ".join(r(c) for c in HIST_DOUBLES)
       + " FROM hist")
def q_scan_csv(spark, sf):
    path = _written_history(spark, sf)
    rows = FS.scan_historical_csv(spark, f"{path}/symbol_dir=*/year=*/*.csv")
    return round_doubles(rows.where(F.col(FS.CORRUPT).isNull()).select(*FS.HISTORICAL_COLS))


@query("write_csv_by_symbol_year", f"""{HIST_SQL} SELECT lower(symbol) AS symbol_dir, year(open_time) AS year,
  count(*) AS n FROM hist GROUP BY 1, 2""")
def q_write_csv(spark, sf):
    path = _written_history(spark, sf)
    back = spark.read.option("header", True).csv(path)
    return back.groupBy("symbol_dir", F.col("year").cast("bigint").alias("year")).agg(F.count(F.lit(1)).alias("n"))


_STATS_SQL = f"""{HIST_SQL}, st AS (SELECT symbol, year(open_time) AS year, min(open) AS open_price_min,
  max(open) AS open_price_max, sum(volume) AS volume_total, CAST(sum(trades) AS BIGINT) AS trades_total, count(*) AS candles_fetched
  FROM hist GROUP BY 1, 2)"""


@query("ingest_stats_by_symbol_year", f"""{_STATS_SQL} SELECT symbol, year, {r('open_price_min')}, {r('open_price_max')},
  {r('volume_total')}, trades_total, candles_fetched FROM st""")
def q_ingest_stats(spark, sf):
    rows = FS.scan_historical_csv(spark, f"{_written_history(spark, sf)}/symbol_dir=*/year=*/*.csv")
    return round_doubles(FS.ingest_stats_by_symbol_year(rows))


@query("run_audit_json", f"""{_STATS_SQL}, {TICKS_CHECKED},
  er AS (SELECT reject_reason, count(*) AS n FROM checked WHERE reject_reason IS NOT NULL GROUP BY 1)
  SELECT CASE WHEN sum(candles_fetched) > 0 THEN 'success' ELSE 'failed' END AS status, CAST(sum(candles_fetched) AS BIGINT) AS total_candles,
  count(DISTINCT year) AS total_years, count(DISTINCT symbol) AS total_symbols, count(*) AS n_details,
  (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM er) AS total_errors,
  (SELECT coalesce(string_agg(reject_reason || ':' || n, ',' ORDER BY reject_reason), '') FROM er) AS errors FROM st""")
def q_audit(spark, sf):
    stats = FS.ingest_stats_by_symbol_year(historical_rows(spark, sf))
    bad = PZ.validate_messages(M.tick_messages(table(spark, sf, "events")).select("value")).where("reject_reason IS NOT NULL")
    path = FS.new_table_path(spark, "audit_json")
    FS.write_audit_json(FS.run_audit(stats, "historical-backfill", bad.select(F.col("reject_reason").alias("error_type"))), path + "/runs")
    FS.write_audit_json(FS.run_audit_details(stats, "historical-backfill"), path + "/details")
    n = spark.read.json(path + "/details").agg(F.count(F.lit(1)).alias("n_details")).withColumn("__k", F.lit(1))
    runs = spark.read.schema("status string, total_candles long, total_years long, total_symbols long, total_errors long, "
                             "errors_by_type array<struct<error_type:string,n:long>>").json(path + "/runs")
    errors = F.array_join(F.transform("errors_by_type", lambda e: F.concat(e["error_type"], F.lit(":"), e["n"].cast("string"))), ",")
    return (runs.withColumn("__k", F.lit(1)).join(n, "__k")
            .select("status", "total_candles", "total_years", "total_symbols", "n_details", "total_errors", errors.alias("errors")))


@query("publish_messages", f"""{WITH_CANDLES} SELECT symbol AS key, symbol AS attr_symbol, '1h' AS attr_interval,
  'binance-websocket' AS attr_source, strftime(timestamp, '%Y-%m-%dT%H:%M:%S') AS start_time FROM candles""")
def q_publish(spark, sf):
    p = M.publish_frame(M.stream_messages(event_candles(spark, sf)))
    return p.select("key", F.col("attributes")["symbol"].alias("attr_symbol"),
                    F.col("attributes")["interval"].alias("attr_interval"),
                    F.col("attributes")["source"].alias("attr_source"),
                    F.get_json_object("value", "$.start_time").alias("start_time"))


_UNI = [c for c in ind.UNIFIED_COLS if c != "ingestion_timestamp"]
_UNI_D = {"open", "high", "low", "close", "volume", *ind.INDICATOR_COLS}
UNI_SELECT = ", ".join(r(c) if c in _UNI_D else c for c in _UNI)


def written_unified(spark, sf) -> str:
    path = FS.new_table_path(spark, "market_data_unified")
    FS.write_parquet_partitioned(ind.indicators_batch(event_candles(spark, sf)), path, mode="append")
    return path


@query("append_unified_batch", f"{WITH_UNIFIED} SELECT {UNI_SELECT} FROM unified")
def q_append_batch(spark, sf):
    back = spark.read.parquet(written_unified(spark, sf))
    return round_doubles(back.select(*_UNI))


@query("scan_unified_all", f"""{WITH_UNIFIED} SELECT {UNI_SELECT} FROM unified
  WHERE symbol IN ('BTCUSDT', 'ETHUSDT', 'SOLUSDT') ORDER BY timestamp DESC""")
def q_scan_all(spark, sf):
    t = spark.read.parquet(written_unified(spark, sf))
    return round_doubles(t.where(F.col("symbol").isin(CORE_SYMBOLS)).orderBy(F.col("timestamp").desc()).select(*_UNI))


ML_COLS = ["timestamp", "symbol", "open", "high", "low", "close", "volume", "trades", "sma_20", "ema_50", "rsi_14",
           "macd", "macd_signal", "bb_upper", "bb_middle", "bb_lower"]


@query("scan_unified_ml", f"""{WITH_UNIFIED} SELECT """ + ", ".join(r(c) if c in _UNI_D else c for c in ML_COLS)
       + """ FROM unified WHERE symbol IN ('BTCUSDT', 'ETHUSDT', 'SOLUSDT') ORDER BY timestamp DESC""")
def q_scan_ml(spark, sf):
    t = spark.read.parquet(written_unified(spark, sf))
    return round_doubles(t.select(*ML_COLS).where(F.col("symbol").isin(CORE_SYMBOLS)).orderBy(F.col("timestamp").desc()))


@query("table_layout", f"{WITH_UNIFIED} SELECT date, count(*) AS n, count(DISTINCT symbol) AS n_symbols FROM unified GROUP BY date")
def q_layout(spark, sf):
    t = spark.read.parquet(written_unified(spark, sf))
    return t.groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("symbol").alias("n_symbols"))


@query("jsonl_sink", f"{WITH_UNIFIED} SELECT {UNI_SELECT} FROM unified")
def q_jsonl(spark, sf):
    path = FS.new_table_path(spark, "enriched_jsonl")
    u = unified(spark, sf)
    FS.write_jsonl(u, path)
    back = spark.read.schema(u.schema).option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").json(path)
    return round_doubles(back.select(*_UNI))


@query("overwrite_dimension", f"{WITH_CANDLES}, {DIM_SYMBOLS_SQL} SELECT * FROM dim_symbols")
def q_overwrite_dim(spark, sf):
    path = FS.new_table_path(spark, "dim_symboles")
    dim = D.dim_symbols(event_candles(spark, sf))
    FS.overwrite_table(dim, path)
    FS.overwrite_table(dim, path)  # reload: truncate-and-write again, no duplicates
    return spark.read.parquet(path)
