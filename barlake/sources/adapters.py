"""Turn the driver tables into candle series.

``events``  -> hourly bars per event type (a few hot symbols).
``lineitem`` -> daily bars per supplier (many symbols) for benchmarks.

Both are plain ``groupBy`` aggregations with map-side partial aggregation;
open/close use ``min_by``/``max_by`` on a total order so results are exact.
The order is one packed DECIMAL key, which keeps the hash aggregate (a struct
key would force a sort-based aggregate over every input row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import packed_order
from ..session import table

# Fixed mapping of event types to candle symbols.
EVENT_SYMBOLS = {
    "click": "BTCUSDT",
    "view": "ETHUSDT",
    "purchase": "SOLUSDT",
    "signup": "ADAUSDT",
    "error": "XRPUSDT",
}

CANDLE_COLS = ["symbol", "timestamp", "open", "high", "low", "close", "volume", "trades"]


def _symbol_of(event_type):
    m = F.create_map(*[F.lit(x) for kv in EVENT_SYMBOLS.items() for x in kv])
    return m[event_type]


def candles_from_events(events: DataFrame, unit: str = "hour") -> DataFrame:
    order = packed_order(F.unix_micros(F.col("ts").cast("timestamp")), "event_id")   # total order (ts, event_id)
    return (events
            .select(_symbol_of(F.col("event_type")).alias("symbol"),
                    F.date_trunc(unit, "ts").cast("timestamp_ntz").alias("timestamp"),
                    "ts", "event_id", "value")
            .groupBy("symbol", "timestamp")
            .agg(F.min_by("value", order).alias("open"),
                 F.max("value").alias("high"),
                 F.min("value").alias("low"),
                 F.max_by("value", order).alias("close"),
                 F.sum("value").alias("volume"),
                 F.count(F.lit(1)).alias("trades")))


def candles_from_lineitem(lineitem: DataFrame) -> DataFrame:
    order = packed_order("l_orderkey", "l_linenumber", 32)                           # (l_orderkey, l_linenumber)
    return (lineitem
            .select(F.col("l_suppkey").cast("string").alias("symbol"),
                    F.col("l_shipdate").alias("timestamp"),
                    (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
                    F.col("l_quantity"), "l_orderkey", "l_linenumber")
            .groupBy("symbol", "timestamp")
            .agg(F.min_by("price", order).alias("open"),
                 F.max("price").alias("high"),
                 F.min("price").alias("low"),
                 F.max_by("price", order).alias("close"),
                 F.sum("l_quantity").alias("volume"),
                 F.count(F.lit(1)).alias("trades")))


def event_candles(spark, sf_dir: str) -> DataFrame:
    return candles_from_events(table(spark, sf_dir, "events"))


def supplier_candles(spark, sf_dir: str) -> DataFrame:
    return candles_from_lineitem(table(spark, sf_dir, "lineitem"))


# DuckDB text of the same adapters, used by the oracle queries.
SQL_EVENT_CANDLES = """
SELECT CASE event_type WHEN 'click' THEN 'BTCUSDT' WHEN 'view' THEN 'ETHUSDT'
         WHEN 'purchase' THEN 'SOLUSDT' WHEN 'signup' THEN 'ADAUSDT'
         WHEN 'error' THEN 'XRPUSDT' END AS symbol,
       date_trunc('hour', ts) AS timestamp,
       arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
       arg_max(value, (ts, event_id)) AS close, sum(value) AS volume,
       count(*) AS trades
FROM events GROUP BY 1, 2
"""

SQL_SUPPLIER_CANDLES = """
SELECT CAST(l_suppkey AS VARCHAR) AS symbol, l_shipdate AS timestamp,
       arg_min(l_extendedprice / l_quantity, (l_orderkey, l_linenumber)) AS open,
       max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low,
       arg_max(l_extendedprice / l_quantity, (l_orderkey, l_linenumber)) AS close,
       sum(l_quantity) AS volume, count(*) AS trades
FROM lineitem GROUP BY 1, 2
"""
