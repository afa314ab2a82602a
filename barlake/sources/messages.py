"""Payload adapters: candle rows -> the exchange / stream payload shapes.

Used to feed the parse operators with data derived from the driver tables:
* stream message (flat JSON object, ISO times, numbers as JSON numbers);
* WebSocket kline envelope (``E`` + nested ``k``, prices as strings), the
  latest bar of each symbol still open (``x = false``);
* REST kline response: one JSON array of 12-position arrays per symbol and day.
Derived money columns: quote volume = volume * close, taker buy = half of each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.joins import checked_broadcast

INTERVAL_MS = {"5m": 300_000, "1h": 3_600_000, "1d": 86_400_000}


def _ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def with_payload_fields(candles: DataFrame, interval: str = "1h") -> DataFrame:
    step = INTERVAL_MS[interval]
    return (candles
            .withColumn("open_ms", _ms(F.col("timestamp")))
            .withColumn("close_ms", F.col("open_ms") + F.lit(step - 1))
            .withColumn("quote_volume", F.col("volume") * F.col("close"))
            .withColumn("taker_buy_base", F.col("volume") / 2)
            .withColumn("taker_buy_quote", F.col("quote_volume") / 2))


def stream_messages(candles: DataFrame, interval: str = "1h") -> DataFrame:
    """One flat JSON message per candle in column ``value`` (plus the symbol attribute)."""
    from ..operators.parse import iso_millis
    x = with_payload_fields(candles, interval)
    body = F.struct(iso_millis(F.col("close_ms")).alias("event_time"), F.col("symbol"), F.lit(interval).alias("interval"),
                    iso_millis(F.col("open_ms")).alias("start_time"), iso_millis(F.col("close_ms")).alias("close_time"),
                    "open", "high", "low", "close", "volume", "quote_volume", "trades", "taker_buy_base",
                    "taker_buy_quote")
    return x.select(F.col("symbol"), F.to_json(body).alias("value"))


def kline_envelopes(candles: DataFrame, interval: str = "1h") -> DataFrame:
    """WebSocket envelopes; the last bar of each symbol is still open (x = false)."""
    x = with_payload_fields(candles, interval)
    last = x.groupBy("symbol").agg(F.max("timestamp").alias("__last"))
    x = x.join(checked_broadcast(last), "symbol")
    s = lambda c: F.col(c).cast("string")
    k = F.struct(F.col("symbol").alias("s"), F.lit(interval).alias("i"), F.col("open_ms").alias("t"),
                 F.col("close_ms").alias("T"), s("open").alias("o"), s("high").alias("h"), s("low").alias("l"),
                 s("close").alias("c"), s("volume").alias("v"), s("quote_volume").alias("q"),
                 F.col("trades").alias("n"), s("taker_buy_base").alias("V"), s("taker_buy_quote").alias("Q"),
                 (F.col("timestamp") < F.col("__last")).alias("x"))
    return x.select(F.to_json(F.struct(F.col("close_ms").alias("E"), k.alias("k"))).alias("value"))


def kline_responses(candles: DataFrame, interval: str = "1h") -> DataFrame:
    """One REST response per (symbol, day): JSON array of 12-position kline arrays."""
    x = with_payload_fields(candles, interval)
    s = lambda c: F.col(c).cast("string")
    arr = F.array(s("open_ms"), s("open"), s("high"), s("low"), s("close"), s("volume"), s("close_ms"),
                  s("quote_volume"), s("trades"), s("taker_buy_base"), s("taker_buy_quote"), F.lit("0"))
    g = (x.select("symbol", F.to_date("timestamp").alias("day"), "open_ms", arr.alias("k"))
         .groupBy("symbol", "day").agg(F.sort_array(F.collect_list(F.struct("open_ms", "k"))).alias("ks")))
    return g.select("symbol", "day", F.to_json(F.transform("ks", lambda e: e["k"])).alias("value"))


def tick_messages(events: DataFrame) -> DataFrame:
    """One flat message per event: price = value, volume = props.k, one trade.

    Events whose ``k`` is 0 carry a zero volume and are rejected by the
    stream cleaning rule, which exercises the quarantine path on real rows.
    """
    from ..functions.exprs import tcast
    from .adapters import EVENT_SYMBOLS
    sym = F.create_map(*[F.lit(x) for kv in EVENT_SYMBOLS.items() for x in kv])[F.col("event_type")]
    ts = F.col("ts")
    iso = F.when(F.date_format(ts, "SSSSSS") == "000000", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")) \
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    body = F.struct(F.col("event_id"), sym.alias("symbol"), iso.alias("start_time"), F.col("value").alias("open"),
                    F.col("value").alias("high"), F.col("value").alias("low"), F.col("value").alias("close"),
                    tcast(F.get_json_object("props", "$.k"), "double").alias("volume"),
                    F.lit(1).alias("trades"))
    return events.select("event_id", F.to_json(body).alias("value"))


# Fixed attribute defaults of published messages.
DEFAULT_SYMBOL_ATTR, DEFAULT_INTERVAL_ATTR, SOURCE_ATTR = "UNKNOWN", "5m", "binance-websocket"


def publish_frame(messages: DataFrame) -> DataFrame:
    """Messages -> Kafka-shaped rows: key, JSON value, attribute map and headers.

    ``timestamp`` is the publish time.  Write with
    ``df.write.format("kafka")`` / ``writeStream.format("kafka")`` or to files.
    """
    v = F.col("value")
    attrs = F.create_map(
        F.lit("symbol"), F.coalesce(F.get_json_object(v, "$.symbol"), F.lit(DEFAULT_SYMBOL_ATTR)),
        F.lit("interval"), F.coalesce(F.get_json_object(v, "$.interval"), F.lit(DEFAULT_INTERVAL_ATTR)),
        F.lit("source"), F.lit(SOURCE_ATTR),
        F.lit("timestamp"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    out = messages.select(F.get_json_object(v, "$.symbol").alias("key"), v.alias("value"), attrs.alias("attributes"))
    return out.withColumn("headers", F.transform(F.map_entries("attributes"),
                                                 lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value"))))
