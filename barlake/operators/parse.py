"""Message parsing, validation, cleaning and quarantine (batch and stream).

Every step is a column expression over the raw payload, so the same
functions serve ``spark.read`` and ``spark.readStream`` frames.  Rows are
never dropped silently: :func:`validate_messages` tags each row with a
``reject_reason`` (NULL when accepted) and :func:`split_rejects` returns the
good rows and the quarantine rows (whole payload, plus a 200-char preview for logs).

Rules (stream cleaning):
* payload must be a JSON object, else ``parse``;
* open, close and volume must be present and non-zero and volume > 0,
  else ``missing`` (a value that does not read as a number gives ``cast``);
* event time = ``start_time`` if the key is present (a present null
  rejects), else ``event_time``; ISO-8601 (``T``, optional ``Z``/offset) or
  ``yyyy-MM-dd HH:mm:ss``; anything else gives ``timestamp``;
* high/low must read as numbers (``cast``); trades defaults to 0 only when
  the key is absent, a present null or non-integer gives ``cast``.
Timestamps are normalised to UTC wall-clock ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import tcast, time_parts

# Fixed field list of a closed-candle stream message.
MESSAGE_FIELDS = ["event_time", "symbol", "interval", "start_time", "close_time", "open", "high", "low",
                  "close", "volume", "quote_volume", "trades", "taker_buy_base", "taker_buy_quote"]
PRICE_FIELDS = ["open", "high", "low", "close", "volume"]
# Accepted time formats (besides the regex guards below).
ISO_RE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?$"
PLAIN_RE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
PREVIEW_CHARS = 200

MESSAGE_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in MESSAGE_FIELDS]
                              + [T.StructField("_corrupt", T.StringType())])


def parse_json_object(value: Column, schema: T.StructType = MESSAGE_SCHEMA) -> tuple[Column, Column]:
    """(parsed struct with string fields, key list) — keys NULL unless a JSON object."""
    txt = value.cast("string")
    m = F.from_json(txt, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return m, F.json_object_keys(txt)


def parse_time(s: Column) -> Column:
    """ISO-8601 or 'yyyy-MM-dd HH:mm:ss' text -> UTC timestamp_ntz; NULL otherwise."""
    iso = s.rlike(ISO_RE)
    plain = s.rlike(PLAIN_RE)
    ts = F.when(iso | plain, F.try_to_timestamp(F.when(iso, F.regexp_replace(s, "Z$", "+00:00")).otherwise(s)))
    return ts.cast("timestamp_ntz")


def _num(c: Column) -> Column:
    return tcast(c, "double")


def validate_messages(df: DataFrame, value: str = "value") -> DataFrame:
    """Parse payloads and add typed columns plus ``reject_reason``."""
    m, keys = parse_json_object(F.col(value))
    x = df.withColumn("__m", m).withColumn("__k", keys)
    has = lambda k: F.coalesce(F.array_contains("__k", F.lit(k)), F.lit(False))
    is_obj = F.col("__k").isNotNull() & F.col("__m").isNotNull() & F.col("__m._corrupt").isNull()
    num = {f: _num(F.col(f"__m.{f}")) for f in PRICE_FIELDS}
    raw = {f: F.col(f"__m.{f}") for f in PRICE_FIELDS}
    truthy = lambda f: raw[f].isNotNull() & (F.coalesce(num[f], F.lit(1.0)) != 0)
    bad_num = lambda f: raw[f].isNotNull() & num[f].isNull()
    present_missing = ~(truthy("open") & truthy("close") & truthy("volume"))
    time_txt = F.when(has("start_time"), F.col("__m.start_time")).otherwise(F.col("__m.event_time"))
    ts = parse_time(time_txt)
    trades_raw = F.col("__m.trades")
    trades = F.when(~has("trades"), F.lit(0).cast("bigint")).otherwise(tcast(trades_raw, "bigint"))
    reason = (F.when(~is_obj, F.lit("parse"))
              .when(truthy("open") & truthy("close") & bad_num("volume"), F.lit("cast"))
              .when(present_missing | (num["volume"] <= 0), F.lit("missing"))
              .when(ts.isNull(), F.lit("timestamp"))
              .when(bad_num("open") | bad_num("close") | num["high"].isNull() | num["low"].isNull(), F.lit("cast"))
              .when(trades.isNull(), F.lit("cast")))
    return (x.withColumn("timestamp", ts)
            .withColumn("symbol", F.col("__m.symbol"))
            .select("*", *[num[f].alias(f) for f in PRICE_FIELDS], trades.alias("trades"),
                    reason.alias("reject_reason"))
            .drop("__m", "__k"))


def split_rejects(validated: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantine rows with reason, the whole payload and a log preview)."""
    good = validated.where(F.col("reject_reason").isNull())
    bad = validated.where(F.col("reject_reason").isNotNull()).select(
        F.col("reject_reason"), F.col(value).cast("string").alias("payload"),
        F.substring(F.col(value).cast("string"), 1, PREVIEW_CHARS).alias("preview"), F.col("symbol"))
    return good, bad


def cleaned_candles(good: DataFrame) -> DataFrame:
    """Accepted messages -> cleaned candle rows (time parts, typed OHLCV)."""
    return good.select("timestamp", *time_parts("timestamp"), "symbol", *PRICE_FIELDS, "trades")


def clean_stream_rule(df: DataFrame) -> DataFrame:
    """Stream rule on typed candles: open, close non-zero, volume > 0."""
    return df.where((F.col("open") != 0) & (F.col("close") != 0) & (F.col("volume") > 0))


# ---- exchange payload shapes ---------------------------------------------------------------

# ``k`` carries case-distinct keys (t/T, v/V, q/Q), so it is read as a map:
# map lookups are case-sensitive whatever ``spark.sql.caseSensitive`` says.
KLINE_SCHEMA = T.StructType([T.StructField("E", T.LongType()),
                             T.StructField("k", T.MapType(T.StringType(), T.StringType()))])


def iso_millis(ms: Column) -> Column:
    """epoch ms -> ISO text (UTC wall clock, microsecond precision when needed)."""
    ts = F.timestamp_millis(ms).cast("timestamp_ntz")
    return F.when(F.unix_micros(F.timestamp_millis(ms)) % 1000000 == 0,
                  F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def flatten_kline_envelope(df: DataFrame, value: str = "value", closed_only: bool = True) -> DataFrame:
    """WebSocket kline envelope -> flat stream-message columns; messages without ``k`` dropped."""
    e = df.select(F.from_json(F.col(value).cast("string"), KLINE_SCHEMA).alias("m")).where(F.col("m.k").isNotNull())
    if closed_only:
        e = closed_candles_only(e)
    k = lambda f: F.col("m.k")[f]
    return e.select(iso_millis(F.col("m.E")).alias("event_time"), k("s").alias("symbol"), k("i").alias("interval"),
                    iso_millis(tcast(k("t"), "bigint")).alias("start_time"),
                    iso_millis(tcast(k("T"), "bigint")).alias("close_time"),
                    _num(k("o")).alias("open"), _num(k("h")).alias("high"), _num(k("l")).alias("low"),
                    _num(k("c")).alias("close"), _num(k("v")).alias("volume"), _num(k("q")).alias("quote_volume"),
                    tcast(k("n"), "bigint").alias("trades"), _num(k("V")).alias("taker_buy_base"), _num(k("Q")).alias("taker_buy_quote"))


def closed_candles_only(envelopes: DataFrame) -> DataFrame:
    return envelopes.where(F.coalesce(F.lower(F.col("m.k")["x"]) == "true", F.lit(False)))


KLINE_POSITIONS = ["open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "trades",
                   "taker_buy_base", "taker_buy_quote", "ignore"]


def kline_arrays_to_rows(df: DataFrame, value: str = "value", symbol: str = "symbol") -> DataFrame:
    """REST response (JSON array of 12-position arrays) -> typed historical rows."""
    a = df.select(F.col(symbol).alias("symbol"),
                  F.explode(F.from_json(F.col(value), "array<array<string>>")).alias("k"))
    g = lambda i: F.get(F.col("k"), i)
    return a.select("symbol",
                    F.timestamp_millis(tcast(g(0), "bigint")).cast("timestamp_ntz").alias("open_time"),
                    *[_num(g(i)).alias(n) for i, n in [(1, "open"), (2, "high"), (3, "low"), (4, "close"), (5, "volume")]],
                    _num(g(7)).alias("quote_volume"), tcast(g(8), "bigint").alias("trades"),
                    _num(g(9)).alias("taker_buy_base"), _num(g(10)).alias("taker_buy_quote"))


def format_for_warehouse(df: DataFrame, required: list[str]) -> DataFrame:
    """Fixed 21-column types; rows with a NULL in a required column are dropped."""
    from .indicators import UNIFIED_COLS
    types = {"timestamp": "timestamp_ntz", "date": "date", "hour": "bigint", "day_of_week": "string",
             "symbol": "string", "trades": "bigint", "source": "string", "ingestion_timestamp": "timestamp"}
    out = df.select(*[F.col(c).cast(types.get(c, "double")).alias(c) for c in UNIFIED_COLS])
    cond = None
    for c in required:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return out.where(cond) if cond is not None else out
