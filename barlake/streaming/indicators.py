"""Stream-mode indicators: NULL warm-up, population sigma, 2-dp rounding.

The streaming path computes, for candle number ``i`` of a symbol (0-based):
rsi_14 (i >= 14, 14 changes, no loss -> 100), sma_20 (i >= 19), ema_50 /
ema_12 / ema_26 (simple means, i >= p - 1), macd = ema_12 - ema_26 when both
are non-zero, macd_signal (i >= 35, mean of the last 9 macd values) and
Bollinger bands over 20 closes with the population sigma.  Values are
rounded to 2 dp ("half up" on the decimal value; the rounding differs from
binary half-even rounding by at most 0.01 on exact ties).

Four physical forms, same numbers:
* :func:`stream_indicators` - batch / backfill form with windows and a global
  row index (chunk-parallel, exact);
* :func:`indicators_per_group` - per (symbol, window) lists with higher-order
  functions, for groups known to be small;
* :mod:`barlake.streaming.window_groups` - the window form inside the windows of a stream;
* :mod:`barlake.streaming.tails` - the window form over each micro-batch and the last candles before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import rows, series_window
from ..plans.chunked import ChunkLayout, chunked_window

STREAM_LOOKBACK = 49
STREAM_COLS = ["sma_20", "ema_50", "rsi_14", "macd", "macd_signal", "bb_upper", "bb_middle", "bb_lower"]


def round2(c: Column) -> Column:
    """Half-up to 2 dp on the value first settled at 10 dp (engine-independent)."""
    return F.round(F.round(c, 10), 2)


def round2_sql(e: str) -> str:
    return f"CAST(round(CAST({e} AS DECIMAL(38, 10)), 2) AS DOUBLE)"


def _stream_columns(df: DataFrame, part: list[str], idx: str = "row_idx") -> DataFrame:
    w = series_window(part, "timestamp")
    i = F.col(idx)
    mean = lambda p: F.avg("close").over(rows(w, p - 1))
    chg = F.col("close") - F.lag("close").over(w)
    x = (df.withColumn("__g", F.when(chg > 0, chg).otherwise(F.lit(0.0)))
         .withColumn("__l", F.when(chg > 0, F.lit(0.0)).otherwise(F.abs(chg))))
    ag, al = F.avg("__g").over(rows(w, 13)), F.avg("__l").over(rows(w, 13))
    x = x.withColumn("__ag", ag).withColumn("__al", al)
    rsi = F.when(F.col("__al") == 0, F.lit(100.0)).otherwise(
        round2(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + F.col("__ag") / F.col("__al"))))
    x = (x.withColumn("rsi_14", F.when(i >= 14, rsi))
         .withColumn("sma_20", F.when(i >= 19, round2(mean(20))))
         .withColumn("ema_50", F.when(i >= 49, round2(mean(50))))
         .withColumn("__e12", F.when(i >= 11, round2(mean(12))))
         .withColumn("__e26", F.when(i >= 25, round2(mean(26))))
         .withColumn("macd", F.when((F.col("__e12") != 0) & (F.col("__e26") != 0), F.col("__e12") - F.col("__e26")))
         .withColumn("__mid", mean(20)).withColumn("__sd", F.stddev_pop("close").over(rows(w, 19))))
    sig = F.when(F.count("macd").over(rows(w, 8)) == 9, round2(F.avg("macd").over(rows(w, 8))))
    x = (x.withColumn("macd_signal", F.when(i >= 35, sig))
         .withColumn("bb_middle", F.when(i >= 19, round2(F.col("__mid"))))
         .withColumn("bb_upper", F.when(i >= 19, round2(F.col("__mid") + 2 * F.col("__sd"))))
         .withColumn("bb_lower", F.when(i >= 19, round2(F.col("__mid") - 2 * F.col("__sd")))))
    return x.drop("__g", "__l", "__ag", "__al", "__e12", "__e26", "__mid", "__sd")


def stream_indicators(candles: DataFrame, layout: ChunkLayout | None = None, **chunking) -> DataFrame:
    """Stream-mode indicator columns over whole per-symbol histories (batch form)."""
    out = chunked_window(candles, ["symbol"], "timestamp", STREAM_LOOKBACK, _stream_columns,
                         layout=layout, index="row_idx", **chunking)
    return out.drop("row_idx")


# ---- per-group higher-order-function form ----------------------------------------------

def _mean(p: int, i: str = "i") -> str:
    return f"(aggregate(slice(c, {i} - {p} + 2, {p}), 0D, (a, x) -> a + x) / {p})"


def _r2(e: str) -> str:
    return f"round(round({e}, 10), 2)"


def group_lists(df: DataFrame, group_cols: list[str]) -> DataFrame:
    """One time-sorted list of candles per group (the state a streaming window keeps)."""
    other = [c for c in df.columns if c not in group_cols and c != "timestamp"]
    return df.groupBy(*group_cols).agg(F.array_sort(F.collect_list(F.struct("timestamp", *other))).alias("rs"))


def indicators_per_group(df: DataFrame, group_cols: list[str]) -> DataFrame:
    """Indicators for each candle of each group, computed on the group's sorted list.

    ``df`` holds one row per candle (timestamp, close, ...) plus ``group_cols``
    (e.g. symbol and a window start).  Each group is one bounded list (a
    window of candles), sorted by time, and turned back into rows with
    ``explode``.
    """
    return expand_group_lists(group_lists(df, group_cols), group_cols)


def expand_group_lists(g: DataFrame, group_cols: list[str]) -> DataFrame:
    """Sorted candle lists (column ``rs``) -> one row per candle with its indicators."""
    g = g.withColumn("c", F.expr("transform(rs, r -> r.close)"))
    gains = "aggregate(sequence(i - 12, i + 1), 0D, (a, j) -> a + greatest(element_at(c, j) - element_at(c, j - 1), 0D))"
    losses = ("aggregate(sequence(i - 12, i + 1), 0D, (a, j) -> a + "
              "IF(element_at(c, j) - element_at(c, j - 1) > 0, 0D, abs(element_at(c, j) - element_at(c, j - 1))))")
    e12 = lambda v: f"IF({v} < 11, NULL, {_r2(_mean(12, v))})"
    e26 = lambda v: f"IF({v} < 25, NULL, {_r2(_mean(26, v))})"
    macd_at = lambda v: f"IF({e12(v)} != 0 AND {e26(v)} != 0, {e12(v)} - {e26(v)}, NULL)"
    sig = (f"IF(i < 35, NULL, IF(size(filter(transform(sequence(i - 8, i), j -> {macd_at('j')}), x -> x IS NOT NULL)) < 9, NULL, "
           f"{_r2('aggregate(transform(sequence(i - 8, i), j -> ' + macd_at('j') + '), 0D, (a, x) -> a + x) / 9')}))")
    mid = _mean(20)
    var = f"(aggregate(slice(c, i - 18, 20), 0D, (a, x) -> a + (x - {mid}) * (x - {mid})) / 20)"
    rsi = (f"IF(i < 14, NULL, IF(({losses}) / 14 = 0, 100D, "
           f"{_r2(f'100 - 100 / (1 + (({gains}) / 14) / (({losses}) / 14))')}))")
    per = (f"transform(sequence(0, size(c) - 1), i -> struct(element_at(rs, i + 1) AS r, "
           f"IF(i < 19, NULL, {_r2(mid)}) AS sma_20, IF(i < 49, NULL, {_r2(_mean(50))}) AS ema_50, {rsi} AS rsi_14, "
           f"{macd_at('i')} AS macd, {sig} AS macd_signal, "
           f"IF(i < 19, NULL, {_r2(f'{mid} + 2 * sqrt({var})')}) AS bb_upper, IF(i < 19, NULL, {_r2(mid)}) AS bb_middle, "
           f"IF(i < 19, NULL, {_r2(f'{mid} - 2 * sqrt({var})')}) AS bb_lower))")
    out = g.select(*group_cols, F.explode(F.expr(per)).alias("e"))
    return out.select(*group_cols, "e.r.*", *[F.col(f"e.{c}").alias(c) for c in STREAM_COLS])


def stream_indicator_sql(src: str, part: str = "symbol") -> str:
    """DuckDB text of the stream-mode indicators over relation ``src`` (CTE list)."""
    w = f"PARTITION BY {part} ORDER BY timestamp"
    m = lambda p: f"avg(close) OVER ({w} ROWS BETWEEN {p - 1} PRECEDING AND CURRENT ROW)"
    return f"""
    s0 AS (SELECT *, row_number() OVER ({w}) - 1 AS idx, close - lag(close) OVER ({w}) AS chg FROM {src}),
    s1 AS (SELECT *, CASE WHEN chg > 0 THEN chg ELSE 0 END AS g, CASE WHEN chg > 0 THEN 0 ELSE abs(chg) END AS l FROM s0),
    s2 AS (SELECT *, avg(g) OVER ({w} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS ag,
             avg(l) OVER ({w} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS al,
             {m(20)} AS mid, stddev_pop(close) OVER ({w} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS sd,
             CASE WHEN idx >= 11 THEN {round2_sql(m(12))} END AS e12,
             CASE WHEN idx >= 25 THEN {round2_sql(m(26))} END AS e26,
             CASE WHEN idx >= 49 THEN {round2_sql(m(50))} END AS ema_50 FROM s1),
    s3 AS (SELECT *, CASE WHEN e12 <> 0 AND e26 <> 0 THEN e12 - e26 END AS macd FROM s2),
    stream_ind AS (SELECT *,
             CASE WHEN idx >= 14 THEN (CASE WHEN al = 0 THEN 100 ELSE {round2_sql('100 - 100 / (1 + ag / al)')} END) END AS rsi_14,
             CASE WHEN idx >= 19 THEN {round2_sql('mid')} END AS sma_20,
             CASE WHEN idx >= 35 AND count(macd) OVER ({w} ROWS BETWEEN 8 PRECEDING AND CURRENT ROW) = 9
                  THEN {round2_sql(f'avg(macd) OVER ({w} ROWS BETWEEN 8 PRECEDING AND CURRENT ROW)')} END AS macd_signal,
             CASE WHEN idx >= 19 THEN {round2_sql('mid + 2 * sd')} END AS bb_upper,
             CASE WHEN idx >= 19 THEN {round2_sql('mid')} END AS bb_middle,
             CASE WHEN idx >= 19 THEN {round2_sql('mid - 2 * sd')} END AS bb_lower FROM s3)"""
