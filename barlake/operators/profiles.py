"""Aggregations over unified rows: overviews, quality checks, profiles, stats.

All are ``groupBy``/``agg`` plans with map-side partial aggregation; exact
quantiles go through :mod:`barlake.plans.quantiles` (no per-group task), and
per-series steps (returns, running max) through the chunked plans.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import (WEEKDAYS_MONDAY_FIRST, base_asset, equal_width_bin, sample_kurtosis,
                               sample_skewness, trading_session)
from ..plans.chunked import plan_chunks
from ..plans.joins import checked_broadcast, null_safe_join
from ..plans.quantiles import MAX_BUFFERED_GROUP, exact_quantiles
from . import series as S

NUMERIC_COLS = ["hour", "open", "high", "low", "close", "volume", "trades", "sma_20", "ema_50", "rsi_14",
                "macd", "macd_signal", "bb_upper", "bb_middle", "bb_lower"]
CORR_COLS = ["open", "high", "low", "close", "volume", "trades", "rsi_14", "macd", "macd_signal"]


def count_by_symbol(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))


def dataset_overview(df: DataFrame) -> DataFrame:
    return (df.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("symbol").alias("n_symbols"),
                   F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"))
            .withColumn("span_days", F.timestamp_diff("DAY", F.col("first_ts"), F.col("last_ts"))))


def symbol_overview(df: DataFrame) -> DataFrame:
    return (df.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rows"), F.min("timestamp").alias("first_ts"),
                                     F.max("timestamp").alias("last_ts"))
            .withColumn("span_days", F.timestamp_diff("DAY", F.col("first_ts"), F.col("last_ts"))))


def _long(df: DataFrame, cols: list[str], name: str = "column_name", value: str = "value") -> DataFrame:
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value))
                                         for c in cols])).alias("__kv")).select("__kv.*")


def describe_numeric(df: DataFrame, cols: list[str] = NUMERIC_COLS) -> DataFrame:
    """count/mean/std/min/25%/50%/75%/max per numeric column (exact quartiles)."""
    long = _long(df, cols)
    base = long.groupBy("column_name").agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
                                      F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                                      F.max("value").alias("max"))
    q = exact_quantiles(long, ["column_name"], "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return base.join(q, "column_name", "left")


def null_profile(df: DataFrame) -> DataFrame:
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = agg.select("__n", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null"))
                                                 for c in cols])).alias("kv")).select("__n", "kv.*")
    return (long.where(F.col("n_null") > 0)
            .select("column_name", "n_null", (F.col("n_null") / F.col("__n") * 100).alias("pct_null")))


def duplicate_full_rows(df: DataFrame) -> DataFrame:
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__c"))
    return g.agg(F.coalesce(F.sum(F.col("__c") - 1), F.lit(0)).alias("n_duplicates"))


def duplicate_keys(df: DataFrame, keys=("timestamp", "symbol")) -> DataFrame:
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__c"))
    return g.agg(F.coalesce(F.sum(F.col("__c") - 1), F.lit(0)).alias("n_duplicate_keys"))


def ohlcv_consistency(df: DataFrame) -> DataFrame:
    c = F.col
    return df.agg(F.count_if(c("high") < c("low")).alias("high_lt_low"),
                  F.count_if((c("close") < c("low")) | (c("close") > c("high"))).alias("close_outside_range"),
                  F.count_if(c("volume") < 0).alias("negative_volume"),
                  F.count_if((c("rsi_14") < 0) | (c("rsi_14") > 100)).alias("rsi_out_of_range"))


def symbol_stats(df: DataFrame) -> DataFrame:
    r = S.with_returns(df.select("symbol", "timestamp", "close", "volume", "trades", "rsi_14"))
    first, last = F.min_by("close", "timestamp"), F.max_by("close", "timestamp")
    return (r.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"), F.avg("close").alias("mean_close"), F.min("close").alias("min_close"),
        F.max("close").alias("max_close"), F.stddev_samp("close").alias("std_close"),
        F.avg("volume").alias("mean_volume"), F.avg("trades").alias("mean_trades"),
        F.avg("rsi_14").alias("mean_rsi"), F.avg("ret_pct").alias("mean_return_pct"),
        ((last / first - 1) * 100).alias("total_return_pct"))
        .withColumn("asset", base_asset("symbol")))


def symbol_risk(df: DataFrame) -> DataFrame:
    x = df.select("symbol", "timestamp", "open", "high", "low", "close", "rsi_14", "macd", "macd_signal")
    lay = plan_chunks(x, ["symbol"], "timestamp")      # one layout for the three per-series steps
    x = S.drawdown(S.macd_bullish_cross(S.with_returns(x, layout=lay), layout=lay), layout=lay)
    g = x.groupBy("symbol").agg(
        F.avg("ret_pct").alias("__m"), F.stddev_samp("ret_pct").alias("__s"),
        F.min("drawdown_pct").alias("max_drawdown_pct"),
        F.count_if(F.col("rsi_14") < 30).alias("n_rsi_below_30"),
        F.count_if(F.col("rsi_14") > 70).alias("n_rsi_above_70"),
        F.count_if("bullish_cross").alias("n_macd_bullish"),
        F.avg((F.col("high") - F.col("low")) / F.col("open") * 100).alias("mean_intraday_vol_pct"))
    sharpe = F.when(F.col("__s") > 0, F.col("__m") / F.col("__s")).otherwise(F.lit(0.0))
    return g.withColumn("sharpe", sharpe).drop("__m", "__s").withColumn("asset", base_asset("symbol"))


def hourly_profile(df: DataFrame) -> DataFrame:
    return df.groupBy("hour").agg(F.avg("close").alias("mean_close"), F.avg("volume").alias("mean_volume"),
                                  F.avg("trades").alias("mean_trades"), F.avg("rsi_14").alias("mean_rsi"))


def top_hours_by_volume(df: DataFrame, k: int = 5) -> DataFrame:
    return hourly_profile(df).orderBy(F.col("mean_volume").desc(), F.col("hour")).limit(k)


def weekday_spine(spark) -> DataFrame:
    """The 7 weekday labels with their Monday-first position (fixed, 7 rows)."""
    return spark.createDataFrame([(d, i) for i, d in enumerate(WEEKDAYS_MONDAY_FIRST)], "day_of_week string, day_order int")


def weekday_profile(df: DataFrame) -> DataFrame:
    g = df.groupBy("day_of_week").agg(F.avg("close").alias("mean_close"), F.stddev_samp("close").alias("std_close"),
                                      F.avg("volume").alias("mean_volume"), F.avg("trades").alias("mean_trades"))
    return reindex_spine(g, weekday_spine(df.sparkSession), "day_of_week", "day_order")


def reindex_spine(df: DataFrame, spine: DataFrame, key: str, order: str, per: list[str] | None = None) -> DataFrame:
    """pandas ``reindex``: every spine label once (per group of ``per``), in spine order, missing -> NULL."""
    if not per:
        return F.broadcast(spine).join(df, key, "left").orderBy(order)
    labels = [F.struct(*[F.lit(v).alias(c) for c, v in row.asDict().items()]) for row in spine.collect()]   # a fixed short list
    every = df.select(*per).distinct().select(*per, F.explode(F.array(*labels)).alias("__s")).select(*per, "__s.*")
    return null_safe_join(every, df, [*per, key], "left").orderBy(*per, order)


def by_symbol_hour(df: DataFrame, expr, name: str) -> DataFrame:
    return df.groupBy("symbol", "hour").agg(F.avg(expr).alias(name))


def weekday_price_by_symbol(df: DataFrame) -> DataFrame:
    return df.groupBy("symbol").pivot("day_of_week", WEEKDAYS_MONDAY_FIRST).agg(F.avg("close"))


def daily_volume(df: DataFrame, how: str = "mean") -> DataFrame:
    """``resample('D')`` per symbol over its own first..last day; empty days NULL (mean) or 0 (sum)."""
    d = df.select("symbol", F.to_date("timestamp").alias("date"), "volume")
    agg = F.avg("volume") if how == "mean" else F.sum("volume")
    daily = d.groupBy("symbol", "date").agg(agg.alias(f"{how}_volume"))
    spine = (d.groupBy("symbol").agg(F.min("date").alias("d0"), F.max("date").alias("d1"))
             .select("symbol", F.explode(F.sequence("d0", "d1", F.expr("INTERVAL 1 DAY"))).alias("date")))
    out = spine.join(daily, ["symbol", "date"], "left")
    if how == "sum":
        out = out.withColumn("sum_volume", F.coalesce(F.col("sum_volume"), F.lit(0.0)))
    return out


def volume_total(df: DataFrame) -> DataFrame:
    return (df.groupBy("symbol").agg(F.sum("volume").alias("total_volume"))
            .withColumn("asset", base_asset("symbol")).orderBy(F.col("total_volume").desc()))


def return_stats(df: DataFrame) -> DataFrame:
    x = df.select("symbol", "timestamp", "close")
    lay = plan_chunks(x, ["symbol"], "timestamp")
    r = S.with_returns(x, layout=lay)
    v = F.col("ret_pct")
    stats = [F.avg(v).alias("mean_ret"), F.stddev_samp(v).alias("std_ret"), F.min(v).alias("min_ret"),
             F.max(v).alias("max_ret"), sample_skewness(v).alias("skewness"), sample_kurtosis(v).alias("kurtosis"),
             F.count_if(v > 0).alias("n_positive"), F.count_if(v < 0).alias("n_negative")]
    if lay.max_rows <= MAX_BUFFERED_GROUP:
        # every symbol's returns fit one bounded buffer: the median joins the same single pass
        g = r.groupBy("symbol").agg(*stats, F.percentile(v, 0.5).alias("median_ret"))
    else:
        g = r.groupBy("symbol").agg(*stats).join(
            exact_quantiles(r, ["symbol"], "ret_pct", {"median_ret": 0.5}), "symbol", "left")
    return g.withColumn("asset", base_asset("symbol"))


def corr_long(df: DataFrame, cols: list[str], a_name: str = "col_a", b_name: str = "col_b") -> DataFrame:
    """Pairwise-complete Pearson matrix in long form; NULL for zero variance.

    Every row gives its unique pairs (i <= j) with both values present, and
    one set of three aggregates per pair is summed map-side: the number of
    aggregate buffers does not grow with the columns.  Each off-diagonal value
    is emitted for both orders.
    """
    value = {c: F.col(c).cast("double") for c in cols}
    pairs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), value[a].alias("x"), value[b].alias("y"))
                      for i, a in enumerate(cols) for b in cols[i:]])
    both = F.filter(pairs, lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    g = df.select(F.explode(both).alias("p")).groupBy("p.a", "p.b").agg(
        F.covar_pop("p.x", "p.y").alias("c"), F.stddev_pop("p.x").alias("sx"), F.stddev_pop("p.y").alias("sy"))
    g = g.select("a", "b", F.try_divide("c", F.col("sx") * F.col("sy")).alias("corr"))
    # pairs without a common row stay in the matrix
    grid = df.sparkSession.createDataFrame([(a, b) for i, a in enumerate(cols) for b in cols[i:]], "a string, b string")
    g = F.broadcast(grid).join(g, ["a", "b"], "left")                       # len(cols)^2 rows
    both_orders = F.array_distinct(F.array(F.struct(F.col("a").alias(a_name), F.col("b").alias(b_name)),
                                           F.struct(F.col("b").alias(a_name), F.col("a").alias(b_name))))
    return g.select(F.explode(both_orders).alias("k"), "corr").select("k.*", "corr")


def feature_corr_matrix(df: DataFrame) -> DataFrame:
    return corr_long(df, CORR_COLS)


def pivot_close(df: DataFrame, symbols: list[str]) -> DataFrame:
    return df.groupBy("timestamp").pivot("symbol", symbols).agg(F.avg("close"))


def price_corr_matrix(df: DataFrame, symbols: list[str]) -> DataFrame:
    return corr_long(pivot_close(df, symbols), symbols, "sym_a", "sym_b")


def pivot_returns_ffill(df: DataFrame, symbols: list[str]) -> DataFrame:
    """pandas ``pivot.pct_change()`` (forward-filled) then ``dropna()``.

    With forward fill a symbol absent at t has return 0 once it has been
    seen, its own pct_change when present, and NULL up to its first row; so
    the kept grid rows are those after every symbol's first timestamp.
    """
    r = S.with_returns(df.select("symbol", "timestamp", "close").where(F.col("symbol").isin(symbols)), "ret", scale=None)
    start = (r.groupBy("symbol").agg(F.min("timestamp").alias("t0"))
             .agg(F.max("t0").alias("__start")).withColumn("__k", F.lit(1)))
    p = r.groupBy("timestamp").pivot("symbol", symbols).agg(F.first("ret")).withColumn("__k", F.lit(1))
    p = p.join(F.broadcast(start), "__k", "inner")
    p = p.where(F.col("timestamp") > F.col("__start")).drop("__start", "__k")
    return p.select("timestamp", *[F.coalesce(F.col(s), F.lit(0.0)).alias(s) for s in symbols])


def return_corr_matrix(df: DataFrame, symbols: list[str]) -> DataFrame:
    return corr_long(pivot_returns_ffill(df, symbols), symbols, "sym_a", "sym_b")


def regime_stats(df: DataFrame) -> DataFrame:
    reg = S.volatility_regime(df.select("symbol", "timestamp", "close"))
    return reg.groupBy("symbol", "regime").agg(F.avg("ret_pct").alias("mean_ret"),
                                               F.stddev_samp("ret_pct").alias("std_ret"),
                                               F.count("ret_pct").alias("n_periods"))


def session_stats(df: DataFrame) -> DataFrame:
    r = S.with_returns(df.select("symbol", "timestamp", "hour", "close", "volume", "trades"))
    return (r.withColumn("session", trading_session("hour"))
            .groupBy("symbol", "session").agg(F.avg("ret_pct").alias("mean_ret"), F.stddev_samp("ret_pct").alias("std_ret"),
                                              F.avg("volume").alias("mean_volume"), F.avg("trades").alias("mean_trades")))


def histogram(df: DataFrame, value: str, nbins: int) -> DataFrame:
    """Equal-width histogram per symbol over the symbol's [min, max]; non-empty bins."""
    x = df.select("symbol", F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    mm = x.groupBy("symbol").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    b = x.join(checked_broadcast(mm), "symbol").withColumn("bin", equal_width_bin("v", "lo", "hi", nbins))
    return b.groupBy("symbol", "bin").agg(F.count(F.lit(1)).alias("n"))


def boxplot_stats(df: DataFrame, value: str = "close") -> DataFrame:
    q = exact_quantiles(df, ["symbol"], value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    lo, hi = F.col("q1") - 1.5 * F.col("iqr"), F.col("q3") + 1.5 * F.col("iqr")
    v = F.col(value)
    w = (df.join(checked_broadcast(q), "symbol")
         .groupBy("symbol").agg(F.min(F.when(v >= lo, v)).alias("whisker_low"),
                                F.max(F.when(v <= hi, v)).alias("whisker_high"),
                                F.count_if((v < lo) | (v > hi)).alias("n_outliers")))
    return q.join(w, "symbol")


def quantile_thresholds(df: DataFrame) -> DataFrame:
    vol = S.regime_thresholds(S.rolling_return_std(df.select("symbol", "timestamp", "close")))
    bbw = exact_quantiles(S.bollinger_width(df), ["symbol"], "bb_width", {"bb_width_q10": 0.10})
    return vol.join(bbw, "symbol", "full")


def fold_union(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)

