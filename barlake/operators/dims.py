"""Dimension tables (dates, hours, symbols) and the insert-missing merge.

Spines are generated from the fact's own range (``sequence`` + ``explode``,
i.e. a lateral unnest), so their size is bounded by the time span, not the
data volume.  Joins with dimensions broadcast only after a row-count check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small

# Fixed labels of the symbol dimension.
SYMBOL_LABELS = {"BTCUSDT": "Bitcoin", "ETHUSDT": "Ethereum", "SOLUSDT": "Solana"}
OTHER_LABEL = "Autres"
QUOTE_CURRENCY, QUOTE_CURRENCY_NAME = "USDT", "Tether"
# Fixed bounds: 24 hours; working hours [6, 18] inclusive; rush hours [7, 10) and [16, 19).
HOURS = 24
WORK_START, WORK_END = 6, 18
RUSH = [(7, 10), (16, 19)]


def dim_dates_between(spark, start: str, end: str) -> DataFrame:
    """Calendar rows for every day in [start, end] (ISO dates)."""
    base = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)),
                                                      F.expr("INTERVAL 1 DAY"))).alias("date"))
    return calendar_columns(base)


def calendar_columns(days: DataFrame) -> DataFrame:
    d = F.col("date")
    return days.select(d, F.year(d).cast("bigint").alias("year"), F.month(d).cast("bigint").alias("month"),
                       F.date_format(d, "MMMM").alias("month_name"), F.dayofmonth(d).cast("bigint").alias("day"),
                       F.dayofweek(d).cast("bigint").alias("day_of_week"),
                       F.date_format(d, "EEEE").alias("day_of_week_name"))


def dim_dates(fact: DataFrame, date_col: str = "date") -> DataFrame:
    """Day spine over the fact's [min date, max date] with calendar attributes (1 = Sunday)."""
    rng = fact.agg(F.min(date_col).alias("d0"), F.max(date_col).alias("d1"))
    days = rng.select(F.explode(F.sequence("d0", "d1", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return calendar_columns(days)


def hour_attributes(hours: DataFrame) -> DataFrame:
    h = F.col("hours")
    rush = None
    for a, b in RUSH:
        c = (h >= a) & (h < b)
        rush = c if rush is None else rush | c
    return hours.select(h.cast("bigint").alias("hours"),
                        F.when(h == 0, F.lit(12)).when(h <= 12, h).otherwise(h - 12).cast("bigint").alias("hour_12"),
                        F.when(h < 12, F.lit("AM")).otherwise(F.lit("PM")).alias("am_pm"),
                        ((h >= WORK_START) & (h <= WORK_END)).alias("is_worked_hours"),
                        rush.alias("is_rush_hour"))


def dim_hours(fact: DataFrame, hour_col: str = "hour") -> DataFrame:
    """All 24 hours of a day, whichever the fact holds; an hour outside 0..23 in the fact is an error."""
    wrong = F.count_if(~F.col(hour_col).between(0, HOURS - 1))
    one = fact.agg(F.when(wrong > 0, F.raise_error(F.lit("hour outside 0..23"))).otherwise(F.sequence(F.lit(0), F.lit(HOURS - 1))).alias("h"))
    return hour_attributes(one.select(F.explode("h").alias("hours")))


def dim_symbols(raw: DataFrame) -> DataFrame:
    s = F.col("symbol")
    label = F.lit(OTHER_LABEL)
    for k, v in reversed(list(SYMBOL_LABELS.items())):
        label = F.when(s == k, F.lit(v)).otherwise(label)
    return (raw.select("symbol").distinct()
            .select(s, label.alias("symbole_libelle"), F.lit(QUOTE_CURRENCY).alias("devise_cotation"),
                    F.lit(QUOTE_CURRENCY_NAME).alias("devise_cotation_nom")))


def merge_insert_missing(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``MERGE ... WHEN NOT MATCHED THEN INSERT``: target rows plus source rows with unseen keys."""
    missing = source.join(target.select(key), key, "left_anti")
    return target.unionByName(missing)


def fact_dim_star(fact: DataFrame, dates: DataFrame, hours: DataFrame, symbols: DataFrame) -> DataFrame:
    """Fact joined to the three dimensions (each broadcast only after a size check)."""
    d = broadcast_if_small(dates)
    h = broadcast_if_small(hours.withColumnRenamed("hours", "hour"))
    s = broadcast_if_small(symbols)
    return fact.join(d.drop("day_of_week"), "date", "left").join(h, "hour", "left").join(s, "symbol", "left")
