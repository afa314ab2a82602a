"""Shared inputs for catalog queries: candle series and the unified fact.

Oracle SQL runs in DuckDB over the same parquet tables; ``WITH_UNIFIED``
rebuilds candles and the batch indicator pipeline there independently.
Doubles are rounded to 8 dp on both sides: window sums may associate
differently, and 2-dp prices averaged over at most 50 rows are exact
decimals with at most 7 places, so 8 dp never lands on a rounding tie.
The SQL side adds ``+ 0.0`` so a rounded negative zero reads as zero.
Ingestion time is never part of a compared result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..operators.indicators import indicator_sql, indicators_batch
from ..sources.adapters import SQL_EVENT_CANDLES, event_candles


def round_doubles(df: DataFrame, dp: int = 8) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), dp).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified fact built from the events table (all symbols), ingestion time dropped."""
    return indicators_batch(event_candles(spark, sf_dir)).drop("ingestion_timestamp")


def core(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The notebooks' scan: the three core symbols."""
    from ..functions.exprs import CORE_SYMBOLS
    return unified(spark, sf_dir).where(F.col("symbol").isin(CORE_SYMBOLS))


WITH_CANDLES = f"WITH candles AS ({SQL_EVENT_CANDLES})"
WITH_UNIFIED = f"{WITH_CANDLES}, {indicator_sql('candles')}"
WITH_CORE = WITH_UNIFIED + ", core AS (SELECT * FROM unified WHERE symbol IN ('BTCUSDT', 'ETHUSDT', 'SOLUSDT'))"


def r(expr: str, alias: str | None = None, dp: int = 8) -> str:
    """SQL: round a double expression to ``dp`` (and alias it)."""
    out = f"(round({expr}, {dp}) + 0.0)"
    return f"{out} AS {alias or expr}"
