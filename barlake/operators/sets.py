"""Unions, de-duplication, alignment and pivots of candle series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import series as S


def union_sources(*frames: DataFrame) -> DataFrame:
    """Batch and stream rows converge in one table, told apart by ``source``."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def dedupe_candles(df: DataFrame, keys=("timestamp", "symbol"), prefer: str = "ingestion_timestamp",
                   source_priority=("historical", "streaming")) -> DataFrame:
    """Keep one row per key: latest ``prefer`` value, ties broken by ``source_priority``.

    An aggregation (``max_by`` over a struct) rather than a window, so copies
    of one key are reduced map-side before the shuffle: even a key holding a
    third of all rows never reaches one task whole.
    """
    cols = [c for c in df.columns if c not in keys]
    prio = F.array(*[F.lit(s) for s in source_priority])
    rank = F.struct(F.col(prefer), -F.array_position(prio, F.col("source")))
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*cols), rank).alias("__r"))
    return best.select(*keys, "__r.*")


def align_returns(df: DataFrame, benchmark: str = "BTCUSDT") -> DataFrame:
    """Each non-benchmark symbol's returns next to the benchmark's, inner-joined on time."""
    r = S.with_returns(df.select("symbol", "timestamp", "close"), "ret", scale=None).where(F.col("ret").isNotNull())
    bench = r.where(F.col("symbol") == benchmark).select("timestamp", F.col("ret").alias("bench_ret"))
    return r.where(F.col("symbol") != benchmark).join(bench, "timestamp", "inner").select(
        "symbol", "timestamp", "ret", "bench_ret")
