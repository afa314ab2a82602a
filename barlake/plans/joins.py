"""Join helpers: broadcast only behind an explicit size check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# Dimension / summary sides up to this many rows are broadcast.
BROADCAST_MAX_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int | None = None) -> DataFrame:
    """Return ``broadcast(df)`` when it has at most ``max_rows`` rows, else ``df``.

    The check runs a bounded count (``limit(max_rows + 1)``), so it stops
    early on large inputs; beyond the bound the join stays a shuffle join
    (and AQE may still demote it using runtime sizes).  Where rows hold texts
    or lists, ``max_bytes`` bounds their bytes in all as well.
    """
    if max_bytes is None:
        return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
    n, size = df.select(row_bytes(df).alias("b")).limit(max_rows + 1).agg(F.count("b"), F.coalesce(F.sum("b"), F.lit(0))).first()
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row: 16 a column and the length of what has no fixed width."""
    total = F.lit(16 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType, ArrayType, MapType, StructType)):
            c = F.col(f"`{f.name}`")
            c = c if isinstance(f.dataType, (StringType, BinaryType)) else c.cast("string")
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
    return total


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where NULL equals NULL; the key columns are those of ``left``."""
    names = {k: f"__right_{i}" for i, k in enumerate(on)}
    r = right
    for k, v in names.items():
        r = r.withColumnRenamed(k, v)
    # a renamed hint is kept: broadcast(right) stays one
    cond = F.lit(True)
    for k, v in names.items():
        cond = cond & left[k].eqNullSafe(r[v])
    return left.join(r, cond, how).drop(*names.values())


def checked_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Materialise a per-key side table once (reliable checkpoint), then broadcast it
    only if its row count is within ``max_rows``.

    Used for per-symbol thresholds / statistics whose size follows the key
    cardinality, not the data volume; the checkpoint also keeps the join from
    recomputing the aggregation that produced them.
    """
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(small.sparkSession)
    t = small.checkpoint(eager=True)
    return F.broadcast(t) if t.limit(max_rows + 1).count() <= max_rows else t
