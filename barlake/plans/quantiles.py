"""Exact (linear-interpolated) quantiles without one task per group.

Values are first counted per (group, value), so ties are one row, and written
once, range-partitioned on (group, value) with the number of their partition.
Sums per (partition, group) give every value the ranks it covers inside its
group, and the values at the two ranks next to each requested position are
picked by aggregation.  Results equal ``percentile_cont`` / pandas ``quantile``
(position = p * (n - 1), linear interpolation).  Groups may be NULL.

If every group is known to hold at most ``MAX_BUFFERED_GROUP`` values, the
built-in exact ``percentile`` has a bounded buffer per group and gives the
same rows; that choice changes the plan only.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import broadcast_if_small, null_safe_join

# Largest group whose values may sit in one aggregation buffer (~16 MB of doubles).
MAX_BUFFERED_GROUP = 2_000_000


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    probs: Mapping[str, float], partitions: int | None = None,
                    max_buffered: int | None = None, group_rows_bound: int | None = None) -> DataFrame:
    """One row per group with values: ``keys`` + one column per entry of ``probs``."""
    keys = list(keys)
    x = df.select(*keys, F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    # group sizes first (a key-sized table); a caller that knows an upper bound skips that pass
    limit = MAX_BUFFERED_GROUP if max_buffered is None else max_buffered
    if group_rows_bound is None:
        group_rows_bound = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).agg(F.max("__n")).first()[0] or 0
    if group_rows_bound <= limit:
        out = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), *[F.percentile("__v", p).alias(k) for k, p in probs.items()])
        return out.where("__n > 0").drop("__n")
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = x.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c"))
    s = (counts.repartitionByRange(n, *keys, "__v").withColumn("__pid", F.spark_partition_id())
         .checkpoint(eager=True))                        # the partition numbers are data from here on
    # one row per (partition, group): about #partitions + #groups rows
    part = s.groupBy("__pid", *keys).agg(F.sum("__c").alias("__pc"))
    before = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    part = part.select("__pid", *keys, F.coalesce(F.sum("__pc").over(before), F.lit(0)).alias("__off"),
                       F.sum("__pc").over(Window.partitionBy(*keys)).alias("__n")).checkpoint(eager=True)
    inside = Window.partitionBy("__pid", *keys).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (null_safe_join(s.withColumn("__run", F.sum("__c").over(inside)), broadcast_if_small(part), ["__pid", *keys])
              .withColumn("__end", F.col("__off") + F.col("__run")).withColumn("__start", F.col("__end") - F.col("__c")))

    def at(rank):
        return F.max(F.when((F.col("__start") <= rank) & (rank < F.col("__end")), F.col("__v")))

    picks = []
    for k, p in probs.items():
        pos = F.lit(p) * (F.col("__n") - 1)
        picks += [at(F.floor(pos)).alias(f"__lo_{k}"), at(F.ceil(pos)).alias(f"__hi_{k}")]
    g = ranked.groupBy(*keys).agg(F.max("__n").alias("__n"), *picks).where(F.col("__n").isNotNull())
    out = []
    for k, p in probs.items():
        pos = F.lit(p) * (F.col("__n") - 1)
        lo, hi = F.col(f"__lo_{k}"), F.col(f"__hi_{k}")
        out.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(k))
    return g.select(*keys, *out)


def quantile_sql(value: str, p: float) -> str:
    return f"quantile_cont({value}, {p})"
