"""Skew-safe plans for per-series window work.

A plain ``Window.partitionBy(symbol).orderBy(timestamp)`` sends every row of
one symbol to one task.  With a handful of symbols (or one symbol holding a
third of the table) that is a single straggler task that must sort and
buffer the whole series.  The helpers here split each series into
*chunks* of about ``chunk_rows`` consecutive rows and parallelise over
``(key, chunk)`` while keeping results exact:

* a small per-``(key, time bucket)`` count summary gives every bucket its
  global row offset inside its series (prefix sum over the summary, whose
  size per key is bounded by the time span / bucket width, not by the data);
* chunks are made of whole buckets, so a row's chunk follows from its bucket
  through a join with the summary (broadcast after an explicit row-count
  check, shuffle join beyond it);
* bounded frames (``ROWS BETWEEN k PRECEDING``) need the ``lookback`` rows
  before a chunk: the whole buckets covering them are copied into the chunk
  as *halo* rows (decided per row from its bucket, in the same scan) and
  dropped after the windows ran.  Extra older halo rows cannot change a
  frame that reaches at most ``lookback`` rows back, so results stay exact;
* unbounded prefix frames (running max, first value) combine a per-chunk
  result with a prefix over the tiny chunk summary.

Buckets are time units (``date_trunc``).  Their width is chosen per key: sparse
keys get wider buckets, so that a summary is never as large as its table, and
keys with a bucket above the chunk size get narrower ones, down to a second.
Keys and times may be NULL: joins treat NULL as a value, and NULL times come
first, as they do in a plain window.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import null_safe_join

# Summaries with at most this many rows are broadcast (checked by count).
BROADCAST_SUMMARY_ROWS = 2_000_000
DEFAULT_CHUNK_ROWS = 250_000

_B, _N, _END, _START, _CHUNK = "__bucket", "__n", "__end", "__start", "__chunk"
_HALO, _DST, _UNIT = "__halo", "__dst", "__unit"


@dataclass
class ChunkLayout:
    """Per-(key, bucket) row offsets and chunk ids of one series table."""
    summary: DataFrame
    keys: list[str]
    order: str
    bucket_unit: str           # of keys without an entry in ``units``
    small: bool
    single_chunk: bool = False
    max_rows: int = 0          # longest series: an upper bound for any per-key group
    units: DataFrame | None = None     # (keys, unit) of keys with another width
    small_units: bool = True

    def with_bucket(self, df: DataFrame) -> DataFrame:
        """Add each row's bucket, in the width of its key."""
        if self.units is None:
            return with_bucket(df, self.order, self.bucket_unit)
        units = F.broadcast(self.units) if self.small_units else self.units
        x = null_safe_join(df, units, self.keys, "left")
        bucket = F.date_trunc(self.bucket_unit, F.col(self.order))
        for u in UNITS:
            bucket = F.when(F.col(_UNIT) == u, F.date_trunc(u, F.col(self.order))).otherwise(bucket)
        return x.withColumn(_B, bucket).drop(_UNIT)

    def attach(self, df: DataFrame) -> DataFrame:
        """Add bucket, bucket start offset and chunk id to every row."""
        s = self.summary.select(*self.keys, _B, _START, _END, _CHUNK)
        s = F.broadcast(s) if self.small else s
        return null_safe_join(self.with_bucket(df), s, [*self.keys, _B])


def with_bucket(df: DataFrame, order: str, unit: str) -> DataFrame:
    return df.withColumn(_B, F.date_trunc(unit, F.col(order)))


# Keys whose buckets average fewer rows than this get wider ones (from the small
# count table, not the data): a daily-bar table must not get a summary as large
# as itself.
MIN_BUCKET_ROWS = 8
UNITS = ["second", "minute", "hour", "day", "month", "year"]


def plan_chunks(df: DataFrame, keys: Sequence[str], order: str = "timestamp",
                chunk_rows: int = DEFAULT_CHUNK_ROWS, bucket_unit: str = "day",
                min_bucket_rows: int = MIN_BUCKET_ROWS) -> ChunkLayout:
    """Build the small bucket summary with offsets and chunk ids.

    One pass over the data counts rows per (key, bucket).  From that summary
    each key gets its bucket width: the narrowest unit whose buckets hold
    ``min_bucket_rows`` on average, and a narrower one than ``bucket_unit`` if
    a bucket exceeds ``chunk_rows`` (only such keys are counted again).  The
    summary is written through a reliable checkpoint and its size is known
    before choosing a broadcast.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(_B)
    at = UNITS.index(bucket_unit)

    def counts(rows: DataFrame, unit: str) -> DataFrame:
        return with_bucket(rows.select(*keys, order), order, unit).groupBy(*keys, _B).agg(F.count(F.lit(1)).alias(_N))

    def widths(c: DataFrame) -> DataFrame:
        """(keys, unit, whether a bucket is too large) from counts in ``bucket_unit``."""
        wider = UNITS[at + 1:]
        g = c.groupBy(*keys).agg(F.sum(_N).alias("__rows"), F.count(F.lit(1)).alias("__k0"), F.max(_N).alias("__top"),
                                 *[F.countDistinct(F.coalesce(F.date_trunc(u, F.col(_B)).cast("string"), F.lit(""))).alias(f"__k{i + 1}")
                                   for i, u in enumerate(wider)])
        unit = F.lit(UNITS[-1])
        for i, u in reversed(list(enumerate([bucket_unit, *wider]))):
            unit = F.when(F.col("__rows") >= min_bucket_rows * F.col(f"__k{i}"), F.lit(u)).otherwise(unit)
        return g.select(*keys, unit.alias(_UNIT), (F.col("__top") > chunk_rows).alias("__large"))

    def offsets(c: DataFrame) -> DataFrame:
        return (c.withColumn(_END, F.sum(_N).over(w.rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn(_START, F.col(_END) - F.col(_N))
                .withColumn(_CHUNK, F.floor(F.col(_START) / F.lit(chunk_rows)))
                .checkpoint(eager=True))

    summary = offsets(counts(df, bucket_unit))
    base = summary.select(*keys, _B, _N)
    n, longest = summary.agg(F.count(F.lit(1)), F.max(_END)).first()
    found = ChunkLayout(summary, keys, order, bucket_unit, (n or 0) <= BROADCAST_SUMMARY_ROWS, (longest or 0) <= chunk_rows, int(longest or 0))
    if found.single_chunk:               # no series longer than one chunk: plain per-key windows, buckets do not matter
        return found
    units = widths(base)
    if units.where((F.col(_UNIT) != bucket_unit) | F.col("__large")).isEmpty():
        return found
    units = units.checkpoint(eager=True)
    pieces = []
    merged = null_safe_join(base, units.where("NOT __large"), keys)
    bucket = F.col(_B)
    for u in UNITS[at + 1:]:
        bucket = F.when(F.col(_UNIT) == u, F.date_trunc(u, F.col(_B))).otherwise(bucket)
    pieces.append(merged.withColumn(_B, bucket).groupBy(*keys, _B).agg(F.sum(_N).alias(_N)))
    other = units.where((~F.col("__large")) & (F.col(_UNIT) != bucket_unit)).select(*keys, _UNIT)
    large = units.where("__large").select(*keys)
    for u in reversed(UNITS[:at]):                       # narrower, for the keys that need it
        if large.isEmpty():
            break
        mine = counts(null_safe_join(df.select(*keys, order), large, keys, "left_semi"), u).checkpoint(eager=True)
        still = mine.groupBy(*keys).agg(F.max(_N).alias("__top")).where(F.col("__top") > chunk_rows).select(*keys)
        still = still.checkpoint(eager=True) if u != UNITS[0] else still.where("false")
        pieces.append(null_safe_join(mine, still, keys, "left_anti"))
        other = other.unionByName(null_safe_join(large, still, keys, "left_anti").withColumn(_UNIT, F.lit(u)))
        large = still
    if at == 0:
        pieces.append(null_safe_join(base, large, keys, "left_semi"))
    all_counts = pieces[0]
    for p in pieces[1:]:
        all_counts = all_counts.unionByName(p)
    summary = offsets(all_counts)
    n, longest = summary.agg(F.count(F.lit(1)), F.max(_END)).first()
    other = other.checkpoint(eager=True)
    n_other = other.limit(BROADCAST_SUMMARY_ROWS + 1).count()
    return ChunkLayout(summary, keys, order, bucket_unit, (n or 0) <= BROADCAST_SUMMARY_ROWS, (longest or 0) <= chunk_rows,
                       int(longest or 0), other if n_other else None, n_other <= BROADCAST_SUMMARY_ROWS)


def _halo_targets(layout: ChunkLayout, lookback: int) -> DataFrame:
    """(key, bucket) -> chunk id and the later chunks that need this bucket as halo.

    A chunk starting at global row S needs rows [S - lookback, S); every bucket
    overlapping that range (it ends after S - lookback and before S) is copied
    whole.  Any such chunk start lies within the next ``lookback`` buckets
    (each bucket holds at least one row), so a bounded frame over the small
    summary finds them.
    """
    keys = layout.keys
    w = Window.partitionBy(*keys).orderBy(_B)
    first = (F.lag(_CHUNK).over(w).isNull()) | (F.lag(_CHUNK).over(w) != F.col(_CHUNK))
    s = layout.summary.withColumn("__first", first)
    nxt = F.collect_list(F.struct(F.col(_CHUNK).alias("c"), F.col(_START).alias("s"),
                                  F.col("__first").alias("f"))).over(w.rowsBetween(1, lookback))
    needed = F.filter(nxt, lambda t: t["f"] & (t["s"] - F.col(_END) < lookback))
    return s.select(*keys, _B, _START, _CHUNK, F.transform(needed, lambda t: t["c"]).alias(_DST))


def chunked_window(df: DataFrame, keys: Sequence[str], order: str, lookback: int,
                   compute: Callable[[DataFrame, list[str]], DataFrame],
                   chunk_rows: int = DEFAULT_CHUNK_ROWS, bucket_unit: str = "day",
                   layout: ChunkLayout | None = None, index: str | None = None) -> DataFrame:
    """Run ``compute(frame, partition_cols)`` chunk-parallel and exactly.

    ``compute`` must only use windows partitioned by ``partition_cols`` and
    ordered by ``order`` whose frames reach at most ``lookback`` rows back
    (``lag(k)`` counts as k rows).  Rows must be unique on (keys, order).
    One scan, one broadcast join with the bucket table, one shuffle.
    With ``index`` the frame also gets each row's 0-based position in its
    series: a chunk partition is a run of consecutive whole buckets, so the
    position is the partition's first bucket offset + ``row_number`` - 1
    (same partitioning, no extra exchange).
    """
    if chunk_rows < lookback:
        raise ValueError("chunk_rows must be >= lookback")
    keys = list(keys)
    cols = df.columns
    layout = layout or plan_chunks(df, keys, order, chunk_rows, bucket_unit)
    if layout.single_chunk:
        if index:
            df = df.withColumn(index, F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1)
        return compute(df, keys)
    targets = _halo_targets(layout, lookback)
    targets = F.broadcast(targets) if layout.small else targets
    x = null_safe_join(layout.with_bucket(df), targets, [*keys, _B])
    # each row goes to its own chunk, plus (as halo) to every later chunk that needs its bucket
    tags = F.concat(F.array(F.struct(F.col(_CHUNK).alias("c"), F.lit(False).alias("h"))),
                    F.transform(_DST, lambda d: F.struct(d.alias("c"), F.lit(True).alias("h"))))
    both = (x.select(*cols, _START, F.explode(tags).alias("__t"))
            .select(*cols, _START, F.col("__t.c").alias(_CHUNK), F.col("__t.h").alias(_HALO)))
    part = [*keys, _CHUNK]
    if index:
        both = both.withColumn(index, F.min(_START).over(Window.partitionBy(*part))
                               + F.row_number().over(Window.partitionBy(*part).orderBy(order)) - 1)
    out = compute(both.drop(_START), part)
    return out.where(~F.col(_HALO)).drop(_CHUNK, _HALO)


def global_row_index(df: DataFrame, keys: Sequence[str], order: str, name: str = "row_idx",
                     layout: ChunkLayout | None = None, bucket_unit: str = "day",
                     with_count: str | None = None, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """0-based row position inside each series without a per-key single task.

    position = bucket start offset (from the summary) + row_number inside the
    bucket; optionally also the series length (``with_count``).
    """
    keys = list(keys)
    layout = layout or plan_chunks(df, keys, order, chunk_rows, bucket_unit)
    if layout.single_chunk:
        x = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1)
        if with_count:
            x = x.withColumn(with_count, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
        return x
    x = layout.attach(df)
    x = x.withColumn(name, F.col(_START) + F.row_number().over(
        Window.partitionBy(*keys, _B).orderBy(order)) - 1)
    if with_count:
        tot = layout.summary.groupBy(*keys).agg(F.max(_END).alias(with_count))
        tot = F.broadcast(tot) if layout.small else tot
        x = null_safe_join(x, tot, keys)
    return x.drop(_B, _START, _END, _CHUNK)


def chunked_running(df: DataFrame, keys: Sequence[str], order: str, value: str,
                    how: str, name: str, layout: ChunkLayout | None = None,
                    bucket_unit: str = "day", chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Unbounded running ``max``/``min``/``sum`` or series ``first`` value.

    Per-chunk running aggregate, combined with the aggregate of all earlier
    chunks taken from a prefix over the (small) per-chunk summary.
    """
    keys = list(keys)
    layout = layout or plan_chunks(df, keys, order, chunk_rows, bucket_unit)
    if layout.single_chunk:
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        f = {"max": F.max, "min": F.min, "sum": F.sum, "first": F.first}[how]
        return df.withColumn(name, f(value).over(w))
    x = layout.attach(df)
    if how == "first":
        firsts = df.groupBy(*keys).agg(F.min_by(F.col(value), F.struct(order)).alias(name))   # a NULL time comes first
        firsts = F.broadcast(firsts) if layout.small else firsts
        return null_safe_join(x.drop(_B, _START, _END, _CHUNK), firsts, keys, "left")
    agg = {"max": F.max, "min": F.min, "sum": F.sum}[how]
    comb = {"max": F.greatest, "min": F.least, "sum": lambda a, b: F.coalesce(a, F.lit(0)) + b}[how]
    wl = Window.partitionBy(*keys, _CHUNK).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = x.withColumn("__loc", agg(value).over(wl))
    per_chunk = x.groupBy(*keys, _CHUNK).agg(agg(value).alias("__cv"))
    wc = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    prior = per_chunk.withColumn("__prev", agg("__cv").over(wc)).select(*keys, _CHUNK, "__prev")
    prior = F.broadcast(prior) if layout.small else prior
    out = null_safe_join(local, prior, [*keys, _CHUNK], "left")
    res: Column = F.when(F.col("__prev").isNull(), F.col("__loc")).otherwise(comb(F.col("__loc"), F.col("__prev")))
    return out.withColumn(name, res).drop("__loc", "__prev", _B, _START, _END, _CHUNK)
