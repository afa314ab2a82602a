"""Indicators inside tumbling windows of a candle stream, without a list per window.

Each micro-batch adds its candles to a table of the open windows, in one folder
per window end and batch.  The windows it touches are then computed as series
of (symbol, window) with the chunk-parallel plan of the batch job: a window is
cut into sub-windows that carry the last 49 candles before them, so one that
holds millions meets in no buffer and no task.  Only rows from the first new
candle of a window on are returned, the others being what they were.

A window is final, and its folder goes, once the newest event time of earlier
batches lies ``lateness_seconds`` past its end; later candles for it are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.chunked import chunked_window
from ..plans.joins import broadcast_if_small, null_safe_join
from ..session import cut_lineage
from .indicators import STREAM_COLS, STREAM_LOOKBACK, _stream_columns
from .jobs import drop_batch, log_newest, newest_before, run_foreach_batch, table_exists, write_batch

_HELD = "symbol string, window_start timestamp, timestamp timestamp, close double, closes long, batch_id long"


class WindowIndicators:
    """Call with (batch, batch id) in order: symbol, window_start, timestamp, close and indicators of the rows that the batch sets.

    * Batches have symbol, ``ts_col`` (TIMESTAMP) and close; other columns are not read.
    * A candle delivered again (same symbol and time) counts once: the latest batch's, in one batch the largest close.
    * An old row may be returned again by a later batch: its version of the largest batch id holds.
    * A batch that runs again reads what it read before and replaces what it wrote.
    """

    def __init__(self, path: str, duration: str = "1 day", lateness_seconds: int = 1800, ts_col: str = "event_ts", **chunking):
        self.path, self.log = path.rstrip("/"), path.rstrip("/") + "_newest"
        self.duration, self.lateness, self.ts, self.chunking = duration, lateness_seconds, ts_col, chunking

    def __call__(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark = batch.sparkSession
        seen = newest_before(spark, self.log, batch_id)
        rows = (batch.select("symbol", F.col(self.ts).alias("timestamp"), F.col("close").cast("double").alias("close"))
                .withColumn("w", F.window("timestamp", self.duration))
                .select("symbol", F.col("w.start").alias("window_start"), "timestamp", "close", F.unix_seconds("w.end").alias("closes")))
        if seen is not None:
            final = seen // 1_000_000 - self.lateness
            rows = rows.where(F.col("closes") > final)
            self._drop_closed(spark, final)
        rows = cut_lineage(rows.withColumn("batch_id", F.lit(batch_id).cast("long")))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("closes", "batch_id").parquet(self.path))
        log_newest(rows, "timestamp", seen, batch_id, self.log)
        drop_batch(spark, self.log, batch_id - 2)                       # a batch runs again with the one before at most
        first, last = rows.agg(F.min("closes"), F.max("closes")).first()
        if first is None:
            held = rows
        else:                                                           # folders between the batch's windows alone
            held = spark.read.schema(_HELD).parquet(self.path).where(F.col("closes").between(first, last) & (F.col("batch_id") <= batch_id))
        touched = broadcast_if_small(rows.groupBy("symbol", "window_start").agg(F.min("timestamp").alias("__from")))
        series = (null_safe_join(held, touched, ["symbol", "window_start"])
                  .groupBy("symbol", "window_start", "timestamp")
                  .agg(F.max(F.struct("batch_id", "close")).alias("last"), F.max("__from").alias("__from"))
                  .select("symbol", "window_start", "timestamp", F.col("last.close").alias("close"), "__from"))
        done = chunked_window(series, ["symbol", "window_start"], "timestamp", STREAM_LOOKBACK, _stream_columns, index="row_idx", **self.chunking)
        plain = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "timestamp")]
        return done.where(F.col("timestamp") >= F.col("__from")).select("symbol", *plain, "close", *STREAM_COLS)

    def _drop_closed(self, spark: SparkSession, final: int) -> None:
        """Remove the folders of windows that ended by ``final`` (seconds)."""
        if not table_exists(spark, self.path):
            return
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        for f in fs.listStatus(folder):
            name = f.getPath().getName()
            if name.startswith("closes=") and int(name.split("=")[1]) <= final:
                fs.delete(f.getPath(), True)


def window_indicator_rows(candles: DataFrame, sink: str, checkpoint: str, duration: str = "1 day", lateness_seconds: int = 1800) -> str:
    """Candle stream -> rows with the indicators of their window, written by batch id (read with ``latest_per_key``)."""
    groups = WindowIndicators(sink.rstrip("/") + "_windows", duration, lateness_seconds)
    run_foreach_batch(candles, lambda batch, i: write_batch(groups(batch, i), i, sink), checkpoint, "append")
    return sink
