"""Stream-mode indicators with history carried across micro-batches as a table.

A micro-batch usually holds few candles per symbol, so the indicators need the
symbol's previous closes.  After every batch the last ``HISTORY`` candles of
each symbol, with their place in its series, are written under the batch's id.
The next batch reads them, puts them before its own candles and runs the same
chunk-parallel windows as the batch job: one symbol that fills a batch is split
over many tasks, and no Python runs per row.

Candles not newer than the last one of an earlier batch, and second candles of
one time within a batch, are returned flagged ``late`` with NULL indicators
(they would need rows already emitted to be computed again).  A batch that runs
again reads the same tails and replaces its own.  Symbols without candles for
``retention`` before the newest are forgotten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.chunked import chunked_window
from ..plans.joins import broadcast_if_small
from ..session import cut_lineage
from .indicators import STREAM_COLS, STREAM_LOOKBACK, _stream_columns
from .jobs import batch_before, drop_batch, run_foreach_batch, write_batch

HISTORY = STREAM_LOOKBACK + 1


class TailIndicators:
    """Call with (batch, batch id) in order: the batch's candles with indicators and ``late``.

    Batches have symbol, ``ts_col`` (TIMESTAMP), close and any other columns.
    """

    def __init__(self, path: str, ts_col: str = "event_ts", retention: str | None = None):
        self.path, self.ts, self.retention = path, ts_col, retention

    def _tails(self, spark: SparkSession, batch_id: int) -> DataFrame:
        before = batch_before(spark, self.path, batch_id)
        kinds = "symbol string, timestamp timestamp, close double, pos long"
        return spark.createDataFrame([], kinds) if before is None else spark.read.schema(kinds).parquet(f"{self.path}/batch_id={before}")

    def __call__(self, batch: DataFrame, batch_id: int) -> DataFrame:
        spark, cols = batch.sparkSession, batch.columns
        tails = self._tails(spark, batch_id)
        ends = broadcast_if_small(tails.groupBy("symbol").agg(F.max("timestamp").alias("__last"), F.min("pos").alias("__base"), F.max("pos").alias("__end")))
        again = F.row_number().over(Window.partitionBy("symbol", self.ts).orderBy(F.xxhash64(*[c for c in cols if c != self.ts]))) > 1
        rows = batch.withColumn("__again", again).join(ends.select("symbol", "__last"), "symbol", "left")
        late = F.col("__again") | F.coalesce(F.col(self.ts) <= F.col("__last"), F.lit(False))
        rows = cut_lineage(rows.withColumn("late", late).drop("__again", "__last"))
        whole = F.struct(*[F.col(c) for c in cols])
        fresh = rows.where(~F.col("late")).select("symbol", F.col(self.ts).alias("timestamp"), F.col("close").cast("double").alias("close"), whole.alias("__row"))
        held = tails.select("symbol", "timestamp", "close", F.lit(None).cast(fresh.schema["__row"].dataType).alias("__row"))
        series = fresh.unionByName(held).join(ends.select("symbol", "__base"), "symbol", "left").withColumn("__base", F.coalesce("__base", F.lit(0)))

        def compute(df: DataFrame, part: list[str]) -> DataFrame:
            return _stream_columns(df.withColumn("row_idx", F.col("row_idx") + F.col("__base")), part)

        done = cut_lineage(chunked_window(series, ["symbol"], "timestamp", STREAM_LOOKBACK, compute, index="row_idx"))
        self._keep(done, tails, batch_id)
        out = done.where(F.col("__row").isNotNull()).select("__row.*", *STREAM_COLS, F.lit(False).alias("late"))
        return out.unionByName(rows.where("late").select(*cols, *[F.lit(None).cast("double").alias(c) for c in STREAM_COLS], "late"))

    def _keep(self, done: DataFrame, tails: DataFrame, batch_id: int) -> None:
        """Write the last candles of every symbol; symbols of earlier batches only are in ``done`` by their tails."""
        end = broadcast_if_small(done.groupBy("symbol").agg(F.max("row_idx").alias("__to"), F.max("timestamp").alias("__at")))
        if self.retention:
            newest = end.agg(F.max("__at").alias("__newest"))                            # one row
            end = end.crossJoin(F.broadcast(newest)).where(F.col("__at") >= F.col("__newest") - F.expr(f"INTERVAL {self.retention}")).drop("__newest")
        kept = done.join(end, "symbol").where(F.col("row_idx") > F.col("__to") - HISTORY)
        write_batch(kept.select("symbol", "timestamp", "close", F.col("row_idx").cast("long").alias("pos")), batch_id, self.path)
        drop_batch(done.sparkSession, self.path, batch_id - 2)                           # a batch runs again with the one before at most


def stream_indicator_rows(candles: DataFrame, sink: str, checkpoint: str, retention: str | None = None) -> str:
    """Candle stream -> rows with indicators and ``late``, written by batch id."""
    tails = TailIndicators(sink.rstrip("/") + "_tails", retention=retention)
    run_foreach_batch(candles, lambda batch, i: write_batch(tails(batch, i), i, sink), checkpoint, "append")
    return sink

