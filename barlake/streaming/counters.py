"""Running counters of a stream: ``DataFrame.observe`` with a listener.

Counts are taken while a micro-batch runs, without a pass of their own; the
listener writes them under the batch's id, so a batch that runs again replaces
its counts and the totals of a replay are those of the whole backlog.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from .jobs import write_batch

NAME = "counters"
SCHEMA = "received long, parse_errors long, cleaned long, rejected long"


def counted(validated: DataFrame) -> DataFrame:
    """A validated message stream whose batches report received, parse errors, cleaned and rejected messages."""
    reason = F.col("reject_reason")
    return validated.observe(NAME, F.count(F.lit(1)).alias("received"), F.count_if(reason == "parse").alias("parse_errors"),
                             F.count_if(reason.isNull()).alias("cleaned"), F.count_if(reason.isNotNull()).alias("rejected"))


class CounterLog(StreamingQueryListener):
    """Writes the counters of every batch of the query called ``query`` below ``path``."""

    def __init__(self, spark: SparkSession, query: str, path: str):
        self.spark, self.query, self.path, self.ended = spark, query, path, set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name == self.query and NAME in p.observedMetrics:
            row = p.observedMetrics[NAME].asDict()
            write_batch(self.spark.createDataFrame([tuple(row[c.split()[0]] for c in SCHEMA.split(", "))], SCHEMA), p.batchId, self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.add(str(event.runId))


def run_counted(validated: DataFrame, write, checkpoint: str, counters: str, name: str, wait_seconds: float = 60) -> DataFrame:
    """Run a validated stream until its backlog is drained; ``write(batch, id)`` gets its batches. The totals of ``counters``."""
    spark = validated.sparkSession
    log = CounterLog(spark, name, counters)
    spark.streams.addListener(log)
    try:
        q = (counted(validated).writeStream.queryName(name).outputMode("append").foreachBatch(write)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
        until = time.time() + wait_seconds
        while str(q.runId) not in log.ended:             # events arrive in order, but after the query has ended
            if time.time() > until:
                raise TimeoutError("the listener has not seen the query's end")
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    return totals(spark, counters)


def totals(spark: SparkSession, counters: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(counters).agg(*[F.sum(c.split()[0]).alias(c.split()[0]) for c in SCHEMA.split(", ")])
