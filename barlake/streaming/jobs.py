"""Structured Streaming jobs over message files (or Kafka) and their sinks.

Every job reads payloads with ``readStream`` (JSON-lines/text files here; the
same transformations apply to ``format("kafka")`` after
``value.cast("string")``), keeps its progress in a checkpoint folder under
the shared checkpoint area, and writes a parquet sink with exactly-once file
commits.  ``trigger(availableNow=True)`` replays a backlog in bounded
micro-batches (``maxFilesPerTrigger``) and stops.
"""

from __future__ import annotations

import time
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import packed_order, time_parts
from ..operators import parse as PZ
from ..sources.files import new_table_path

DEFAULT_LATENESS = "30 minutes"


def message_stream(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Raw payload stream: one message per line in column ``value``."""
    return spark.readStream.option("maxFilesPerTrigger", max_files).text(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, max_offsets: int = 100_000) -> DataFrame:
    """Raw payload stream from a Kafka topic, same ``value`` column as the file source.

    Needs the Spark Kafka connector on the classpath (not bundled here).
    """
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).option("startingOffsets", "earliest")
            .option("maxOffsetsPerTrigger", max_offsets).load()
            .select(F.col("value").cast("string").alias("value"), F.col("timestamp").alias("publish_ts")))


def publish_to_kafka(published: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Write a publish frame (key, value, headers) to Kafka; batch or streaming input."""
    out = published.select(F.col("key").cast("binary"), F.col("value").cast("binary"), "headers")
    if published.isStreaming:
        return (out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
                .option("checkpointLocation", checkpoint).start())
    out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    return None


def validated_stream(raw: DataFrame) -> DataFrame:
    """Parsed + validated messages; event time as TIMESTAMP (watermarks reject NTZ)."""
    v = PZ.validate_messages(raw)
    return v.withColumn("event_ts", F.col("timestamp").cast("timestamp"))


def run_to_parquet(df: DataFrame, sink: str, mode: str = "append", partition_by: list[str] | None = None,
                   checkpoint: str | None = None) -> str:
    """Run a streaming frame to a parquet sink until the backlog is drained."""
    ck = checkpoint or sink.rstrip("/") + "_checkpoint"
    w = (df.writeStream.format("parquet").outputMode(mode).option("path", sink)
         .option("checkpointLocation", ck).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    return sink


def run_foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                      mode: str = "update"):
    q = (df.writeStream.outputMode(mode).foreachBatch(fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def write_messages(df: DataFrame, path: str) -> str:
    """Stage payloads as JSON-lines text files (the replayable message backlog)."""
    df.select("value").write.mode("append").text(path)
    return path


BACKLOG_FILE_ROWS = 200_000


def write_messages_in_order(df: DataFrame, path: str, files: int = 3) -> str:
    """Stage a backlog in event-time order: each file counts as written after those with earlier events.

    A file source reads files by modification time, so a replay sees ordered
    events however many files a micro-batch takes, and its watermark drops none.
    One job writes all files at once, range-partitioned by time and a hash of
    the message: messages of one time are divided too, so files hold about
    ``BACKLOG_FILE_ROWS`` at most.  Their times are set afterwards, in order,
    after all files that were there before.  The file system must keep such
    times (HDFS and local ones do).
    """
    spark = df.sparkSession
    t = F.coalesce(F.get_json_object("value", "$.start_time"), F.get_json_object("value", "$.event_time"))
    rows = df.select("value", t.alias("__t"), F.xxhash64("value").alias("__h"))
    files = max(files, -(-rows.count() // BACKLOG_FILE_ROWS))
    known = {f: m for f, m in _files(spark, path)}
    rows.repartitionByRange(files, "__t", "__h").sortWithinPartitions("__t", "__h").select("value").write.mode("append").text(path)
    new = sorted((f for f, _ in _files(spark, path) if f not in known), key=lambda f: f.rsplit("/", 1)[-1])      # part-00000 on: range order
    at = max([int(time.time() * 1000) - 1000 * len(new), *[m + 1000 for m in known.values()]])
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for k, f in enumerate(new):
        fs.setTimes(spark._jvm.org.apache.hadoop.fs.Path(f), at + 1000 * k, -1)
    return path


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Data files of a folder with their modification times, in milliseconds."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    found = [(f.getPath().toString(), f.getPath().getName(), f.getModificationTime()) for f in fs.listStatus(folder) if f.isFile()]
    return [(f, m) for f, name, m in found if not name.startswith(("_", "."))]


def batch_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    """The largest batch id below ``batch_id`` that has been written whole under ``path``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    ids = sorted((int(n.split("=")[1]) for n in names if n.startswith("batch_id=")), reverse=True)
    return next((i for i in ids if i < batch_id and table_exists(spark, f"{path}/batch_id={i}/_SUCCESS")), None)


def drop_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch_id={batch_id}")
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(old):
        fs.delete(old, True)


def write_batch(batch: DataFrame, batch_id: int, sink: str) -> None:
    """Write a micro-batch under its id; a batch that runs again replaces what it wrote before."""
    batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")


# ---- stream operators -------------------------------------------------------------------

def windowed_candles(v: DataFrame, duration: str = "1 hour", lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """Ticks -> OHLCV bars per (symbol, tumbling window) with an event-time watermark."""
    order = packed_order(F.unix_micros("event_ts"), "event_id")
    return (v.where(F.col("reject_reason").isNull())
            .withWatermark("event_ts", lateness)
            .groupBy("symbol", F.window("event_ts", duration).alias("w"))
            .agg(F.min_by("open", order).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
                 F.max_by("close", order).alias("close"), F.sum("volume").alias("volume"),
                 F.count(F.lit(1)).alias("trades")))


def latest_per_key(sink_df: DataFrame, keys: list[str], version: str = "batch_id") -> DataFrame:
    """Read side of an update-mode sink: the last emitted version of each key."""
    cols = [c for c in sink_df.columns if c not in keys and c != version]
    return (sink_df.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col(version)).alias("__r"))
            .select(*keys, "__r.*"))


def update_mode_to_parquet(df: DataFrame, sink: str, checkpoint: str) -> str:
    """Update-mode aggregate -> append each batch's changed rows with their batch id."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, sink)
    run_foreach_batch(df, fn, checkpoint, "update")
    return sink


def newest_before(spark: SparkSession, log_path: str, batch_id: int) -> int | None:
    """The newest event time, in microseconds, that the last batch below ``batch_id`` logged."""
    before = batch_before(spark, log_path, batch_id)
    return None if before is None else spark.read.schema("us long").parquet(f"{log_path}/batch_id={before}").first()[0]


def log_newest(rows: DataFrame, ts_col: str, seen: int | None, batch_id: int, log_path: str) -> None:
    """Log the newest event time so far under the batch's id, one row."""
    newest = rows.agg(F.max(F.unix_micros(ts_col)).alias("us"))
    write_batch(newest.select(F.greatest("us", F.lit(seen).cast("long")).alias("us")), batch_id, log_path)


class LateSplitter:
    """foreachBatch body: rows older than (max event time of earlier batches - lateness) go to quarantine.

    Every batch logs the newest event time so far under its id, one row; the
    next reads that row alone, however long the history.  A batch that runs
    again decides as before and replaces its own output.
    """

    def __init__(self, good_path: str, late_path: str, lateness_seconds: int, log_path: str | None = None):
        self.good_path, self.late_path, self.lateness = good_path, late_path, lateness_seconds
        self.log_path = log_path or good_path.rstrip("/") + "_newest"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        seen = newest_before(batch.sparkSession, self.log_path, batch_id)
        is_late = F.lit(False)
        if seen is not None:
            is_late = F.col("event_ts") < F.timestamp_micros(F.lit(seen)) - F.expr(f"INTERVAL {self.lateness} SECONDS")
        b = batch.withColumn("is_late", is_late).persist()
        write_batch(b.where(F.col("is_late")).drop("is_late"), batch_id, self.late_path)
        write_batch(b.where(~F.col("is_late")).drop("is_late"), batch_id, self.good_path)
        log_newest(b.where(~F.col("is_late")), "event_ts", seen, batch_id, self.log_path)
        b.unpersist()


def dedupe_stream(v: DataFrame, lateness: str = DEFAULT_LATENESS) -> DataFrame:
    """At-least-once redelivery: one row per (symbol, event time) within the watermark."""
    return v.withWatermark("event_ts", lateness).dropDuplicatesWithinWatermark(["symbol", "event_ts"])


def health_counts(v: DataFrame) -> DataFrame:
    """received / processed / errors / last event time of a batch of validated messages, one row."""
    return v.agg(F.count(F.lit(1)).alias("received"), F.count_if(F.col("reject_reason").isNull()).alias("processed"),
                 F.count_if(F.col("reject_reason").isNotNull()).alias("errors"),
                 F.max(F.unix_micros("event_ts")).alias("last_event_us"))


def stream_health(v: DataFrame, sink: str, checkpoint: str) -> DataFrame:
    """Counts of a whole validated stream: each micro-batch writes its own, the totals are their sums."""
    run_foreach_batch(v, lambda batch, i: write_batch(health_counts(batch), i, sink), checkpoint, "append")
    return v.sparkSession.read.parquet(sink).agg(
        *[F.sum(c).alias(c) for c in ("received", "processed", "errors")], F.max("last_event_us").alias("last_event_us"))


def stream_unified_rows(ind: DataFrame, keep_late: bool = False) -> DataFrame:
    """Stateful indicator rows -> 21-column unified rows tagged ``streaming``.

    Late rows are left out, or kept with their flag for a sink that quarantines them.
    """
    from ..operators.indicators import UNIFIED_COLS
    x = ind if keep_late else ind.where(~F.col("late"))
    x = x.withColumn("timestamp", F.col("event_ts").cast("timestamp_ntz"))
    x = x.select("*", *time_parts("timestamp")).withColumn("source", F.lit("streaming")) \
         .withColumn("ingestion_timestamp", F.current_timestamp())
    return x.select(*UNIFIED_COLS, *(["late"] if keep_late else []))


def scratch(spark: SparkSession, name: str) -> str:
    return new_table_path(spark, name)


REQUIRED_UNIFIED = ["timestamp", "date", "hour", "symbol", "open", "high", "low", "close", "volume", "source",
                    "ingestion_timestamp"]


def table_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def create_table(spark: SparkSession, schema, path: str, partition_by=("date",)) -> str:
    """Create an empty day-partitioned table folder with the fixed schema (done once, up front)."""
    spark.createDataFrame([], schema).write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return path


def append_to_existing_table(rows: DataFrame, path: str, checkpoint: str, partition_by=("date",),
                             keys=("symbol", "timestamp"), late_path: str | None = None,
                             prepare: Callable[[DataFrame, int], DataFrame] | None = None):
    """Streaming append of unified rows into an existing table (create-never).

    Each micro-batch is cast to the fixed 21-column types, rows with a NULL in
    a required column are dropped, and rows whose key is already in the table
    are skipped (anti join against the batch's dates only, pruned by the date
    partitions), so a re-executed batch after a failure appends nothing twice.
    Plain batch writes are used, not the streaming file sink: its metadata log
    would hide the table's batch-written files from readers.  An absent table
    is an error, never created here.  Rows flagged ``late`` go to ``late_path``.
    ``prepare(batch, id)`` makes the unified rows of a batch where the stream does not hold them.
    """
    spark = rows.sparkSession
    if not table_exists(spark, path):
        raise FileNotFoundError(f"table {path} does not exist (create-never)")

    def fn(batch: DataFrame, batch_id: int) -> None:
        batch = prepare(batch, batch_id) if prepare else batch
        if late_path:
            batch = batch.persist()
            write_batch(batch.where("late"), batch_id, late_path)
            batch = batch.where("NOT late").drop("late")
        b = PZ.format_for_warehouse(batch, REQUIRED_UNIFIED).persist()
        dates = [r[0] for r in b.select("date").distinct().collect()]      # the few days of one micro-batch
        if dates:
            existing = (spark.read.schema(b.schema).parquet(path)
                        .where(F.col("date").isin(dates)).select(*keys))
            (b.join(existing, list(keys), "left_anti")
             .write.mode("append").partitionBy(*partition_by).parquet(path))
        b.unpersist()

    return run_foreach_batch(rows, fn, checkpoint, "append")


def split_to_sinks(raw: DataFrame, good_path: str, quarantine_path: str, checkpoint: str):
    """Validate a payload stream; accepted rows and rejects (with reason) go to two sinks per batch."""
    v = validated_stream(raw)

    def fn(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist()
        good, bad = PZ.split_rejects(b)
        write_batch(good.drop("reject_reason", "value"), batch_id, good_path)
        write_batch(bad, batch_id, quarantine_path)
        b.unpersist()

    return run_foreach_batch(v, fn, checkpoint, "append")
