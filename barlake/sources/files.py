"""File scans and sinks (CSV history, parquet fact, JSON logs, result tables).

Paths are plain URIs (HDFS / object store / local).  Intermediate and test
tables go under the shared checkpoint folder (``spark.checkpoint.dir``),
never a machine-local temp folder.  Writes are whole-job commits through
Spark's output committer, so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

# Fixed column order/types of the historical CSV files.
HISTORICAL_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("open_time", T.TimestampNTZType()),
    T.StructField("open", T.DoubleType()), T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()), T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()), T.StructField("quote_volume", T.DoubleType()),
    T.StructField("trades", T.LongType()), T.StructField("taker_buy_base", T.DoubleType()),
    T.StructField("taker_buy_quote", T.DoubleType()),
])
HISTORICAL_COLS = [f.name for f in HISTORICAL_SCHEMA.fields]
CORRUPT = "_corrupt"


def new_table_path(spark: SparkSession, name: str) -> str:
    """Fresh folder under the shared scratch area (one per run, never reused)."""
    return scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex[:12]}")


def write_csv_by_symbol_year(rows: DataFrame, path: str) -> None:
    """CSV files with header per (symbol, year): ``{path}/symbol_dir=<sym>/year=<y>/part-*.csv``.

    Range partitioning on (symbol, year, open time) splits a large symbol-year
    over several writers (several files in its folder, each in time order)
    instead of funnelling it through one task.
    """
    (rows.select(*HISTORICAL_COLS)
     .withColumn("symbol_dir", F.lower("symbol")).withColumn("year", F.year("open_time"))
     .repartitionByRange("symbol_dir", "year", "open_time").sortWithinPartitions("symbol_dir", "year", "open_time")
     .write.mode("overwrite").partitionBy("symbol_dir", "year")
     .option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def scan_historical_csv(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """Read history CSVs with the fixed schema (no inference); a bad line stays whole in ``_corrupt``."""
    return (spark.read.schema(T.StructType([*HISTORICAL_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())]))
            .option("header", True).option("quote", '"').option("columnNameOfCorruptRecord", CORRUPT)
            .option("mode", "PERMISSIVE").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .option("recursiveFileLookup", False).csv(paths))


def ingest_stats_by_symbol_year(rows: DataFrame) -> DataFrame:
    return (rows.groupBy("symbol", F.year("open_time").cast("bigint").alias("year"))
            .agg(F.min("open").alias("open_price_min"), F.max("open").alias("open_price_max"),
                 F.sum("volume").alias("volume_total"), F.sum("trades").alias("trades_total"),
                 F.count(F.lit(1)).alias("candles_fetched")))


def ingest_summary(stats: DataFrame) -> DataFrame:
    return stats.agg(F.sum("candles_fetched").alias("total_candles"),
                     F.countDistinct("year").alias("total_years"),
                     F.countDistinct("symbol").alias("total_symbols"))


def run_audit(stats: DataFrame, run_id: str, errors: DataFrame | None = None) -> DataFrame:
    """One audit row of a run: totals, errors by type and the status they imply.

    ``errors`` has one row per error with its ``error_type``.  A run without a
    single candle has failed; errors beside candles are counted, not fatal.
    """
    one = ingest_summary(stats).withColumn("__k", F.lit(1))
    if errors is None:
        errors = stats.where("false").select(F.lit("").alias("error_type"))
    by_type = errors.groupBy("error_type").agg(F.count(F.lit(1)).alias("n"))      # a handful of types
    err = by_type.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_errors"),
                      F.sort_array(F.collect_list(F.struct("error_type", "n"))).alias("errors_by_type")).withColumn("__k", F.lit(1))
    candles = F.coalesce(F.col("total_candles"), F.lit(0)).cast("bigint")
    return (one.join(err, "__k").select(
        F.lit(run_id).alias("execution_id"), F.when(candles > 0, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
        F.current_date().alias("run_date"), candles.alias("total_candles"), "total_years", "total_symbols", "total_errors", "errors_by_type"))


def run_audit_details(stats: DataFrame, run_id: str) -> DataFrame:
    """One row per (year, symbol) of a run, next to its audit row."""
    return stats.select(F.lit(run_id).alias("execution_id"), F.current_date().alias("run_date"), "*")


def write_audit_json(audit: DataFrame, path: str) -> None:
    """Append audit rows under ``run_date=YYYY-MM-DD`` folders as JSON."""
    audit.write.mode("append").partitionBy("run_date").json(path)


def write_parquet_partitioned(df: DataFrame, path: str, mode: str = "append",
                              cluster: tuple[str, ...] = ("symbol", "hour")) -> None:
    """Day-partitioned fact layout, clustered inside files by (symbol, hour) for min/max skipping.

    Range partitioning on (date, symbol, hour) keeps each writer on a narrow,
    sorted slice: a heavy day is split over several tasks and files rather
    than written by one.
    """
    (df.repartitionByRange("date", *cluster).sortWithinPartitions("date", *cluster)
     .write.mode(mode).partitionBy("date").parquet(path))


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_single_csv(df: DataFrame, path: str) -> None:
    """Small result tables only (model results): one CSV file with header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    """Reload a (small) table: write aside, then swap by rename.

    Readers see the old table until the new one is whole.  A failure before the
    swap leaves the old table; one between its two renames leaves it under the
    name ``path + ".old"``, from where the next reload, or ``recover_table``, puts it back.
    """
    spark = df.sparkSession
    recover_table(spark, path)
    new, old = _path(spark, path + ".new"), _path(spark, path + ".old")
    df.write.mode("overwrite").parquet(path + ".new")
    fs, at = _fs(spark, path), _path(spark, path)
    if fs.exists(at):
        _rename(fs, at, old)
    _rename(fs, new, at)
    fs.delete(old, True)


def recover_table(spark, path: str) -> None:
    """Finish or undo a swap that broke off; what was written aside but not swapped is left for the next reload to replace."""
    fs, at, old = _fs(spark, path), _path(spark, path), _path(spark, path + ".old")
    if fs.exists(old):
        if fs.exists(at):
            fs.delete(old, True)
        else:
            _rename(fs, old, at)


def table_there(spark, path: str) -> bool:
    """Whether a whole table lies at ``path``, after a broken swap has been undone."""
    recover_table(spark, path)
    return _fs(spark, path).exists(_path(spark, path + "/_SUCCESS"))


def _path(spark, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _rename(fs, a, b) -> None:
    if not fs.rename(a, b):
        raise OSError(f"{a} could not be renamed to {b}")
