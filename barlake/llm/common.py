"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``, with its DuckDB text if SQL can say it."""
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table once, compressed, below the shared checkpoint folder and read it from there."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_by_key(df: DataFrame, key: str, name: str, buckets: int) -> DataFrame:
    """Like ``written``, in hash buckets of ``key``: later joins and groups by ``key`` read it without a shuffle."""
    spark = df.sparkSession
    buckets = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    table = f"{name}_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, key).option("path", scratch_path(spark, table)).saveAsTable(table)
    out = spark.table(table)
    out.schema                                           # resolved: the files stay when the name goes
    spark.sql(f"DROP TABLE {table}")
    return out


def word_array(text: Column) -> Column:
    """Words of a text, split at ASCII white space only; NULL text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_PATTERN), lambda w: w != F.lit(""))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long"), F.lit(0).cast("long"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside higher-order functions.

    Spark may inline a projected expression into a lambda and evaluate it for
    every element; a lambda variable is bound once.
    """
    return F.transform(F.array(value), body)[0]


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores added until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
