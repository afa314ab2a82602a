"""Corpus pipeline: raw documents to token ids, one operator a stage.

quality rules -> SimHash near-dedup -> PII surrogates -> source mix -> BPE.
Every stage takes (spark, docs, sf_dir) and its result is written as Parquet
before the next one reads it.  All but the last return the columns of
``documents``, whatever further columns these have.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import bpe, mixing, pii, quality, simhash
from barlake.llm.common import free_name, read_table
from barlake.session import scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or diverge from their language go; copies weigh once in the references."""
    out = free_name(docs.columns, "quality")
    return quality.quality_rules(docs, out=out).where(F.col(f"{out}.kept")).select(*[f"`{c}`" for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays; NULL ids come last."""
    return simhash.keep_one_per_group(docs, simhash.near_duplicates(docs))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Detected entities get surrogates; n_chars follows the new text."""
    out = pii.pseudonymize(docs, pii.session_key(spark))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(docs.schema["n_chars"].dataType)))
    return out.select(*[f"`{c}`" for c in docs.columns])


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, copies as equal rows."""
    return mixing.repeat_rows(docs).select(*[f"`{c}`" for c in docs.columns])


def tokenize_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    return bpe.encode_and_decode(docs, bpe.vocabulary_path())


STAGES = [
    ("quality rules", quality_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("pii surrogates", pii_stage),
    ("mix sources", mix_stage),
    ("bpe", tokenize_stage),
]

#: SQL has neither the fingerprints' hash nor BPE; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}-{i}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
