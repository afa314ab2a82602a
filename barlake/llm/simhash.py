"""SimHash near-duplicates with covering locality-sensitive hashing.

Bit i of a fingerprint gets a non-zero code c(i) of r + 1 bits.  Table v
(1 <= v < 2**(r+1)) keys a fingerprint by the bits whose code has odd overlap
with v.  The codes of any r differing bits span at most r dimensions, so some
v is orthogonal to all of them: every pair within radius r shares the key of
at least one table.  Inside a bucket only the bits outside the mask can
differ; members meet at a common fingerprint one flip away from both (radius
2) and are linked to the smallest fingerprint there.  Every such ball holds a
bounded number of fingerprints, so no group's pairs are ever listed.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import free_name, query, read_table
from .components import connected_components

BITS = 64
SEED = 42
SHINGLE = 3
RADIUS = 2
COUNT_BLOCK = 1 << 15


def fingerprint(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of the word shingles of a UTF-8 text as a signed 64-bit integer; no words: 0."""
    words = (text or b"").lower().split()          # bytes: lowers A-Z and splits at ASCII white space only
    if not words:
        return 0
    grams = zip(*(words[i:] for i in range(shingle))) if len(words) >= shingle else [words]
    n = max(1, len(words) - shingle + 1)
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=seed), map(b" ".join, grams)), dtype="<u8", count=n)
    ones = np.zeros(BITS, dtype="i8")
    for i in range(0, n, COUNT_BLOCK):
        part = h[i:i + COUNT_BLOCK].view("u1").reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype="i4")
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def add_fingerprints(docs: DataFrame, shingle: int = SHINGLE, text_col: str = "text", out: str = "fp") -> DataFrame:
    """Replace the text column by its fingerprint, batch by batch."""
    fields = [f for f in docs.schema.fields if f.name != text_col]

    def run(batches):
        for b in batches:
            texts = b.column(text_col).cast(pa.binary())
            fps = pa.array((fingerprint(t.as_py(), shingle) for t in texts), pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in fields), fps], [*(f.name for f in fields), out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", `{out}` long"
    return docs.mapInArrow(run, schema)


def covering_masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """Masks of the 2**(radius+1) - 1 tables as signed 64-bit integers."""
    codes = 2 ** (radius + 1) - 1
    masks = []
    for v in range(1, codes + 1):
        m = sum(1 << i for i in range(bits) if bin((1 + i % codes) & v).count("1") % 2)
        masks.append(m - (1 << 64) if m >> 63 else m)
    return masks


def _signed_bit(i: int) -> int:
    return -(1 << 63) if i == 63 else 1 << i


def fingerprint_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that join all distinct fingerprints ``fps(fp)`` within ``radius`` (at most 2)."""
    if not 0 <= radius <= 2:
        raise ValueError("radius must be 0, 1 or 2")
    masks = covering_masks(radius)
    key = F.transform(F.array(*[F.lit(m) for m in masks]), lambda m: F.col("fp").bitwiseAND(m))
    keyed = fps.select("fp", F.posexplode(key).alias("t", "key"))
    full = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    members = keyed.join(full, ["t", "key"])
    # members of a bucket that lie within the radius share a fingerprint one flip from each
    flips = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(_signed_bit(i)) for i in range(BITS) if not (m >> i) & 1])
                      for m in masks])
    balls = members.select("t", "fp", F.explode(F.get(flips, F.col("t"))).alias("flip"))
    balls = balls.select("t", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("centre"))
    # any two members of a ball differ by two bits at most; by one only if one of them is its centre
    hub = F.min("fp") if radius == 2 else F.max(F.when(F.col("fp") == F.col("centre"), F.col("fp")))
    low = balls.groupBy("t", "centre").agg(hub.alias("low"), F.count("*").alias("n")).where("n > 1 AND low IS NOT NULL")
    links = balls.join(low, ["t", "centre"]).where("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b")).distinct()
    return links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of every row.

    ``root`` is the component's smallest fingerprint (as a signed number) and names it;
    ``component_id`` is the smallest id reachable.

    * NULL or empty text, or only white space: fingerprint 0, linked like any other.
    * NULL ids take part; a component without any id has component_id NULL, and a root like any other.
    * Repeated rows stay repeated; an empty table gives no rows; other columns are not read.
    * Copies meet as one fingerprint, so a text that fills a third of the table
      costs no more than one row in the search.
    """
    rows = add_fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                                        F.xxhash64(F.col(text_col)).alias("text_hash")), shingle)
    rows = cut_lineage(rows)
    fps = rows.groupBy("fp").agg(F.min("id").alias("low_id"))
    links = fingerprint_links(fps.select("fp"), radius)
    comp = connected_components(links)
    fps = fps.join(comp, fps["fp"] == comp["node"], "left").select(
        "fp", "low_id", F.coalesce("root", "fp").alias("root"))
    fps = cut_lineage(fps)
    roots = fps.groupBy("root").agg(F.min("low_id").alias("component_id"))
    names = fps.join(roots, "root").select("fp", "root", "component_id")
    return rows.join(names, "fp").select(F.col("id").alias(id_col), "text_hash", "fp", "root", "component_id")


def keep_one_per_group(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that stay: of each component of ``near_duplicates`` the row with the smallest id.

    Rows are named by (id, text hash), NULL ids last; of rows equal in both one stays.
    Components without any id go by their root like all others.  Columns of any name pass through.
    """
    rank = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("text_hash").alias("h"))
    id_, h_ = free_name(docs.columns, "_id"), free_name(docs.columns, "_h")
    best = (found.groupBy("root", rank.alias("r")).agg(F.count("*").alias("n"))
            .groupBy("root").agg(F.min(F.struct("r", "n")).alias("b"))
            .select(F.col("b.r.id").alias(id_), F.col("b.r.h").alias(h_), F.col("b.n").alias("n")))
    best = cut_lineage(best)
    h = F.xxhash64(F.col(text_col))

    def rows_of(names: DataFrame) -> DataFrame:
        return docs.join(names.select(id_, h_), F.col(id_col).eqNullSafe(F.col(id_)) & (h == F.col(h_)), "left_semi")

    once = rows_of(best.where("n = 1"))
    again = rows_of(best.where("n > 1")).withColumn(h_, h).dropDuplicates([id_col, h_]).drop(h_)
    return once.unionByName(again)


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
