"""Exact top-k inner-product search with norm buckets.

Vectors are grouped into buckets of nearly equal length, and each bucket is
cut into slices of bounded size.  A first pass scores every query against one
slice of the longest vectors; its k-th best score is a true lower bound.  In
the second pass queries are put into blocks by the length that a vector must
have to reach their bound, and a block is sent only to the slices of buckets
that hold such lengths.  A (slice, query block) pair works bucket by bucket,
longest first: with the bound t, the query length and the bucket's largest
length, a member needs a cosine of at least t / (|q| * l).  Above 1 the bucket
is left out.  A high local threshold prunes by the query's largest coordinate (only
unit vectors whose coordinate lies in the feasible interval can reach the
cosine), a low one by length.  Products of the survivors are verified exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from ..session import cut_lineage
from .common import query, read_table

SCALE = 64
LENGTH_STEP = 1.02          # lengths in a bucket differ by at most this factor
SLICE_ROWS = 8192
QUERY_ROWS = 1024
COORDINATE_FROM = 0.5       # local cosine threshold from which coordinates prune better than lengths


def quantize(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as long; NULL if any is NULL or not finite."""
    d = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False)),
                  F.transform(d, lambda x: F.floor(F.lit(float(scale)) * x).cast("long")))


def _pack(key: str):
    """Rows of one bounded group -> one row with ids and a matrix."""
    def run(t: pa.Table) -> pa.Table:
        m = np.array(t.column("v").combine_chunks().flatten()).reshape(t.num_rows, -1).astype("<i8")
        ids = t.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        return pa.table({"dim": pa.array([m.shape[1]], pa.int32()), key: pa.array([t.column(key)[0].as_py()], pa.int64()),
                         "bucket": pa.array([t.column("bucket")[0].as_py()], pa.int32()),
                         "ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
                         "m": pa.array([m[order].tobytes()], pa.binary())})
    return run


def _top(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _exact_dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer products; by doubles when they are exact there."""
    if a.size and b.size and float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[-1] < 2 ** 52:
        return np.rint(a.astype("f8") @ b.astype("f8").T).astype("i8")
    return a @ b.T


_BLOCKS = "dim int, reach double, qids binary, qm binary, bounds binary"
_BLOCK_SCHEMA = pa.schema([("dim", pa.int32()), ("reach", pa.float64()), ("qids", pa.binary()), ("qm", pa.binary()), ("bounds", pa.binary())])


def _bounded_queries(k: int):
    """Query blocks with the first slice -> one row per query: its k-th best score there and the length that reaches it."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                d = r["dim"]
                ids, vecs = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["m"], "<i8").reshape(-1, d)
                qids, qvecs = np.frombuffer(r["qids"], "<i8"), np.frombuffer(r["qm"], "<i8").reshape(-1, d)
                sc = np.where(qids[:, None] == ids[None, :], np.iinfo("i8").min, _exact_dot(qvecs, vecs))
                kth = np.partition(sc, -k, axis=1)[:, -k] if sc.shape[1] >= k else np.full(len(qids), np.iinfo("i8").min)
                qn = np.sqrt((qvecs.astype("f8") ** 2).sum(1))
                reach = np.where(kth > 0, kth / np.maximum(qn, 1e-300), 0.0)           # a bound up to 0 leaves out no length
                flat = pa.array(qvecs.ravel(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([d] * len(qids), pa.int32()), pa.array(reach), pa.array(qids, pa.int64()), pa.array(kth, pa.int64()),
                                                  pa.ListArray.from_arrays(pa.array(np.arange(len(qids) + 1) * d, pa.int32()), flat)],
                                                 names=["dim", "reach", "vec_id", "bound", "v"])
    return run


def _pack_queries(batches):
    """Queries in order of (dim, reach) -> blocks of neighbours with the smallest reach of each."""
    for b in batches:
        dims = b.column("dim").to_numpy()
        a = 0
        while a < b.num_rows:
            z = min(a + QUERY_ROWS, int(np.searchsorted(dims, dims[a], side="right")))
            part = b.slice(a, z - a)
            m = part.column("v").flatten().to_numpy().astype("<i8")
            row = {"dim": int(dims[a]), "reach": float(part.column("reach")[0].as_py()), "qids": part.column("vec_id").to_numpy().astype("<i8").tobytes(),
                   "qm": m.tobytes(), "bounds": part.column("bound").to_numpy().astype("<i8").tobytes()}
            yield pa.RecordBatch.from_pylist([row], schema=_BLOCK_SCHEMA)
            a = z


def search_block(ids, vecs, qids, qvecs, bounds, k: int, step: float = LENGTH_STEP):
    """k best of a slice for each query that can still beat its bound: (query row, id, score)."""
    norms = np.sqrt((vecs.astype("f8") ** 2).sum(1))
    order = np.argsort(-norms, kind="stable")
    ids, vecs, norms = ids[order], vecs[order], norms[order]
    unit = vecs / np.maximum(norms, 1e-300)[:, None]
    level = np.floor(np.log(np.maximum(norms, 1e-300)) / np.log(step)).astype("i8")
    starts = np.flatnonzero(np.r_[True, level[1:] != level[:-1]]) if len(ids) else np.array([], "i8")
    ends = np.r_[starts[1:], len(ids)].astype("i8")
    by_coord: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for qi in range(len(qids)):
        q, theta = qvecs[qi], bounds[qi]
        qn = float(np.sqrt((q.astype("f8") ** 2).sum()))
        f = int(np.argmax(np.abs(q))) if len(q) else 0
        best_i, best_s = np.array([], "i8"), np.array([], "i8")
        for s, e in zip(starts, ends):
            need = theta / (qn * norms[s]) if qn > 0 and norms[s] > 0 else (2.0 if theta > 0 else -2.0)
            need -= 1e-9                                         # rounding never removes a candidate
            if need > 1:                                         # shorter buckets can't reach it either
                if theta > 0:
                    break
                continue
            if need >= COORDINATE_FROM:
                if (s, f) not in by_coord:
                    o = np.argsort(unit[s:e, f], kind="stable")
                    by_coord[s, f] = (o + s, unit[s:e, f][o])
                rows, coord = by_coord[s, f]
                qf = q[f] / qn
                span = np.sqrt(max(0.0, 1 - qf * qf) * max(0.0, 1 - need * need))
                a, b = np.searchsorted(coord, [qf * need - span - 1e-9, qf * need + span + 1e-9])
                # the interval is cut at the pole only from the side on which the query lies
                if qf > need:
                    b = len(coord)
                elif qf < -need:
                    a = 0
                cand = rows[a:b]
            elif theta > 0:
                cand = np.arange(s, s + np.searchsorted(-norms[s:e], -theta / qn + 1e-9, side="right"))
            else:
                cand = np.arange(s, e)
            if not len(cand):
                continue
            sc = _exact_dot(vecs[cand], q[None, :])[:, 0]
            ok = (sc >= theta) & (ids[cand] != qids[qi])
            best_i, best_s = _top(np.r_[best_i, ids[cand][ok]], np.r_[best_s, sc[ok]], k)
            if len(best_s) == k:
                theta = max(theta, best_s[-1])
        yield qi, best_i, best_s


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of each query.

    ``queries`` has the same columns as ``vectors``; a row with the query's
    own id is no candidate.  Ties go to the smaller id.  Vectors that are NULL,
    empty or hold NULL or non-finite components, and rows without id, take no
    part; vectors meet only vectors of their own dimension; repeated equal rows
    count once.  Empty tables give no rows.  Queries meet all vectors in blocks
    of bounded size, whatever keys or copies prevail.
    """
    def prepare(df: DataFrame) -> DataFrame:
        return (df.select(F.col(id_col).cast("long").alias("vec_id"), quantize(F.col(vector_col), scale).alias("v"))
                .where("vec_id IS NOT NULL AND v IS NOT NULL").distinct()
                .withColumn("dim", F.size("v")))

    spark = vectors.sparkSession
    norm2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    bucket = F.floor(F.log(F.greatest(F.sqrt(norm2), F.lit(1.0))) / F.log(F.lit(LENGTH_STEP))).cast("int")
    v = cut_lineage(prepare(vectors).withColumn("bucket", bucket))
    # slices of about SLICE_ROWS rows inside (dim, bucket), from counts of the buckets
    sizes = v.groupBy("dim", "bucket").agg(F.count("*").alias("n"))
    nslices = F.greatest(F.lit(1), F.ceil(F.col("n") / SLICE_ROWS)).cast("long")
    slices = sizes.select("dim", "bucket", nslices.alias("k"),
                          F.coalesce(F.sum(nslices).over(Window.partitionBy("dim").orderBy(F.desc("bucket"))
                                                         .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    slices = cut_lineage(slices)
    packed = "dim int, slice long, bucket int, ids binary, m binary"
    sl = cut_lineage(v.join(broadcast_if_small(slices), ["dim", "bucket"])       # one row per length step
                     .withColumn("slice", F.col("first") + F.pmod(F.xxhash64("vec_id", "v"), F.col("k")))
                     .groupBy("dim", "slice").applyInArrow(_pack("slice"), packed))
    q = prepare(queries).withColumn("bucket", F.lit(0))
    nq = q.count()
    blocks = max(1, -(-nq // QUERY_ROWS))
    qb = (q.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)))
          .groupBy("dim", "block").applyInArrow(_pack("block"), packed.replace("slice", "block"))
          .select("dim", "block", F.col("ids").alias("qids"), F.col("m").alias("qm")))
    qb = cut_lineage(qb)

    def work(batches):
        for b in batches:
            for r in b.to_pylist():
                d = r["dim"]
                ids, vecs = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["m"], "<i8").reshape(-1, d)
                qids, qvecs = np.frombuffer(r["qids"], "<i8"), np.frombuffer(r["qm"], "<i8").reshape(-1, d)
                bounds = np.frombuffer(r["bounds"], "<i8").astype("f8")
                oq, oi, os_ = [], [], []
                for qi, bi, bs in search_block(ids, vecs, qids, qvecs, bounds, k):
                    oq.append(np.full(len(bi), qids[qi])); oi.append(bi); os_.append(bs)
                if oq:
                    yield pa.RecordBatch.from_pydict({"query_id": pa.array(np.concatenate(oq), pa.int64()),
                                                      "vec_id": pa.array(np.concatenate(oi), pa.int64()),
                                                      "score": pa.array(np.concatenate(os_), pa.int64())})

    # pass 1: one slice of the longest vectors gives each query its bound; queries of like reach form the blocks of pass 2
    seeds = qb.join(sl.where("slice = 0"), "dim")
    bounded = seeds.mapInArrow(_bounded_queries(k), "dim int, reach double, vec_id long, bound long, v array<bigint>")
    bounded = bounded.repartitionByRange(blocks, "dim", "reach", "vec_id").sortWithinPartitions("dim", "reach", "vec_id")
    qb = cut_lineage(bounded.mapInArrow(_pack_queries, _BLOCKS).withColumn("block", F.monotonically_increasing_id()))
    # pass 2: a block meets the slices of buckets whose longest vectors can have its reach
    longest = F.pow(F.lit(LENGTH_STEP), F.col("bucket") + 1) * (1 + 1e-9)
    lengths = broadcast_if_small(slices.select("dim", longest.alias("longest"), (F.col("first") + F.col("k")).alias("end")))
    ends = (qb.select("dim", "block", "reach").join(lengths, "dim").where((F.col("longest") >= F.col("reach")) | (F.col("reach") <= 0))
            .groupBy("dim", "block").agg(F.max("end").alias("end")))
    grid = qb.join(ends, ["dim", "block"]).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("end") - 1)))
    hits = (grid.join(sl.select("dim", "slice", "ids", "m"), ["dim", "slice"])
            .mapInArrow(work, "query_id long, vec_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (hits.distinct().withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


SQL = """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e::DOUBLE[], v.e::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op3_topk_search", SQL)
def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(v, v.where("vec_id % 20 = 0"), 20)
