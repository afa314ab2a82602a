"""Whitening of embeddings from an exact, bit-sliced scatter matrix.

Vector entries become whole numbers.  Every distinct vector counts once in the
fit.  A block of rows is shifted by its smallest entry per dimension and cut
into bit planes; the bits of one plane over all rows of the block are packed
into 64-bit words.  The cross-product of two dimensions is then the sum over
their planes of ``2**(i + j) * popcount(plane_i & plane_j)``, and undoing the
shift gives the products of the entries themselves.  Blocks add up to whole
numbers of any size, which travel as limbs of 32 bits; the covariance is
centred while still whole, and only then divided and decomposed.

What reaches the driver follows the square of the dimension, not the rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from .common import free_name, query, read_table, written

SCALE = 256
COMPONENTS = 4
BLOCK_ROWS = 8192           # rows whose planes are packed together; fewer where vectors are long
BLOCK_BYTES = 16 << 20
LIMB = 32
SAFE = 1 << 62              # sums below it fit a signed 64-bit number


def whole_entries(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every entry, NULL for vectors that are NULL or hold NULL or non-finite entries.

    Entries beyond 64 bits become the largest or smallest 64-bit number.
    """
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return F.when(~odd, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))


def _rows(column: pa.Array) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix) for every vector length of an Arrow list column."""
    sizes = np.diff(column.offsets.to_numpy())
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)
    out = []
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        out.append((int(d), rows, flat[(ends[rows] - d)[:, None] + np.arange(d)] if d else np.empty((len(rows), 0), "i8")))
    return out


def cross_products(x: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sums per dimension and the matrix of cross-products of the rows of ``x`` (64-bit), as exact whole numbers."""
    n, d = x.shape
    low = x.min(axis=0)
    y = x.astype("u8") - low.astype("u8")                               # exact modulo 2**64, so exact
    bits = [int(v).bit_length() for v in y.max(axis=0)]
    plane, owner, weight = [], [], []
    words = -(-n // 64)
    for i in range(max(bits, default=0)):
        held = np.array([k for k in range(d) if bits[k] > i])
        bit = np.zeros((words * 64, len(held)), "u1")
        bit[:n] = (y[:, held] >> np.uint64(i)) & np.uint64(1)
        plane.append(np.ascontiguousarray(np.packbits(bit, axis=0).T).view("u8"))
        owner.extend(held)
        weight.extend([i] * len(held))
    order = np.argsort(np.array(owner, "i8"), kind="stable")
    planes = np.concatenate(plane)[order] if plane else np.empty((0, words), "u8")
    owner, weight = np.array(owner, "i8")[order], np.array(weight, "i8")[order]
    counts = np.zeros((len(planes), len(planes)), "i8")
    for p in range(len(planes)):
        counts[p, p:] = np.bitwise_count(planes[p] & planes[p:]).sum(axis=1, dtype="i8")
        counts[p:, p] = counts[p, p:]
    kind = "i8" if 2 * max(bits, default=0) + n.bit_length() < 62 else object
    power = np.array([1 << int(w) for w in weight], kind)
    own, first = np.unique(owner, return_index=True)
    products = np.zeros((d, d), object)
    sums = [0] * d
    if len(own):
        part = np.add.reduceat(np.add.reduceat(counts.astype(kind) * power[:, None] * power, first, axis=0), first, axis=1)
        products[np.ix_(own, own)] = part.astype(object)
        for k, s in zip(own, np.add.reduceat(np.diag(counts).astype(kind) * power, first)):
            sums[k] = int(s)
    shift, moved = np.array([int(v) for v in low], object), np.array(sums, object)
    if d:
        products = products + np.outer(shift, moved) + np.outer(moved, shift) + n * np.outer(shift, shift)
    return [int(s + n * m) for s, m in zip(sums, shift)], products


def _limbs(value: int) -> list[int]:
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << LIMB) - 1)))
        value >>= LIMB
    return out


def _scatter(batches):
    """(dim, i, j, limb, v) of the rows of a task: cross-products for i <= j, sums as j = -1, the count as i = j = -1."""
    held: dict[int, list] = {}
    for b in batches:
        for d, _, x in _rows(b.column(0)):
            step = max(64, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(d, 1)) // 64 * 64))
            for a in range(0, len(x), step):
                block = x[a:a + step]
                sums, products = cross_products(block)
                if d not in held:
                    held[d] = [len(block), sums, products]
                else:
                    h = held[d]
                    held[d] = [h[0] + len(block), [p + q for p, q in zip(h[1], sums)], h[2] + products]
    for d, (n, sums, products) in held.items():
        rows = [(d, -1, -1, k, v) for k, v in enumerate(_limbs(n))]
        rows += [(d, i, -1, k, v) for i, s in enumerate(sums) for k, v in enumerate(_limbs(s))]
        rows += [(d, i, j, k, v) for i in range(d) for j in range(i, d) for k, v in enumerate(_limbs(int(products[i, j])))]
        for a in range(0, len(rows), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a:a + (1 << 16)]), [pa.int32()] * 4 + [pa.int64()])],
                                             names=["dim", "i", "j", "limb", "v"])


class Fit:
    """Whitening of the vectors of one length: n, exact sums S, components by falling eigenvalue."""

    def __init__(self, n: int, sums: list[int], products: np.ndarray, components: int):
        d = len(sums)
        s = np.array(sums, object)
        centred = n * products - np.outer(s, s) if d else np.zeros((0, 0), object)      # n**2 times the covariance
        v = np.array([[a / (n * n) for a in row] for row in centred.tolist()], "f8").reshape(d, d)
        e, u = np.linalg.eigh(v) if d else (np.empty(0), np.empty((0, 0)))
        take = np.arange(d)[::-1][:components]
        trace = sum(centred[i, i] for i in range(d)) / (n * n) if d else 0.0
        least = trace * max(d, 1) * np.finfo("f8").eps
        self.n, self.sums, self.u, self.e = n, sums, np.ascontiguousarray(u[:, take]), e[take]
        self.whole = [bool(x > least) for x in self.e]                                  # others are rounding of 0
        self.explained = [max(float(x), 0.0) / trace if trace else None for x in self.e]

    def rows(self, x: np.ndarray) -> tuple[list[int], np.ndarray]:
        """(sum over dimensions of (n*x - S)**2, whitened values; NaN where an eigenvalue is 0)."""
        largest = max((abs(int(v)) for v in (x.max(), x.min())), default=0) if x.size else 0
        bound = self.n * largest + max(map(abs, self.sums), default=0)
        kind = "i8" if len(self.sums) * bound * bound < SAFE else object
        off = x.astype(kind) * self.n - np.array(self.sums, kind)
        scale = np.array([1 / math.sqrt(e) if ok else math.nan for e, ok in zip(self.e, self.whole)])
        return (off * off).sum(axis=1).tolist() if len(self.sums) else [0] * len(x), ((off / self.n).astype("f8") @ self.u) * scale


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Fit]:
    """Fits by vector length from distinct whole vectors (one array column)."""
    parts = vectors.mapInArrow(_scatter, "dim int, i int, j int, limb int, v long")
    found: dict[int, dict] = {}
    for r in parts.groupBy("dim", "i", "j", "limb").agg(F.sum("v").alias("v")).toPandas().itertuples(index=False):
        key = (int(r.i), int(r.j))
        held = found.setdefault(int(r.dim), {})
        held[key] = held.get(key, 0) + (int(r.v) << (LIMB * int(r.limb)))
    fits = {}
    for d, held in found.items():
        products = np.zeros((d, d), object)
        for (i, j), v in held.items():
            if j >= 0:
                products[i, j] = products[j, i] = v
        fits[d] = Fit(held[-1, -1], [held.get((i, -1), 0) for i in range(d)], products, components)
    return fits


def _identity_error(distinct: DataFrame, fits: dict[int, Fit]) -> dict[int, float | None]:
    """Largest absolute entry of the whitened covariance minus the identity, by vector length, measured over the fit list."""
    most = max((len(f.e) for f in fits.values()), default=0)

    def run(batches):
        for b in batches:
            for d, _, x in _rows(b.column(0)):
                w = fits[d].rows(x)[1]
                yield pa.RecordBatch.from_arrays([pa.array([d] * len(x), pa.int32()), pa.array(w.tolist(), pa.list_(pa.float64()))], names=["dim", "w"])

    pairs = [(a, b) for a in range(most) for b in range(a, most)]
    w = distinct.mapInArrow(run, "dim int, w array<double>")
    if not pairs:
        return {d: None for d in fits}
    cov = w.groupBy("dim").agg(*[F.covar_pop(F.get("w", a), F.get("w", b)).alias(f"{a}_{b}") for a, b in pairs]).collect()   # a row per length
    out: dict[int, float | None] = {}
    for r in cov:
        f = fits[r.dim]
        off = [abs(r[f"{a}_{b}"] - (a == b)) for a, b in pairs if b < len(f.e) and f.whole[a] and f.whole[b]]
        out[r.dim] = max(off, default=None)
    return out


def whiten(vectors: DataFrame, vector_col: str = "embedding", out: str = "whitening", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """All columns but ``vector_col`` of every row with a whole, finite vector, plus a struct ``out``.

    Fields: n, deviation, deviation_exact (the same as text), whitened, explained
    (arrays by component), identity_error.

    * Rows whose vector is NULL or holds NULL, NaN or infinite entries are left out.
    * Vectors of each length are a fit of their own; empty vectors have no components.
    * Repeated vectors count once in the fit; every row of them is returned.
    * Of equal eigenvalues any basis may come, the same for all rows.  Where an eigenvalue is 0
      (as few distinct vectors as dimensions, or one) whitened is NULL, and explained 0 or, if all are 0, NULL.
    * ``deviation`` is NULL where it does not fit 64 bits; ``deviation_exact`` has it.
    * An empty table gives no rows; columns of any name pass through, but for ``out``, which must not be one.
    """
    rest = [c for c in vectors.columns if c != vector_col]
    if out.lower() in [c.lower() for c in rest]:
        raise ValueError(f"vectors has a column {out}")
    x = free_name(rest, "_x")
    keys = [f"c{i}" for i in range(len(rest))]
    ready = vectors.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(rest, keys)], whole_entries(F.col(f"`{vector_col}`"), scale).alias(x)).where(F.col(x).isNotNull())
    distinct = written(ready.select(x).distinct(), "whitening-fit")
    fits = fit(distinct, components)
    errors = _identity_error(distinct, fits)
    fields = StructType([StructField("n", LongType()), StructField("deviation", LongType()), StructField("deviation_exact", StringType()),
                         StructField("whitened", ArrayType(DoubleType())), StructField("explained", ArrayType(DoubleType())),
                         StructField("identity_error", DoubleType())])
    schema = StructType([*[StructField(k, vectors.schema[c].dataType) for c, k in zip(rest, keys)], *fields])

    def run(batches):
        for b in batches:
            for d, rows, values in _rows(b.column(x)):
                f, m = fits[d], len(rows)
                deviation, w = f.rows(values)
                lists = [[v if ok else None for v, ok in zip(row, f.whole)] for row in w.tolist()]
                taken = [b.column(k).take(pa.array(rows)) for k in keys]
                yield pa.RecordBatch.from_arrays(
                    [*taken, pa.array([f.n] * m, pa.int64()), pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64()),
                     pa.array(list(map(str, deviation)), pa.string()), pa.array(lists, pa.list_(pa.float64())),
                     pa.array([f.explained] * m, pa.list_(pa.float64())), pa.array([errors[d]] * m, pa.float64())], names=[*keys, *fields.names])

    done = ready.mapInArrow(run, schema)
    return done.select(*[F.col(k).alias(c) for c, k in zip(rest, keys)], F.struct(*fields.names).alias(out))


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = whiten(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).select("vec_id", "whitening.*")
    w = w.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "c"))
    return w.select("vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
                    F.col("c.explained").alias("explained"), "identity_error")
